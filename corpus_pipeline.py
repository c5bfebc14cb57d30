"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; ``run`` writes each result as Parquet in the shared folder
and rereads it for the next stage.  All stages but the last return the columns
of ``docs``.  Null handling, ties, repeated rows, empty tables and extra columns
follow the operators (see their modules).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm import exact_dedup, langid, mixing, packing, simhash
from hourglass.llm.common import store
from hourglass.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised: ``und`` texts (null, empty, without a
    letter) and those flagged as ambiguous between languages go."""
    model = langid.train(docs.filter(langid.learnable("doc_id")))
    return langid.recognised(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of every group linked by SimHash
    fingerprints of 3-word shingles at no more than two bits."""
    return simhash.simhash_dedup(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample by probabilities raked to flattened source, language and topic shares."""
    return mixing.sample_mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 1024 tokens, with their ids."""
    return packing.pack_documents(docs, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mix_to_targets", mix),
    ("packing", pack),
]

# language ID and packing are not expressible in SQL; tests compare run() with
# a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage-{name}")
    return docs
