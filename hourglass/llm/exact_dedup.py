"""Exact duplicate removal by a tree merge of digest runs.

Every row gets a 64-bit digest of its text and belongs to one of ``runs``
runs, chosen from its id.  A run holds, per distinct text, one entry with the
representative id, the number of rows and the 256-bit digest that verifies the
64-bit one; entries of a run are cut into slices by digest, so a
slice of a run is a bounded unit of work.  In merge round r the
runs whose numbers differ only in the bits of that round meet: each sends its
slices to the run that has those bits cleared.  There they are brought into one
order of digest, verifying digest and id, and merged in that order: of entries
that stand together the first, with the id to keep, stays and takes their sum of
rows (a window over the sorted slice, at most one entry per merged run).  After the last round run 0 holds one entry per text
of the whole table.  Copies are folded into one entry per run before anything
is exchanged, so a text that a third of all rows share costs one entry per run.

The answer then travels back down: each run looks its own entries up in run 0
and each row looks itself up in its own run (a key of text and run, so the
copies of one text are spread over all runs).

Null handling: a null text is the empty text.  A row without an id takes part
in its group's size but never represents it unless no row of the group has an
id.  Rows repeating both id and text are all returned, one of them kept.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass.llm.common import store, text_or_empty, whole_row


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64) -> DataFrame:
    """One row per document: id, 64-bit digest, verifying 256-bit digest, run."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(text).alias("_digest"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("_sha"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(runs)).cast("int").alias("_run"),
    )


def merge_runs(runs: DataFrame, first, bits: int, radix_bits: int, slices: int) -> DataFrame:
    """Merge rounds over sorted (run, digest) entries until run 0 is left.

    A round joins ``2**radix_bits`` runs (binomial tree of that radix).  Rows
    are dealt by (run, digest slice) and sorted, so a round is spread over all
    slices and the merge, which follows the order ``first`` of equal texts,
    needs no further exchange or sort.
    """
    same = ["_run", "_slice", "_digest", "_sha"]
    order = Window.partitionBy(*same).orderBy(first)
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = runs
    for low in range(0, bits, radix_bits):
        clear = ~(((1 << radix_bits) - 1) << low)
        merged = (
            merged.withColumn("_run", F.col("_run").bitwiseAND(F.lit(clear)))
            .withColumn("_slice", F.pmod("_digest", F.lit(slices)).cast("int"))
            .repartition("_run", "_slice")
            .sortWithinPartitions(*same, first)
            .withColumn("_at", F.row_number().over(order))
            .withColumn("_n", F.sum("_n").over(group))
            .filter("_at = 1")
            .drop("_slice", "_at")
        )
    return merged


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    bits: int = 6,
    radix_bits: int = 3,
    slices: int = 4096,
) -> DataFrame:
    """One row per input row: ``_id, _sha, _keep, _n, kept`` (see module text).

    ``keep`` chooses the smallest ("min") or largest ("max") id of a group;
    ``2**bits`` runs are merged ``2**radix_bits`` at a time.
    """
    best = {"min": F.min, "max": F.max}[keep]
    rows = digest_rows(docs, id_col, text_col, 1 << bits)
    # rows of one text and run stand together: repeated rows and the run's
    # entry are both counted without another exchange
    ids = store(
        rows.repartition("_digest", "_run")
        .groupBy("_digest", "_sha", "_run", "_id")
        .agg(F.count(F.lit(1)).alias("_rows")),
        "digests",  # texts are read once; both directions of the tree use the digests
    )
    level0 = ids.groupBy("_digest", "_sha", "_run").agg(best("_id").alias("_keep"), F.sum("_rows").alias("_n"))
    first = F.col("_keep").asc_nulls_last() if keep == "min" else F.col("_keep").desc_nulls_last()
    root = merge_runs(level0, first, bits, radix_bits, slices).drop("_run")
    # down the tree: run entries against the root, then rows against their run
    answers = level0.select("_digest", "_sha", "_run").join(root, ["_digest", "_sha"])
    found = ids.join(answers, ["_digest", "_sha", "_run"])
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return copies.select(
        "_id", "_sha", "_keep", "_n",
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", **tree) -> DataFrame:
    """``docs`` without later copies, all columns retained, whatever their names.

    Dropped are the rows whose id is not the group's representative; of rows
    repeating id and text one is left.  The rows that stay are found by id and
    digest; only rows known to be repeated are compared as a whole again.
    """
    classes = exact_classes(docs, id_col, text_col, keep, **tree)
    stay = (
        classes.groupBy("_id", "_sha")
        .agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
        .filter("_kept")
        .select(F.col("_id").alias("_kid"), F.col("_sha").alias("_ksha"), "_rows")
    )
    sha = F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))
    tagged = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("_own"), sha.alias("_sha_row"))
    left = tagged.join(stay, F.col("_own").eqNullSafe(F.col("_kid")) & (F.col("_sha_row") == F.col("_ksha")))
    once = left.filter("_rows = 1").select("_row.*")
    again = left.filter("_rows > 1").dropDuplicates(["_kid", "_ksha"]).select("_row.*")
    return once.unionByName(again)
