"""Mixing sources to target token weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  Starting from the cells'
token counts, every round scales the cells so that each source's total meets
its target, then each language's, then each topic's (raking), until no
marginal is off by more than ``TOLERANCE`` of its target, or, after at
least ``ROUNDS``, until a round lowers the sum of the errors by less than 5 %,
as it does where no weights meet all targets (and where sources and languages
are so nearly tied that raking creeps).  A cell's factor is its raked weight over its tokens; divided
by the largest factor it is the inclusion probability of the cell's documents,
so the expected token shares of the sample are the targets and no probability
exceeds one.  Documents are drawn by a hash of their id.

The cell table is a grouped aggregate that stays distributed: rounds are
windows over it, each stored in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass.llm.common import store, whole_row

DIMS = ("source", "lang", "topic")
ROUNDS = 8  # written out in the SQL of op3
TOLERANCE = 1e-4
STALL = 0.95
WORDS = r"[^\x20\x09-\x0D]+"


def with_topic(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_tokens`` (words of the whole text) and ``_topic``, a
    rule for corpora without a topic column: legal, contact, else by length."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumn("_tokens", F.regexp_count(text, F.lit(WORDS)).cast("long"))  # counted once, used by the rule
    return counted.withColumn(
        "_topic",
        F.when(text.rlike("[Ll]icen[sc]e|rights reserved|[Cc]opyright"), "legal")
        .when(text.rlike("@|https?://"), "contact")
        .when(F.col("_tokens") < 100, "note").when(F.col("_tokens") < 1000, "article").otherwise("book"),
    )


def rake(cells: DataFrame, dims=DIMS, targets: dict | None = None, alpha: float = 0.85, rounds: int | None = None) -> DataFrame:
    """``cells`` (one row per combination of ``dims``, with ``tokens``) plus
    ``raked`` and ``probability``.

    ``targets[dim]`` maps values to shares; a dimension without an entry gets
    its own shares raised to ``alpha`` and normalised, which flattens it.
    Cells without tokens get probability 1 (they cost nothing).  ``rounds``
    fixes the number of rounds; without it they go on until the marginals hold.
    """
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    now = cells
    for d in dims:
        given = (targets or {}).get(d)
        if given:
            pairs = [x for k, v in given.items() for x in (F.lit(k), F.lit(float(v)))]
            now = now.withColumn(f"_t_{d}", F.coalesce(F.create_map(*pairs)[F.col(d)], F.lit(0.0)))
        else:
            own = cells.groupBy(F.col(d).alias("_v")).agg(F.sum("tokens").alias("_m")).filter("_m > 0")
            power = own.withColumn("_p", F.pow(F.col("_m").cast("double"), F.lit(alpha)))
            share = power.crossJoin(power.agg(F.sum("_p").alias("_all"))).select("_v", (F.col("_p") / F.col("_all")).alias(f"_t_{d}"))
            now = now.join(share, F.col(d).eqNullSafe(F.col("_v")), "left").drop("_v").fillna(0.0, [f"_t_{d}"])
    now = store(now.withColumn("_w", F.col("tokens").cast("double")).withColumn("_total", total.cast("double")), "rake")
    turn, off, gap, last = 0, float("inf"), float("inf"), float("inf")
    while turn < rounds if rounds is not None else turn == 0 or (off > TOLERANCE and (turn < ROUNDS or gap < STALL * last)):
        for d in dims:
            have = F.sum("_w").over(Window.partitionBy(d))
            now = now.withColumn("_w", F.coalesce(F.try_divide(F.col("_w") * F.col(f"_t_{d}") * F.col("_total"), have), F.lit(0.0)))
        now = store(now, "rake")
        turn += 1
        if rounds is None:
            last, (off, gap) = gap, _off(now, dims)
    factor = F.try_divide(F.col("_w"), F.col("tokens"))
    top = now.agg(F.max(factor).alias("_top"))  # one row
    return now.crossJoin(top).select(
        *dims, "tokens", F.col("_w").alias("raked"),
        F.when(F.col("tokens") == 0, 1.0).otherwise(F.coalesce(F.try_divide(factor, F.col("_top")), F.lit(0.0))).alias("probability"),
    )


def _off(now: DataFrame, dims) -> tuple[float, float]:
    """Largest relative error of a marginal, and the sum of all errors (which
    raking never raises) as a share of the tokens."""
    parts = [now.groupBy(d).agg(F.sum("_w").alias("have"), F.max(F.col(f"_t_{d}") * F.col("_total")).alias("due"), F.max("_total").alias("all"))
             .select("have", "due", "all") for d in dims]
    miss = F.abs(F.col("have") - F.col("due"))
    row = reduce(DataFrame.unionByName, parts).agg(F.max(F.try_divide(miss, F.col("due"))), F.sum(F.try_divide(miss, F.col("all")))).first()
    return row[0] or 0.0, row[1] or 0.0


def draw(id_col: str = "doc_id", seed: str = "mix"):
    """Uniform number in [0, 1) from the id (missing ids draw like text "null")."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        topic_col: str | None = None, targets: dict | None = None, alpha: float = 0.85, seed: str = "mix",
        rounds: int | None = None) -> DataFrame:
    """Per input row ``_id, _source, _lang, _topic, _tokens, probability,
    sampled``.  Null sources, languages and topics are values of their own;
    null text has no tokens; rows repeating an id share its draw."""
    rows = store(_keyed(docs, text_col, source_col, lang_col, topic_col, F.col(id_col).cast("long").alias("_id")), "mix-rows")
    cells = rake_rows(rows, targets, alpha, rounds)
    return _joined(rows, cells).withColumn("sampled", draw("_id", seed) < F.col("probability")).select(
        "_id", "_source", "_lang", "_topic", "_tokens", "probability", "sampled")


def sample_mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   lang_col: str = "lang", topic_col: str | None = None, targets: dict | None = None,
                   alpha: float = 0.85, seed: str = "mix") -> DataFrame:
    """The sampled rows of ``docs`` with their columns, whatever their names.
    An empty table gives an empty one; rows repeating an id share its draw."""
    cells = rake_rows(_keyed(docs, text_col, source_col, lang_col, topic_col), targets, alpha)
    rows = _keyed(docs, text_col, source_col, lang_col, topic_col, whole_row(docs), draw(id_col, seed).alias("_draw"))
    return _joined(rows, cells).filter(F.col("_draw") < F.col("probability")).select("_row.*")


def _keyed(docs, text_col, source_col, lang_col, topic_col, *more) -> DataFrame:
    """``more`` columns, cell and tokens of every row; no other column of ``docs``."""
    own = [F.col(text_col).alias("_text"), F.col(source_col).alias("_source"), F.col(lang_col).alias("_lang")]
    if topic_col:
        own.append(F.col(topic_col).cast("string").alias("_given"))
    keyed = with_topic(docs.select(*more, *own), "_text")
    if topic_col:
        keyed = keyed.withColumn("_topic", F.col("_given")).drop("_given")
    return keyed.drop("_text")


def rake_rows(rows: DataFrame, targets: dict | None = None, alpha: float = 0.85, rounds: int | None = None) -> DataFrame:
    cells = store(
        rows.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"))
        .agg(F.sum("_tokens").alias("tokens")), "cells")
    return store(rake(cells, DIMS, targets, alpha, rounds), "raked")


def _joined(rows: DataFrame, cells: DataFrame) -> DataFrame:
    same = (F.col("_source").eqNullSafe(F.col("c.source")) & F.col("_lang").eqNullSafe(F.col("c.lang"))
            & F.col("_topic").eqNullSafe(F.col("c.topic")))
    cell = cells.alias("c")
    return rows.join(cell, same).drop(cell["source"], cell["lang"], cell["topic"], cell["tokens"], cell["raked"])


def oracle(rounds: int = ROUNDS, alpha: float = 0.85) -> str:
    """DuckDB SQL of ``op3``: the rounds written out one after the other."""
    sql = [f"""WITH d0 AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS tokens FROM documents),
d AS MATERIALIZED (
  SELECT doc_id, source, lang, tokens,
         CASE WHEN regexp_matches(text, '[Ll]icen[sc]e|rights reserved|[Cc]opyright') THEN 'legal'
              WHEN regexp_matches(text, '@|https?://') THEN 'contact'
              WHEN tokens < 100 THEN 'note' WHEN tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM d0),
c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL)"""]
    for d in DIMS:
        sql.append(f"""m_{d} AS (SELECT {d} AS v, pow(sum(tokens), {alpha}) AS p FROM c GROUP BY 1),
t_{d} AS MATERIALIZED (SELECT v, p / sum(p) OVER () AS t FROM m_{d})""")
    sql.append("""w_0 AS MATERIALIZED (
  SELECT c.*, tokens AS w, sum(tokens) OVER () AS total, a.t AS t_source, b.t AS t_lang, e.t AS t_topic
  FROM c JOIN t_source a ON c.source IS NOT DISTINCT FROM a.v JOIN t_lang b ON c.lang IS NOT DISTINCT FROM b.v
         JOIN t_topic e ON c.topic IS NOT DISTINCT FROM e.v)""")
    n = 0
    for _ in range(rounds):
        for d in DIMS:
            sql.append(f"""w_{n + 1} AS MATERIALIZED (
  SELECT * REPLACE (w * t_{d} * total / sum(w) OVER (PARTITION BY {d}) AS w) FROM w_{n})""")
            n += 1
    return ",\n".join(sql) + f""",
p AS (SELECT source, lang, topic, (w / tokens) / max(w / tokens) OVER () AS probability FROM w_{n})
SELECT d.doc_id, d.source, d.lang, d.topic, CAST(d.tokens AS BIGINT) AS tokens, round(p.probability, 6) AS probability,
       CAST('0x' || substr(md5('mix:' || CAST(d.doc_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 < p.probability AS sampled
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic IS NOT DISTINCT FROM p.topic
"""
