"""Queries for aggregations and correlations (E, H2, J2)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from hourglass.functions import exprs as X
from hourglass.operators import stats
from hourglass.plans import frames
from hourglass.plans.catalog import query, r6
from hourglass.plans.sqlparts import LINEITEM4
from hourglass.sources.tables import read_table

PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_NUMERIC = {"p_partkey", "p_size", "p_retailprice"}
FEATURES = [*LINEITEM4, "l_linenumber"]


def _col_stats_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"""
        for c in LINEITEM4
    ]
    return "\nUNION ALL\n".join(parts)


def _qc_sql() -> str:
    parts = []
    for c in PART_COLS:
        if c in PART_NUMERIC:
            st = (f"round(avg({c}), 6), round(stddev_samp({c}), 6), round(CAST(min({c}) AS DOUBLE), 6), "
                  f"round(CAST(max({c}) AS DOUBLE), 6)")
        else:
            st = "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS "column", count(*) AS total, count(*) - count({c}) AS missing,
       round(CASE WHEN count(*) > 0 THEN (count(*) - count({c})) / count(*) ELSE 0.0 END, 6) AS pct_missing,
       {st} FROM part"""
        )
    body = "\nUNION ALL\n".join(parts)
    return f'SELECT "column", total, missing, pct_missing, c4 AS mean, c5 AS std, c6 AS min, c7 AS max FROM ({body}) AS t("column", total, missing, pct_missing, c4, c5, c6, c7)'


def _feature_stats_sql() -> str:
    dt = {"l_linenumber": "int32"}
    parts = [
        f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
       count({c}) AS non_null_count, '{dt.get(c, "float64")}' AS dtype FROM lineitem"""
        for c in FEATURES
    ]
    return "\nUNION ALL\n".join(parts)


def _corr_sql(pairs_only: bool = False) -> str:
    rows = []
    for a, b in combinations(LINEITEM4, 2):
        n = f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        r = f"CASE WHEN {n} >= 3 AND NOT isnan(corr({a}, {b})) THEN round(corr({a}, {b}), 6) END"
        rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {n} AS n, {r} AS r FROM lineitem")
        if not pairs_only:
            rows.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {n} AS n, {r} AS r FROM lineitem")
    if not pairs_only:
        for c in LINEITEM4:
            rows.append(f"SELECT '{c}' AS col_a, '{c}' AS col_b, count({c}) AS n, 1.0 AS r FROM lineitem")
    return "\nUNION ALL\n".join(rows)


@query("column_stats", _col_stats_sql())
def column_stats(spark, sf_dir):
    return r6(stats.column_stats(frames.lineitem4(spark, sf_dir), LINEITEM4))


@query("qc_summary", _qc_sql())
def qc_summary(spark, sf_dir):
    part = read_table(spark, sf_dir, "part", PART_COLS)
    return r6(stats.qc_summary(part))


@query("feature_stats", _feature_stats_sql())
def feature_stats(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", FEATURES)
    return r6(stats.feature_stats(li, FEATURES))


@query(
    "median_mad",
    """
WITH m AS (SELECT l_suppkey, median(l_extendedprice) AS median FROM lineitem GROUP BY 1)
SELECT m.l_suppkey, round(m.median, 6) AS median, round(median(abs(l.l_extendedprice - m.median)), 6) AS mad
FROM lineitem l JOIN m USING (l_suppkey) GROUP BY m.l_suppkey, m.median""",
)
def median_mad(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_extendedprice"])
    return r6(stats.median_mad(li, ["l_suppkey"], "l_extendedprice"))


@query("corr_matrix", _corr_sql())
def corr_matrix(spark, sf_dir):
    return r6(stats.corr_matrix(frames.lineitem4(spark, sf_dir), LINEITEM4))


@query("corr_pairs", _corr_sql(pairs_only=True))
def corr_pairs(spark, sf_dir):
    c = stats.corr_matrix(frames.lineitem4(spark, sf_dir), LINEITEM4)
    return r6(stats.corr_pairs(c, LINEITEM4))


def _top_sql() -> str:
    return f"""
WITH p AS ({_corr_sql(pairs_only=True)})
SELECT CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, col_a DESC, col_b DESC) AS BIGINT) AS rank,
       col_a, col_b, r
FROM p ORDER BY rank LIMIT 5"""


@query("top_correlations", _top_sql())
def top_correlations(spark, sf_dir):
    c = stats.corr_matrix(frames.lineitem4(spark, sf_dir), LINEITEM4)
    return r6(stats.top_correlations(r6(c), LINEITEM4, 5))


def _raw_corr_sql() -> str:
    """Unrounded r of every ordered pair and the diagonal."""
    rows = []
    for a in LINEITEM4:
        for b in LINEITEM4:
            n = f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            r = "1.0::DOUBLE" if a == b else f"CASE WHEN {n} >= 3 AND NOT isnan(corr({a}, {b})) THEN corr({a}, {b}) END"
            rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {n} AS n, {r} AS r FROM lineitem")
    return "\nUNION ALL\n".join(rows)


@query(
    "corr_pvalues",
    f"""WITH RECURSIVE cm AS MATERIALIZED ({_raw_corr_sql()}),
{stats.pearson_pvalues_sql("cm")},
o AS (SELECT col_a, col_b, n, round(r, 6) AS r, CASE WHEN col_a <> col_b THEN p END AS q FROM pval)
SELECT col_a, col_b, n, r, round(q, 6) AS p,
       CASE WHEN q IS NULL THEN '' WHEN q < 0.001 THEN '***' WHEN q < 0.01 THEN '**' WHEN q < 0.05 THEN '*' ELSE '' END AS stars,
       printf('%.12e', round(q, 6)) AS p_text FROM o""",
)
def corr_pvalues(spark, sf_dir):
    """P-values (the text form shows the rounded value)."""
    c = stats.corr_matrix(frames.lineitem4(spark, sf_dir), LINEITEM4)
    return r6(stats.corr_pvalues(c)).withColumn("p_text", X.sci12("p"))


@query(
    "significance_stars",
    """SELECT l_orderkey, l_linenumber, l_discount AS p,
       CASE WHEN l_discount IS NULL THEN '' WHEN l_discount < 0.001 THEN '***' WHEN l_discount < 0.01 THEN '**'
            WHEN l_discount < 0.05 THEN '*' ELSE '' END AS stars FROM lineitem""",
)
def significance_stars(spark, sf_dir):
    """E11 applied to a probability-like column of the table."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount"])
    return li.select("l_orderkey", "l_linenumber", F.col("l_discount").alias("p"),
                     X.significance_stars("l_discount").alias("stars"))


@query(
    "pvalue_format",
    """SELECT l_orderkey, l_linenumber, printf('%.12e', l_extendedprice / 1000000.0) AS p_text FROM lineitem""",
)
def pvalue_format(spark, sf_dir):
    """A6 text form ``%.12e`` (blank for NULL) of a ratio in the table."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return li.select("l_orderkey", "l_linenumber", X.sci12(F.col("l_extendedprice") / 1000000.0).alias("p_text"))
