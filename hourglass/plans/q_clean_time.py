"""Queries for cleaning (B) and time handling (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.operators import clean, stats, timeaxis
from hourglass.plans import frames
from hourglass.plans.catalog import query, r6
from hourglass.plans.sqlparts import HOURLY_CTE, LINEITEM4
from hourglass.sources.tables import read_table

KEY = ["l_orderkey", "l_linenumber"]


def _sql_clip(c: str, lo, hi) -> str:
    e = c
    if lo is not None:
        e = f"greatest({e}, {lo})"
    if hi is not None:
        e = f"least({e}, {hi})"
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE {e} END"


def _sql_clean(scale_first: bool) -> str:
    cols = LINEITEM4
    rng = frames.LINEITEM_RANGES
    s = ", ".join(f"nullif(CAST({c} AS DOUBLE), {frames.LINEITEM_SENTINEL}) AS {c}" for c in cols)
    imp = ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM s)) AS {c}" for c in cols)

    def clip_sel(src):
        return f"SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"{_sql_clip(c, *rng[c])} AS {c}" for c in cols
        ) + f" FROM {src}"

    def scale_sel(src):
        return f"SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"({c} - (SELECT min({c}) FROM {src})) / CASE WHEN (SELECT max({c}) - min({c}) FROM {src}) = 0 "
            f"THEN 1.0 ELSE (SELECT max({c}) - min({c}) FROM {src}) END AS {c}"
            for c in cols
        ) + f" FROM {src}"

    first, second = (scale_sel, clip_sel) if scale_first else (clip_sel, scale_sel)
    out = ", ".join(cols)  # unrounded: both engines compute the same doubles
    return f"""
WITH s AS (SELECT l_orderkey, l_linenumber, {s} FROM lineitem),
i AS (SELECT l_orderkey, l_linenumber, {imp} FROM s),
a AS ({first('i')}),
b AS ({second('a')})
SELECT l_orderkey, l_linenumber, {out} FROM b"""


@query(
    "resample_hourly",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, round(value_mean, 6) AS value_mean, n FROM hourly""",
)
def resample_hourly(spark, sf_dir):
    h = frames.hourly(spark, sf_dir)
    return r6(h.select("series", "ts_hour", "value_mean", "n"))


@query(
    "mean_impute",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, round(value, 6) AS value FROM himp""",
)
def mean_impute(spark, sf_dir):
    return r6(frames.hourly_imputed(spark, sf_dir).select("series", "ts_hour", "value"))


@query(
    "daily_profile",
    f"""WITH {HOURLY_CTE}
SELECT series, CAST(hour(ts_hour) AS BIGINT) AS hour_of_day, round(avg(value), 6) AS value_mean
FROM himp GROUP BY 1, 2""",
)
def daily_profile(spark, sf_dir):
    h = frames.hourly_imputed(spark, sf_dir)
    return r6(stats.profile(h, "ts_hour", ["value"], by="hour", series=["series"]))


@query(
    "weekly_profile",
    f"""WITH {HOURLY_CTE}
SELECT series, CAST(isodow(ts_hour) - 1 AS BIGINT) AS day_of_week, round(avg(value), 6) AS value_mean
FROM himp GROUP BY 1, 2""",
)
def weekly_profile(spark, sf_dir):
    h = frames.hourly_imputed(spark, sf_dir)
    return r6(stats.profile(h, "ts_hour", ["value"], by="dow", series=["series"]))


@query(
    "sentinel_to_null",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"nullif({c}, {frames.LINEITEM_SENTINEL}) AS {c}" for c in LINEITEM4)
    + " FROM lineitem",
)
def sentinel_to_null(spark, sf_dir):
    li = frames.lineitem4(spark, sf_dir, KEY)
    return clean.sentinel_to_null(li, LINEITEM4, frames.LINEITEM_SENTINEL)


# text "fields" derived from the event row: the JSON number text, a
# non-numeric label and the value printed as text
_NUMERIC_COERCE_SQL = r"""
SELECT event_id,
       TRY_CAST(regexp_extract(props, ':\s*([^}]*)\}', 1) AS DOUBLE) AS k_num,
       TRY_CAST(event_type AS DOUBLE) AS type_num,
       TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_num
FROM events"""


@query("numeric_coerce", _NUMERIC_COERCE_SQL)
def numeric_coerce(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "props", "event_type", "value"])
    texts = ev.select(
        "event_id",
        F.regexp_extract("props", r":\s*([^}]*)\}", 1).alias("k_num"),
        F.col("event_type").alias("type_num"),
        F.col("value").cast("string").alias("value_num"),
    )
    return clean.numeric_coerce(texts, ["k_num", "type_num", "value_num"])


@query(
    "rename_project",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS quantity, l_extendedprice, "
    "l_discount, l_tax AS tax, l_linestatus, l_shipdate FROM lineitem",
)
def rename_project(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    out = clean.rename_columns(li, {"l_quantity": "quantity", "l_tax": "tax", "l_comment": "comment"})
    return clean.drop_if_present(out, ["l_returnflag", "l_comment"])


@query(
    "range_clip",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"{_sql_clip(c, *frames.LINEITEM_RANGES[c])} AS {c}" for c in LINEITEM4)
    + " FROM lineitem",
)
def range_clip(spark, sf_dir):
    li = frames.lineitem4(spark, sf_dir, KEY)
    return clean.range_clip(li, frames.LINEITEM_RANGES)


@query(
    "minmax_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - (SELECT min({c}) FROM lineitem)) / CASE WHEN (SELECT max({c}) - min({c}) FROM lineitem) = 0 "
        f"THEN 1.0 ELSE (SELECT max({c}) - min({c}) FROM lineitem) END, 6) AS {c}"
        for c in LINEITEM4
    )
    + " FROM lineitem",
)
def minmax_scale(spark, sf_dir):
    li = frames.lineitem4(spark, sf_dir, KEY)
    return r6(clean.minmax_scale(li, LINEITEM4))


@query("clean_table", _sql_clean(scale_first=False))
def clean_table(spark, sf_dir):
    li = frames.lineitem4(spark, sf_dir, KEY)
    out = clean.clean_table(
        li, LINEITEM4, sentinel=frames.LINEITEM_SENTINEL, bounds=frames.LINEITEM_RANGES, scale_first=False
    )
    return out


@query("clean_table_scale_first", _sql_clean(scale_first=True))
def clean_table_scale_first(spark, sf_dir):
    li = frames.lineitem4(spark, sf_dir, KEY)
    out = clean.clean_table(
        li, LINEITEM4, sentinel=frames.LINEITEM_SENTINEL, bounds=frames.LINEITEM_RANGES, scale_first=True
    )
    return out


@query(
    "attach_target",
    "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, "
    "o.o_totalprice AS Target FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey",
)
def attach_target(spark, sf_dir):
    """A2: attach a target column aligned on the row key; rows without one keep NULL."""
    li = frames.lineitem4(spark, sf_dir, KEY)
    tgt = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("Target")
    )
    return li.join(tgt, "l_orderkey", "left")


@query(
    "parse_timestamp",
    """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text,
         strftime(o_orderdate, '%H:%M:%S') AS time_text
  FROM orders)
SELECT o_orderkey, ts FROM (
  SELECT o_orderkey, try_strptime(trim(date_text) || ' ' || trim(time_text), '%d/%m/%Y %H:%M:%S') AS ts FROM t)
WHERE ts IS NOT NULL""",
)
def parse_timestamp(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    text = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("date_text"),
        F.date_format("o_orderdate", "HH:mm:ss").alias("time_text"),
    )
    return timeaxis.parse_timestamp(text, "date_text", "time_text", out="ts").select("o_orderkey", "ts")


@query(
    "temporal_features",
    """SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(day(ts) AS BIGINT) AS day,
       CAST(month(ts) AS BIGINT) AS month, CAST((month(ts) % 12) // 3 + 1 AS BIGINT) AS season,
       CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week FROM events""",
)
def temporal_features(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    parts = timeaxis.temporal_parts("ts")
    return ev.select("event_id", *[v.cast("long").alias(k) for k, v in parts.items()])


@query(
    "cyclical_features",
    """SELECT event_id,
       round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
       round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_cos,
       round(sin(2 * pi() * (month(ts) - 1) / 12), 6) AS month_sin, round(cos(2 * pi() * (month(ts) - 1) / 12), 6) AS month_cos
FROM events""",
)
def cyclical_features(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    return r6(ev.select("event_id", *[v.alias(k) for k, v in timeaxis.cyclical_parts("ts").items()]))


@query(
    "row_index",
    """SELECT event_id, event_type AS series,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS BIGINT) AS idx
FROM events""",
)
def row_index(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "ts"]).withColumnRenamed("event_type", "series")
    return timeaxis.row_index(ev, ["series"], ["ts", "event_id"]).select("event_id", "series", "idx")


@query(
    "synthetic_time_index",
    """
WITH r AS (
  SELECT event_id, event_type AS series,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM events)
SELECT event_id, series, CAST(idx AS BIGINT) AS idx,
       TIMESTAMP '2024-02-01 00:00:00' - to_hours(CAST(n - 1 - idx AS BIGINT)) AS ts_synth
FROM r""",
)
def synthetic_time_index(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "ts"]).withColumnRenamed("event_type", "series")
    ix = timeaxis.row_index(ev, ["series"], ["ts", "event_id"])
    n = ev.groupBy("series").agg(F.count(F.lit(1)).alias("n"))
    out = timeaxis.synthetic_time_index(ix.join(n, "series"), "idx", "n", "2024-02-01 00:00:00")
    return out.select("event_id", "series", "idx", "ts_synth")

