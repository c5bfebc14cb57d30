"""Queries for messages, scoring helpers, scalar functions and the
streaming jobs (run to completion on a file source)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X
from hourglass.operators import clean, stats, timeaxis
from hourglass.plans.catalog import query, r6
from hourglass.session import ensure_checkpoint_dir
from hourglass.sources.tables import read_table, table_path
from hourglass.streaming import jobs
from hourglass.streaming import messages as M

K_SCHEMA = T.StructType([T.StructField("k", T.DoubleType()), T.StructField("missing", T.DoubleType())])

# Undecodable messages are derived from the table: rows of one event type
# arrive with a broken JSON prefix.
def _msg_col():
    return F.when(F.col("event_type") == "error", F.concat(F.lit("{bad json "), F.col("props"))).otherwise(F.col("props"))
_MSG_SQL = "CASE WHEN event_type = 'error' THEN '{bad json ' || props ELSE props END"


def _messages(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value", "props"])
    return ev.withColumn("msg", _msg_col())


@query(
    "json_decode_raw",
    f"""SELECT event_id, CASE WHEN json_valid(msg) THEN TRY_CAST(json_extract_string(msg, '$.k') AS DOUBLE) END AS k,
       CASE WHEN json_valid(msg) THEN NULL ELSE msg END AS raw
FROM (SELECT event_id, {_MSG_SQL} AS msg FROM events)""",
)
def json_decode_raw(spark, sf_dir):
    d = M.decode(_messages(spark, sf_dir), "msg", K_SCHEMA)
    return d.select("event_id", "k", "raw")


@query(
    "ingest_counters",
    f"""SELECT event_type AS series, CAST(count(*) FILTER (WHERE json_valid(msg)) AS BIGINT) AS processed,
       CAST(count(*) FILTER (WHERE NOT json_valid(msg)) AS BIGINT) AS failed
FROM (SELECT event_type, {_MSG_SQL} AS msg FROM events) GROUP BY 1""",
)
def ingest_counters(spark, sf_dir):
    """L5 in batch form: decoded and dead-lettered message counts per key."""
    d = M.decode(_messages(spark, sf_dir), "msg", K_SCHEMA)
    return d.groupBy(F.col("event_type").alias("series")).agg(
        F.count_if(F.col("raw").isNull()).cast("long").alias("processed"),
        F.count_if(F.col("raw").isNotNull()).cast("long").alias("failed"),
    )


@query(
    "json_roundtrip",
    "SELECT event_id, event_type AS event_type_rt, value AS value_rt FROM events",
)
def json_roundtrip(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    enc = ev.select("event_id", M.encode(["event_id", "event_type", "value"]).alias("txt"))
    schema = "event_id bigint, event_type string, value double"
    dec = enc.select(F.from_json("txt", schema, M.JSON_OPTIONS).alias("m"))
    return dec.select(F.col("m.event_id").alias("event_id"), F.col("m.event_type").alias("event_type_rt"),
                      X.nan_to_null(F.col("m.value")).alias("value_rt"))


@query(
    "publish_payload",
    "SELECT event_type AS key, CAST(json_object('event_id', event_id, 'event_type', event_type, 'value', value) AS VARCHAR) AS value FROM events",
)
def publish_payload(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    return M.payload(ev, "event_type", ["event_id", "event_type", "value"])


def _k_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "value", "props"])
    return ev.select("event_id", "value", F.from_json("props", K_SCHEMA, M.JSON_OPTIONS)["k"].alias("k"))


@query(
    "drift_check",
    """WITH e AS (SELECT event_id, value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
st AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk FROM e)
SELECT event_id, round(greatest(CASE WHEN sv > 0 THEN abs(value - mv) / sv END,
                                 CASE WHEN sk > 0 THEN abs(k - mk) / sk END), 6) AS max_abs_z,
       coalesce(greatest(CASE WHEN sv > 0 THEN abs(value - mv) / sv END,
                         CASE WHEN sk > 0 THEN abs(k - mk) / sk END) > 3, false) AS drift
FROM e, st""",
)
def drift_check(spark, sf_dir):
    """L7 + L8: training statistics (E3) read once, then a per-row drift flag."""
    e = _k_events(spark, sf_dir)
    st = M.stats_dict(stats.feature_stats(e, ["value", "k"]))
    return r6(M.drift_columns(e, st).select("event_id", "max_abs_z", "drift"))


@query(
    "score_defaults",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k,
       coalesce(TRY_CAST(json_extract_string(props, '$.missing') AS DOUBLE), 0.0) AS missing, value FROM events""",
)
def score_defaults(spark, sf_dir):
    """Absent or non-numeric scoring inputs become 0.0."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "value", "props"])
    p = ev.select("event_id", "value", F.from_json("props", K_SCHEMA, M.JSON_OPTIONS).alias("p"))
    return p.select("event_id", clean.fill_default("p.k").alias("k"), clean.fill_default("p.missing").alias("missing"),
                    "value")


@query(
    "threshold_alert",
    """SELECT event_id, coalesce(value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS alert_value
FROM events WHERE coalesce(value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) > 300""",
)
def threshold_alert(spark, sf_dir):
    """B12 + B15 + L3: primary field, else the fallback field; alert above 300."""
    e = _k_events(spark, sf_dir)
    return jobs.threshold_alerts(e, 300.0, "value", "k").select("event_id", "alert_value")


@query(
    "scalar_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(day(ts) AS BIGINT) AS day, CAST(month(ts) AS BIGINT) AS month, CAST(isodow(ts) - 1 AS BIGINT) AS dow,
       date_trunc('day', ts) AS day_start FROM events""",
)
def scalar_time(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    return ev.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.hour("ts").cast("long").alias("hour"),
        F.dayofmonth("ts").cast("long").alias("day"), F.month("ts").cast("long").alias("month"),
        X.day_of_week("ts").cast("long").alias("dow"), timeaxis.truncate("ts", "day").alias("day_start"))


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, round(abs(l_discount - 0.05), 6) AS abs_dev, round(sqrt(l_quantity), 6) AS sqrt_q,
       CAST(ceil(l_extendedprice / 1000.0) AS BIGINT) AS ceil_k, CAST(floor(l_extendedprice / 1000.0) AS BIGINT) AS floor_k,
       CAST(l_orderkey % 7 AS BIGINT) AS mod7, CAST(l_orderkey // 7 AS BIGINT) AS div7,
       round(sin(2 * pi() * l_linenumber / 7), 6) AS sin_l, round(cos(2 * pi() * l_linenumber / 7), 6) AS cos_l,
       round(least(greatest(l_tax, 0.02), 0.06), 6) AS clipped
FROM lineitem""",
)
def scalar_math(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_quantity",
                                                "l_extendedprice", "l_tax"])
    s, c = X.cyclic("l_linenumber", 7)
    return r6(li.select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_discount") - 0.05).alias("abs_dev"),
        F.sqrt("l_quantity").alias("sqrt_q"), F.ceil(F.col("l_extendedprice") / 1000.0).cast("long").alias("ceil_k"),
        F.floor(F.col("l_extendedprice") / 1000.0).cast("long").alias("floor_k"),
        (F.col("l_orderkey") % 7).cast("long").alias("mod7"), (F.col("l_orderkey") / 7).cast("long").alias("div7"),
        s.alias("sin_l"), c.alias("cos_l"), X.clip("l_tax", 0.02, 0.06).alias("clipped")))


def _stream_path(sf_dir: str, name: str) -> str:
    """A glob that matches exactly the table's file (a file stream source
    takes a directory or a glob, not a bare file)."""
    p = table_path(sf_dir, name)
    return p[:-1] + "[" + p[-1] + "]"


def _scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@query(
    "stream_hourly",
    """SELECT event_type AS series, date_trunc('hour', ts) AS ts_hour, round(avg(value), 6) AS value_mean, count(*) AS n
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def stream_hourly(spark, sf_dir):
    """The events file read as a stream (availableNow), hourly means per
    event type with a one-hour lateness bound, written to a checkpointed
    Parquet sink. A second run at the end of the input writes the hours that
    are still open; returns the sink contents."""
    src = table_path(sf_dir, "events")
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(_stream_path(sf_dir, "events"))
    sink, ckpt, end = (_scratch(spark, f"stream_hourly{x}") for x in ("", "_ckpt", "_end"))
    whole = jobs.with_end(stream, "ts", end)
    out = jobs.hourly_stream(whole.withColumnRenamed("event_type", "series"), ["series"], "ts", ["value"])

    def run():
        q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
        jobs.run_available(q)

    run()
    jobs.end_input(spark, schema, "ts", end)
    run()
    return r6(spark.read.schema(out.schema).parquet(sink))


@query(
    "stream_ingest",
    f"""SELECT event_id, CASE WHEN json_valid(msg) THEN TRY_CAST(json_extract_string(msg, '$.k') AS DOUBLE) END AS k,
       CASE WHEN json_valid(msg) THEN TRY_CAST(json_extract_string(msg, '$.missing') AS DOUBLE) END AS missing,
       CASE WHEN json_valid(msg) THEN NULL ELSE msg END AS raw
FROM (SELECT event_id, {_MSG_SQL} AS msg FROM events)""",
)
def stream_ingest(spark, sf_dir):
    """Messages decoded from a stream into a checkpointed
    Parquet sink (dead letters kept in ``raw``); returns the sink contents."""
    src = table_path(sf_dir, "events")
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).parquet(_stream_path(sf_dir, "events"))
              .withColumn("msg", _msg_col()).select("event_id", "msg"))
    sink, ckpt = _scratch(spark, "ingest"), _scratch(spark, "ingest_ckpt")
    q = jobs.ingest(stream, "msg", sink, ckpt, schema=K_SCHEMA)
    jobs.run_available(q)
    return spark.read.parquet(sink).select("event_id", "k", "missing", "raw")


SPANS = (3, 6, 12, 24)


def _features_sql() -> str:
    lags = ", ".join(f"lag(value, {k}) OVER o AS value_lag{k}" for k in (1, 2, 3, 24))
    rolls = ", ".join(f"avg(value) OVER (o ROWS {w - 1} PRECEDING) AS value_roll_mean_{w}, "
                      f"coalesce(stddev_samp(value) OVER (o ROWS {w - 1} PRECEDING), 0.0) AS value_roll_std_{w}" for w in SPANS)
    first = ", ".join(f"value AS value_ema_{s}" for s in SPANS)
    then = ", ".join(f"m.value_ema_{s} + (2.0::DOUBLE / {s + 1}) * (e.value - m.value_ema_{s})" for s in SPANS)
    emas = ", ".join(f"value_ema_{s}" for s in SPANS)
    return f"""WITH RECURSIVE e AS (
  SELECT event_type AS series, ts, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
m AS (SELECT series, i, {first} FROM e WHERE i = 1
  UNION ALL SELECT e.series, e.i, {then} FROM m JOIN e ON e.series = m.series AND e.i = m.i + 1),
f AS (SELECT series, ts, event_id, value, i, {lags}, {rolls} FROM e WINDOW o AS (PARTITION BY series ORDER BY ts, event_id))
SELECT f.* EXCLUDE (i), {emas}, false AS late FROM f JOIN m ON f.series = m.series AND f.i = m.i"""


@query("stream_features", _features_sql())
def stream_features(spark, sf_dir):
    """Online lag/rolling/EMA features per event type from the events
    stream, with bounded keyed state; returns the sink contents."""
    from hourglass.streaming.features import feature_stream

    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    stream = (spark.readStream.schema(schema).parquet(_stream_path(sf_dir, "events"))
              .select(F.col("event_type").alias("series"), "ts", "event_id", "value"))
    sink, ckpt = _scratch(spark, "features"), _scratch(spark, "features_ckpt")
    q = feature_stream(stream, "series", "ts", "value", sink, ckpt, spans=SPANS, tie="event_id")
    jobs.run_available(q)
    return spark.read.parquet(sink).drop("batch")
