"""Structured Streaming jobs: source/sink builders, checkpointed ingest with
observed counters, watermarked hourly means and online scoring.

Sources and sinks are parameters: Kafka in production (the connector jar
must be on the classpath), a file source in tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X
from hourglass.streaming import messages as M


def kafka_source(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                 max_offsets: int | None = None):
    """A3: subscribe from the earliest offset; offsets live in the query checkpoint."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if group:
        r = r.option("kafka.group.id", group)
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """A4: keyed JSON records to a topic with acks=all (df has key, value)."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.acks", "all").option("checkpointLocation", checkpoint))


def ingest(stream: DataFrame, text_col: str, sink_path: str, checkpoint: str, clean_bounds=None,
           partition_by: Sequence[str] = (), rows_per_file: int | None = None, schema: T.StructType = M.MESSAGE_SCHEMA):
    """A5 + L1 + L4 + L5 + L10: decode by ``schema`` -> optional clip -> Parquet sink.

    The checkpoint records offsets and committed files together, so a
    restart neither loses nor duplicates rows (the reference committed
    offsets before writing). ``processed``/``failed`` counters are observed
    metrics of every micro-batch. Returns the started query.
    """
    from hourglass.operators.clean import range_clip

    d = M.decode(stream, text_col, schema)
    if clean_bounds:
        d = range_clip(d, clean_bounds)
    d = d.observe("ingest", F.count(F.lit(1)).alias("processed"), F.count_if(F.col("raw").isNotNull()).alias("failed"))
    w = d.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", str(rows_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(availableNow=True).start()


def threshold_alerts(stream: DataFrame, threshold: float = M.ALERT_THRESHOLD,
                     primary: str = M.ALERT_FIELD, fallback: str = M.ALERT_FALLBACK) -> DataFrame:
    """L3 + B15: stateless per-message alert rows."""
    return stream.withColumn("alert_value", M.alert_value(primary, fallback)).where(F.col("alert_value") > threshold)


def hourly_stream(stream: DataFrame, series: Sequence[str], ts: str, cols: Sequence[str],
                  lateness: str = "1 hour") -> DataFrame:
    """Hourly means per series with a lateness bound. Event time is cast
    to TIMESTAMP (watermarks reject TIMESTAMP_NTZ); an hour is emitted once
    the watermark passes its end (append mode)."""
    t = stream.withColumn("__et", F.col(ts).cast("timestamp")).withWatermark("__et", lateness)
    return t.groupBy(F.window("__et", "1 hour").alias("w"), *series).agg(
        *[F.avg(X.nan_to_null(c)).alias(f"{c}_mean") for c in cols], F.count(F.lit(1)).alias("n")
    ).select(*series, F.col("w.start").cast("timestamp_ntz").alias("ts_hour"), *[f"{c}_mean" for c in cols], "n")


END = "9999-12-01 00:00:00"


def _end_rows(spark: SparkSession, schema: T.StructType, ts: str, n: int) -> DataFrame:
    return spark.range(n).select(*[F.lit(END if f.name == ts else None).cast(f.dataType).alias(f.name) for f in schema])


def with_end(stream: DataFrame, ts: str, folder: str) -> DataFrame:
    """``stream`` and the rows of ``folder``, where ``end_input`` puts the row
    that closes all open windows."""
    spark = stream.sparkSession
    _end_rows(spark, stream.schema, ts, 0).write.mode("ignore").parquet(folder)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def end_input(spark: SparkSession, schema: T.StructType, ts: str, folder: str) -> None:
    """Say that no more input comes: a row far in the future, whose own window
    is never written. The next run of the query moves the watermark past every
    open window."""
    _end_rows(spark, schema, ts, 1).write.mode("append").parquet(folder)


def score(stream: DataFrame, model, stats: dict[str, tuple[float, float]], features: Sequence[str],
          default: float = 0.0, drift_threshold: float = M.DRIFT_THRESHOLD, arrived: str | None = None) -> DataFrame:
    """L9 + M14 + L7 + A12: fill missing features with ``default``, score with
    a fitted PipelineModel (column ``prediction``) or with several (a dict of
    column name to model), flag drift, and shape a prediction-log row.

    ``latency_sec`` is the time from ``arrived`` (a timestamp column, such as
    the broker's) to the micro-batch that scores the row; NULL without it."""
    from hourglass.operators.clean import fill_default

    models = model if isinstance(model, dict) else {"prediction": model}
    t = stream.withColumns({f: fill_default(f, default) for f in features})
    t = M.drift_columns(t, stats, drift_threshold)
    for name, fitted in models.items():
        kept = [F.col(c) for c in t.columns]
        t = fitted.transform(t).select(*kept, F.col("prediction").alias(name))
    latency = (F.unix_micros(F.current_timestamp()) - F.unix_micros(F.col(arrived).cast("timestamp"))) / 1e6 if arrived else F.lit(None)
    t = t.withColumn("latency_sec", latency.cast("double"))
    failed = F.lit(False)
    for name in models:
        failed = failed | F.col(name).isNull() | F.isnan(name)
    # Prediction count, failed predictions, latency summary, drift gauge
    return t.observe(
        "scoring",
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(failed).alias("prediction_errors"),
        F.avg("latency_sec").alias("latency_avg"),
        F.max("latency_sec").alias("latency_max"),
        F.max(F.col("drift").cast("int")).alias("drift"),
    )


def prediction_log(scored: DataFrame, data_cols: Sequence[str], prediction_cols: dict[str, str]) -> DataFrame:
    """Topic, partition, offset, data{...}, predictions{...}, latency_sec, drift."""
    meta = [F.col(c) for c in ("topic", "partition", "offset") if c in scored.columns]
    return scored.select(
        *meta,
        F.struct(*[F.col(c) for c in data_cols]).alias("data"),
        F.struct(*[F.col(src).alias(name) for name, src in prediction_cols.items()]).alias("predictions"),
        "latency_sec", "drift",
    )


def bounded(stream_reader, max_per_trigger: int):
    """Consume at most ``max_per_trigger`` records per micro-batch
    (Kafka ``maxOffsetsPerTrigger``; file sources take ``maxFilesPerTrigger``)."""
    return stream_reader.option("maxOffsetsPerTrigger", str(max_per_trigger))


def run_available(query) -> None:
    """Drive an availableNow query to its end (bounded consumption, L10)."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
