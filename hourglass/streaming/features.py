"""Streaming lag / rolling / EMA features per series.

Every micro-batch is one set of distributed batch operators: the last ``reach``
rows of each series are put before its new rows, positions come from the
distributed row index, features from halo-bucket windows and the blocked EMA
scan, so no task holds a series. What a series leaves behind - its last rows,
place and one EMA value per span - is one row of the state table, written per
micro-batch next to the features; both are replaced as a whole when a
micro-batch is repeated. A row placed before the last one of its series, or
without a time, comes too late to change what was written: it is emitted once
with ``late`` true and NULL features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators import ema, timeaxis, windows
from hourglass.session import materialize


def feature_names(col: str, lags: Sequence[int], windows: Sequence[int], spans: Sequence[int]) -> list[str]:
    return ([f"{col}_lag{k}" for k in lags] + [f"{col}_roll_mean_{w}" for w in windows]
            + [f"{col}_roll_std_{w}" for w in windows] + [f"{col}_ema_{s}" for s in spans])


def read_state(spark: SparkSession, folder: str, batch: int, schema: str) -> DataFrame:
    """State left by the micro-batch before ``batch`` (none before the first)."""
    if batch == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/batch={batch - 1}")


def with_lateness(state: DataFrame, rows: DataFrame, series: str, ts: str, tie: str) -> DataFrame:
    """Checkpointed ``rows`` with their order of arrival (``__seq``) and ``late``:
    placed before the last row of their series, or without a time. ``state`` has
    series, ``last_ts`` and ``last_tie``."""
    new = materialize(rows.withColumn("__seq", F.monotonically_increasing_id()))
    before = state.select(F.col(series).alias("__series"), "last_ts", "last_tie")
    late = F.col(ts).isNull() | F.coalesce(
        (F.col(ts) < F.col("last_ts")) | ((F.col(ts) == F.col("last_ts")) & (F.col(tie) < F.col("last_tie"))), F.lit(False))
    placed = new.join(before, F.col(series).eqNullSafe(F.col("__series")), "left").drop("__series")
    return materialize(placed.withColumn("late", late).drop("last_ts", "last_tie"))


def after_last_rows(state: DataFrame, ontime: DataFrame, series: str, ts: str, tie: str, col: str) -> DataFrame:
    """The ``hist`` rows of every series that has new rows (``__new`` 0), then
    the new ones (``__new`` 1), with their dense position ``__idx``."""
    keys = ontime.select(F.col(series).alias("__series")).distinct()
    held = state.join(keys, F.col(series).eqNullSafe(F.col("__series")), "left_semi").select(
        series, F.posexplode("hist").alias("__seq", "__h")).select(
        series, F.col("__h.ts").alias(ts), F.col("__h.tie").alias(tie), F.col("__h.value").alias(col),
        F.col("__seq").cast("long").alias("__seq"), F.lit(0).alias("__new"))
    new = ontime.select(series, ts, tie, col, "__seq").withColumn("__new", F.lit(1))
    return timeaxis.row_index(new.unionByName(held), [series], ["__new", ts, tie, "__seq"], "__idx")


def last_rows(tail: DataFrame, series: str, ts: str, tie: str, col: str) -> DataFrame:
    """``hist`` of every series: its rows in ``tail``, in order."""
    row = F.struct("__idx", F.col(ts).alias("ts"), F.col(tie).alias("tie"), F.col(col).alias("value"))
    hist = tail.groupBy(series).agg(F.sort_array(F.collect_list(row)).alias("h"))
    return hist.select(series, F.transform("h", lambda x: F.struct(x["ts"].alias("ts"), x["tie"].alias("tie"), x["value"].alias("value"))).alias("hist"))


def features_after(
    state: DataFrame, rows: DataFrame, series: str, ts: str, tie: str, col: str, lags: Sequence[int],
    roll_windows: Sequence[int], spans: Sequence[int], bucket_rows: int = windows.DEFAULT_BUCKET_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(features, next state)`` of new ``rows`` (series, ts, tie, col) after ``state``."""
    reach = max([*lags, *(w - 1 for w in roll_windows), 1])
    names = feature_names(col, lags, roll_windows, spans)
    mine = F.col(series).eqNullSafe(F.col("__series"))
    before = state.select(F.col(series).alias("__series"), "ema")
    placed = with_lateness(state, rows, series, ts, tie)
    t = after_last_rows(state, placed.where(~F.col("late")), series, ts, tie, col)
    t = windows.window_features(t, [series], "__idx", [col], lags=lags, roll_windows=roll_windows, bucket_rows=bucket_rows)
    t = materialize(t)
    # the EMA runs over the new rows that have a value, from their first one on
    some = windows.running_scan(
        t.where("__new = 1").withColumn("__one", F.col(col).isNotNull().cast("double")), [series], "__idx", "__one", "sum", "__i",
        bucket_rows, exclusive=True).withColumn("__i", F.col("__i").cast("long")).drop("__one")
    some = materialize(some)
    avg = ema.ema_features(some.where(F.col(col).isNotNull()).select(series, "__idx", "__i", col), [series], "__i", [col], spans)
    first = some.where(F.col(col).isNotNull()).groupBy(F.col(series).alias("__series")).agg(F.min_by(col, "__i").alias("__first"))
    carry = first.join(before.select(F.col("__series").alias("__before"), "ema"), F.col("__series").eqNullSafe(F.col("__before")), "left")
    avg = avg.join(carry.drop("__before"), mine, "left").drop("__series")
    # an average that starts at ``y`` instead of the first value differs by (1 - a)^(i + 1) (y - first)
    for j, s in enumerate(spans):
        left = F.pow(F.lit(1 - 2.0 / (s + 1)), F.col("__i") + 1) * (F.col("ema")[j] - F.col("__first"))
        avg = avg.withColumn(f"{col}_ema_{s}", F.col(f"{col}_ema_{s}") + F.coalesce(left, F.lit(0.0)))
    emas = [f"{col}_ema_{s}" for s in spans]
    avg = avg.select(F.col(series).alias("__series"), F.col("__idx").alias("__at"), *emas)
    full = materialize(some.join(avg, mine & (F.col("__idx") == F.col("__at")), "left").drop("__series", "__at"))
    out = full.withColumn("late", F.lit(False)).select(series, ts, tie, col, *names, "late").unionByName(
        placed.where("late").select(series, ts, tie, col, *[F.lit(None).cast("double").alias(n) for n in names], "late"))
    sizes = t.groupBy(F.col(series).alias("__series")).agg(F.max("__idx").alias("__top"))
    hist = last_rows(t.join(sizes, mine).where(F.col("__idx") > F.col("__top") - reach), series, ts, tie, col)
    last = full.where(F.col(emas[0]).isNotNull()).groupBy(F.col(series).alias("__series")).agg(
        F.max_by(F.array(*emas), "__idx").alias("fresh")) if emas else None
    after = hist
    if last is not None:
        after = after.join(last, mine, "left").drop("__series")
        after = after.join(before.select("__series", F.col("ema").alias("__old")), mine, "left").drop("__series").withColumn(
            "ema", F.coalesce("fresh", "__old")).drop("fresh", "__old")
    else:
        after = after.withColumn("ema", F.array().cast("array<double>"))
    end = F.element_at("hist", -1)
    after = after.select(series, end["ts"].alias("last_ts"), end["tie"].alias("last_tie"), "ema", "hist")
    idle = state.join(after.select(F.col(series).alias("__series")), mine, "left_anti")
    return out, after.unionByName(idle.select(*after.columns))


def feature_stream(
    stream: DataFrame, series: str, ts: str, col: str, sink: str, checkpoint: str, lags: Sequence[int] = (1, 2, 3, 24),
    roll_windows: Sequence[int] = (3, 6, 12, 24), spans: Sequence[int] = (3, 6, 12, 24), tie: str | None = None,
    bucket_rows: int = windows.DEFAULT_BUCKET_ROWS,
):
    """Start the job that writes rows (series, ts, tie, value, features..., late),
    one for each input row, as Parquet folders ``sink/batch=<n>``; state goes to
    ``checkpoint/features``. Returns the started query.

    Rows are ordered by (ts, ``tie``), ``tie`` an integer column; a stream that
    arrives in that order gives the same rows, equal to the batch window
    operators, however it is cut into micro-batches. Rows with equal places keep
    their order of arrival. A missing value has lags and rolling figures, but no
    EMA, and leaves the running one as it is."""
    key = dict(stream.dtypes)[series]
    schema = (f"`{series}` {key}, last_ts timestamp_ntz, last_tie long, ema array<double>, "
              "hist array<struct<ts:timestamp_ntz,tie:long,value:double>>")
    folder = f"{checkpoint.rstrip('/')}/features"
    place = tie or "__tie"

    def batch(rows: DataFrame, n: int) -> None:
        # an empty batch still passes the state on
        rows = rows.select(series, F.col(ts).cast("timestamp_ntz").alias(ts),
                           (F.col(tie) if tie else F.lit(0)).cast("long").alias(place), F.col(col).cast("double").alias(col))
        out, after = features_after(read_state(rows.sparkSession, folder, n, schema), rows, series, ts, place, col, lags, roll_windows, spans,
                                    bucket_rows)
        if tie is None:
            out = out.drop(place)
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={n}")
        after.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
