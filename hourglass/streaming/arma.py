"""ARMA forecasts next to other models in the scoring of a stream.

The coefficient table is static. What a series leaves behind - its last p + 1
values, its place and its last q innovations - is one row of the state table,
written per micro-batch and replaced as a whole when one is repeated. A
micro-batch continues every series with the batch operators
(``forecast.arma_residuals``), so rows that arrive in order have the forecasts
of the whole series, however the stream is cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.operators import forecast as FC
from hourglass.session import materialize
from hourglass.streaming import features, jobs
from hourglass.streaming import messages as M


def _orders(coefs: DataFrame) -> tuple[int, int]:
    return len([c for c in coefs.columns if c.startswith("ar_")]), len([c for c in coefs.columns if c.startswith("ma_")])


def arma_after(state: DataFrame, rows: DataFrame, coefs: DataFrame, series: str, ts: str, tie: str, value: str, out: str = "arma"):
    """``(rows with a forecast of the next value, next state)`` of new ``rows``
    after ``state``. NULL forecasts: rows that come too late, rows without a
    value (which do not move the series) and series without coefficients."""
    p, _ = _orders(coefs)
    mine = F.col(series).eqNullSafe(F.col("__series"))
    placed = features.with_lateness(state, rows, series, ts, tie)
    ontime = placed.where(~F.col("late") & F.col(value).isNotNull())
    t = materialize(features.after_last_rows(state, ontime, series, ts, tie, value))
    sizes = t.groupBy(F.col(series).alias("__series")).agg(F.max("__idx").alias("__top"), F.count_if(F.col("__new") == 0).alias("__lead"))
    before = state.select(F.col(series).alias("__old"), F.col("e").alias("__before"))
    t = t.join(sizes, mine).drop("__series").join(before, F.col(series).eqNullSafe(F.col("__old")), "left").drop("__old")
    done = materialize(FC.arma_residuals(t, coefs, [series], "__idx", value, before="__before", lead="__lead"))
    found = done.select("__seq", FC.arma_step(coefs, value).alias(out))
    scored = placed.join(found, "__seq", "left").drop("__seq")
    hist = features.last_rows(t.where(F.col("__idx") > F.col("__top") - (p + 1)), series, ts, tie, value)
    last = done.groupBy(F.col(series).alias("__series")).agg(F.max_by("__e", "__idx").alias("e"))
    after = hist.join(last, mine, "left").drop("__series")
    end = F.element_at("hist", -1)
    after = after.select(series, end["ts"].alias("last_ts"), end["tie"].alias("last_tie"), "e", "hist")
    idle = state.join(after.select(F.col(series).alias("__series")), mine, "left_anti")
    return scored, after.unionByName(idle.select(*after.columns))


def score_stream(
    stream: DataFrame, models: Mapping[str, object], coefs: DataFrame, series: str, ts: str, value: str, sink: str, checkpoint: str,
    stats: Mapping[str, tuple[float, float]], feature_cols: Sequence[str], data_cols: Sequence[str], tie: str = "offset",
    arrived: str | None = None, default: float = 0.0, drift_threshold: float = M.DRIFT_THRESHOLD,
):
    """Start the job that writes the prediction log (``jobs.prediction_log``) as
    Parquet folders ``sink/batch=<n>``: topic, partition and offset as far as the
    stream has them, the data columns, one prediction per fitted model and
    ``arma``, the latency and the drift flag. Forecasts come from ``value``,
    ordered by (ts, ``tie``) within a series. Returns the started query."""
    key = dict(stream.dtypes)[series]
    schema = (f"`{series}` {key}, last_ts timestamp_ntz, last_tie long, e array<double>, "
              "hist array<struct<ts:timestamp_ntz,tie:long,value:double>>")
    folder = f"{checkpoint.rstrip('/')}/arma"

    def batch(rows: DataFrame, n: int) -> None:
        state = features.read_state(rows.sparkSession, folder, n, schema)
        rows = rows.withColumns({"__ts": F.col(ts).cast("timestamp_ntz"), "__tie": F.col(tie).cast("long"), "__value": F.col(value).cast("double")})
        scored, after = arma_after(state, rows, coefs, series, "__ts", "__tie", "__value", "__arma")
        scored = jobs.score(scored.drop("late"), dict(models), dict(stats), list(feature_cols), default, drift_threshold, arrived)
        log = jobs.prediction_log(scored, data_cols, {**{k: k for k in models}, "arma": "__arma"})
        log.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={n}")
        after.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
