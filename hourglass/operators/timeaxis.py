"""Time handling: parsing, hourly resampling on a gap-free spine, time parts,
cyclic encodings, synthetic time axes and a distributed per-series row index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X
from hourglass.session import materialize, shuffle_partitions

STRETCH = 1 << 16  # buckets of one stretch of an axis
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def parse_timestamp(df: DataFrame, date_col: str, time_col: str | None = None, out: str = "ts",
                    drop_bad: bool = True) -> DataFrame:
    """C1 + B7: day-first parse of date (+ time) text; unparseable rows dropped."""
    res = df.withColumn(out, X.parse_day_first(date_col, time_col))
    return res.where(F.col(out).isNotNull()) if drop_bad else res


def reparse_timestamp(df: DataFrame, col: str, out: str | None = None, drop_bad: bool = False) -> DataFrame:
    """Re-parse an existing time column (text or timestamp); text that is
    not a time becomes NULL, never an error."""
    c = F.col(col)
    dt = df.schema[col].dataType
    parsed = c.cast("timestamp_ntz") if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)) else \
        F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
    res = df.withColumn(out or col, parsed)
    return res.where(F.col(out or col).isNotNull()) if drop_bad else res


def truncate(ts, unit: str = "hour") -> Column:
    """Wall-clock bucket start as TIMESTAMP_NTZ, built from the wall-clock
    fields, so no session time zone (or DST gap) moves a reading into
    another bucket (``date_trunc`` converts through the session zone)."""
    t = X.col(ts)
    zero = F.lit(0)
    parts = {
        "day": (F.year(t), F.month(t), F.dayofmonth(t), zero, zero),
        "hour": (F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), zero),
        "minute": (F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t)),
    }
    if unit not in parts:
        return F.date_trunc(unit, t).cast("timestamp_ntz")
    y, mo, d, h, mi = parts[unit]
    return F.make_timestamp_ntz(y, mo, d, h, mi, F.lit(0))


def resample(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    cols: Sequence[str],
    unit: str = "hour",
    out_ts: str = "ts_hour",
    suffix: str = "_mean",
    with_index: bool = False,
    fill_mean: bool = False,
    stretch: int = STRETCH,
) -> DataFrame:
    """C3 + I5: mean per (series, time bucket) on a gap-free axis from the
    first to the last bucket of each series; empty buckets are present with
    NULL means and ``n = 0``.

    The aggregate is partial/final (skew-proof, one exchange). The axis has two
    levels: stretches of ``stretch`` buckets, and the buckets inside one. A
    window over the non-empty stretches of a series (one small row each) finds
    its ends and the next stretch; a window per (series, stretch) fills the gaps
    between the buckets inside; stretches without any bucket are listed first,
    dealt to tasks, and then filled. So no task holds more than a stretch, and
    no row explodes into more than a stretch or the list of empty stretches.
    ``idx`` (with ``with_index``) is the dense bucket position inside the
    series (0 at the first bucket), which window operators use for halo
    bucketing without any extra shuffle. ``fill_mean`` (B16 on the hourly
    frame) fills empty buckets with the series mean of the bucket means.
    """
    series = list(series)
    secs = UNIT_SECONDS[unit]
    means = [f"{c}{suffix}" for c in cols]
    agg = df.groupBy(*series, truncate(ts, unit).alias(out_ts)).agg(
        *[F.avg(X.nan_to_null(c)).alias(m) for c, m in zip(cols, means)], F.count(F.lit(1)).alias("n")
    )
    # positions from wall-clock seconds: no session time zone (or DST) involved
    agg = agg.withColumn("__ws", X.wall_seconds(out_ts)).withColumn("__st", F.floor(F.col("__ws") / (secs * stretch)).cast("long"))
    held = agg.groupBy(*series, "__st").agg(
        F.min("__ws").alias("__first"), F.max("__ws").alias("__last"),
        *[f(m).alias(f"__{k}_{m}") for m in (means if fill_mean else []) for k, f in (("sum", F.sum), ("some", F.count))])
    whole = Window.partitionBy(*series)
    held = held.select(
        *[F.col(c).alias(f"__k_{c}") for c in series], F.col("__st").alias("__k"),
        F.min("__first").over(whole).alias("__lo"), F.max("__last").over(whole).alias("__hi"),
        F.lead("__st", 1).over(whole.orderBy("__st")).alias("__after"),
        *[F.try_divide(F.sum(f"__sum_{m}").over(whole), F.sum(f"__some_{m}").over(whole)).alias(f"__fill_{m}") for m in (means if fill_mean else [])])
    same = F.col("__st") == F.col("__k")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    inside = Window.partitionBy(*series, "__st").orderBy("__ws")
    t = agg.join(held, same).withColumns({"__next": F.lead("__ws", 1).over(inside), "__prev": F.lag("__ws", 1).over(inside)})
    # empty buckets before the first one of a stretch and after every one, as whole steps
    begin, end = F.col("__st") * (secs * stretch), (F.col("__st") + 1) * (secs * stretch)
    before = F.when(F.col("__prev").isNull(), F.col("__ws") - F.greatest(begin, F.col("__lo"))).otherwise(F.lit(0))
    after = F.coalesce("__next", F.least(end, F.col("__hi") + secs)) - F.col("__ws")
    steps = F.sequence(-(before / secs).cast("long"), (after / secs).cast("long") - 1)
    t = t.select("*", F.explode(steps).alias("__step"))
    gap = F.col("__step") != 0
    fill = {m: F.col(f"__fill_{m}") if fill_mean else F.lit(None).cast("double") for m in means}
    at = F.col("__ws") + F.col("__step") * secs
    index = [((at - F.col("__lo")) / secs).cast("long").alias("idx")] if with_index else []
    out = t.select(
        *series, F.when(gap, X.ntz_from_wall_seconds(at)).otherwise(F.col(out_ts)).cast("timestamp_ntz").alias(out_ts),
        *[(F.coalesce(F.when(~gap, F.col(m)), fill[m]) if fill_mean else F.when(~gap, F.col(m))).alias(m) for m in means],
        F.when(gap, F.lit(0)).otherwise(F.col("n")).cast("long").alias("n"), *index)
    # stretches without a bucket: listed, dealt out, then filled
    empty = held.where(F.col("__after") > F.col("__k") + 1).withColumn("__st", F.explode(F.sequence(F.col("__k") + 1, F.col("__after") - 1)))
    # a fixed number of partitions: these rows are few and small only until they are filled
    empty = empty.repartition(shuffle_partitions(df.sparkSession), *[f"__k_{c}" for c in series], "__st").withColumn(
        "__step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stretch - 1).cast("long")))).withColumn("__ws", F.col("__st") * (secs * stretch))
    return out.unionByName(empty.select(
        *[F.col(f"__k_{c}").alias(c) for c in series], X.ntz_from_wall_seconds(at).cast("timestamp_ntz").alias(out_ts),
        *[fill[m].alias(m) for m in means], F.lit(0).cast("long").alias("n"), *index))


def temporal_parts(ts) -> dict[str, Column]:
    """Hour, day, month, season (Dec-Feb = 1), day_of_week (Mon = 0)."""
    t = X.col(ts)
    return {
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "season": X.season(F.month(t)),
        "day_of_week": X.day_of_week(t),
    }


def cyclical_parts(ts) -> dict[str, Column]:
    """sin/cos of hour/24, day-of-week/7 and (month-1)/12."""
    t = X.col(ts)
    hs, hc = X.cyclic(F.hour(t), 24)
    ds, dc = X.cyclic(X.day_of_week(t), 7)
    ms, mc = X.cyclic(F.month(t), 12, shift=1)
    return {"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc, "month_sin": ms, "month_cos": mc}


def add_temporal_features(df: DataFrame, ts: str, cyclical: bool = True) -> DataFrame:
    parts = temporal_parts(ts)
    if cyclical:
        parts.update(cyclical_parts(ts))
    return df.withColumns(parts)


def range_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``__chunk``: rows dealt by range over all ``order`` columns
    together, so chunk numbers ascend with the order and a value that fills
    most rows of the first columns is split by the columns after it. The
    result is checkpointed: the chunk of a row never changes afterwards."""
    n = chunks or shuffle_partitions(df.sparkSession)
    return materialize(df.repartitionByRange(n, *order).withColumn("__chunk", F.spark_partition_id()))


def add_chunk_offsets(df: DataFrame, series: Sequence[str], weight: Column, off: str, total: str) -> DataFrame:
    """Add ``off`` (weight of the same series in earlier chunks) and ``total``
    (weight of the series) from the small (series, chunk) table."""
    per = df.groupBy(*[F.col(c).alias(f"__k_{c}") for c in series], F.col("__chunk").alias("__k")).agg(F.sum(weight).alias("__w"))
    mine = Window.partitionBy(*[f"__k_{c}" for c in series])
    before = mine.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({off: F.coalesce(F.sum("__w").over(before), F.lit(0)), total: F.sum("__w").over(mine)})
    same = F.col("__chunk") == F.col("__k")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return df.join(per, same).select(*df.columns, off, total)


def row_index(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    idx_col: str = "idx",
    chunks: int | None = None,
) -> DataFrame:
    """Dense 0-based position of each row inside its series by ``order``.

    ``order`` should make rows unique inside a series (add tie-breakers).
    There is one path at every size: rows are cut into ranges of (series,
    order) (``range_chunks``; a hot series and a hot time spread over many),
    numbered inside each (series, chunk), and each chunk adds its series'
    rows in earlier chunks.
    """
    series, order = list(series), list(order)
    t = range_chunks(df, [*series, *order], chunks)
    w = Window.partitionBy(*series, "__chunk").orderBy(*order)
    local = add_chunk_offsets(t, series, F.lit(1), "__off", "__total").withColumn("__local", F.row_number().over(w) - 1)
    return local.select(*df.columns, (F.col("__local") + F.col("__off")).cast("long").alias(idx_col))


def synthetic_time_index(df: DataFrame, idx_col: str, n_col: str, end: str, unit: str = "hour",
                         out: str = "ts_synth") -> DataFrame:
    """A regular axis ending at ``end``: ts = end - (n - 1 - idx) * unit."""
    secs = UNIT_SECONDS[unit]
    end_ws = X.wall_seconds(F.lit(end).cast("timestamp_ntz"))
    back = (F.col(n_col) - 1 - F.col(idx_col)) * secs
    return df.withColumn(out, X.ntz_from_wall_seconds(end_ws - back))
