"""Window features over a dense per-series position ``idx`` (0..n-1).

A plain ``Window.partitionBy(series)`` puts a whole series in one task,
which cannot hold when one series carries a third of all rows. All bounded
frames here run on **halo buckets** instead: rows are grouped into buckets of
``bucket_rows`` consecutive positions, each bucket also receives copies of
the last ``preceding`` rows of the bucket before it (and the first
``following`` rows of the bucket after it), the windows run partitioned by
(series, bucket), and the copies are dropped. Results are identical to the
plain form; the only extra cost is the duplicated halo rows.

Running (unbounded-preceding) aggregates use a two-level scan: a running
aggregate inside each bucket plus a carry from a prefix over one summary row
per bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Rows per halo bucket. A bucket (plus its halo) is the unit of work of one
# window task, so this bounds task memory independently of series length.
DEFAULT_BUCKET_ROWS = 1 << 20

BuildFn = Callable[[WindowSpec], Mapping[str, Column]]


def window_select(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    build: BuildFn,
    preceding: int = 0,
    following: int = 0,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Add the columns ``build(w)`` to ``df``; ``w`` is ordered by ``idx``.

    Frames used by ``build`` must stay within ``preceding`` rows before and
    ``following`` rows after the current row. ``bucket_rows=None`` runs the
    plain per-series window (one task per series).
    """
    series = list(series)
    if bucket_rows is None:
        w = Window.partitionBy(*series).orderBy(idx)
        return df.withColumns(dict(build(w)))
    B = int(bucket_rows)
    if B < max(preceding, following, 1):
        raise ValueError("bucket_rows must be at least the frame reach")
    b = F.floor(F.col(idx) / B)
    pos = F.col(idx) - b * B
    copies = [F.struct(b.alias("bk"), F.lit(False).alias("halo"))]
    if preceding:
        copies.append(F.when(pos >= B - preceding, F.struct((b + 1).alias("bk"), F.lit(True).alias("halo"))))
    if following:
        copies.append(F.when((pos < following) & (b > 0), F.struct((b - 1).alias("bk"), F.lit(True).alias("halo"))))
    arr = F.array(*copies)
    if len(copies) > 1:
        arr = F.filter(arr, lambda s: s.isNotNull())
    exploded = df.select("*", F.explode(arr).alias("__copy")).select(
        "*", F.col("__copy.bk").alias("__bk"), F.col("__copy.halo").alias("__halo")
    )
    w = Window.partitionBy(*series, "__bk").orderBy(idx)
    out = exploded.withColumns(dict(build(w)))
    return out.where(~F.col("__halo")).drop("__copy", "__bk", "__halo")


def running_scan(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    value: str,
    how: str,
    out: str,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    exclusive: bool = False,
) -> DataFrame:
    """Unbounded-preceding running ``sum`` or ``last`` non-null (forward fill).

    Inside each bucket a window computes the local running value; one summary
    row per (series, bucket) feeds a prefix over buckets (a window over the
    summary table only), and the carry is joined back on (series, bucket).
    ``exclusive`` excludes the current row (prefix before the row).
    """
    series = list(series)
    B = int(bucket_rows)
    bk = F.floor(F.col(idx) / B).alias("__bk")
    t = df.withColumn("__bk", bk)
    w_in = Window.partitionBy(*series, "__bk").orderBy(idx).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0
    )
    w_b = Window.partitionBy(*series).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    v = F.col(value)
    if how == "sum":
        local = F.coalesce(F.sum(v).over(w_in), F.lit(0.0))
        summ = t.groupBy(*series, "__bk").agg(F.sum(v).alias("__tot"))
        carry = summ.select(*series, "__bk", F.coalesce(F.sum("__tot").over(w_b), F.lit(0.0)).alias("__carry"))
        res = t.withColumn("__local", local).join(carry, [*series, "__bk"], "left")
        return res.withColumn(out, F.col("__local") + F.coalesce(F.col("__carry"), F.lit(0.0))).drop(
            "__bk", "__local", "__carry"
        )
    if how == "last":
        local = F.last(v, ignorenulls=True).over(w_in)
        summ = t.where(v.isNotNull()).groupBy(*series, "__bk").agg(F.max_by(v, F.col(idx)).alias("__lastv"))
        carry = summ.select(*series, "__bk", F.last("__lastv", ignorenulls=True).over(w_b).alias("__carry"))
        res = t.withColumn("__local", local).join(carry, [*series, "__bk"], "left")
        return res.withColumn(out, F.coalesce(F.col("__local"), F.col("__carry"))).drop("__bk", "__local", "__carry")
    raise ValueError(how)


# ---------------------------------------------------------------- features


def lag_features(
    df: DataFrame, series: Sequence[str], idx: str, cols: Sequence[str], lags: Sequence[int] = (1,),
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """F1 / F2: ``<col>_lag<k>``; leading rows stay NULL. One window node for all."""
    return window_select(
        df, series, idx,
        lambda w: {f"{c}_lag{k}": F.lag(c, k).over(w) for k in lags for c in cols},
        preceding=max(lags), bucket_rows=bucket_rows,
    )


def horizon_target(
    df: DataFrame, series: Sequence[str], idx: str, target: str, horizon: int = 1, out: str | None = None,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """value ``horizon`` rows ahead."""
    name = out or f"{target}_lead{horizon}"
    return window_select(
        df, series, idx, lambda w: {name: F.lead(target, horizon).over(w)},
        following=horizon, bucket_rows=bucket_rows,
    )


def rolling_features(
    df: DataFrame, series: Sequence[str], idx: str, cols: Sequence[str], windows: Sequence[int] = (3, 6, 24),
    stats: Sequence[str] = ("mean", "std"), bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Trailing ROWS windows of size w (partial windows allowed,
    NULLs skipped); the sample std of a single value is 0."""

    def build(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for win in windows:
            fr = w.rowsBetween(-(win - 1), 0)
            for c in cols:
                if "mean" in stats:
                    out[f"{c}_roll_mean_{win}"] = F.avg(c).over(fr)
                if "std" in stats:
                    out[f"{c}_roll_std_{win}"] = F.coalesce(F.stddev_samp(c).over(fr), F.lit(0.0))
        return out

    return window_select(df, series, idx, build, preceding=max(windows) - 1, bucket_rows=bucket_rows)


def rolling_slope(
    df: DataFrame, series: Sequence[str], idx: str, cols: Sequence[str], windows: Sequence[int] = (6, 12, 24),
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """least-squares slope of value on position over the trailing w rows;
    NULL values are skipped with their positions kept; fewer than two
    values gives NULL."""

    def build(w: WindowSpec) -> dict[str, Column]:
        x = F.col(idx).cast("double")
        return {
            f"{c}_slope_{win}": F.regr_slope(F.col(c), x).over(w.rowsBetween(-(win - 1), 0))
            for win in windows
            for c in cols
        }

    return window_select(df, series, idx, build, preceding=max(windows) - 1, bucket_rows=bucket_rows)


def interaction_names(base_cols: Sequence[str], lags: Sequence[int] = (1, 24)) -> list[tuple[str, str]]:
    lagged = [f"{c}_lag{k}" for c in base_cols for k in lags]
    return list(combinations(lagged, 2))


def lag_interactions(
    df: DataFrame, series: Sequence[str], idx: str, base_cols: Sequence[str], lags: Sequence[int] = (1, 24),
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """F8 + B20: lags, then ``<a>__<b>`` products of every unordered pair of
    lagged columns (one projection, not one column at a time)."""
    missing = [c for c in base_cols for k in lags if f"{c}_lag{k}" not in df.columns]
    out = lag_features(df, series, idx, list(dict.fromkeys(missing)), lags, bucket_rows) if missing else df
    return out.withColumns({f"{a}__{b}": F.col(a) * F.col(b) for a, b in interaction_names(base_cols, lags)})


def persistence_baseline(
    df: DataFrame, series: Sequence[str], idx: str, y: str, out: str = "baseline",
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS, lagged: str | None = None,
) -> DataFrame:
    """the column ``lagged`` (such as ``<target>_lag1``) where the frame has
    it, missing values included; else the previous value of ``y``, where the
    first row predicts itself."""
    if lagged is not None and lagged in df.columns:
        return df.withColumn(out, F.col(lagged).cast("double"))
    return window_select(
        df, series, idx, lambda w: {out: F.coalesce(F.lag(y, 1).over(w), F.col(y))},
        preceding=1, bucket_rows=bucket_rows,
    )


def ffill_then_mean(
    df: DataFrame, series: Sequence[str], idx: str, y: str, out: str = "baseline",
    bucket_rows: int = DEFAULT_BUCKET_ROWS, materialize_input: bool = True,
) -> DataFrame:
    """F10 + B18: previous value, forward-filled; what is still missing takes
    the series mean of ``y``. The input feeds the lag window, the per-bucket
    carry and the mean, so it is checkpointed once (``materialize_input``)."""
    from hourglass.session import materialize

    series = list(series)
    if materialize_input:
        df = materialize(df)
    prev = window_select(df, series, idx, lambda w: {"__prev": F.lag(y, 1).over(w)}, preceding=1,
                         bucket_rows=bucket_rows)
    filled = running_scan(prev, series, idx, "__prev", "last", "__ff", bucket_rows)
    if series:
        means = df.groupBy(*series).agg(F.avg(y).alias("__mean"))
        filled = filled.join(means, series, "left")
        fill = F.col("__mean")
    else:
        fill = df.select(F.avg(y)).scalar()
    return filled.withColumn(out, F.coalesce(F.col("__ff"), fill)).drop("__prev", "__ff", "__mean")


def centered_moving_average(
    df: DataFrame, series: Sequence[str], idx: str, value: str, period: int = 24, out: str = "trend",
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """two-sided moving average; an even period uses half weights at both
    ends. NULL unless the whole frame lies inside the series."""
    h = period // 2

    def build(w: WindowSpec) -> dict[str, Column]:
        if period % 2 == 0:
            full = w.rowsBetween(-h, h)
            s = F.sum(value).over(w.rowsBetween(-h, h - 1)) + F.sum(value).over(w.rowsBetween(-h + 1, h))
            val = s / F.lit(2.0 * period)
            n = F.count(value).over(full)
            return {out: F.when(n == period + 1, val)}
        full = w.rowsBetween(-h, h)
        return {out: F.when(F.count(value).over(full) == period, F.avg(value).over(full))}

    return window_select(df, series, idx, build, preceding=h, following=h, bucket_rows=bucket_rows)


def window_features(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    cols: Sequence[str],
    lags: Sequence[int] = (),
    roll_windows: Sequence[int] = (),
    slope_windows: Sequence[int] = (),
    leads: Mapping[str, tuple[str, int]] | None = None,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """All bounded-frame features of one series order in a single window
    projection (one exchange, one sort): lags, rolling mean/std, slopes and
    named leads ``{out: (col, h)}``."""
    leads = dict(leads or {})

    def build(w: WindowSpec) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for k in lags:
            for c in cols:
                out[f"{c}_lag{k}"] = F.lag(c, k).over(w)
        for win in roll_windows:
            fr = w.rowsBetween(-(win - 1), 0)
            for c in cols:
                out[f"{c}_roll_mean_{win}"] = F.avg(c).over(fr)
                out[f"{c}_roll_std_{win}"] = F.coalesce(F.stddev_samp(c).over(fr), F.lit(0.0))
        x = F.col(idx).cast("double")
        for win in slope_windows:
            for c in cols:
                out[f"{c}_slope_{win}"] = F.regr_slope(F.col(c), x).over(w.rowsBetween(-(win - 1), 0))
        for name, (c, h) in leads.items():
            out[name] = F.lead(c, h).over(w)
        return out

    reach = max([*lags, *(w - 1 for w in roll_windows), *(w - 1 for w in slope_windows), 0])
    ahead = max([h for _, h in leads.values()] + [0])
    return window_select(df, series, idx, build, preceding=reach, following=ahead, bucket_rows=bucket_rows)


def ordered_features(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    lags: Sequence[int] = (),
    roll_windows: Sequence[int] = (),
    slope_windows: Sequence[int] = (),
    idx_col: str = "idx",
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """``window_features`` for series without a dense position (irregular
    time, ties broken by ``order``); adds ``idx_col`` as well.

    ``row_index`` supplies the position and the features run on halo
    buckets, so no task holds a whole hot series.
    """
    from hourglass.operators import timeaxis

    series, order = list(series), list(order)
    t = timeaxis.row_index(df, series, order, idx_col)
    return window_features(t, series, idx_col, cols, lags, roll_windows, slope_windows, bucket_rows=bucket_rows)
