"""Seasonal-trend decomposition by local regression (STL), as windows.

Every smoothing is a local linear fit with tricube weights over the q nearest
positions of a series. The positions are dense, so the nearest ones are a
bounded frame around the row, and a fit is a handful of weighted sums over it:
halo-bucket windows (see ``windows``), no task holds a series. The subseries of
one phase of the cycle are series of their own. The low-pass filter (moving
averages of the period twice and of 3) is one weighted sum over two periods.
Robustness weights come from the exact median of the residuals.

Inputs are gap-free (impute first) with dense positions from 0; every series
must span at least two periods.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators import stats, windows
from hourglass.session import materialize


def odd_above(x: float) -> int:
    """Smallest odd whole number that is not below ``x``."""
    n = math.ceil(x)
    return n if n % 2 else n + 1


def _fit(points: Column, at: Column, n: Column, q: int) -> Column:
    """Local line through ``points`` (array of struct i, y, w) at position
    ``at`` (which may lie one step outside 0 .. n-1); NULL without weight."""
    inside = F.greatest(F.lit(0), F.least(at, n - 1))
    start = F.greatest(F.lit(0), F.least(inside - (q - 1) // 2, n - q))
    end = F.least(n, start + q) - 1
    h = (F.greatest(at - start, end - at) + F.when(n < q, F.floor((F.lit(q) - n) / 2)).otherwise(F.lit(0))).cast("double")

    def add(s, p):
        x = (p["i"] - at).cast("double")
        r = F.abs(x)
        near = F.when(r <= 0.001 * h, F.lit(1.0)).when(r <= 0.999 * h, F.pow(1 - F.pow(r / h, F.lit(3.0)), F.lit(3.0))).otherwise(F.lit(0.0))
        w = F.when((p["i"] >= start) & (p["i"] <= end), p["w"] * near).otherwise(F.lit(0.0))
        return F.transform(F.array(w), lambda v: F.struct(
            (s["w"] + v).alias("w"), (s["x"] + v * x).alias("x"), (s["xx"] + v * x * x).alias("xx"),
            (s["y"] + v * p["y"]).alias("y"), (s["xy"] + v * x * p["y"]).alias("xy")))[0]

    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("w", "x", "xx", "y", "xy")])

    def line(s):
        mean, level = s["x"] / s["w"], s["y"] / s["w"]
        spread = s["xx"] / s["w"] - mean * mean
        steep = spread > F.pow(0.001 * (n - 1).cast("double"), F.lit(2.0))
        return F.when(s["w"] > 0, F.when(steep, level - mean / spread * (s["xy"] / s["w"] - mean * level)).otherwise(level))

    return F.aggregate(points, zero, add, line)


def _frame(t: DataFrame, series: Sequence[str], idx: str, value: Column, weight: Column, reach: int, bucket_rows: int | None) -> DataFrame:
    point = F.struct(F.col(idx).cast("long").alias("i"), value.alias("y"), weight.alias("w"))
    t = t.withColumn("__point", point)
    return windows.window_select(t, series, idx, lambda w: {"__points": F.collect_list("__point").over(w.rowsBetween(-reach, reach))},
                                 preceding=reach, following=reach, bucket_rows=bucket_rows).drop("__point")


def loess(t: DataFrame, series: Sequence[str], idx: str, value: str, n: str, q: int, out: str, weight: Column | None = None,
          bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``t`` with ``out``: ``value`` smoothed over the ``q`` nearest positions.
    ``n`` is the column with the length of the series."""
    framed = _frame(t, series, idx, F.col(value), F.lit(1.0) if weight is None else weight, q - 1, bucket_rows)
    fit = _fit(F.col("__points"), F.col(idx).cast("long"), F.col(n), q)
    return framed.withColumn(out, F.coalesce(fit, F.col(value))).drop("__points")


def _cycles(t: DataFrame, series: list[str], idx: str, period: int, seasonal: int, weight: Column, bucket_rows: int | None) -> DataFrame:
    """Smoothed subseries of every phase, one period longer at both ends:
    series, ``idx`` (-period .. n + period - 1), ``c``."""
    t = t.withColumns({"__phase": (F.col(idx) % period).cast("int"), "__cycle": F.floor(F.col(idx) / period).cast("long"),
                       "__m": F.floor((F.col("__n") - 1 - F.col(idx) % period) / period).cast("long") + 1})
    framed = _frame(t, [*series, "__phase"], "__cycle", F.col("__detr"), weight, seasonal - 1, bucket_rows)
    at, points = F.col("__cycle"), F.col("__points")
    framed = framed.withColumn("__c", F.coalesce(_fit(points, at, F.col("__m"), seasonal), F.col("__detr")))
    early = F.when(at == 0, F.struct(F.lit(-1).alias("d"), F.coalesce(_fit(points, at - 1, F.col("__m"), seasonal), F.col("__c")).alias("c")))
    late = F.when(at == F.col("__m") - 1, F.struct(F.lit(1).alias("d"), F.coalesce(_fit(points, at + 1, F.col("__m"), seasonal), F.col("__c")).alias("c")))
    own = F.struct(F.lit(0).alias("d"), F.col("__c").alias("c"))
    rows = framed.select(*series, idx, F.explode(F.filter(F.array(own, early, late), lambda x: x.isNotNull())).alias("__x"))
    return rows.select(*series, (F.col(idx) + F.col("__x.d") * period).alias(idx), F.col("__x.c").alias("c"))


def _low_pass(period: int) -> list[float]:
    box = np.ones(period) / period
    return np.convolve(np.convolve(box, box), np.ones(3) / 3).tolist()


def stl_decompose(
    df: DataFrame, series: Sequence[str], idx: str, value: str, period: int = 24, seasonal: int = 7, trend: int | None = None,
    low_pass: int | None = None, inner: int | None = None, outer: int | None = None, robust: bool = False,
    bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """``df`` with ``trend``, ``seasonal``, ``resid`` and ``weights`` (of the last
    robustness round). ``seasonal``, ``trend`` and ``low_pass`` are the odd
    lengths of the three smoothers; by default the trend takes the smallest odd
    number from 1.5 period / (1 - 1.5 / seasonal) up and the low-pass filter
    from period + 1 up. ``inner`` rounds (5, or 2 if robust) run in each of
    1 + ``outer`` (0, or 15 if robust) robustness rounds."""
    series = list(series)
    trend = trend or odd_above(1.5 * period / (1 - 1.5 / seasonal))
    low_pass = low_pass or odd_above(period + 1)
    inner = inner if inner is not None else 2 if robust else 5
    outer = outer if outer is not None else 15 if robust else 0
    sizes = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    t = stats.with_series(df.select(*series, idx, F.col(value).cast("double").alias("__y")), sizes, series)
    t = materialize(t.withColumns({"__trend": F.lit(0.0), "__rw": F.lit(1.0), "__seasonal": F.lit(0.0)}))
    taps = F.array(*[F.lit(x) for x in _low_pass(period)])
    keys = [*series, idx]
    for turn in range(outer + 1):
        for _ in range(inner):
            detr = t.withColumn("__detr", F.col("__y") - F.col("__trend"))
            c = materialize(_cycles(detr, series, idx, period, seasonal, F.col("__rw"), bucket_rows))
            shifted = c.withColumn("__at", F.col(idx) + period)  # dense from 0 for the buckets
            wide = windows.window_select(shifted, series, "__at", lambda w: {"__band": F.collect_list("c").over(w.rowsBetween(-period, period))},
                                         preceding=period, following=period, bucket_rows=bucket_rows)
            passed = wide.where(F.size("__band") == 2 * period + 1).select(
                *keys, "c", F.aggregate(F.zip_with("__band", taps, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x).alias("__low"))
            passed = stats.with_series(passed, sizes, series)
            smooth = loess(passed, series, idx, "__low", "__n", low_pass, "__base", None, bucket_rows)
            season = smooth.select(*keys, (F.col("c") - F.col("__base")).alias("__s"))
            t = _joined(t.drop("__trend", "__seasonal"), season, keys).withColumnRenamed("__s", "__seasonal")
            t = t.withColumn("__rest", F.col("__y") - F.col("__seasonal"))
            t = materialize(loess(t, series, idx, "__rest", "__n", trend, "__trend", F.col("__rw"), bucket_rows).drop("__rest"))
        if turn < outer:
            off = t.withColumn("__off", F.abs(F.col("__y") - F.col("__seasonal") - F.col("__trend"))).drop("__rw")
            med = stats.exact_median(off, series, "__off", "__med")
            off = stats.with_series(off, med, series)
            h, r = 6 * F.col("__med"), F.col("__off")
            w = F.when(r <= 0.001 * h, F.lit(1.0)).when(r <= 0.999 * h, F.pow(1 - F.pow(r / h, F.lit(2.0)), F.lit(2.0))).otherwise(F.lit(0.0))
            t = materialize(off.withColumn("__rw", w).drop("__off", "__med"))
    found = t.select(*keys, F.col("__trend").alias("trend"), F.col("__seasonal").alias("seasonal"),
                     (F.col("__y") - F.col("__trend") - F.col("__seasonal")).alias("resid"), F.col("__rw").alias("weights"))
    return _joined(df, found, keys)


def _joined(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Join on null-safe keys; the keys appear once."""
    right = side.withColumnsRenamed({k: f"__s_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__s_{k}"))
    return df.join(right, same).drop(*[f"__s_{k}" for k in keys])
