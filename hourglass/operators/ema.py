"""exponential moving average (``adjust=False``) as a distributed scan.

y_0 = x_0, y_t = q * y_{t-1} + a * x_t with a = 2 / (span + 1), q = 1 - a.

The recurrence is an affine map y -> A * y + C per row, and affine maps
compose associatively, so the scan is split into levels:

* Level 0, blocks of ``block`` consecutive rows of a series: the local scan
  with zero carry-in is ``q^j * sum_{k<=j} c_k q^-k`` (j = position in the
  block), a plain running window sum inside the (series, block) partition.
  A row with carry-in Y gets ``local + q^(j+1) * Y``.
* Upper levels: one summary row per block, (A = q^len, C = local at the
  block end). Their inclusive prefix (the true y at each block end) is
  computed by the same idea with an ordered ``aggregate`` fold over groups
  of ``fan`` summaries, recursing until one group covers a series.

No task holds more than ``block`` rows or ``fan`` summaries of a series, so
a series of any length runs in parallel. The number of levels is a
plan-time number from one small aggregate (the longest series).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import materialize

BLOCK = 256
FAN = 64


def _block_for(q: float) -> int:
    # keep q^-block far from the double range limit
    if q <= 0.0:
        return BLOCK
    return max(1, min(BLOCK, int(600.0 / -math.log(q)))) if q < 1.0 else BLOCK


def _fold_group(items: Column, keys: list[str]) -> Column:
    """Ordered fold over an array of structs (idx, A_k, C_k...) giving, per
    element, the inclusive local prefix y_k and cumulative product P_k."""
    zero_fields = [F.lit(0.0).alias(f"y_{k}") for k in keys] + [F.lit(1.0).alias(f"p_{k}") for k in keys]
    out_type = "array<struct<idx:bigint," + ",".join(
        [f"y_{k}:double" for k in keys] + [f"p_{k}:double" for k in keys]
    ) + ">>"
    zero = F.struct(*zero_fields, F.array().cast(out_type).alias("out"))

    def merge(acc: Column, e: Column) -> Column:
        ys = [(e[f"A_{k}"] * acc[f"y_{k}"] + e[f"C_{k}"]).alias(f"y_{k}") for k in keys]
        ps = [(acc[f"p_{k}"] * e[f"A_{k}"]).alias(f"p_{k}") for k in keys]
        row = F.struct(e["idx"].alias("idx"), *ys, *ps)
        return F.struct(*ys, *ps, F.concat(acc["out"], F.array(row)).alias("out"))

    return F.aggregate(items, zero, merge, lambda acc: acc["out"])


def _affine_prefix(t: DataFrame, series: list[str], keys: list[str], depth: int) -> DataFrame:
    """Inclusive prefix Y_k of y = A*y + C over dense ``idx`` per series.

    ``t`` has series, idx, A_<k>, C_<k>; returns series, idx, Y_<k>.
    """
    fields = ["idx", *[f"A_{k}" for k in keys], *[f"C_{k}" for k in keys]]
    # groups of FAN consecutive elements (at depth 0 a group is the whole remaining series)
    gcol = F.floor(F.col("idx") / FAN) if depth else F.lit(0).cast("long")
    g = t.groupBy(*series, gcol.alias("__g")).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(f) for f in fields]))).alias("__items")
    )
    g = g.select(*series, "__g", F.explode(_fold_group(F.col("__items"), keys)).alias("__e")).select(
        *series, "__g", F.col("__e.idx").alias("idx"),
        *[F.col(f"__e.y_{k}").alias(f"L_{k}") for k in keys],
        *[F.col(f"__e.p_{k}").alias(f"P_{k}") for k in keys],
    )
    if depth == 0:
        return g.select(*series, "idx", *[F.col(f"L_{k}").alias(f"Y_{k}") for k in keys])
    last = Window.partitionBy(*series, "__g")
    summ = (
        g.withColumn("__mx", F.max("idx").over(last))
        .where(F.col("idx") == F.col("__mx"))
        .select(*series, F.col("__g").alias("idx"),
                *[F.col(f"P_{k}").alias(f"A_{k}") for k in keys], *[F.col(f"L_{k}").alias(f"C_{k}") for k in keys])
    )
    carry = _affine_prefix(summ, series, keys, depth - 1).select(
        *series, (F.col("idx") + 1).alias("__g"), *[F.col(f"Y_{k}").alias(f"K_{k}") for k in keys]
    )
    res = g.join(carry, [*series, "__g"], "left")
    return res.select(
        *series, "idx",
        *[(F.col(f"L_{k}") + F.col(f"P_{k}") * F.coalesce(F.col(f"K_{k}"), F.lit(0.0))).alias(f"Y_{k}") for k in keys],
    )


def ema_features(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    cols: Sequence[str],
    spans: Sequence[int] = (3, 6, 12, 24),
    max_len: int | None = None,
    materialize_input: bool = True,
) -> DataFrame:
    """Add ``<col>_ema_<span>`` columns. ``idx`` must be dense per series and
    the value columns gap-free (impute first). ``max_len`` (rows of the
    longest series) skips the one small job that measures it."""
    series = list(series)
    cols = list(cols)
    if materialize_input:
        df = materialize(df)  # read by the sizing job, the block scan and the carry join
    specs = [(c, s, 2.0 / (s + 1.0)) for s in spans for c in cols]
    block = min(_block_for(1.0 - a) for _, _, a in specs)
    if max_len is None:
        max_len = df.groupBy(*series).count().agg(F.max("count")).first()[0] or 0
    nblocks = max(1, math.ceil(max_len / block))
    depth = 0
    while FAN ** (depth + 1) < nblocks:
        depth += 1

    blk = F.floor(F.col(idx) / block)
    j = (F.col(idx) - blk * block).cast("double")
    t = df.withColumns({"__blk": blk, "__j": j})
    w = Window.partitionBy(*series, "__blk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    local, keys = {}, []
    for n, (c, s, a) in enumerate(specs):
        q = 1.0 - a
        k = f"k{n}"
        keys.append(k)
        weight = F.when(F.col(idx) == 0, F.lit(1.0)).otherwise(F.lit(a))
        if q == 0.0:
            local[f"__L_{k}"] = F.col(c)
        else:
            local[f"__L_{k}"] = F.pow(F.lit(q), F.col("__j")) * F.sum(
                weight * F.col(c) * F.pow(F.lit(q), -F.col("__j"))
            ).over(w)
    t = t.withColumns(local)
    # one summary row per block: A = q^len, C = local value at the block end
    ends = Window.partitionBy(*series, "__blk")
    summ = (
        t.withColumn("__mx", F.max(idx).over(ends)).where(F.col(idx) == F.col("__mx"))
        .select(
            *series, F.col("__blk").alias("idx"),
            *[F.pow(F.lit(1.0 - a), F.col("__j") + 1).alias(f"A_{keys[n]}") for n, (_, _, a) in enumerate(specs)],
            *[F.col(f"__L_{k}").alias(f"C_{k}") for k in keys],
        )
    )
    carry = _affine_prefix(summ, series, keys, depth).select(
        *series, (F.col("idx") + 1).alias("__blk"), *[F.col(f"Y_{k}").alias(f"__K_{k}") for k in keys]
    )
    res = t.join(carry, [*series, "__blk"], "left")
    outs = {}
    for n, (c, s, a) in enumerate(specs):
        k = keys[n]
        q = 1.0 - a
        outs[f"{c}_ema_{s}"] = F.col(f"__L_{k}") + F.pow(F.lit(q), F.col("__j") + 1) * F.coalesce(
            F.col(f"__K_{k}"), F.lit(0.0)
        )
    return res.withColumns(outs).drop("__blk", "__j", *[f"__L_{k}" for k in keys], *[f"__K_{k}" for k in keys])
