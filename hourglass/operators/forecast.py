"""Forecasting jobs: feature matrix, chronological split, rolling-origin
folds, bootstrap intervals, boosted trees (MLlib) and ARMA by Hannan-Rissanen.

Random draws use a deterministic integer hash of (replicate, draw) so a run
is reproducible and recomputation after an executor loss draws the same
rows; the same hash is plain integer SQL, so results can be checked in
another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators import ema, stats, timeaxis, windows
from hourglass.operators.clean import usable_features
from hourglass.session import ensure_checkpoint_dir, materialize, ship_package

M32 = 4294967296  # 2^32
M31 = 2147483648
HASH_MULT = 73244475  # 0x45d9f3b, integer finalizer multiplier
WORDS = (0, 2654435769)  # offsets that make the two words of a draw differ


def _round(x: Column) -> Column:
    return (F.shiftright(x, 16).bitwiseXOR(x) * HASH_MULT) % M32


def hash_draw(rep, k, n) -> Column:
    """Uniform draw in [0, n) from (rep, k).

    Replicate and draw number are mixed in rounds of their own before they are
    combined, so neighbouring replicates share no inputs at any number of
    draws; two 31-bit words make a 62-bit number, so n may exceed 2^32. All
    intermediate values stay below 2^63 (exact BIGINT math).
    """
    rep = (F.col(rep) if isinstance(rep, str) else rep).cast("long")
    k = (F.col(k) if isinstance(k, str) else k).cast("long")
    words = []
    for off in WORDS:
        inner = _round(_round((k % M32 + F.lit(off)) % M32))
        h = _round(_round((rep + F.lit(off + 1)) % M32))
        x = (inner + h + F.shiftright(k, 32)) % M32
        for _ in range(2):
            x = _round(x)
        words.append(F.shiftright(x, 16).bitwiseXOR(x) % M31)
    return (words[0] * M31 + words[1]) % (n if isinstance(n, Column) else F.lit(n))


def hash_draw_sql(rep: str, k: str, n: str) -> str:
    def rnd(x):
        return f"((xor(({x}) >> 16, {x})) * {HASH_MULT}) % {M32}"

    words = []
    for off in WORDS:
        inner = rnd(rnd(f"((({k}) % {M32} + {off}) % {M32})"))
        h = rnd(rnd(f"((({rep}) + {off + 1}) % {M32})"))
        x = f"(({inner}) + ({h}) + (({k}) >> 32)) % {M32}"
        for _ in range(2):
            x = f"({rnd(x)})"
        words.append(f"(xor(({x}) >> 16, {x}) % {M31})")
    return f"(({words[0]} * {M31} + {words[1]}) % ({n}))"


# ------------------------------------------------------------ feature matrix


def feature_matrix(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    ts: str,
    target: str,
    horizon: int = 1,
    lags: Sequence[int] = (1, 2, 3, 24),
    candidates: Sequence[str] | None = None,
    temporal: bool = True,
    bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> tuple[DataFrame, list[str]]:
    """M1: lags of every usable numeric feature (target excluded, all-missing
    dropped) plus lagged hour/day/month/season; y = target ``horizon`` rows
    ahead; complete cases only. Returns (frame with series, ts, y, features; feature names)."""
    series = list(series)
    t = df
    base = list(candidates) if candidates is not None else [
        c for c in df.columns if c not in (*series, idx, ts) and dict(df.dtypes)[c] in ("double", "bigint", "int", "float")
    ]
    feats = usable_features(t, base, target)
    if temporal:
        parts = timeaxis.temporal_parts(ts)
        t = t.withColumns({k: parts[k].cast("double") for k in ("hour", "day", "month", "season")})
        feats = feats + ["hour", "day", "month", "season"]
    if horizon <= 0:
        out = t.select(*series, ts, F.col(target).alias("y"), *[F.col(c).cast("double") for c in feats])
        return out.dropna(subset=["y", *feats]), feats
    names = [f"{c}_lag{k}" for k in lags for c in feats]
    t = windows.window_select(
        t, series, idx,
        lambda w: {**{f"{c}_lag{k}": F.lag(F.col(c).cast("double"), k).over(w) for k in lags for c in feats},
                   "y": F.lead(F.col(target), horizon).over(w)},
        preceding=max(lags), following=horizon, bucket_rows=bucket_rows,
    )
    out = t.select(*series, ts, idx, "y", *names).dropna(subset=["y", *names])
    return out, names


def chrono_split(df: DataFrame, series: Sequence[str], idx: str, test_size: float = 0.2) -> DataFrame:
    """M6: rows with position < floor(n * (1 - test_size)) are ``train``."""
    series = list(series)
    n = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    t = df.join(n, series) if series else df.withColumn("__n", n.select("__n").scalar())
    split = F.floor(F.col("__n") * (1.0 - test_size))
    return t.withColumn("split_at", split.cast("long")).withColumn(
        "part", F.when(F.col(idx) < F.col("split_at"), F.lit("train")).otherwise(F.lit("test"))
    ).drop("__n")


def rolling_origin_folds(df: DataFrame, series: Sequence[str], idx: str, ts: str, n_splits: int = 3) -> DataFrame:
    """M7: expanding-window folds; validation size n // (k + 1), the folds end
    at the last row. Output: series, fold, n_train, n_val, val_start, val_end."""
    series = list(series)
    n = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    t = df.join(n, series) if series else df.withColumn("__n", n.select("__n").scalar())
    size = F.floor(F.col("__n") / (n_splits + 1))
    first = F.col("__n") - n_splits * size
    fold = F.floor((F.col(idx) - first) / size)
    t = t.where((size > 0) & (F.col(idx) >= first)).withColumns({"fold": fold.cast("long"), "__size": size, "__first": first})
    return t.groupBy(*series, "fold").agg(
        (F.first("__first") + F.col("fold") * F.first("__size")).cast("long").alias("n_train"),
        F.count(F.lit(1)).cast("long").alias("n_val"),
        F.min(ts).alias("val_start"),
        F.max(ts).alias("val_end"),
    )


def fold_membership(df: DataFrame, series: Sequence[str], idx: str, n_splits: int = 3) -> DataFrame:
    """Explode each row into (fold, role) pairs: role train or val."""
    series = list(series)
    n = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    t = df.join(n, series) if series else df.withColumn("__n", n.select("__n").scalar())
    size = F.floor(F.col("__n") / (n_splits + 1))
    first = F.col("__n") - n_splits * size
    folds = F.sequence(F.lit(0), F.lit(n_splits - 1))
    t = t.withColumn("fold", F.explode(folds))
    start = first + F.col("fold") * size
    role = F.when(F.col(idx) < start, F.lit("train")).when(F.col(idx) < start + size, F.lit("val"))
    return t.withColumn("role", role).where(F.col("role").isNotNull()).drop("__n")


# ------------------------------------------------------------------ bootstrap


def _percentiles(col: str, alpha: float) -> tuple[Column, Column]:
    q = F.percentile(F.col(col), F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return q[0], q[1]


RANGE_ROWS = 4096  # rows of one range of a bootstrap; a range's values are one array
SPLIT_BITS = 40  # bits of a split's probability; ranges of equal size need one
WORD_BITS = 60


def _word(*key: Column) -> Column:
    """60 random bits for a key of integers."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *key).cast("binary")), 1, WORD_BITS // 4), 16, 10).cast("long")


def _word_sql(*key: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(key)})), 1, {WORD_BITS // 4}) AS BIGINT)"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _ones(key: Sequence[Column], draws: Column) -> Column:
    """Number of ones among ``draws`` random bits."""
    zero = F.lit(0).cast("long")

    def add(total, j):
        left = F.least(draws - j * WORD_BITS, F.lit(WORD_BITS)).cast("int")
        part = _word(*key, j) % F.call_function("shiftleft", F.lit(1).cast("long"), left)
        return total + F.bit_count(part).cast("long")

    last = F.floor((draws - 1) / WORD_BITS).cast("long")
    return F.when(draws > 0, F.aggregate(F.sequence(zero, F.greatest(last, zero)), zero, add)).otherwise(zero)


def _split(draws: Column, left: Column, both: Column, key: Sequence[Column]) -> Column:
    """Binomial(draws, left / both): every draw's uniform number is compared
    with the probability bit by bit, all undecided draws at once (a popcount)."""
    zero = F.lit(0).cast("long")

    def step(acc, s):
        one = acc["t"] * 2 >= both
        return _let(_ones([*key, s], acc["open"]), lambda ones: F.struct(
            (acc["t"] * 2 - F.when(one, both).otherwise(zero)).alias("t"),
            # nothing of the probability left: who is still undecided is above it
            F.when(acc["t"] * 2 == both, zero).when(one, ones).otherwise(acc["open"] - ones).alias("open"),
            (acc["got"] + F.when(one, acc["open"] - ones).otherwise(zero)).alias("got")))

    start = F.struct(left.cast("long").alias("t"), draws.cast("long").alias("open"), zero.alias("got"))
    got = F.aggregate(F.sequence(zero, F.lit(SPLIT_BITS - 1).cast("long")), start, step, lambda acc: acc["got"])
    even = draws - _ones([*key, zero], draws)  # one bit decides between equal halves
    return F.when(left <= 0, zero).when(left >= both, draws).when(left * 2 == both, even).otherwise(got)


def _levels(ranges: Column) -> Column:
    """Bit length of ``ranges - 1``: levels of a binary tree over the ranges."""
    return F.when(ranges <= 1, F.lit(0)).otherwise(F.length(F.bin(ranges - 1))).cast("long")


def range_draws(rep: Column, n: Column, range_rows: int, draws: Column | None = None) -> Column:
    """Array of how many of replicate ``rep``'s ``draws`` (by default ``n``) from
    ``n`` positions fall into each range of ``range_rows`` positions: a multinomial count by halving the ranges, each
    half's share a binomial split of its parent's draws."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    n = n.cast("long")
    draws = n if draws is None else draws.cast("long")
    depth = _levels(F.floor((n + range_rows - 1) / range_rows).cast("long"))

    def halve(counts, level):
        width = F.call_function("shiftleft", F.lit(range_rows).cast("long"), (depth - level).cast("int"))
        first = F.call_function("shiftleft", one, (level - 1).cast("int"))

        def children(m, i):
            rest = n - i.cast("long") * 2 * width
            left, both = F.greatest(zero, F.least(width, rest)), F.greatest(zero, F.least(width * 2, rest))
            return _let(_split(m, left, both, [rep, first + i.cast("long")]), lambda got: F.array(got, m - got))

        return F.flatten(F.transform(counts, children))

    return F.when(depth == 0, F.array(draws)).otherwise(F.aggregate(F.sequence(one, F.greatest(depth, one)), F.array(draws), halve))


def bootstrap_draws_sql(frame: str, n_boot: int, range_rows: int, draws: str = "n") -> str:
    """CTEs ``split`` and ``leaf(series, n, r, rng, m)``: :func:`range_draws` in
    SQL, for a recursive WITH. ``frame`` holds (series, n) and ``draws``."""
    word = _word_sql("s.r", "(1::BIGINT << s.lvl::INT) + s.idx", "s.step", "j")
    ones = (f"coalesce(list_sum(list_transform(range(0, (s.opened + {WORD_BITS - 1}) // {WORD_BITS}), "
            f"lambda j: bit_count({word} % (1::BIGINT << least(s.opened - j * {WORD_BITS}, {WORD_BITS})::INT)))), 0)::BIGINT")
    levels = f"CASE WHEN n <= {range_rows} THEN 0 ELSE length(bin((n + {range_rows} - 1) // {range_rows} - 1)) END"
    return f"""split(series, n, depth, r, lvl, idx, m, step, t, opened, got) AS (
  SELECT series, n, CAST({levels} AS BIGINT), r, 0::BIGINT, 0::BIGINT, {draws}, 0::BIGINT, -1::BIGINT, {draws}, 0::BIGINT
  FROM {frame} CROSS JOIN range(0, {n_boot}) AS q(r)
  UNION ALL
  SELECT series, n, depth, r,
         CASE WHEN done THEN lvl + 1 ELSE lvl END, CASE WHEN done THEN idx * 2 + side ELSE idx END,
         CASE WHEN NOT done THEN m WHEN side = 0 THEN share ELSE m - share END,
         CASE WHEN done THEN 0 ELSE step + 1 END,
         CASE WHEN done THEN -1 WHEN 2 * t >= b THEN 2 * t - b ELSE 2 * t END,
         CASE WHEN done THEN CASE WHEN side = 0 THEN share ELSE m - share END WHEN 2 * t = b THEN 0 WHEN 2 * t >= b THEN h ELSE opened - h END,
         CASE WHEN done THEN 0 WHEN 2 * t >= b THEN got + opened - h ELSE got END
  FROM (SELECT *, CASE WHEN a <= 0 THEN 0 WHEN a >= b THEN m ELSE got END AS share,
               step = {SPLIT_BITS} OR opened = 0 OR a <= 0 OR a >= b AS done
        FROM (SELECT s.* EXCLUDE (t), CASE WHEN s.t < 0 THEN a ELSE s.t END AS t, {ones} AS h
              FROM (SELECT *, greatest(0, least(w, n - idx * 2 * w)) AS a, greatest(0, least(2 * w, n - idx * 2 * w)) AS b
                    FROM (SELECT *, ({range_rows}::BIGINT << greatest(depth - lvl - 1, 0)::INT) AS w
                          FROM split WHERE lvl < depth)) AS s))
       JOIN (VALUES (0), (1)) AS sides(side) ON done OR side = 0),
leaf AS (SELECT series, n, r, idx AS rng, m FROM split WHERE lvl = depth AND step = 0 AND m > 0)"""


def range_pick_sql(rep: str, rng: str, k: str, size: str) -> str:
    return f"({_word_sql(rep, f'-1 - ({rng})', k)} % ({size}))"


def _picked() -> Column:
    """Struct ``s, c``: sum and count of the ``__m`` values that replicate
    ``__r`` draws from the array ``__values`` of range ``__g``; NULLs are drawn
    but not counted."""

    def add(acc, k):
        pick = F.get("__values", (_word(F.col("__r"), -1 - F.col("__g"), k) % F.size("__values")).cast("int"))
        return _let(pick, lambda v: F.struct((acc["s"] + F.coalesce(v, F.lit(0.0))).alias("s"), (acc["c"] + v.isNotNull().cast("long")).alias("c")))

    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("c"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("__m") - 1), start, add)


def bootstrap_ci(
    diffs: DataFrame, series: Sequence[str], pos: str, value: str, n_boot: int = 1000, alpha: float = 0.05,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """IID bootstrap of the mean. Positions are cut into ranges of
    ``range_rows``; how many of a replicate's n draws fall into each range is a
    multinomial count from binomial splits (:func:`range_draws`), and the draws
    inside a range pick from the array of its values. So B rows per range are
    shuffled instead of B per value. The interval is the exact
    linear-interpolated percentile of the B means; NULL values are drawn but
    not averaged. ``pos`` is the dense position 0..n-1 inside each series.
    Output: series, n, n_boot, mean_diff, ci_low, ci_high."""
    if not 1 <= range_rows <= 1 << 20:
        raise ValueError("range_rows must lie between 1 and 2^20")
    series = list(series)
    cells = diffs.groupBy(*series, F.floor(F.col(pos) / range_rows).cast("long").alias("__g")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(value).alias("__v")))).alias("__rows"),
        F.count(value).alias("__some"), F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__all"))
    cells = materialize(cells.select(*series, "__g", F.transform("__rows", lambda x: x["__v"]).alias("__values"), "__some", "__sum", "__all"))
    stats_ = cells.groupBy(*series).agg(F.sum("__all").alias("n"), F.try_divide(F.sum("__sum"), F.sum("__some")).alias("mean_diff"))
    # replicates are spread before their counts are worked out
    reps = stats_.select(*series, "n", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("__r")).repartition("__r")
    shares = reps.select(*series, "n", "__r", F.posexplode_outer(range_draws(F.col("__r"), F.col("n"), range_rows)).alias("__g", "__m")).filter("__m > 0")
    drawn = shares.withColumn("__g", F.col("__g").cast("long")).join(cells.select(*series, "__g", "__values"), [*series, "__g"])
    means = drawn.select(*series, "__r", _picked().alias("__p")).groupBy(*series, "__r").agg(
        F.try_divide(F.sum("__p.s"), F.sum("__p.c")).alias("__m"))
    lo, hi = _percentiles("__m", alpha)
    ci = means.groupBy(*series).agg(lo.alias("ci_low"), hi.alias("ci_high"), F.count(F.lit(1)).cast("long").alias("n_boot"))
    return stats_.join(ci, series) if series else stats_.select(
        "n", F.lit(n_boot).cast("long").alias("n_boot"), "mean_diff",
        ci.select("ci_low").scalar().alias("ci_low"), ci.select("ci_high").scalar().alias("ci_high"))


def block_bootstrap_ci(
    diffs: DataFrame, series: Sequence[str], pos: str, value: str, block: int = 24, n_boot: int = 1000,
    alpha: float = 0.05, bucket_rows: int = windows.DEFAULT_BUCKET_ROWS, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Moving-block bootstrap. ceil(n / block) blocks per replicate with
    uniform starts among the max(1, n - block + 1) possible ones, the last block
    truncated so the sample has n values. Every start's block sum comes from a
    halo window; how many whole blocks of a replicate start in each range of
    ``range_rows`` starts is a multinomial count (:func:`range_draws`), the starts
    are drawn inside a range. So B rows per range are shuffled. NULL values
    count as 0."""
    series = list(series)
    diffs = materialize(diffs.select(*series, pos, value))  # n rows, read by two branches
    stats_ = diffs.groupBy(*series).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_diff"))
    nb = F.ceil(F.col("n") / block).cast("long")
    sized = stats_.withColumns({"__starts": F.greatest(F.lit(1).cast("long"), F.col("n") - block + 1), "__blocks": nb,
                                "__last": F.col("n") - block * (nb - 1)})
    sized = materialize(sized)  # one row per series
    ahead = windows.window_select(
        diffs.withColumn("__v", F.coalesce(F.col(value).cast("double"), F.lit(0.0))), series, pos,
        lambda w: {"__next": F.collect_list("__v").over(w.rowsBetween(0, block - 1))}, following=block - 1, bucket_rows=max(bucket_rows, block))
    t = stats.with_series(ahead, sized.drop("mean_diff"), series).where(F.col(pos) < F.col("__starts"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    item = F.struct(F.col(pos).alias("p"), total(F.col("__next")).alias("whole"), total(F.slice("__next", F.lit(1), F.col("__last").cast("int"))).alias("part"))
    cells = t.groupBy(*series, F.floor(F.col(pos) / range_rows).cast("long").alias("__g")).agg(F.sort_array(F.collect_list(item)).alias("__rows"))
    cells = materialize(cells.select(*series, "__g", F.transform("__rows", lambda x: x["whole"]).alias("__values"),
                                     F.transform("__rows", lambda x: x["part"]).alias("__parts")))
    reps = sized.select(*series, "n", "__starts", "__blocks", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("__r")).repartition("__r")
    counts = range_draws(F.col("__r"), F.col("__starts"), range_rows, F.col("__blocks") - 1)
    whole = reps.select(*series, "__r", F.posexplode_outer(counts).alias("__g", "__m")).filter("__m > 0").withColumn("__g", F.col("__g").cast("long"))
    at = _word(F.col("__r"), F.lit(0)) % F.col("__starts")
    ends = reps.select(*series, "__r", F.floor(at / range_rows).cast("long").alias("__g"), (at % range_rows).cast("int").alias("__at"))
    sums = _in_cells(whole, cells, series).select(*series, "__r", _picked()["s"].alias("__sum")).unionByName(
        _in_cells(ends, cells, series).select(*series, "__r", F.get("__parts", F.col("__at")).alias("__sum")))
    totals = sums.groupBy(*series, "__r").agg(F.sum("__sum").alias("__total"))
    means = stats.with_series(totals, sized.select(*series, "n"), series).withColumn("__m", F.col("__total") / F.col("n"))
    lo, hi = _percentiles("__m", alpha)
    ci = means.groupBy(*series).agg(lo.alias("ci_low"), hi.alias("ci_high"), F.count(F.lit(1)).cast("long").alias("n_boot"))
    return stats_.join(ci, series) if series else stats_.select(
        "n", F.lit(n_boot).cast("long").alias("n_boot"), "mean_diff",
        ci.select("ci_low").scalar().alias("ci_low"), ci.select("ci_high").scalar().alias("ci_high"))


def _in_cells(rows: DataFrame, cells: DataFrame, series: Sequence[str]) -> DataFrame:
    side = cells.withColumnsRenamed({c: f"__k_{c}" for c in (*series, "__g")})
    return rows.join(side, _same(series) & (F.col("__g") == F.col("__k___g"))).drop(*[f"__k_{c}" for c in (*series, "__g")])


DRAW_BITS = 50  # resolution of the uniform number behind a Poisson weight


def poisson_thresholds() -> list[int]:
    """Cumulative Poisson(1) probabilities as integers of ``DRAW_BITS`` bits,
    up to the last one that resolution can tell from 1."""
    out, term, total, k = [], float(np.exp(-1.0)), 0.0, 0
    while True:
        total += term
        cut = round(total * (1 << DRAW_BITS))
        if out and cut <= out[-1] or cut >= 1 << DRAW_BITS:
            return out
        out.append(cut)
        k += 1
        term /= k


def poisson_weight_sql(rep: str, k: str) -> str:
    cuts = poisson_thresholds()
    cases = " ".join(f"WHEN u < {c} THEN {i}" for i, c in enumerate(cuts))
    return f"(SELECT CASE {cases} ELSE {len(cuts)} END FROM (SELECT {hash_draw_sql(rep, k, str(1 << DRAW_BITS))} AS u))"


def poisson_bootstrap_ci(
    diffs: DataFrame, series: Sequence[str], pos: str, value: str, n_boot: int = 1000, alpha: float = 0.05
) -> DataFrame:
    """M11, scale form: each row gets an independent Poisson(1) weight per
    replicate (the integer hash of replicate and position through the inverse
    CDF), and replicate means are weighted sums aggregated map-side - no join
    and no shuffle of the data, only B partial sums per task. A replicate in
    which every weight is 0 (possible for a handful of rows) has no mean and
    is left out of the percentiles."""
    series = list(series)
    t = diffs.select(*series, F.col(pos).alias("__k"), F.col(value).alias("__v"),
                     F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("__r"))
    t = t.withColumn("__u", hash_draw("__r", "__k", 1 << DRAW_BITS))
    cuts = poisson_thresholds()
    w = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        w = F.when(F.col("__u") < cuts[i], F.lit(i)).otherwise(w)
    reps = t.withColumn("__w", w).groupBy(*series, "__r").agg(
        F.try_divide(F.sum(F.col("__w") * F.col("__v")), F.sum("__w")).alias("__m"))
    lo, hi = _percentiles("__m", alpha)
    return reps.groupBy(*series).agg(lo.alias("ci_low"), hi.alias("ci_high"), F.count("__m").alias("n_boot"))


# ------------------------------------------------------------------ models


SERIES_MEAN = "__series_mean"


def series_encoding(train: DataFrame, series: Sequence[str], label: str = "y", folds: int = 5, weight: float = 20.0):
    """Numeric feature of a series key: the mean label of the key's other rows.

    Rows are dealt to ``folds`` by a hash of their content; a row takes the mean
    over the other folds of its key, shrunk towards the overall mean by
    ``weight`` rows, so its own label never enters. One aggregate and joins by
    key; no list of keys reaches the driver. Returns (train with
    ``SERIES_MEAN``, table of series and ``SERIES_MEAN`` over all rows for
    scoring, overall mean, which unseen keys take)."""
    series = list(series)
    t = train.withColumn("__fold", F.pmod(F.xxhash64(*train.columns), F.lit(folds)))
    parts = materialize(t.groupBy(*series, "__fold").agg(F.sum(label).alias("__s"), F.count(label).alias("__n")))
    total = parts.agg(F.sum("__s"), F.sum("__n")).first()
    prior = float(total[0]) / total[1] if total[1] else 0.0
    whole = parts.groupBy(*series).agg(F.sum("__s").alias("__ts"), F.sum("__n").alias("__tn"))
    mean = lambda s, n: (s + F.lit(prior * weight)) / (n + F.lit(weight))
    table = whole.select(*series, mean(F.coalesce("__ts", F.lit(0.0)), F.col("__tn")).alias(SERIES_MEAN))
    keys = [F.col(c).alias(f"__k_{c}") for c in series]
    none = F.lit(0.0)
    rest = parts.join(whole.select(*keys, "__ts", "__tn"), _same(series)).select(
        *[F.col(c).alias(f"__f_{c}") for c in series], F.col("__fold").alias("__of"),
        mean(F.coalesce("__ts", none) - F.coalesce("__s", none), F.col("__tn") - F.col("__n")).alias(SERIES_MEAN))
    out = t.join(rest, _same(series, "__f_") & (F.col("__fold") == F.col("__of")))
    return out.select(*train.columns, SERIES_MEAN), table, prior


def _same(series: Sequence[str], prefix: str = "__k_") -> Column:
    same = F.lit(True)
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def prepared(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "y", series: Sequence[str] = (),
             encoding_path: str | None = None):
    """``(train, test, stages)``: both frames with the vector ``features``, and
    the fitted stages that make it for new rows. The table of series means is
    written to ``encoding_path`` (by default in the shared folder); the stage
    joins it, so it must stay where a saved model is used."""
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    stages, cols = [], list(features)
    if series:
        path = encoding_path or f"{ensure_checkpoint_dir(train.sparkSession).rstrip('/')}/series-means-{uuid.uuid4().hex}"
        train, table, prior = series_encoding(train, series, label)
        table.write.parquet(path)
        on = " AND ".join(f"d.`{c}` <=> m.`{c}`" for c in series)
        stages.append(SQLTransformer(statement=(
            f"SELECT d.*, coalesce(m.`{SERIES_MEAN}`, CAST({prior!r} AS DOUBLE)) AS `{SERIES_MEAN}` FROM __THIS__ d LEFT JOIN parquet.`{path}` m ON {on}")))
        cols.append(SERIES_MEAN)
        test = stages[0].transform(test)
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"))
    return stages[-1].transform(train), stages[-1].transform(test), stages


def gbt(label: str, n_trees: int, max_depth: int, step: float, subsample: float, feature_subset: str, seed: int):
    from pyspark.ml.regression import GBTRegressor

    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=max_depth, stepSize=step,
                        subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=seed)


def gbt_fit_predict(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "y", n_trees: int = 100,
    max_depth: int = 5, step: float = 0.1, subsample: float = 1.0, feature_subset: str = "all", seed: int = 42,
    series: Sequence[str] = (), encoding_path: str | None = None,
):
    """Gradient-boosted regression trees (MLlib). The series key
    enters as one more numeric feature, its out-of-fold mean label
    (:func:`series_encoding`), so one model serves every series. Both frames
    are made once, whatever the number of trees. Returns (fitted PipelineModel,
    test predictions)."""
    from pyspark.ml import PipelineModel

    train, test, stages = prepared(train, test, features, label, series, encoding_path)
    model = gbt(label, n_trees, max_depth, step, subsample, feature_subset, seed).fit(materialize(train.select("features", label)))
    return PipelineModel([*stages, model]), model.transform(test)


def difference_sums(
    df: DataFrame, series: Sequence[str], idx: str, value: str, reach: int, bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Per series ``rows`` and ``s_i_j`` (0 <= i <= j <= reach): sums of
    dy[t-i] * dy[t-j] over the rows that have all these differences. One
    window projection, one aggregate."""
    series = list(series)
    t = windows.window_select(df.select(*series, idx, value), series, idx,
                              lambda w: {f"__y{k}": F.lag(value, k).over(w) for k in range(1, reach + 2)},
                              preceding=reach + 1, bucket_rows=bucket_rows)
    y = [F.col(value), *[F.col(f"__y{k}") for k in range(1, reach + 2)]]
    d = t.select(*series, *[(y[k] - y[k + 1]).alias(f"__d{k}") for k in range(reach + 1)]).dropna(
        subset=[f"__d{k}" for k in range(reach + 1)])
    return d.groupBy(*series).agg(F.count(F.lit(1)).alias("rows"), *[
        F.sum(F.col(f"__d{i}") * F.col(f"__d{j}")).alias(f"s_{i}_{j}") for i in range(reach + 1) for j in range(i, reach + 1)])


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Many small systems at once; least squares where one is singular."""
    try:
        return np.linalg.solve(a, b[..., None])[..., 0]
    except np.linalg.LinAlgError:
        return np.stack([np.linalg.lstsq(x, y, rcond=None)[0] for x, y in zip(a, b)])


def _hannan_rissanen(s: np.ndarray, rows: np.ndarray, p: int, q: int, long_ar: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and residual variance from the sums ``s[series, i, j]``.

    Stage 1 is an AR(``long_ar``). Its residual is a fixed combination of
    differences, so the sums that stage 2 needs are combinations of ``s``."""
    size = s.shape[1]
    ar = _solve(s[:, 1 : long_ar + 1, 1 : long_ar + 1], s[:, 1 : long_ar + 1, 0])
    take = np.zeros((len(s), p + q, size))
    for k in range(p):
        take[:, k, k + 1] = 1.0
    for k in range(q):
        take[:, p + k, k + 1] = 1.0
        take[:, p + k, k + 2 : k + 2 + long_ar] = -ar
    xx = take @ s @ take.transpose(0, 2, 1)
    xy = (take @ s[:, :, :1])[..., 0]
    beta = _solve(xx, xy)
    rest = s[:, 0, 0] - 2 * (beta * xy).sum(axis=1) + np.einsum("ni,nij,nj->n", beta, xx, beta)
    return beta, np.maximum(rest, 0.0) / rows


def arma_fit(
    df: DataFrame, series: Sequence[str], idx: str, value: str, p: int = 2, q: int = 2, long_ar: int = 10,
    min_points: int = 10, bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """M4: ARIMA(p,1,q) coefficients by Hannan-Rissanen, per series (or of the
    whole table without a series key).

    The data is read once, for the cross-product sums of the lagged differences
    (``difference_sums``); both regressions (no constant with d = 1) are
    solved from them, for many series at a time.
    Output: series, ar_1..ar_p, ma_1..ma_q, sigma2, n.
    """
    series = list(series)
    reach = max(long_ar + q, p)
    sums = difference_sums(df, series, idx, value, reach, bucket_rows).where(F.col("rows") >= min_points)
    ship_package(df.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [f"ar_{k}" for k in range(1, p + 1)] + [f"ma_{k}" for k in range(1, q + 1)]
    schema = ", ".join([*(f"`{s}` {types[s]}" for s in series), *(f"{c} double" for c in names), "sigma2 double", "n bigint"])

    def solve(pdfs):
        for pdf in pdfs:
            if not len(pdf):
                continue
            s = np.zeros((len(pdf), reach + 1, reach + 1))
            for i in range(reach + 1):
                for j in range(i, reach + 1):
                    s[:, i, j] = s[:, j, i] = pdf[f"s_{i}_{j}"].to_numpy(dtype=float)
            beta, sigma2 = _hannan_rissanen(s, pdf["rows"].to_numpy(dtype=float), p, q, long_ar)
            yield pd.DataFrame({**{c: pdf[c] for c in series}, **{c: beta[:, k] for k, c in enumerate(names)}, "sigma2": sigma2, "n": pdf["rows"]})

    return sums.mapInPandas(solve, schema)


FAN = 256  # elements of one group of a vector scan (a power of two)


def _times(mat: Column, vec: Column) -> Column:
    return F.transform(mat, lambda row: F.aggregate(F.zip_with(row, vec, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))


def _squared(mat: Column, size: int) -> Column:
    rows = range(size)
    return F.array(*[F.array(*[sum((mat[i][k] * mat[k][j] for k in rows), F.lit(0.0)) for j in rows]) for i in rows])


def vector_scan(t: DataFrame, series: Sequence[str], size: int, longest: int) -> DataFrame:
    """y_t = A y_{t-1} + c_t (y before the first row 0) over dense ``idx``.

    ``t``: series, idx, ``c`` (array of ``size``) and ``mat``, the matrix A of
    the series (array of rows). Groups of ``FAN`` elements are folded in order
    from 0; their ends form a scan of their own with A^FAN, whose result is
    carried into the groups. No task holds more than ``FAN`` elements of a
    series; ``longest`` (rows of the longest series) sets the levels.
    Returns series, idx, ``y``."""
    series = list(series)
    zeros = F.array(*[F.lit(0.0)] * size)
    g = t.groupBy(*series, F.floor(F.col("idx") / FAN).alias("__g")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "c"))).alias("__items"), F.first("mat").alias("mat"))

    def step(y, x):
        return F.zip_with(_times(F.col("mat"), y), x["c"], lambda a, b: a + b)

    if longest > FAN:
        g = materialize(g)  # read for the group ends and for the result
        power = g.select(*series, F.col("__g").alias("idx"), F.aggregate("__items", zeros, step).alias("c"), "mat")
        for _ in range(FAN.bit_length() - 1):
            power = power.withColumn("mat", F.transform(F.array("mat"), lambda m: _squared(m, size))[0])
        ends = vector_scan(power, series, size, -(-longest // FAN))
        carried = ends.select(*[F.col(c).alias(f"__s_{c}") for c in series], (F.col("idx") + 1).alias("__to"), F.col("y").alias("__in"))
        same = F.col("__g") == F.col("__to")
        for c in series:
            same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
        g = g.join(carried, same, "left").withColumn("__in", F.coalesce("__in", zeros))
    else:
        g = g.withColumn("__in", zeros)
    kind = "array<struct<idx:bigint,y:array<double>>>"
    start = F.struct(F.col("__in").alias("y"), F.array().cast(kind).alias("out"))

    def walk(acc, x):
        return F.transform(F.array(step(acc["y"], x)), lambda y: F.struct(
            y.alias("y"), F.concat(acc["out"], F.array(F.struct(x["idx"].cast("long").alias("idx"), y.alias("y")))).alias("out")))[0]

    return g.select(*series, F.inline(F.aggregate("__items", start, walk, lambda acc: acc["out"])))


def arma_residuals(
    df: DataFrame, coefs: DataFrame, series: Sequence[str], idx: str, value: str, before: str | None = None,
    lead: str | None = None, bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """``df`` with ``__d`` (array of the last p differences, latest first), the
    ARMA innovations ``__e`` (array of the last q, latest first) and the
    coefficients. e_t = dy_t - sum ar_k dy_{t-k} - sum ma_k e_{t-k}: a vector
    scan with the companion matrix of the MA part. Differences and innovations
    before the first row count as 0. For rows that continue a series, the first
    ``lead`` (a column) rows of the series only supply differences, are
    not returned, and ``before`` holds the innovations before the first returned
    row (latest first)."""
    series = list(series)
    p = len([c for c in coefs.columns if c.startswith("ar_")])
    q = len([c for c in coefs.columns if c.startswith("ma_")])
    t = windows.window_select(df, series, idx, lambda w: {f"__y{k}": F.lag(value, k).over(w) for k in range(1, p + 2)},
                              preceding=p + 1, bucket_rows=bucket_rows)
    y = [F.col(value), *[F.col(f"__y{k}") for k in range(1, p + 2)]]
    d = [F.coalesce(y[k] - y[k + 1], F.lit(0.0)) for k in range(p + 1)]
    t = t.withColumns({f"__d{k}": d[k] for k in range(p + 1)}).drop(*[f"__y{k}" for k in range(1, p + 2)])
    t = _with_coefficients(t, coefs, series)
    if lead is not None:
        t = t.where(F.col(idx) >= F.col(lead)).withColumn(idx, F.col(idx) - F.col(lead))
    c0 = F.col("__d0") - sum((F.col(f"ar_{k}") * F.col(f"__d{k}") for k in range(1, p + 1)), F.lit(0.0))
    t = t.withColumn("__d", F.array(*[F.col(f"__d{k}") for k in range(p)]).cast("array<double>")).withColumn("__u", c0)
    t = t.drop(*[f"__d{k}" for k in range(p + 1)])
    if not q:
        return t.withColumn("__e", F.array().cast("array<double>"))
    t = materialize(t)  # read by the scan and joined with its result
    mat = F.array(F.array(*[-F.col(f"ma_{k}") for k in range(1, q + 1)]),
                  *[F.array(*[F.lit(1.0 if j == i else 0.0) for j in range(q)]) for i in range(q - 1)])
    c = F.array(F.col("__u"), *[F.lit(0.0)] * (q - 1))
    if before is not None:
        entry = F.zip_with(c, _times(F.col("mat"), F.coalesce(F.col(before), F.array(*[F.lit(0.0)] * q))), lambda a, b: a + b)
        c = F.when(F.col(idx) == 0, entry).otherwise(c)
    rows = t.withColumn("mat", mat).select(*series, F.col(idx).cast("long").alias("idx"), c.alias("c"), "mat")
    longest = t.agg(F.max(idx)).first()[0]
    e = vector_scan(rows, series, q, (longest or 0) + 1)
    e = e.select(*[F.col(c).alias(f"__s_{c}") for c in series], F.col("idx").alias("__at"), F.col("y").alias("__e"))
    same = F.col(idx) == F.col("__at")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return t.join(e, same).drop("__at", "__u", *[f"__s_{c}" for c in series])


def _with_coefficients(t: DataFrame, coefs: DataFrame, series: list[str]) -> DataFrame:
    names = [c for c in coefs.columns if c.startswith(("ar_", "ma_"))]
    if not series:
        return t.withColumns({c: coefs.select(c).scalar() for c in names})
    side = coefs.select(*[F.col(c).alias(f"__s_{c}") for c in series], *names)
    same = None
    for c in series:
        eq = F.col(c).eqNullSafe(F.col(f"__s_{c}"))
        same = eq if same is None else same & eq
    return t.join(side, same).drop(*[f"__s_{c}" for c in series])


def arma_forecast(
    df: DataFrame, coefs: DataFrame, series: Sequence[str], idx: str, value: str,
    bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """M5: one-step forecast y_t + sum ar_k dy_{t-k+1} + sum ma_k e_{t-k+1} at
    every row, with the innovations of :func:`arma_residuals`. Adds ``forecast``
    (prediction for the next position); series without coefficients are left out."""
    t = arma_residuals(df, coefs, series, idx, value, bucket_rows=bucket_rows)
    return t.select(*df.columns, arma_step(coefs, value).alias("forecast"))


def arma_step(coefs: DataFrame, value: str) -> Column:
    """Forecast from the columns that :func:`arma_residuals` adds."""
    p = len([c for c in coefs.columns if c.startswith("ar_")])
    q = len([c for c in coefs.columns if c.startswith("ma_")])
    out = F.col(value)
    for k in range(p):
        out = out + F.col(f"ar_{k + 1}") * F.col("__d")[k]
    for k in range(q):
        out = out + F.col(f"ma_{k + 1}") * F.col("__e")[k]
    return out


def replay_sample(df: DataFrame, series: Sequence[str], pos: str, n_draws: int | None = None, seed: int = 42,
                  ts: str | None = None, stamp_now: bool = False) -> DataFrame:
    """Draw rows uniformly with replacement (per series, as many draws as
    rows unless ``n_draws``), each stamped with its own time or the current
    time. The draw is a hash join on the dense position, never a collect."""
    series = list(series)
    n = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    base = df.join(n, series) if series else df.withColumn("__n", n.select("__n").scalar())
    k = F.col(pos) if n_draws is None else None
    draws = base.select(*series, "__n", (k if k is not None else F.col(pos)).alias("draw_id"))
    if n_draws is not None:
        draws = n.select(*series, "__n", F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))).alias("draw_id"))
    draws = draws.withColumn("__j", hash_draw(F.lit(seed), F.col("draw_id"), F.col("__n")))
    rows = df.withColumnRenamed(pos, "__j")
    out = draws.join(rows, [*series, "__j"]).drop("__n")
    if stamp_now:
        out = out.withColumn("sent_at", F.current_timestamp())
    elif ts:
        out = out.withColumn("sent_at", F.col(ts))
    return out.withColumnRenamed("__j", "source_pos")



def engineered_features(
    df: DataFrame,
    series: Sequence[str],
    idx: str,
    ts: str,
    cols: Sequence[str],
    rolling_windows: Sequence[int] = (3, 6, 12, 24),
    lags: Sequence[int] = (1, 2, 3, 24),
    add_ema: bool = True,
    ema_windows: Sequence[int] = (3, 6, 12, 24),
    add_slopes: bool = True,
    slope_windows: Sequence[int] = (6, 12, 24),
    add_interactions: bool = True,
    interaction_lags: Sequence[int] = (1, 24),
    bucket_rows: int | None = windows.DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """M2: the full feature set on a cleaned, gap-free frame, in the
    reference's order: temporal parts and cyclic encodings, rolling mean/std,
    lags, EMA, slopes, lag interactions; every group can be switched off.

    Rolling stats, lags, slopes and the interaction lags share one window
    projection (one exchange); the EMA is the blocked scan."""
    series = list(series)
    t = timeaxis.add_temporal_features(df, ts)
    all_lags = sorted(set(lags) | (set(interaction_lags) if add_interactions else set()))
    t = windows.window_features(t, series, idx, cols, lags=all_lags, roll_windows=rolling_windows,
                                slope_windows=slope_windows if add_slopes else (), bucket_rows=bucket_rows)
    if add_ema:
        t = ema.ema_features(t, series, idx, cols, ema_windows)
    if add_interactions:
        t = t.withColumns({f"{a}__{b}": F.col(a) * F.col(b) for a, b in windows.interaction_names(cols, interaction_lags)})
    extra = [f"{c}_lag{k}" for k in all_lags if k not in set(lags) for c in cols]
    return t.drop(*extra)
