"""Aggregations: column statistics, QC, profiles, exact medians, correlations,
p-values and forecast errors.

Wide statistics are computed as one aggregate over the wide table (partial
aggregation on every task, a single tiny final merge) and only the one-row
result is reshaped into long form, so the data itself is never unpivoted
or shuffled by column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X
from hourglass.operators.clean import NUMERIC_TYPES
from hourglass.session import materialize


def _stack(one_row: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Reshape a one-row wide aggregate into one row per name.

    ``fields`` maps output column -> pattern with ``{i}`` for the name index.
    """
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(p.format(i=i)).alias(k) for k, p in fields.items()])
        for i, n in enumerate(names)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per-column mean, std (ddof 1), min, max in a single pass."""
    aggs = []
    for i, c in enumerate(cols):
        v = X.nan_to_null(c)
        aggs += [
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).cast("double").alias(f"min{i}"),
            F.max(v).cast("double").alias(f"max{i}"),
        ]
    return _stack(df.agg(*aggs), cols, {"mean": "mean{i}", "std": "std{i}", "min": "min{i}", "max": "max{i}"})


def qc_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column, total, missing, pct_missing (fraction), mean, std, min, max.

    Statistics are NULL for non-numeric or all-missing columns.
    """
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)}
    null_d = F.lit(None).cast("double")
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(cols):
        is_num = c in numeric
        v = X.nan_to_null(F.col(c).cast("double")) if is_num else F.col(c)
        aggs += [
            F.count(v).alias(f"present{i}"),
            (F.avg(v) if is_num else null_d).alias(f"mean{i}"),
            (F.stddev_samp(v) if is_num else null_d).alias(f"std{i}"),
            (F.min(v) if is_num else null_d).alias(f"min{i}"),
            (F.max(v) if is_num else null_d).alias(f"max{i}"),
        ]
    wide = df.agg(*aggs)
    long = _stack(
        wide,
        cols,
        {"total": "total", "present": "present{i}", "mean": "mean{i}", "std": "std{i}", "min": "min{i}", "max": "max{i}"},
    )
    return long.select(
        "column",
        F.col("total").cast("long").alias("total"),
        (F.col("total") - F.col("present")).cast("long").alias("missing"),
        F.when(F.col("total") > 0, (F.col("total") - F.col("present")) / F.col("total"))
        .otherwise(F.lit(0.0))
        .alias("pct_missing"),
        "mean",
        "std",
        "min",
        "max",
    )


def _dtype_name(dt: T.DataType) -> str:
    return {
        T.DoubleType: "float64",
        T.FloatType: "float32",
        T.IntegerType: "int32",
        T.LongType: "int64",
        T.ShortType: "int16",
        T.ByteType: "int8",
    }.get(type(dt), dt.simpleString())


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Feature, mean, std, min, max, non_null_count, dtype (training statistics)."""
    aggs = []
    for i, c in enumerate(cols):
        v = X.nan_to_null(F.col(c).cast("double"))
        aggs += [
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            F.count(v).alias(f"nn{i}"),
        ]
    wide = df.agg(*aggs).withColumns({f"dt{i}": F.lit(_dtype_name(df.schema[c].dataType)) for i, c in enumerate(cols)})
    long = _stack(
        wide,
        cols,
        {"mean": "mean{i}", "std": "std{i}", "min": "min{i}", "max": "max{i}", "non_null_count": "nn{i}", "dtype": "dt{i}"},
    )
    return long.withColumnRenamed("column", "feature").withColumn(
        "non_null_count", F.col("non_null_count").cast("long")
    )


def profile(df: DataFrame, ts: str, cols: Sequence[str], by: str = "hour", series: Sequence[str] = ()) -> DataFrame:
    """Mean of every column by hour of day (``by='hour'``) or by day
    of week, Monday = 0 (``by='dow'``)."""
    key = (F.hour(ts) if by == "hour" else X.day_of_week(ts)).cast("long")
    name = "hour_of_day" if by == "hour" else "day_of_week"
    return df.groupBy(*series, key.alias(name)).agg(*[F.avg(X.nan_to_null(c)).alias(f"{c}_mean") for c in cols])


SKETCH = 10_000  # accuracy of the rank sketch that brackets a median


def exact_median(
    df: DataFrame, series: Sequence[str], value: str, out: str = "median", relative_error: float | None = None,
    accuracy: int = SKETCH,
) -> DataFrame:
    """Exact median per series (NULLs ignored), midpoint of the two middle
    values for an even count.

    Distributed selection, one path at every size: a rank sketch per series
    gives a bracket that must hold the middle (its error is below 1 /
    ``accuracy`` of the rows, the bracket reaches twice as far to either side);
    a second pass counts the values below the bracket and, value by value, those
    inside; the middle positions are picked from the running counts inside. Only
    the distinct values inside (some 4 / ``accuracy`` of the rows) are shuffled
    and sorted. ``relative_error`` gives the sketch's own answer instead.
    """
    return exact_medians(df, series, {out: value}, relative_error, accuracy)


def exact_medians(
    df: DataFrame, series: Sequence[str], values: dict[str, str], relative_error: float | None = None, accuracy: int = SKETCH,
) -> DataFrame:
    """:func:`exact_median` of several columns (``{output: column}``) in the same
    two passes. A series without any value has no row; NULL where only one
    column has none."""
    series, names = list(series), list(values)
    v = df.select(*series, *[X.nan_to_null(F.col(c).cast("double")).alias(f"__v{i}") for i, c in enumerate(values.values())])
    some = [F.count(f"__v{i}") for i in range(len(names))]
    if relative_error is not None:
        acc = int(max(1, round(1.0 / relative_error)))
        got = v.groupBy(*series).agg(*[F.percentile_approx(f"__v{i}", 0.5, acc).cast("double").alias(n) for i, n in enumerate(names)])
        return got.where(F.coalesce(*names).isNotNull())
    reach = min(0.5, 2.0 / accuracy)
    ends = F.array(F.lit(0.5 - reach), F.lit(0.5 + reach))
    box = v.groupBy(*series).agg(*[F.percentile_approx(f"__v{i}", ends, accuracy).alias(f"__q{i}") for i in range(len(names))],
                                 *[c.alias(f"__n{i}") for i, c in enumerate(some)])
    box = materialize(box)  # one row per series, read by both passes
    t = with_series(v, box, series)
    cells = []
    for i in range(len(names)):
        x, lo, hi = F.col(f"__v{i}"), F.col(f"__q{i}")[0], F.col(f"__q{i}")[1]
        # below the bracket (x NULL), inside it, or not needed
        cells.append(F.when(x < lo, F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("x")))
                     .when(x <= hi, F.struct(F.lit(i).alias("i"), (x + F.lit(0.0)).alias("x"))))
    cell = t.select(*series, F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("__c"))
    counts = cell.groupBy(*series, F.col("__c.i").alias("__i"), F.col("__c.x").alias("__x")).agg(F.count(F.lit(1)).alias("__k"))
    upto = Window.partitionBy(*series, "__i").orderBy(F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    counts = with_series(counts.withColumn("__z", F.sum("__k").over(upto)), box, series)  # positions [z - k, z)
    n = F.element_at(F.array(*[F.col(f"__n{i}") for i in range(len(names))]), F.col("__i") + 1)
    held = lambda m: ((F.col("__z") - F.col("__k") <= m) & (m < F.col("__z")) & F.col("__x").isNotNull()).cast("int")
    times = held(F.floor((n - 1) / 2)) + held(F.ceil((n - 1) / 2))
    picked = counts.withColumn("__m", times).where("__m > 0")
    return picked.groupBy(*series).agg(*[
        (F.sum(F.when(F.col("__i") == i, F.col("__x") * F.col("__m"))) / 2).alias(name) for i, name in enumerate(names)
    ]).where(F.coalesce(*names).isNotNull())


def with_series(df: DataFrame, per_series: DataFrame, series: Sequence[str]) -> DataFrame:
    """``df`` with the columns of a one-row-per-series table (null-safe keys)."""
    if not series:
        return df.withColumns({c: per_series.select(c).scalar() for c in per_series.columns})
    side = per_series.withColumnsRenamed({c: f"__s_{c}" for c in series})
    same = None
    for c in series:
        eq = F.col(c).eqNullSafe(F.col(f"__s_{c}"))
        same = eq if same is None else same & eq
    return df.join(side, same).drop(*[f"__s_{c}" for c in series])


def median_mad(df: DataFrame, series: Sequence[str], value: str, relative_error: float | None = None) -> DataFrame:
    """Per series median and MAD = median(|x - median|), both by
    ``exact_median``; no group is gathered in one row or task."""
    return median_mads(df, series, {"": value}, relative_error)


def median_mads(df: DataFrame, series: Sequence[str], values: dict[str, str], relative_error: float | None = None) -> DataFrame:
    """``median<suffix>`` and ``mad<suffix>`` of several columns
    (``{suffix: column}``): one selection for all medians, one for all MADs."""
    series = list(series)
    med = exact_medians(df, series, {f"median{k}": c for k, c in values.items()}, relative_error)
    med = materialize(med)  # one row per series
    dev = with_series(df.select(*series, *[F.col(c).alias(f"__x{i}") for i, c in enumerate(values.values())]), med, series)
    dev = dev.select(*series, *[F.abs(X.nan_to_null(F.col(f"__x{i}").cast("double")) - F.col(f"median{k}")).alias(f"__d{i}") for i, k in enumerate(values)])
    mad = exact_medians(dev, series, {f"mad{k}": f"__d{i}" for i, k in enumerate(values)}, relative_error)
    if not series:
        return med.select(*med.columns, *[mad.select(c).scalar().alias(c) for c in mad.columns])
    return med.join(mad, series)


def corr_matrix(df: DataFrame, cols: Sequence[str], min_n: int = 3) -> DataFrame:
    """E9 + B8 + J2: Pearson r over pairwise complete rows, every pair computed
    once (i < j) in one aggregate pass, then mirrored; diagonal exactly 1.

    Output: col_a, col_b, n, r (NULL when n < ``min_n`` or a variance is 0).
    """
    cols = list(cols)
    pairs = list(combinations(range(len(cols)), 2))
    aggs = []
    for i, j in pairs:
        a, b = X.nan_to_null(cols[i]), X.nan_to_null(cols[j])
        both = a.isNotNull() & b.isNotNull()
        # Pearson r over pairwise complete rows; a zero variance gives NULL
        # (``corr`` itself raises DIVIDE_BY_ZERO under ANSI mode)
        r = F.try_divide(F.covar_samp(a, b), F.stddev_samp(F.when(both, a)) * F.stddev_samp(F.when(both, b)))
        aggs += [r.alias(f"r{i}_{j}"), F.count_if(both).alias(f"n{i}_{j}")]
    for i, c in enumerate(cols):
        aggs.append(F.count(X.nan_to_null(c)).alias(f"n{i}_{i}"))
    wide = df.agg(*aggs)
    structs = []
    for i, j in pairs:
        r = F.when(F.col(f"n{i}_{j}") >= min_n, X.nan_to_null(f"r{i}_{j}"))
        for a, b in ((i, j), (j, i)):
            structs.append(
                F.struct(
                    F.lit(cols[a]).alias("col_a"),
                    F.lit(cols[b]).alias("col_b"),
                    F.col(f"n{i}_{j}").cast("long").alias("n"),
                    r.alias("r"),
                )
            )
    for i, c in enumerate(cols):
        structs.append(
            F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.col(f"n{i}_{i}").cast("long").alias("n"), F.lit(1.0).alias("r"))
        )
    return wide.select(F.inline(F.array(*structs)))


def corr_long(df: DataFrame, on: str, key: str, value: str, min_n: int = 3) -> DataFrame:
    """E9 on long rows (one per ``on`` and ``key``): Pearson r of every pair of
    keys in the data over the ``on`` that both have a value for.

    Output: col_a < col_b, n, r (NULL when n < ``min_n`` or a variance is 0).
    """
    rows = df.select(on, key, X.nan_to_null(value).alias("v")).where(F.col(key).isNotNull())
    a = rows.select(on, F.col(key).alias("col_a"), F.col("v").alias("a")).where("a IS NOT NULL")
    b = rows.select(on, F.col(key).alias("col_b"), F.col("v").alias("b")).where("b IS NOT NULL")
    r = F.try_divide(F.covar_samp("a", "b"), F.stddev_samp("a") * F.stddev_samp("b"))
    both = a.join(b, on).where("col_a < col_b").groupBy("col_a", "col_b").agg(
        F.count(F.lit(1)).alias("n"), r.alias("r"))
    keys = rows.select(key).distinct()
    pairs = keys.select(F.col(key).alias("col_a")).join(keys.select(F.col(key).alias("col_b")), F.col("col_a") < F.col("col_b"))
    return pairs.join(both, ["col_a", "col_b"], "left").select(
        "col_a", "col_b", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.when(F.col("n") >= min_n, X.nan_to_null("r")).alias("r"))


def corr_pairs(corr: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """Unordered pairs i < j in the given column order, by name without."""
    if order is None:
        return corr.where(F.col("col_a") < F.col("col_b"))
    pos = {c: i for i, c in enumerate(order)}
    m = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return corr.where(m[F.col("col_a")] < m[F.col("col_b")])


def top_correlations(corr: DataFrame, order: Sequence[str] | None, k: int = 5) -> DataFrame:
    """H2: top-k pairs by |r| descending, ties by names descending."""
    pairs = corr_pairs(corr, order).select("col_a", "col_b", "r")
    ranked = pairs.orderBy(
        F.abs("r").desc_nulls_last(), F.col("col_a").desc(), F.col("col_b").desc(), F.col("r").desc_nulls_last()
    ).limit(k)
    # k rows only: numbering them needs no distributed index
    w = Window.orderBy(F.abs("r").desc_nulls_last(), F.col("col_a").desc(), F.col("col_b").desc())
    return ranked.select(F.row_number().over(w).cast("long").alias("rank"), "col_a", "col_b", "r")


# fixed values: Gamma(z + 1/2) / Gamma(z) = sqrt(z) * sum of these over z^k
HALF_STEP = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)
HALF_SHIFT = 64  # the series is taken this far above the argument
TINY, CLOSE = 1e-300, 1e-15


def _gamma_ratio(a: Column) -> Column:
    """Gamma(a + 1/2) / Gamma(a): asymptotic series above, product down."""
    z = a + HALF_SHIFT
    total = F.lit(0.0)
    for c in reversed(HALF_STEP):
        total = total / z + F.lit(c)
    down = F.aggregate(F.sequence(F.lit(0), F.lit(HALF_SHIFT - 1)), F.lit(1.0), lambda s, i: s * ((a + i) / (a + i + 0.5)))
    return F.sqrt(z) * total * down


def _beta_fraction(a: Column, b: Column, x: Column, steps: Column) -> Column:
    """Continued fraction of the incomplete beta function (Lentz), minus one."""

    def step(s, i):
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        num = F.when(i == 0, F.lit(1.0)).when(i % 2 == 0, even).otherwise(odd)
        keep = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)
        parts = F.struct((1 / keep(1 + num * s["d"])).alias("d"), keep(1 + num / s["c"]).alias("c"))
        fresh = F.transform(F.array(parts), lambda q: F.struct(
            (s["f"] * q["c"] * q["d"]).alias("f"), q["c"].alias("c"), q["d"].alias("d"), (F.abs(1 - q["c"] * q["d"]) < CLOSE).alias("done")))[0]
        return F.when(s["done"], s).otherwise(fresh)

    start = F.struct(F.lit(1.0).alias("f"), F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), steps), start, step, lambda s: s["f"] - 1)


def pearson_pvalues(df: DataFrame, r: str, n: str, out: str = "p") -> DataFrame:
    """Two-sided p-value of ``r`` over ``n`` pairs, n - 2 degrees of freedom:
    I_x(df / 2, 1/2) with x = 1 - r^2, from column expressions alone. NULL
    without r or without degrees of freedom."""
    free = F.col(n).cast("double") - 2
    ok = F.col(r).isNotNull() & (free > 0)
    t = df.withColumns({"__a": F.when(ok, free / 2), "__y": F.when(ok, F.least(F.col(r) * F.col(r), F.lit(1.0)))})
    t = t.withColumn("__swap", (1 - F.col("__y")) > (F.col("__a") + 1) / (F.col("__a") + 2.5))
    half, a, y, swap = F.lit(0.5), F.col("__a"), F.col("__y"), F.col("__swap")
    t = t.withColumns({"__p": F.when(swap, half).otherwise(a), "__q": F.when(swap, a).otherwise(half), "__x": F.when(swap, y).otherwise(1 - y),
                       "__g": _gamma_ratio(a), "__s": (F.lit(200) + 4 * F.sqrt(a)).cast("long")})
    front = F.exp(a * F.log1p(-y)) * F.sqrt(y) * F.col("__g") / math.sqrt(math.pi) / F.col("__p")
    t = t.withColumn("__v", F.when((y > 0) & (y < 1), front * _beta_fraction(F.col("__p"), F.col("__q"), F.col("__x"), F.col("__s"))))
    p = F.when(y <= 0, F.lit(1.0)).when(y >= 1, F.lit(0.0)).when(swap, 1 - F.col("__v")).otherwise(F.col("__v"))
    return t.withColumn(out, p).drop("__a", "__y", "__swap", "__p", "__q", "__x", "__g", "__s", "__v")


def pearson_pvalues_sql(frame: str) -> str:
    """CTEs ``pv0 .. pval(col_a, col_b, n, r, p)``: :func:`pearson_pvalues` in SQL,
    for a recursive WITH over ``frame(col_a, col_b, n, r)``."""
    series = "0.0"
    for c in reversed(HALF_STEP):
        series = f"({series} / (a + {HALF_SHIFT}) + {c!r})"
    num = """CASE WHEN i = 0 THEN 1.0 WHEN i % 2 = 0 THEN (i // 2) * (q - i // 2) * x / ((p + 2 * (i // 2) - 1) * (p + 2 * (i // 2)))
             ELSE -(p + i // 2) * (p + q + i // 2) * x / ((p + 2 * (i // 2)) * (p + 2 * (i // 2) + 1)) END"""
    keep = lambda v: f"CASE WHEN abs({v}) < {TINY!r} THEN {TINY!r} ELSE {v} END"
    return f"""pv0 AS (SELECT col_a, col_b, n, r, (n - 2) / 2.0::DOUBLE AS a, least(r * r, 1.0::DOUBLE) AS y FROM {frame} WHERE r IS NOT NULL AND n > 2),
pv1 AS (SELECT *, 1 - y > (a + 1) / (a + 2.5) AS swap,
        sqrt(a + {HALF_SHIFT}) * {series} * list_product(list_transform(range(0, {HALF_SHIFT}), lambda i: (a + i) / (a + i + 0.5))) AS g FROM pv0),
pv2 AS (SELECT *, CASE WHEN swap THEN 0.5 ELSE a END AS p, CASE WHEN swap THEN a ELSE 0.5 END AS q, CASE WHEN swap THEN y ELSE 1 - y END AS x FROM pv1),
lentz(col_a, col_b, i, f, c, d, done) AS (
  SELECT col_a, col_b, 0, 1.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, false FROM pv2 WHERE y > 0 AND y < 1
  UNION ALL
  SELECT col_a, col_b, i + 1, f * c2 * d2, c2, d2, abs(1 - c2 * d2) < {CLOSE!r}
  FROM (SELECT *, {keep("(1 + num / c)")} AS c2, 1 / ({keep("(1 + num * d)")}) AS d2
        FROM (SELECT l.*, {num} AS num FROM lentz l JOIN pv2 USING (col_a, col_b) WHERE NOT done AND i <= 200 + 4 * sqrt(a)))),
fin AS (SELECT col_a, col_b, arg_max(f, i) - 1 AS f FROM lentz GROUP BY 1, 2),
pval AS (SELECT t.col_a, t.col_b, t.n, t.r,
                CASE WHEN y <= 0 THEN 1.0 WHEN y >= 1 THEN 0.0 WHEN swap THEN 1 - v WHEN NOT swap THEN v END AS p
         FROM {frame} t LEFT JOIN (SELECT pv2.*, exp(a * ln(1 - y)) * sqrt(y) * g / sqrt(pi()) / p * f AS v FROM pv2 LEFT JOIN fin USING (col_a, col_b)) USING (col_a, col_b))"""


def corr_pvalues(corr: DataFrame) -> DataFrame:
    """E10 + E11 + A6: r, p (diagonal NULL), stars and ``%.12e`` text."""
    p = F.when(F.col("col_a") != F.col("col_b"), F.col("p"))
    return pearson_pvalues(corr, "r", "n").withColumn("p", p).withColumns(
        {"stars": X.significance_stars("p"), "p_text": X.sci12("p")}
    )


def forecast_errors(df: DataFrame, y: str, model: str, baseline: str, series: Sequence[str] = ()) -> DataFrame:
    """E12 + E13: n, MAE/RMSE of model and baseline, mean paired |e| difference."""
    em = F.col(model) - F.col(y)
    eb = F.col(baseline) - F.col(y)
    ok = F.col(y).isNotNull() & F.col(model).isNotNull() & F.col(baseline).isNotNull()
    d = df.where(ok)
    return d.groupBy(*series).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(F.abs(em)).alias("mae_model"),
        F.sqrt(F.avg(em * em)).alias("rmse_model"),
        F.avg(F.abs(eb)).alias("mae_baseline"),
        F.sqrt(F.avg(eb * eb)).alias("rmse_baseline"),
        F.avg(F.abs(em) - F.abs(eb)).alias("mae_diff_mean"),
    )
