"""Time-series analytics: ACF/PACF, classical decomposition, anomaly rules,
anomaly tables and the summary table.

Inputs are long frames (series, idx, value) with a dense per-series ``idx``
and gap-free values (impute first). Per-series statistics are small tables
joined back on the series key; every window is halo-bucketed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.exprs import Z_975
from hourglass.operators import stats, timeaxis
from hourglass.operators.windows import DEFAULT_BUCKET_ROWS, centered_moving_average, window_select
from hourglass.session import materialize

# Fixed values that must equal the reference for equal results.
MAD_SCALE = 1.4826  # MAD -> sigma for normal data
ANOMALY_THRESHOLD = 3.0
RESID_MAD_FLOOR = 1e-9  # residual MAD of 0 is replaced by this
METHOD_Z, METHOD_MAD, METHOD_RESID = "zscore", "mad", "seasonal_residual"


def _join_stats(df: DataFrame, st: DataFrame, series: Sequence[str]) -> DataFrame:
    if series:
        return df.join(st, list(series), "left")
    return df.withColumns({c: st.select(c).scalar() for c in st.columns})


def acf(
    df: DataFrame, series: Sequence[str], idx: str, value: str, nlags: int = 40,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS, materialize_input: bool = True,
) -> DataFrame:
    """G1: r_k = sum (x_t - m)(x_{t-k} - m) / sum (x_t - m)^2 for k = 0..nlags
    (k < n), with the Bartlett 95% half width 1.96 * sqrt((1 + 2 sum_{j<k} r_j^2) / n)
    (1/n at k = 1, 0 at k = 0). Output: series, lag, r, ci_half_width."""
    series = list(series)
    if materialize_input:
        df = materialize(df.select(*series, idx, value))  # read by the statistics and the lag branches
    means = df.groupBy(*series).agg(F.avg(value).alias("__m"), F.count(value).alias("__n"))
    d = _join_stats(df, means, series).withColumn("__d", F.col(value) - F.col("__m"))
    lagged = window_select(
        d, series, idx, lambda w: {f"__l{k}": F.lag("__d", k).over(w) for k in range(1, nlags + 1)},
        preceding=nlags, bucket_rows=bucket_rows,
    )
    sums = lagged.groupBy(*series).agg(
        F.first("__n").alias("__n"),
        F.sum(F.col("__d") * F.col("__d")).alias("__c0"),
        *[F.coalesce(F.sum(F.col("__d") * F.col(f"__l{k}")), F.lit(0.0)).alias(f"__c{k}") for k in range(1, nlags + 1)],
    )
    long = sums.select(
        *series, "__n",
        F.inline(F.array(*[F.struct(F.lit(k).cast("long").alias("lag"), F.try_divide(F.col(f"__c{k}"), F.col("__c0")).alias("r"))
                           for k in range(nlags + 1)])),
    ).where(F.col("lag") < F.col("__n"))
    w = Window.partitionBy(*series).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("r") * F.col("r"))).over(w), F.lit(0.0))
    var = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise((1.0 + 2.0 * prior) / F.col("__n"))
    return long.select(*series, "lag", "r", (F.lit(Z_975) * F.sqrt(var)).alias("ci_half_width"))


def pacf(acf_table: DataFrame, series: Sequence[str], n_table: DataFrame) -> DataFrame:
    """Yule-Walker partial autocorrelation: Durbin-Levinson as a fold over the
    array of a series' autocorrelations (nlags + 1 values), band 1.96/sqrt(n).
    NULL from the lag on where the recursion has no variance left.

    ``n_table`` gives (series..., n). Output: series, lag, r, ci_half_width.
    """
    series = list(series)
    lists = acf_table.groupBy(*series).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "r"))), lambda x: x["r"]).alias("__r"))
    t = lists.join(n_table, series) if series else lists.withColumn("n", n_table.select("n").scalar())
    r, none = F.col("__r"), F.array().cast("array<double>")

    def step(s, k):
        k = k.cast("int")
        met = F.zip_with(s["phi"], F.reverse(F.slice(r, F.lit(2), k - 1)), lambda x, y: x * y)
        rest = r[k] - F.aggregate(met, F.lit(0.0), lambda u, x: u + x)

        def grow(a):
            phi = F.concat(F.zip_with(s["phi"], F.reverse(s["phi"]), lambda x, y: x - a * y), F.array(a))
            return F.struct(phi.alias("phi"), (s["v"] * (1 - a * a)).alias("v"), F.concat(s["out"], F.array(a)).alias("out"))

        return F.transform(F.array(F.when(s["v"] > 0, rest / s["v"])), grow)[0]

    start = F.struct(none.alias("phi"), F.lit(1.0).alias("v"), none.alias("out"))
    folded = F.when(F.size(r) > 1, F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(r) - 1, F.lit(1))), start, step, lambda s: s["out"])).otherwise(none)
    out = t.select(*series, "n", F.posexplode(F.concat(F.array(F.lit(1.0)), folded)).alias("lag", "r"))
    half = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(Z_975) / F.sqrt("n"))
    return out.select(*series, F.col("lag").cast("long").alias("lag"), "r", half.alias("ci_half_width"))


def seasonal_decompose(
    df: DataFrame, series: Sequence[str], idx: str, value: str, period: int = 24,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS, materialize_input: bool = True,
) -> DataFrame:
    """G4 + F11: additive classical decomposition.

    trend = centered moving average (NULL at the ends); seasonal = mean of
    the detrended values per phase (idx % period), centered to mean 0 over
    the phases; resid = observed - trend - seasonal. The phase table has
    ``period`` rows per series. Adds observed, trend, seasonal, resid.
    """
    series = list(series)
    if materialize_input:
        df = materialize(df)  # read by the phase-average and the residual branches
    t = centered_moving_average(df, series, idx, value, period, "trend", bucket_rows)
    t = t.withColumns({"observed": F.col(value), "__detr": F.col(value) - F.col("trend"),
                       "__phase": (F.col(idx) % period).cast("int")})
    ph = t.groupBy(*series, "__phase").agg(F.avg("__detr").alias("__pa"))
    ph = ph.withColumn("seasonal", F.col("__pa") - F.avg("__pa").over(Window.partitionBy(*series))).drop("__pa")
    out = t.join(ph, [*series, "__phase"], "left")
    return out.withColumn("resid", F.col("__detr") - F.col("seasonal")).drop("__detr", "__phase")


def zscore_columns(df: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """z = (x - mean) / std (ddof 1); std = 0 gives z = 0."""
    st = df.groupBy(*series).agg(F.avg(value).alias("__mean"), F.stddev_samp(value).alias("__std"))
    t = _join_stats(df, st, series)
    z = F.when(F.col("__std") == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("__mean")) / F.col("__std"))
    return t.withColumn("z_score", z).drop("__mean", "__std")


def mad_columns(
    df: DataFrame, series: Sequence[str], value: str, out: str = "mad_z", floor: float | None = None,
    relative_error: float | None = None,
) -> DataFrame:
    """mad_z = (x - median) / (1.4826 * MAD); MAD = 0 gives 0, or uses ``floor``."""
    return mad_scores(df, series, {out: (value, floor)}, relative_error)


def mad_scores(df: DataFrame, series: Sequence[str], scores: dict[str, tuple[str, float | None]],
               relative_error: float | None = None) -> DataFrame:
    """:func:`mad_columns` of several columns (``{output: (column, floor)}``); all
    medians come from the same passes."""
    mm = stats.median_mads(df, series, {f"__{o}": v for o, (v, _) in scores.items()}, relative_error)
    t = _join_stats(df, mm, series)
    cols = {}
    for o, (value, floor) in scores.items():
        med, raw = F.col(f"median__{o}"), F.col(f"mad__{o}")
        mad = raw if floor is None else F.when(raw == 0, F.lit(floor)).otherwise(raw)
        z = (F.col(value) - med) / (F.lit(MAD_SCALE) * mad)
        cols[o] = z if floor is not None else F.when(raw == 0, F.lit(0.0)).otherwise(z)
    return t.withColumns(cols).drop(*[f"{k}__{o}" for o in scores for k in ("median", "mad")])


def anomaly_scores(
    df: DataFrame, series: Sequence[str], idx: str, value: str, period: int = 24,
    relative_error: float | None = None, bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """z_score, mad_z and the residual MAD score ``resid_z`` on one wide row per
    point. The residual score needs more than ``period`` points in the
    series (NULL otherwise); NULL residuals (series ends) get no score."""
    series = list(series)
    t = materialize(df.where(F.col(value).isNotNull()))
    sized = t.groupBy(*series).agg(F.count(F.lit(1)).alias("__cnt"))
    dec = seasonal_decompose(_join_stats(t, sized, series), series, idx, value, period, bucket_rows, materialize_input=False)
    dec = dec.withColumn("__r", F.when(F.col("__cnt") > period, F.col("resid")))
    dec = materialize(zscore_columns(dec, series, value))
    dec = mad_scores(dec, series, {"mad_z": (value, None), "resid_z": ("__r", RESID_MAD_FLOOR)}, relative_error)
    return dec.drop("__cnt", "__r", "trend", "seasonal", "observed")


def _flag(c: str, thr: float) -> Column:
    return F.coalesce(F.abs(F.col(c)) > thr, F.lit(False))


def anomaly_table(scored: DataFrame, series: Sequence[str], ts: str, value: str,
                  threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """One row per anomalous point, precedence zscore > mad > residual;
    z_score and mad_z are NULL on residual rows.
    Output: ts, series..., value, z_score, mad_z, method."""
    zf, mf, rf = _flag("z_score", threshold), _flag("mad_z", threshold), _flag("resid_z", threshold)
    method = F.when(zf, F.lit(METHOD_Z)).when(mf, F.lit(METHOD_MAD)).when(rf, F.lit(METHOD_RESID))
    resid_row = ~zf & ~mf
    return scored.where(zf | mf | rf).select(
        F.col(ts), *series, F.col(value).alias("value"),
        F.when(resid_row, F.lit(None).cast("double")).otherwise(F.col("z_score")).alias("z_score"),
        F.when(resid_row, F.lit(None).cast("double")).otherwise(F.col("mad_z")).alias("mad_z"),
        method.alias("method"),
    )


def anomaly_table_by_exclusion(scored: DataFrame, series: Sequence[str], ts: str, value: str,
                               threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """I2 + J1: the same table built as in the reference: each method's rows
    minus points already reported by an earlier method (left anti joins on
    (series, ts)), appended with UNION ALL."""
    key = [*series, ts]
    base = scored.select(F.col(ts), *series, F.col(value).alias("value"), "z_score", "mad_z", "resid_z")
    z = base.where(_flag("z_score", threshold))
    m = base.where(_flag("mad_z", threshold))
    r = base.where(_flag("resid_z", threshold))
    null = F.lit(None).cast("double")
    z_rows = z.select(ts, *series, "value", "z_score", "mad_z", F.lit(METHOD_Z).alias("method"))
    m_rows = m.join(z.select(*key), key, "left_anti").select(
        ts, *series, "value", "z_score", "mad_z", F.lit(METHOD_MAD).alias("method"))
    r_rows = (r.join(z.select(*key), key, "left_anti").join(m.select(*key), key, "left_anti")
              .select(ts, *series, "value", null.alias("z_score"), null.alias("mad_z"), F.lit(METHOD_RESID).alias("method")))
    return z_rows.unionByName(m_rows).unionByName(r_rows)


def anomaly_counts(anoms: DataFrame, group: str) -> DataFrame:
    """Anomaly count per group plus the total (group NULL) via ROLLUP."""
    return anoms.rollup(group).agg(F.count(F.lit(1)).cast("long").alias("n"))


def summary_table(corr: DataFrame, order: Sequence[str] | None, anoms: DataFrame, group: str, k: int = 5) -> DataFrame:
    """Section, rank, label, value - the top-k absolute correlations
    (H2) and the anomaly total and per-group counts (E6), largest first."""
    top = stats.top_correlations(corr, order, k).select(
        F.lit("top_correlations").alias("section"), "rank",
        F.concat_ws(" vs ", "col_a", "col_b").alias("label"), F.col("r").alias("value"))
    counts = anomaly_counts(anoms, group)
    # as many groups as the data has: numbered without gathering them in one task
    ranked = timeaxis.row_index(counts.where(F.col(group).isNotNull()).withColumn("__down", -F.col("n")), [], ["__down", group], "__rank")
    per = ranked.select(
        F.lit("anomalies").alias("section"), (F.col("__rank") + 1).alias("rank"),
        F.col(group).alias("label"), F.col("n").cast("double").alias("value"))
    tot = counts.where(F.col(group).isNull()).select(
        F.lit("anomalies").alias("section"), F.lit(0).cast("long").alias("rank"),
        F.lit("total").alias("label"), F.col("n").cast("double").alias("value"))
    return top.unionByName(tot).unionByName(per)
