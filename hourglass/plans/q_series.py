"""Queries for time-series analytics (G) on the hourly event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.operators import series as TS
from hourglass.operators import stats, stl
from hourglass.plans import frames
from hourglass.plans.catalog import query, r6
from hourglass.plans.sqlparts import HOURLY_CTE
from hourglass.session import materialize

S = ["series"]
NLAGS = 40
PERIOD = 24

_PART = "PARTITION BY series ORDER BY idx"
DECOMP_CTE = f"""{HOURLY_CTE},
tr AS (
  SELECT series, ts_hour, idx, value,
         CASE WHEN count(value) OVER ({_PART} ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
              THEN (sum(value) OVER ({_PART} ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)
                    + sum(value) OVER ({_PART} ROWS BETWEEN 11 PRECEDING AND 12 FOLLOWING)) / 48.0 END AS trend
  FROM himp),
ph AS (SELECT series, idx % 24 AS phase, avg(value - trend) AS pa FROM tr GROUP BY 1, 2),
pc AS (SELECT series, phase, pa - avg(pa) OVER (PARTITION BY series) AS seasonal FROM ph),
dec AS (
  SELECT tr.series, tr.ts_hour, tr.idx, tr.value, tr.trend, pc.seasonal, (tr.value - tr.trend) - pc.seasonal AS resid
  FROM tr JOIN pc ON pc.series = tr.series AND pc.phase = tr.idx % 24)
"""

SCORE_CTE = f"""{DECOMP_CTE},
st AS (SELECT series, avg(value) AS mean, stddev_samp(value) AS std, median(value) AS med, count(*) AS cnt
       FROM himp GROUP BY 1),
md AS (SELECT h.series, median(abs(h.value - st.med)) AS mad FROM himp h JOIN st USING (series) GROUP BY 1),
rs AS (SELECT d.series, median(d.resid) AS rmed FROM dec d JOIN st USING (series)
       WHERE st.cnt > 24 AND d.resid IS NOT NULL GROUP BY 1),
rm AS (SELECT d.series, median(abs(d.resid - rs.rmed)) AS rmad FROM dec d JOIN rs USING (series)
       WHERE d.resid IS NOT NULL GROUP BY 1),
sc AS (
  SELECT d.series, d.ts_hour, d.value,
         CASE WHEN st.std = 0 THEN 0.0 ELSE (d.value - st.mean) / st.std END AS z,
         CASE WHEN md.mad = 0 THEN 0.0 ELSE (d.value - st.med) / (1.4826 * md.mad) END AS mz,
         CASE WHEN st.cnt > 24 AND d.resid IS NOT NULL
              THEN (d.resid - rs.rmed) / (1.4826 * CASE WHEN rm.rmad = 0 THEN 1e-9 ELSE rm.rmad END) END AS rz
  FROM dec d JOIN st USING (series) JOIN md USING (series) LEFT JOIN rs USING (series) LEFT JOIN rm USING (series)),
an AS (
  SELECT ts_hour, series, value,
         CASE WHEN abs(z) > 3 OR abs(mz) > 3 THEN z END AS z_score,
         CASE WHEN abs(z) > 3 OR abs(mz) > 3 THEN mz END AS mad_z,
         CASE WHEN abs(z) > 3 THEN 'zscore' WHEN abs(mz) > 3 THEN 'mad' ELSE 'seasonal_residual' END AS method
  FROM sc WHERE abs(z) > 3 OR abs(mz) > 3 OR coalesce(abs(rz) > 3, false))
"""

ANOMALY_SELECT = """SELECT ts_hour, series, round(value, 6) AS value, round(z_score, 6) AS z_score,
       round(mad_z, 6) AS mad_z, method FROM an"""


def _h(spark, sf_dir):
    return frames.hourly_imputed(spark, sf_dir)


def _scored(spark, sf_dir):
    return TS.anomaly_scores(_h(spark, sf_dir), S, "idx", "value", PERIOD)


@query(
    "acf",
    f"""WITH {HOURLY_CTE},
d AS (SELECT series, idx, value - avg(value) OVER (PARTITION BY series) AS d,
             count(*) OVER (PARTITION BY series) AS n FROM himp),
c AS (SELECT a.series, k.lag, sum(a.d * b.d) AS ck
      FROM d a JOIN range(0, {NLAGS + 1}) AS k(lag) ON true
      JOIN d b ON b.series = a.series AND b.idx = a.idx - k.lag GROUP BY 1, 2),
c0 AS (SELECT series, sum(d * d) AS c0, any_value(n) AS n FROM d GROUP BY 1),
r AS (SELECT c.series, c.lag, c.ck / c0.c0 AS r, c0.n FROM c JOIN c0 USING (series) WHERE c.lag < c0.n)
SELECT series, CAST(lag AS BIGINT) AS lag, round(r, 6) AS r,
       round(1.959963984540054 * sqrt(CASE WHEN lag = 0 THEN 0.0 ELSE
         (1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN r * r END) OVER (PARTITION BY series ORDER BY lag
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / n END), 6) AS ci_half_width
FROM r""",
)
def acf(spark, sf_dir):
    return r6(TS.acf(_h(spark, sf_dir), S, "idx", "value", NLAGS))


@query(
    "pacf",
    f"""WITH RECURSIVE {HOURLY_CTE},
d AS (SELECT series, idx, value - avg(value) OVER (PARTITION BY series) AS d,
             count(*) OVER (PARTITION BY series) AS n FROM himp),
c AS (SELECT a.series, k.lag, sum(a.d * b.d) AS ck
      FROM d a JOIN range(0, {NLAGS + 1}) AS k(lag) ON true
      JOIN d b ON b.series = a.series AND b.idx = a.idx - k.lag GROUP BY 1, 2),
c0 AS (SELECT series, sum(d * d) AS c0, any_value(n) AS n FROM d GROUP BY 1),
ar AS MATERIALIZED (SELECT c.series, list(c.ck / c0.c0 ORDER BY c.lag) AS r, any_value(c0.n) AS n
                    FROM c JOIN c0 USING (series) WHERE c.lag < c0.n GROUP BY 1),
dl(series, k, phi, v, a) AS (
  SELECT series, 0::BIGINT, []::DOUBLE[], 1.0::DOUBLE, 1.0::DOUBLE FROM ar
  UNION ALL
  SELECT series, k + 1, list_append(list_transform(phi, lambda x, i: x - a2 * phi[k + 1 - i]), a2), v * (1 - a2 * a2), a2
  FROM (SELECT dl.*, CASE WHEN v > 0 THEN (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda x, i: x * r[k + 2 - i])), 0)) / v END AS a2
        FROM dl JOIN ar USING (series) WHERE k + 2 <= len(r)))
SELECT dl.series, dl.k AS lag, round(dl.a, 6) AS r,
       CASE WHEN dl.k = 0 THEN 0.0 ELSE round(1.959963984540054 / sqrt(ar.n), 6) END AS ci_half_width
FROM dl JOIN ar USING (series)""",
)
def pacf(spark, sf_dir):
    """Durbin-Levinson over the ACF rows."""
    h = _h(spark, sf_dir)
    a = TS.acf(h, S, "idx", "value", NLAGS).select("series", "lag", "r")
    n = h.groupBy("series").agg(F.count(F.lit(1)).alias("n"))
    return r6(TS.pacf(a, S, n))


@query(
    "seasonal_decompose",
    f"""WITH {DECOMP_CTE}
SELECT series, ts_hour, round(value, 6) AS observed, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(resid, 6) AS resid FROM dec""",
)
def seasonal_decompose(spark, sf_dir):
    d = TS.seasonal_decompose(_h(spark, sf_dir), S, "idx", "value", PERIOD)
    return r6(d.select("series", "ts_hour", "observed", "trend", "seasonal", "resid"))


@query("stl_decompose")
def stl_decompose(spark, sf_dir):
    """Robust seasonal-trend decomposition of the hourly means (an iteration
    without SQL; tested against a plain version)."""
    d = stl.stl_decompose(_h(spark, sf_dir), S, "idx", "value", PERIOD, inner=2, outer=1, robust=True)
    return r6(d.select("series", "ts_hour", "value", "trend", "seasonal", "resid", "weights"))


@query(
    "anomaly_zscore",
    f"""WITH {SCORE_CTE}
SELECT ts_hour, series, round(value, 6) AS value, round(z, 6) AS z_score, round(mz, 6) AS mad_z, 'zscore' AS method
FROM sc WHERE abs(z) > 3""",
)
def anomaly_zscore(spark, sf_dir):
    h = _h(spark, sf_dir)
    t = TS.mad_columns(TS.zscore_columns(h, S, "value"), S, "value")
    out = t.where(F.abs("z_score") > TS.ANOMALY_THRESHOLD).select(
        "ts_hour", "series", "value", "z_score", "mad_z", F.lit(TS.METHOD_Z).alias("method"))
    return r6(out)


@query(
    "anomaly_mad",
    f"""WITH {SCORE_CTE}
SELECT ts_hour, series, round(value, 6) AS value, round(z, 6) AS z_score, round(mz, 6) AS mad_z, 'mad' AS method
FROM sc WHERE abs(mz) > 3""",
)
def anomaly_mad(spark, sf_dir):
    h = _h(spark, sf_dir)
    t = TS.mad_columns(TS.zscore_columns(h, S, "value"), S, "value")
    out = t.where(F.abs("mad_z") > TS.ANOMALY_THRESHOLD).select(
        "ts_hour", "series", "value", "z_score", "mad_z", F.lit(TS.METHOD_MAD).alias("method"))
    return r6(out)


@query(
    "anomaly_seasonal_resid",
    f"""WITH {SCORE_CTE}
SELECT ts_hour, series, round(value, 6) AS value, round(rz, 6) AS resid_z, 'seasonal_residual' AS method
FROM sc WHERE abs(rz) > 3""",
)
def anomaly_seasonal_resid(spark, sf_dir):
    s = _scored(spark, sf_dir)
    out = s.where(F.abs("resid_z") > TS.ANOMALY_THRESHOLD).select(
        "ts_hour", "series", "value", "resid_z", F.lit(TS.METHOD_RESID).alias("method"))
    return r6(out)


@query("anomaly_combined", f"WITH {SCORE_CTE}\n{ANOMALY_SELECT}")
def anomaly_combined(spark, sf_dir):
    return r6(TS.anomaly_table(_scored(spark, sf_dir), S, "ts_hour", "value"))


@query("anomaly_antijoin", f"WITH {SCORE_CTE}\n{ANOMALY_SELECT}")
def anomaly_antijoin(spark, sf_dir):
    return r6(TS.anomaly_table_by_exclusion(_scored(spark, sf_dir), S, "ts_hour", "value"))


@query(
    "anomaly_counts",
    f"""WITH {SCORE_CTE}
SELECT series, CAST(count(*) AS BIGINT) AS n FROM an GROUP BY ROLLUP (series)""",
)
def anomaly_counts(spark, sf_dir):
    return TS.anomaly_counts(TS.anomaly_table(_scored(spark, sf_dir), S, "ts_hour", "value"), "series")


_PAIRS_CTE = """keys AS (SELECT DISTINCT series FROM himp WHERE series IS NOT NULL),
both_ AS (SELECT a.series AS col_a, b.series AS col_b, count(*) AS n, corr(a.value, b.value) AS r
          FROM himp a JOIN himp b ON a.ts_hour = b.ts_hour AND a.series < b.series
          WHERE a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY 1, 2),
pairs AS (SELECT x.series AS col_a, y.series AS col_b, CASE WHEN n >= 3 AND NOT isnan(r) THEN round(r, 6) END AS r
          FROM keys x JOIN keys y ON x.series < y.series LEFT JOIN both_ ON col_a = x.series AND col_b = y.series)"""


def _event_pairs(spark, sf_dir):
    return stats.corr_long(materialize(frames.hourly_imputed(spark, sf_dir)), "ts_hour", "series", "value")


@query(
    "event_corr_matrix",
    f"""WITH {HOURLY_CTE}, {_PAIRS_CTE}
SELECT col_a, col_b, r FROM pairs""",
)
def event_corr_matrix(spark, sf_dir):
    """E9 on the hourly table: every pair of event types in the data, like one column per sensor."""
    return r6(_event_pairs(spark, sf_dir).select("col_a", "col_b", "r"))


@query(
    "summary_report",
    f"""WITH {SCORE_CTE}, {_PAIRS_CTE},
top AS (SELECT 'top_correlations' AS section,
               CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, col_a DESC, col_b DESC) AS BIGINT) AS rank,
               col_a || ' vs ' || col_b AS label, r AS value FROM pairs),
cnt AS (SELECT series, count(*) AS n FROM an GROUP BY series)
SELECT section, rank, label, value FROM top WHERE rank <= 5
UNION ALL SELECT 'anomalies', CAST(0 AS BIGINT), 'total', CAST(count(*) AS DOUBLE) FROM an
UNION ALL SELECT 'anomalies', CAST(row_number() OVER (ORDER BY n DESC, series) AS BIGINT), series, CAST(n AS DOUBLE) FROM cnt""",
)
def summary_report(spark, sf_dir):
    corr = r6(_event_pairs(spark, sf_dir))
    anoms = TS.anomaly_table(_scored(spark, sf_dir), S, "ts_hour", "value")
    return r6(TS.summary_table(corr, None, anoms, "series"))
