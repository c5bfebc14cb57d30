"""Queries for forecasting jobs (M) on the hourly event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.operators import forecast as FC
from hourglass.operators import stats, timeaxis, windows
from hourglass.plans import frames
from hourglass.plans.catalog import query, r6
from hourglass.plans.sqlparts import HOURLY_CTE
from hourglass.session import materialize

S = ["series"]
LAGS = (1, 2, 3, 24)
FEATS = ["n", "hour", "day", "month", "season"]
TEST_SIZE = 0.2
N_BOOT = 1000
BLOCK = 24


def _h(spark, sf_dir):
    return frames.hourly_imputed(spark, sf_dir)


_W = "WINDOW w AS (PARTITION BY series ORDER BY idx)"
_FM_NAMES = [f"{c}_lag{k}" for k in LAGS for c in FEATS]
_FM_SQL = f"""WITH {HOURLY_CTE},
f AS (SELECT series, ts_hour, idx, value, CAST(n AS DOUBLE) AS n, CAST(hour(ts_hour) AS DOUBLE) AS hour,
             CAST(day(ts_hour) AS DOUBLE) AS day, CAST(month(ts_hour) AS DOUBLE) AS month,
             CAST((month(ts_hour) % 12) // 3 + 1 AS DOUBLE) AS season FROM himp),
l AS (SELECT series, ts_hour, idx, lead(value, 1) OVER w AS y,
             {", ".join(f"lag({c}, {k}) OVER w AS {c}_lag{k}" for k in LAGS for c in FEATS)} FROM f {_W})
SELECT series, ts_hour, idx, round(y, 6) AS y, {", ".join(f"round({nm}, 6) AS {nm}" for nm in _FM_NAMES)}
FROM l WHERE y IS NOT NULL AND {" AND ".join(f"{nm} IS NOT NULL" for nm in _FM_NAMES)}"""


@query("feature_matrix", _FM_SQL)
def feature_matrix(spark, sf_dir):
    fm, names = FC.feature_matrix(_h(spark, sf_dir), S, "idx", "ts_hour", "value", 1, LAGS, candidates=["n", "value"])
    return r6(fm.select("series", "ts_hour", "idx", "y", *names))


_SPLIT_CTE = f"""{HOURLY_CTE},
c AS (SELECT series, count(*) AS n FROM himp GROUP BY 1),
sp AS (SELECT h.*, CAST(floor(c.n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS split_at FROM himp h JOIN c USING (series))
"""


@query(
    "chrono_split",
    f"""WITH {_SPLIT_CTE}
SELECT series, ts_hour, idx, split_at, CASE WHEN idx < split_at THEN 'train' ELSE 'test' END AS part FROM sp""",
)
def chrono_split(spark, sf_dir):
    return FC.chrono_split(_h(spark, sf_dir), S, "idx", TEST_SIZE).select("series", "ts_hour", "idx", "split_at", "part")


@query(
    "rolling_origin_folds",
    f"""WITH {HOURLY_CTE},
c AS (SELECT series, count(*) AS n FROM himp GROUP BY 1),
t AS (SELECT h.series, h.ts_hour, h.idx, c.n // 4 AS size, c.n - 3 * (c.n // 4) AS first
      FROM himp h JOIN c USING (series))
SELECT series, CAST((idx - first) // size AS BIGINT) AS fold,
       CAST(first + ((idx - first) // size) * size AS BIGINT) AS n_train,
       CAST(count(*) AS BIGINT) AS n_val, min(ts_hour) AS val_start, max(ts_hour) AS val_end
FROM t WHERE size > 0 AND idx >= first GROUP BY 1, 2, 3""",
)
def rolling_origin_folds(spark, sf_dir):
    return FC.rolling_origin_folds(_h(spark, sf_dir), S, "idx", "ts_hour", 3)


def forecast_frame(spark, sf_dir):
    """Test rows with a model (mean of the previous 24 hours), the persistence
    baseline inside the test split (its first row predicts itself), the
    position ``pos`` in the split and the paired |error| difference."""
    h = materialize(_h(spark, sf_dir))  # read by the split counts and the window branch
    t = windows.window_select(
        h, S, "idx",
        lambda w: {"model": F.avg("value").over(w.rowsBetween(-24, -1)), "__prev": F.lag("value", 1).over(w)},
        preceding=24,
    )
    t = FC.chrono_split(t, S, "idx", TEST_SIZE).where(F.col("part") == "test")
    t = t.withColumn("baseline", F.when(F.col("idx") == F.col("split_at"), F.col("value")).otherwise(F.col("__prev")))
    return t.withColumns({
        "pos": F.col("idx") - F.col("split_at"),
        "diff": F.abs(F.col("model") - F.col("value")) - F.abs(F.col("baseline") - F.col("value")),
    }).drop("__prev")


_FF_CTE = f"""{_SPLIT_CTE},
ff0 AS (SELECT series, ts_hour, idx, value, split_at,
               avg(value) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS model,
               CASE WHEN idx = split_at THEN value ELSE lag(value, 1) OVER w END AS baseline FROM sp {_W}),
ff AS (SELECT *, idx - split_at AS pos, abs(model - value) - abs(baseline - value) AS diff FROM ff0 WHERE idx >= split_at),
cs AS (SELECT series, count(*) AS n, avg(diff) AS mean_diff FROM ff GROUP BY 1)
"""

_CI_SELECT = """SELECT cs.series, cs.n, CAST(count(*) AS BIGINT) AS n_boot, round(cs.mean_diff, 6) AS mean_diff,
       round(quantile_cont(m, 0.025), 6) AS ci_low, round(quantile_cont(m, 0.975), 6) AS ci_high
FROM rep JOIN cs USING (series) GROUP BY cs.series, cs.n, cs.mean_diff"""


@query(
    "forecast_errors",
    f"""WITH {_FF_CTE}
SELECT series, CAST(count(*) AS BIGINT) AS n, round(avg(abs(model - value)), 6) AS mae_model,
       round(sqrt(avg((model - value) * (model - value))), 6) AS rmse_model,
       round(avg(abs(baseline - value)), 6) AS mae_baseline,
       round(sqrt(avg((baseline - value) * (baseline - value))), 6) AS rmse_baseline,
       round(avg(abs(model - value) - abs(baseline - value)), 6) AS mae_diff_mean
FROM ff WHERE model IS NOT NULL AND baseline IS NOT NULL GROUP BY 1""",
)
def forecast_errors(spark, sf_dir):
    return r6(stats.forecast_errors(forecast_frame(spark, sf_dir), "value", "model", "baseline", S))


RANGE = 60  # rows of a bootstrap range: several ranges even in small tables


@query(
    "bootstrap_ci",
    f"""WITH RECURSIVE {_FF_CTE.replace("ff AS (", "ff AS MATERIALIZED (")},
{FC.bootstrap_draws_sql("cs", N_BOOT, RANGE)},
dr AS (SELECT series, n, r, rng, unnest(range(0, m)) AS k FROM leaf),
rep AS (SELECT dr.series, dr.r, avg(ff.diff) AS m FROM dr JOIN ff ON ff.series = dr.series
        AND ff.pos = dr.rng * {RANGE} + {FC.range_pick_sql("dr.r", "dr.rng", "dr.k", f"least({RANGE}, dr.n - dr.rng * {RANGE})")} GROUP BY 1, 2)
{_CI_SELECT}""",
)
def bootstrap_ci(spark, sf_dir):
    d = forecast_frame(spark, sf_dir).select("series", "pos", "diff")
    out = FC.bootstrap_ci(d, S, "pos", "diff", N_BOOT, range_rows=RANGE)
    return r6(out.select("series", "n", "n_boot", "mean_diff", "ci_low", "ci_high"))


@query(
    "block_bootstrap_ci",
    f"""WITH RECURSIVE {_FF_CTE.replace("ff AS (", "ff AS MATERIALIZED (")},
st AS (SELECT series, greatest(1, n - {BLOCK} + 1) AS n, CAST(ceil(n / {BLOCK}.0) AS BIGINT) AS nb, n AS rows FROM cs),
{FC.bootstrap_draws_sql("st", N_BOOT, RANGE, "nb - 1")},
q AS (SELECT series, pos, sum(diff) OVER (PARTITION BY series ORDER BY pos ROWS UNBOUNDED PRECEDING) AS q FROM ff),
dr AS (SELECT series, n, r, rng, unnest(range(0, m)) AS k FROM leaf),
bs AS (SELECT dr.series, dr.r, rng * {RANGE} + {FC.range_pick_sql("dr.r", "dr.rng", "dr.k", f"least({RANGE}, dr.n - dr.rng * {RANGE})")} AS s,
              {BLOCK}::BIGINT AS len FROM dr
       UNION ALL
       SELECT series, b.r, {FC._word_sql("b.r", "0")} % n, rows - {BLOCK} * (nb - 1) FROM st CROSS JOIN range(0, {N_BOOT}) AS b(r)),
sm AS (SELECT bs.series, bs.r, qe.q - coalesce(qb.q, 0.0) AS s
       FROM bs JOIN q qe ON qe.series = bs.series AND qe.pos = bs.s + bs.len - 1
       LEFT JOIN q qb ON qb.series = bs.series AND qb.pos = bs.s - 1),
rep AS (SELECT sm.series, r, sum(s) / any_value(cs.n) AS m FROM sm JOIN cs USING (series) GROUP BY 1, 2)
{_CI_SELECT}""",
)
def block_bootstrap_ci(spark, sf_dir):
    d = forecast_frame(spark, sf_dir).select("series", "pos", "diff")
    out = FC.block_bootstrap_ci(d, S, "pos", "diff", BLOCK, N_BOOT, bucket_rows=50, range_rows=RANGE)
    return r6(out.select("series", "n", "n_boot", "mean_diff", "ci_low", "ci_high"))


@query("gbt_forecast")
def gbt_forecast(spark, sf_dir):
    """M3: boosted trees (100 trees, seed 42) on the feature matrix; train on
    the first 80% of each series' matrix rows, predict the rest."""
    fm, names = FC.feature_matrix(_h(spark, sf_dir), S, "idx", "ts_hour", "value", 1, LAGS, candidates=["n", "value"])
    fm = timeaxis.row_index(fm, S, ["idx"], idx_col="pos")
    sp = FC.chrono_split(fm, S, "pos", TEST_SIZE)
    train, test = sp.where(F.col("part") == "train"), sp.where(F.col("part") == "test")
    _, pred = FC.gbt_fit_predict(train, test, names, "y", n_trees=100, seed=42, series=S)
    return r6(pred.select("series", "ts_hour", "y", "prediction"))


_REACH = 12  # differences that ARIMA(2,1,2) with a long AR(10) needs
_SUM_PAIRS = [(i, j) for i in range(_REACH + 1) for j in range(i, _REACH + 1)]


@query(
    "arma_sums",
    f"""WITH {HOURLY_CTE},
y AS (SELECT series, value AS y0, {", ".join(f"lag(value, {k}) OVER w AS y{k}" for k in range(1, _REACH + 2))} FROM himp {_W}),
d AS (SELECT series, {", ".join(f"y{k} - y{k + 1} AS d{k}" for k in range(_REACH + 1))} FROM y)
SELECT series, count(*) AS rows, {", ".join(f"round(sum(d{i} * d{j}), 6) AS s_{i}_{j}" for i, j in _SUM_PAIRS)}
FROM d WHERE {" AND ".join(f"d{k} IS NOT NULL" for k in range(_REACH + 1))} GROUP BY 1""",
)
def arma_sums(spark, sf_dir):
    """M4: the cross-product sums that the coefficients are solved from."""
    return r6(FC.difference_sums(_h(spark, sf_dir), S, "idx", "value", _REACH))


@query("arma_coefficients")
def arma_coefficients(spark, sf_dir):
    """M4: ARIMA(2,1,2) by Hannan-Rissanen per series (checked by parameter
    recovery in pytest)."""
    return r6(FC.arma_fit(_h(spark, sf_dir), S, "idx", "value", 2, 2))


@query("arma_forecast")
def arma_forecast(spark, sf_dir):
    h = materialize(_h(spark, sf_dir))  # read by the fit and the forecast
    coefs = materialize(FC.arma_fit(h, S, "idx", "value", 2, 2).drop("sigma2", "n"))
    return r6(FC.arma_forecast(h, coefs, S, "idx", "value").select("series", "ts_hour", "value", "forecast"))


_FIXED_ARMA = (0.4, -0.2, 0.3, 0.1)  # ar_1, ar_2, ma_1, ma_2


@query(
    "arma_innovations",
    f"""WITH RECURSIVE {HOURLY_CTE.replace("himp AS (", "himp AS MATERIALIZED (")},
y AS (SELECT series, ts_hour, idx, value, coalesce(value - lag(value, 1) OVER w, 0) AS d0,
             coalesce(lag(value, 1) OVER w - lag(value, 2) OVER w, 0) AS d1,
             coalesce(lag(value, 2) OVER w - lag(value, 3) OVER w, 0) AS d2 FROM himp {_W}),
e(series, idx, e1, e2) AS (
  SELECT series, -1::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE FROM y WHERE idx = 0
  UNION ALL
  SELECT y.series, y.idx, d0 - ({_FIXED_ARMA[0]} * d1 + {_FIXED_ARMA[1]} * d2) - ({_FIXED_ARMA[2]} * e1 + {_FIXED_ARMA[3]} * e2), e1
  FROM e JOIN y ON y.series = e.series AND y.idx = e.idx + 1)
SELECT series, ts_hour, round(e1, 6) AS innovation,
       round(value + {_FIXED_ARMA[0]} * d0 + {_FIXED_ARMA[1]} * d1 + {_FIXED_ARMA[2]} * e1 + {_FIXED_ARMA[3]} * e2, 6) AS forecast
FROM y JOIN e USING (series, idx)""",
)
def arma_innovations(spark, sf_dir):
    """M5: innovations and one-step forecasts of an ARIMA(2,1,2) with given coefficients."""
    h = materialize(_h(spark, sf_dir))
    coefs = h.select("series").distinct().withColumns(
        {k: F.lit(v) for k, v in zip(("ar_1", "ar_2", "ma_1", "ma_2"), _FIXED_ARMA)})
    t = FC.arma_residuals(h, coefs, S, "idx", "value")
    return r6(t.select("series", "ts_hour", F.col("__e")[0].alias("innovation"), FC.arma_step(coefs, "value").alias("forecast")))


@query(
    "replay_sample",
    f"""WITH {HOURLY_CTE},
c AS (SELECT series, idx, count(*) OVER (PARTITION BY series) AS rows FROM himp),
d AS (SELECT series, idx AS draw_id, {FC.hash_draw_sql("42", "idx", "rows")} AS source_pos FROM c)
SELECT d.series, d.draw_id, CAST(d.source_pos AS BIGINT) AS source_pos, h.ts_hour, round(h.value, 6) AS value, h.ts_hour AS sent_at
FROM d JOIN himp h ON h.series = d.series AND h.idx = d.source_pos""",
)
def replay_sample(spark, sf_dir):
    """Rows drawn uniformly with replacement per series, stamped with
    their own hour."""
    out = FC.replay_sample(_h(spark, sf_dir), S, "idx", seed=42, ts="ts_hour")
    return r6(out.select("series", "draw_id", "source_pos", "ts_hour", "value", "sent_at"))


@query("evaluation_report")
def evaluation_report(spark, sf_dir):
    """Boosted trees (100 trees) vs persistence per series with the IID
    bootstrap CI of the paired |error| difference."""
    from hourglass.operators import modeljobs

    rep = modeljobs.evaluation_report(_h(spark, sf_dir), S, "idx", "ts_hour", "value", 1, TEST_SIZE)
    return r6(rep.select(
        "series", "target", "horizon", "n_train", "n_test", F.col("model.mae").alias("model_mae"), F.col("model.rmse").alias("model_rmse"),
        F.col("baseline.mae").alias("baseline_mae"), F.col("baseline.rmse").alias("baseline_rmse"), "mae_diff_mean",
        F.col("mae_diff_ci")[0].alias("ci_low"), F.col("mae_diff_ci")[1].alias("ci_high")))


_FS_COLS = ["value", "n"]
_FS_ROLL, _FS_LAGS, _FS_EMA, _FS_SLOPE, _FS_INTER = (3, 6, 12, 24), (1, 2, 3, 24), (3, 6, 12, 24), (6, 12, 24), (1, 24)


def _feature_set_sql() -> str:
    def fr(w):
        return f"(PARTITION BY series ORDER BY idx ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"

    temporal = [
        "CAST(hour(ts_hour) AS INTEGER) AS hour", "CAST(day(ts_hour) AS INTEGER) AS day",
        "CAST(month(ts_hour) AS INTEGER) AS month", "CAST((month(ts_hour) % 12) // 3 + 1 AS INTEGER) AS season",
        "CAST(isodow(ts_hour) - 1 AS INTEGER) AS day_of_week",
        "round(sin(2 * pi() * hour(ts_hour) / 24), 6) AS hour_sin", "round(cos(2 * pi() * hour(ts_hour) / 24), 6) AS hour_cos",
        "round(sin(2 * pi() * (isodow(ts_hour) - 1) / 7), 6) AS dow_sin",
        "round(cos(2 * pi() * (isodow(ts_hour) - 1) / 7), 6) AS dow_cos",
        "round(sin(2 * pi() * (month(ts_hour) - 1) / 12), 6) AS month_sin",
        "round(cos(2 * pi() * (month(ts_hour) - 1) / 12), 6) AS month_cos",
    ]
    win = []
    for w in _FS_ROLL:
        for c in _FS_COLS:
            win.append(f"round(avg({c}) OVER {fr(w)}, 6) AS {c}_roll_mean_{w}")
            win.append(f"round(coalesce(stddev_samp({c}) OVER {fr(w)}, 0.0), 6) AS {c}_roll_std_{w}")
    lag_ks = sorted(set(_FS_LAGS) | set(_FS_INTER))
    for k in lag_ks:
        for c in _FS_COLS:
            win.append(f"lag({c}, {k}) OVER (PARTITION BY series ORDER BY idx) AS {c}_lag{k}")
    for w in _FS_SLOPE:
        for c in _FS_COLS:
            win.append(f"CASE WHEN count({c}) OVER {fr(w)} < 2 THEN NULL "
                       f"ELSE round(regr_slope({c}, CAST(idx AS DOUBLE)) OVER {fr(w)}, 6) END AS {c}_slope_{w}")
    keys = [(c, s) for s in _FS_EMA for c in _FS_COLS]
    ema_cols = ", ".join(f"e_{c}_{s}" for c, s in keys)
    ema_init = ", ".join(c for c, _ in keys)
    ema_step = ", ".join(f"{1.0 - 2.0 / (s + 1.0)!r} * e.e_{c}_{s} + {2.0 / (s + 1.0)!r} * b.{c}" for c, s in keys)
    ema_out = ", ".join(f"round(e.e_{c}_{s}, 6) AS {c}_ema_{s}" for c, s in keys)
    inter = ", ".join(f"round(w.{a} * w.{b}, 6) AS {a}__{b}" for a, b in windows.interaction_names(_FS_COLS, _FS_INTER))
    lag_out = ", ".join(f"round(w.{c}_lag{k}, 6) AS {c}_lag{k}" for k in _FS_LAGS for c in _FS_COLS)
    cte = HOURLY_CTE.replace("himp AS (", "himp AS MATERIALIZED (")
    return f"""WITH RECURSIVE {cte},
base AS MATERIALIZED (SELECT series, ts_hour, idx, value, CAST(n AS DOUBLE) AS n FROM himp),
e(series, idx, {ema_cols}) AS (
  SELECT series, idx, {ema_init} FROM base WHERE idx = 0
  UNION ALL
  SELECT b.series, b.idx, {ema_step} FROM e JOIN base b ON b.series = e.series AND b.idx = e.idx + 1),
w AS (SELECT series, ts_hour, idx, value, n, {", ".join(temporal)}, {", ".join(win)} FROM base)
SELECT w.series, w.ts_hour, round(w.value, 6) AS value, round(w.n, 6) AS n,
       w.hour, w.day, w.month, w.season, w.day_of_week, w.hour_sin, w.hour_cos, w.dow_sin, w.dow_cos, w.month_sin, w.month_cos,
       {", ".join(f"w.{c}_roll_mean_{x}, w.{c}_roll_std_{x}" for x in _FS_ROLL for c in _FS_COLS)},
       {lag_out},
       {", ".join(f"w.{c}_slope_{x}" for x in _FS_SLOPE for c in _FS_COLS)},
       {ema_out}, {inter}
FROM w JOIN e ON e.series = w.series AND e.idx = w.idx"""


@query("feature_set", _feature_set_sql())
def feature_set(spark, sf_dir):
    """M2: temporal parts, rolling mean/std, lags, EMA, slopes and lag
    interactions of the hourly value and count, in the reference's order."""
    h = _h(spark, sf_dir).withColumn("n", F.col("n").cast("double"))
    out = FC.engineered_features(h, S, "idx", "ts_hour", _FS_COLS, _FS_ROLL, _FS_LAGS, True, _FS_EMA, True, _FS_SLOPE,
                                 True, _FS_INTER)
    return r6(out.drop("idx"))


@query(
    "bootstrap_ci_poisson",
    f"""WITH {_FF_CTE},
wt AS (SELECT f.series, r.r, f.diff, {FC.poisson_weight_sql("r.r", "f.pos")} AS w
       FROM ff f CROSS JOIN range(0, {N_BOOT}) AS r(r)),
rep AS (SELECT series, r, sum(w * diff) / nullif(sum(w), 0) AS m FROM wt GROUP BY 1, 2)
SELECT series, round(quantile_cont(m, 0.025), 6) AS ci_low, round(quantile_cont(m, 0.975), 6) AS ci_high,
       count(m) AS n_boot FROM rep GROUP BY 1""",
)
def bootstrap_ci_poisson(spark, sf_dir):
    """M11, scale form: Poisson(1) replicate weights from the integer hash,
    reduced map-side to B weighted sums per series (no join)."""
    d = forecast_frame(spark, sf_dir).select("series", "pos", "diff")
    return r6(FC.poisson_bootstrap_ci(d, S, "pos", "diff", N_BOOT))
