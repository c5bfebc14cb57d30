"""Queries for window features (F) on the hourly event series and on an
irregular per-supplier lineitem series."""

from __future__ import annotations

from hourglass.operators import ema, windows
from hourglass.plans import frames
from hourglass.plans.catalog import query, r6
from hourglass.plans.sqlparts import HOURLY_CTE
from hourglass.sources.tables import read_table

S = ["series"]
LAGS = (1, 2, 3, 24)
ROLL = (3, 6, 12, 24)
SLOPES = (6, 12, 24)
SPANS = (3, 6, 12, 24)
W = "WINDOW w AS (PARTITION BY series ORDER BY idx)"


def _h(spark, sf_dir):
    return frames.hourly_imputed(spark, sf_dir)


@query(
    "lag_features",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, round(value, 6) AS value,
       {", ".join(f"round(lag(value, {k}) OVER w, 6) AS value_lag{k}" for k in LAGS)}
FROM himp {W}""",
)
def lag_features(spark, sf_dir):
    out = windows.lag_features(_h(spark, sf_dir), S, "idx", ["value"], LAGS)
    return r6(out.select("series", "ts_hour", "value", *[f"value_lag{k}" for k in LAGS]))


@query(
    "horizon_target",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, round(value, 6) AS value, round(lead(value, 1) OVER w, 6) AS y_h1 FROM himp {W}""",
)
def horizon_target(spark, sf_dir):
    out = windows.horizon_target(_h(spark, sf_dir), S, "idx", "value", 1, out="y_h1")
    return r6(out.select("series", "ts_hour", "value", "y_h1"))


def _frame(win: int) -> str:
    return f"(PARTITION BY series ORDER BY idx ROWS BETWEEN {win - 1} PRECEDING AND CURRENT ROW)"


@query(
    "rolling_mean",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, {", ".join(f"round(avg(value) OVER {_frame(w)}, 6) AS value_roll_mean_{w}" for w in ROLL)}
FROM himp""",
)
def rolling_mean(spark, sf_dir):
    out = windows.rolling_features(_h(spark, sf_dir), S, "idx", ["value"], ROLL, stats=("mean",))
    return r6(out.select("series", "ts_hour", *[f"value_roll_mean_{w}" for w in ROLL]))


@query(
    "rolling_std",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour,
       {", ".join(f"round(coalesce(stddev_samp(value) OVER {_frame(w)}, 0.0), 6) AS value_roll_std_{w}" for w in ROLL)}
FROM himp""",
)
def rolling_std(spark, sf_dir):
    out = windows.rolling_features(_h(spark, sf_dir), S, "idx", ["value"], ROLL, stats=("std",))
    return r6(out.select("series", "ts_hour", *[f"value_roll_std_{w}" for w in ROLL]))


@query(
    "rolling_slope",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour,
       {", ".join(f"CASE WHEN count(value) OVER {_frame(w)} < 2 THEN NULL ELSE round(regr_slope(value, CAST(idx AS DOUBLE)) OVER {_frame(w)}, 6) END AS value_slope_{w}" for w in SLOPES)}
FROM himp""",
)
def rolling_slope(spark, sf_dir):
    out = windows.rolling_slope(_h(spark, sf_dir), S, "idx", ["value"], SLOPES)
    return r6(out.select("series", "ts_hour", *[f"value_slope_{w}" for w in SLOPES]))


_PAIRS = windows.interaction_names(["value", "n"], (1, 24))


@query(
    "lag_interactions",
    f"""WITH {HOURLY_CTE},
l AS (SELECT series, ts_hour, lag(value, 1) OVER w AS value_lag1, lag(value, 24) OVER w AS value_lag24,
             lag(n, 1) OVER w AS n_lag1, lag(n, 24) OVER w AS n_lag24 FROM himp {W})
SELECT series, ts_hour, {", ".join(f"round({a} * {b}, 6) AS {a}__{b}" for a, b in _PAIRS)} FROM l""",
)
def lag_interactions(spark, sf_dir):
    out = windows.lag_interactions(_h(spark, sf_dir), S, "idx", ["value", "n"], (1, 24))
    return r6(out.select("series", "ts_hour", *[f"{a}__{b}" for a, b in _PAIRS]))


@query(
    "persistence_baseline",
    f"""WITH {HOURLY_CTE}
SELECT series, ts_hour, round(value, 6) AS value, round(coalesce(lag(value, 1) OVER w, value), 6) AS baseline
FROM himp {W}""",
)
def persistence_baseline(spark, sf_dir):
    out = windows.persistence_baseline(_h(spark, sf_dir), S, "idx", "value")
    return r6(out.select("series", "ts_hour", "value", "baseline"))


@query(
    "ffill_then_mean",
    f"""WITH {HOURLY_CTE},
p AS (SELECT series, ts_hour, idx, value_mean, lag(value_mean, 1) OVER w AS prev FROM hourly {W})
SELECT series, ts_hour,
       round(coalesce(last_value(prev IGNORE NULLS) OVER (PARTITION BY series ORDER BY idx
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      avg(value_mean) OVER (PARTITION BY series)), 6) AS baseline
FROM p""",
)
def ffill_then_mean(spark, sf_dir):
    """F10 on the raw hourly means (with empty hours), carried across 100-hour buckets."""
    h = frames.hourly(spark, sf_dir)
    out = windows.ffill_then_mean(h, S, "idx", "value_mean", bucket_rows=100)
    return r6(out.select("series", "ts_hour", "baseline"))


def _ema_sql() -> str:
    alphas = {s: 2.0 / (s + 1.0) for s in SPANS}
    init = ", ".join("value" for _ in SPANS)
    step = ", ".join(f"{1.0 - a!r} * e.e{s} + {a!r} * h.value" for s, a in alphas.items())
    cols = ", ".join(f"e{s}" for s in SPANS)
    out = ", ".join(f"round(e{s}, 6) AS value_ema_{s}" for s in SPANS)
    cte = HOURLY_CTE.replace("himp AS (", "himp AS MATERIALIZED (")
    return f"""WITH RECURSIVE {cte},
e(series, idx, {cols}) AS (
  SELECT series, idx, {init} FROM himp WHERE idx = 0
  UNION ALL
  SELECT h.series, h.idx, {step} FROM e JOIN himp h ON h.series = e.series AND h.idx = e.idx + 1)
SELECT h.series, h.ts_hour, {out} FROM e JOIN himp h USING (series, idx)"""


@query("ema_features", _ema_sql())
def ema_features(spark, sf_dir):
    out = ema.ema_features(_h(spark, sf_dir), S, "idx", ["value"], SPANS)
    return r6(out.select("series", "ts_hour", *[f"value_ema_{s}" for s in SPANS]))


_SUPP = "(PARTITION BY l_suppkey ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"


@query(
    "supplier_window_features",
    f"""
WITH ix AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS BIGINT) AS idx
  FROM lineitem)
SELECT l_suppkey, l_orderkey, l_linenumber, idx,
       lag(l_quantity, 1) OVER (PARTITION BY l_suppkey ORDER BY idx) AS l_quantity_lag1,
       round(avg(l_quantity) OVER {_SUPP}, 6) AS l_quantity_roll_mean_24,
       round(coalesce(stddev_samp(l_quantity) OVER {_SUPP}, 0.0), 6) AS l_quantity_roll_std_24,
       CASE WHEN count(l_quantity) OVER {_SUPP} < 2 THEN NULL
            ELSE round(regr_slope(l_quantity, CAST(idx AS DOUBLE)) OVER {_SUPP}, 6) END AS l_quantity_slope_24
FROM ix""",
)
def supplier_window_features(spark, sf_dir):
    """Irregular series (one per supplier, ordered by ship date with
    tie-breakers): one ordered window pass when every supplier is bounded,
    else the chunked row index plus 256-row halo buckets."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    out = windows.ordered_features(li, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], ["l_quantity"],
                                   lags=(1,), roll_windows=(24,), slope_windows=(24,), bucket_rows=256)
    return r6(out.select("l_suppkey", "l_orderkey", "l_linenumber", "idx", "l_quantity_lag1",
                         "l_quantity_roll_mean_24", "l_quantity_roll_std_24", "l_quantity_slope_24"))

