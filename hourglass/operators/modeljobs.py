"""Model jobs: evaluation report, grid tuning over rolling-origin folds,
refit + holdout report and the training manifest.

Each model fit is a set of distributed MLlib jobs; the grid is a driver
loop that submits fits from a small thread pool so independent fits run
concurrently, over fold data materialized once.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.operators import forecast as FC
from hourglass.operators import stats, timeaxis, windows
from hourglass.session import materialize
from hourglass.sources import files

# Fixed values that must equal the reference for equal results.
# Search grid, in search order (the first best setting wins ties).
DEFAULT_GRID = {
    "max_depth": [3, 6, 9],
    "learning_rate": [0.2, 0.1, 0.05, 0.01],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
}
GRID_TREES, REFIT_TREES, EVAL_TREES = 150, 300, 100


def _subset_strategy(colsample: float) -> str:
    # MLlib samples features per node, not per tree; a fraction is the closest knob
    return "all" if colsample >= 1.0 else str(colsample)


def _matrix(df, series, idx, ts, target, horizon):
    fm, names = FC.feature_matrix(df, series, idx, ts, target, horizon)
    fm = timeaxis.row_index(fm, series, [idx], idx_col="__pos")
    return fm, names


def evaluation_report(
    df: DataFrame, series: Sequence[str], idx: str, ts: str, target: str, horizon: int = 1,
    test_size: float = 0.2, n_trees: int = EVAL_TREES, n_boot: int = 1000, block: int | None = None, seed: int = 42,
    alpha: float = 0.05, candidates: Sequence[str] | None = None,
) -> DataFrame:
    """Boosted trees vs persistence on the last ``test_size`` of each
    series' feature rows; paired |error| difference and its bootstrap CI
    (IID, or moving-block when ``block`` is set). The baseline is the feature
    ``<target>_lag1`` where the features have it, else the previous test value.

    One nested row per series: target, horizon, n_train, n_test,
    model {mae, rmse}, baseline {mae, rmse}, mae_diff_mean, mae_diff_ci [low, high].
    """
    series = list(series)
    fm, names = FC.feature_matrix(df, series, idx, ts, target, horizon, candidates=candidates)
    if candidates is not None and target in candidates:  # the target's own previous value as a feature
        lag = f"{target}_lag1"
        prev = windows.lag_features(df.select(*series, idx, F.col(target).cast("double").alias(target)), series, idx, [target], (1,))
        fm = fm.join(prev.select(*series, idx, lag), [*series, idx])
        names = [*names, lag]
    fm = timeaxis.row_index(fm, series, [idx], idx_col="__pos")
    sp = materialize(FC.chrono_split(fm, series, "__pos", test_size))
    train, test = sp.where(F.col("part") == "train"), sp.where(F.col("part") == "test")
    _, pred = FC.gbt_fit_predict(train, test, names, "y", n_trees=n_trees, seed=seed, series=series)
    pred = windows.persistence_baseline(pred.drop("features"), series, "__pos", "y", lagged=f"{target}_lag1")
    pred = pred.withColumn("diff", F.abs(F.col("prediction") - F.col("y")) - F.abs(F.col("baseline") - F.col("y")))
    pred = materialize(pred.withColumn("__k", F.col("__pos") - F.col("split_at")))
    err = stats.forecast_errors(pred, "y", "prediction", "baseline", series)
    ci = (FC.block_bootstrap_ci(pred, series, "__k", "diff", block, n_boot, alpha) if block
          else FC.bootstrap_ci(pred, series, "__k", "diff", n_boot, alpha)).select(*series, "ci_low", "ci_high")
    n_train = train.groupBy(*series).agg(F.count(F.lit(1)).cast("long").alias("n_train"))
    out = err.join(n_train, series).join(ci, series) if series else err.crossJoin(n_train).crossJoin(ci)  # one row each
    pair = lambda k: F.struct(F.col(f"mae_{k}").alias("mae"), F.col(f"rmse_{k}").alias("rmse")).alias(k)
    return out.select(
        *series, F.lit(target).alias("target"), F.lit(horizon).alias("horizon"), "n_train", F.col("n").alias("n_test"),
        pair("model"), pair("baseline"), "mae_diff_mean", F.array("ci_low", "ci_high").alias("mae_diff_ci"))


def grid_settings(grid: Mapping[str, Sequence]) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


class Tuned(NamedTuple):
    """Result of :func:`tune`."""

    scores: DataFrame
    report: dict
    model: object


def tune(
    df: DataFrame, series: Sequence[str], idx: str, ts: str, target: str, horizon: int = 1,
    grid: Mapping[str, Sequence] = DEFAULT_GRID, n_splits: int = 3, n_trees: int = GRID_TREES,
    holdout: float = 0.2, refit_trees: int = REFIT_TREES, parallelism: int = 4, seed: int = 42, save_to: str | None = None,
) -> Tuned:
    """M8 + M9 + E15: grid search by mean validation MAE over expanding
    folds (strict < keeps the first best), refit of the best setting on the
    first 1 - ``holdout`` of the rows, holdout MAE/RMSE against the
    forward-filled persistence baseline (first row = holdout mean).

    The vectors of every fold are assembled and checkpointed once, and all fits
    read those. ``save_to``: a folder that takes the refitted pipeline
    (``model``), its table of series means and the report (``report``).
    Returns scores (setting, fold, mae), report and the fitted pipeline.
    """
    series = list(series)
    fm, names = _matrix(df, series, idx, ts, target, horizon)
    sp = materialize(FC.chrono_split(fm, series, "__pos", holdout))
    train, hold = sp.where(F.col("part") == "train"), sp.where(F.col("part") == "test")
    # folds cut the training part only; the holdout stays unseen until the refit
    folds = materialize(FC.fold_membership(train.drop("split_at", "part"), series, "__pos", n_splits))
    vectors = []
    for fold in range(n_splits):
        part = folds.where(F.col("fold") == fold)
        a, b, _ = FC.prepared(part.where(F.col("role") == "train"), part.where(F.col("role") == "val"), names, "y", series)
        vectors.append((materialize(a.select("features", "y")), materialize(b.select("features", "y"))))
    settings = grid_settings(grid)

    def trees(s, n):
        return FC.gbt("y", n, s["max_depth"], s["learning_rate"], s["subsample"], _subset_strategy(s["colsample_bytree"]), seed)

    def run(job):
        i, s, fold = job
        fit, val = vectors[fold]
        pred = trees(s, n_trees).fit(fit).transform(val)
        return i, fold, pred.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]

    jobs = [(i, s, f) for i, s in enumerate(settings) for f in range(n_splits)]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(pool.map(run, jobs))
    spark = df.sparkSession
    scores = spark.createDataFrame(results, "setting int, fold int, mae double")
    mean = {}
    for i, _, mae in results:
        mean.setdefault(i, []).append(mae)
    best_i, best = None, float("inf")
    for i in range(len(settings)):
        m = sum(mean[i]) / len(mean[i])
        if m < best:
            best_i, best = i, m
    s = settings[best_i]
    model, pred = FC.gbt_fit_predict(
        train, hold, names, "y", n_trees=refit_trees, max_depth=s["max_depth"], step=s["learning_rate"],
        subsample=s["subsample"], feature_subset=_subset_strategy(s["colsample_bytree"]), seed=seed, series=series,
        encoding_path=f"{save_to.rstrip('/')}/series_means" if save_to else None)
    pred = windows.ffill_then_mean(pred.drop("features"), series, "__pos", "y", out="baseline")
    err = stats.forecast_errors(pred, "y", "prediction", "baseline", series).agg(
        F.sum("n").alias("n"), *[  # pooled over all rows, like cv_mae
            e for out, k in (("", "model"), ("b", "baseline")) for e in (
                (F.sum(F.col(f"mae_{k}") * F.col("n")) / F.sum("n")).alias(f"{out}mae"),
                F.sqrt(F.sum(F.col(f"rmse_{k}") * F.col(f"rmse_{k}") * F.col("n")) / F.sum("n")).alias(f"{out}rmse"))]).first()
    report = {
        "best_params": s, "cv_mae": best, "holdout_mae": err["mae"], "holdout_rmse": err["rmse"],
        "baseline_mae": err["bmae"], "baseline_rmse": err["brmse"],
        "n_train": train.count(), "n_holdout": int(err["n"]),
    }
    if save_to:
        files.save_model(model, f"{save_to.rstrip('/')}/model")
        kinds = ", ".join(f"{k}: {'int' if k == 'max_depth' else 'double'}" for k in s)
        row = {**report, "best_params": {k: int(v) if k == "max_depth" else float(v) for k, v in s.items()}}
        schema = (f"best_params struct<{kinds}>, cv_mae double, holdout_mae double, holdout_rmse double, baseline_mae double, "
                  "baseline_rmse double, n_train long, n_holdout long")
        files.write_json_report(spark.createDataFrame([row], schema), f"{save_to.rstrip('/')}/report")
    return Tuned(scores, report, model)


def manifest(df: DataFrame, features: Sequence[str], target: str, horizon: int, models: Sequence[str]) -> DataFrame:
    """One-row training manifest with per-feature statistics (E3) as a map."""
    st = stats.feature_stats(df, features)
    entry = F.struct("mean", "std", "min", "max", "non_null_count", "dtype")
    fs = st.agg(F.map_from_entries(F.collect_list(F.struct("feature", entry))).alias("feature_stats"),
                F.lit(None).cast("long").alias("__x"))
    return fs.select(
        F.array(*[F.lit(m) for m in models]).alias("models"), F.lit(target).alias("target"),
        F.lit(horizon).alias("horizon"), F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        "feature_stats", df.select(F.count(F.lit(1))).scalar().alias("rows"))
