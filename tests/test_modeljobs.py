import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import forecast as FC
from hourglass.operators import modeljobs
from hourglass.sources import files


def _frame(spark, n=400):
    rng = np.random.default_rng(5)
    base = dt.datetime(2024, 1, 1)
    x = 10 + 3 * np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(0, 0.5, n)
    data = [("a", i, base + dt.timedelta(hours=i), float(v), float(v * 2 + rng.normal())) for i, v in enumerate(x)]
    return spark.createDataFrame(data, "s string, idx long, ts timestamp_ntz, y double, other double")


def test_evaluation_report(spark):
    rep = modeljobs.evaluation_report(_frame(spark), ["s"], "idx", "ts", "y", 1, n_trees=10, n_boot=200).collect()[0]
    n_rows = 400 - 24 - 1
    assert rep.n_train + rep.n_test == n_rows and rep.n_train == int(n_rows * 0.8)
    assert rep.mae_diff_ci[0] <= rep.mae_diff_mean <= rep.mae_diff_ci[1]
    assert rep.model.mae > 0 and rep.baseline.rmse >= rep.baseline.mae


def test_evaluation_report_uses_the_lagged_target(spark):
    df = _frame(spark)
    rep = modeljobs.evaluation_report(df, ["s"], "idx", "ts", "y", 1, n_trees=5, n_boot=100, candidates=["other", "y"]).collect()[0]
    y = np.array([r.y for r in df.orderBy("idx").collect()])
    pos = np.arange(24, 399)  # rows of the matrix; the label is one row ahead, the feature one row back
    test = pos[int(len(pos) * 0.8):]
    assert rep.baseline.mae == pytest.approx(np.abs(y[test - 1] - y[test + 1]).mean())


def test_series_means_tell_colliding_keys_apart(spark):
    rng = np.random.default_rng(2)
    keys = ["a", "b", None]
    rows = [(keys[i % 3], float(i % 3 * 10 + rng.normal())) for i in range(600)]
    df = spark.createDataFrame(rows, "s string, y double")
    out, table, prior = FC.series_encoding(df, ["s"])
    y = {k: [v for s, v in rows if s == k] for k in keys}
    means = {r.s: r[FC.SERIES_MEAN] for r in table.collect()}
    assert prior == pytest.approx(np.mean([v for _, v in rows]))
    for k in keys:  # every key has a feature of its own: no buckets to share
        assert means[k] == pytest.approx((sum(y[k]) + 20 * prior) / (len(y[k]) + 20))
    assert len({round(v, 6) for v in means.values()}) == 3 and out.count() == 600
    own = out.groupBy("s").agg(F.countDistinct(FC.SERIES_MEAN).alias("n"), F.corr("y", FC.SERIES_MEAN).alias("r")).collect()
    assert all(1 < r.n <= 5 and r.r < 0.2 for r in own)  # a row's label is not in its own mean


def test_tune_small_grid_and_manifest(spark):
    grid = {"max_depth": [2, 3], "learning_rate": [0.1], "subsample": [1.0], "colsample_bytree": [1.0]}
    tmp = tempfile.mkdtemp(dir="/tmp")
    scores, rep, model = modeljobs.tune(_frame(spark), ["s"], "idx", "ts", "y", 1, grid=grid, n_trees=5, refit_trees=5, save_to=tmp)
    full, _ = modeljobs._matrix(_frame(spark), ["s"], "idx", "ts", "y", 1)
    hold = FC.chrono_split(full, ["s"], "__pos", 0.2).where("part = 'test'")
    for m in (model, files.load_model(f"{tmp}/model")):
        mae = m.transform(hold).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
        assert mae == pytest.approx(rep["holdout_mae"])
    saved = spark.read.json(f"{tmp}/report", multiLine=True).collect()[0]
    assert saved.holdout_mae == pytest.approx(rep["holdout_mae"]) and saved.best_params.max_depth == rep["best_params"]["max_depth"]
    assert scores.count() == 2 * 3
    means = {r.setting: r.m for r in scores.groupBy("setting").agg(F.avg("mae").alias("m")).collect()}
    assert rep["cv_mae"] == pytest.approx(min(means.values()))
    assert rep["best_params"]["max_depth"] == [2, 3][min(means, key=lambda k: (means[k], k))]
    assert rep["n_holdout"] > 0 and rep["baseline_mae"] > 0
    fm, names = FC.feature_matrix(_frame(spark), ["s"], "idx", "ts", "y", 1)
    man = modeljobs.manifest(fm, names, "y", 1, ["gbt"]).collect()[0]
    assert man.rows == fm.count() and set(man.feature_stats) == set(names)
    assert man.feature_stats["other_lag1"]["dtype"] == "float64"


def test_model_save_load_and_exports(spark, monkeypatch):
    tmp = tempfile.mkdtemp(dir="/tmp")
    fm, names = FC.feature_matrix(_frame(spark), ["s"], "idx", "ts", "y", 1)
    model, pred = FC.gbt_fit_predict(fm, fm, names, "y", n_trees=3, series=["s"])
    monkeypatch.setenv("HG_MODEL_PATH", os.path.join(tmp, "m"))
    path = files.resolve_path(None, "HG_MODEL_PATH", "model_default")
    files.save_model(model, path)
    again = files.load_model(path).transform(fm).select("prediction").collect()
    assert [r.prediction for r in again] == [r.prediction for r in pred.select("prediction").collect()]
    p = spark.createDataFrame([("a", 0.000123, None)], "k string, p double, q double")
    files.write_csv(p, os.path.join(tmp, "pv"), sci_cols=("p", "q"))
    back = files.read_csv(spark, os.path.join(tmp, "pv"), "k string, p string, q string").collect()[0]
    assert back.p == "1.230000000000e-04" and back.q is None


def test_read_sensor_csv(spark):
    tmp = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(tmp, "air.csv")
    head = ";".join(files.SENSOR_HEADERS)
    rows = [
        "10/03/2004;18.00.00;2,6;1360;150;11,9;1046;166;1056;113;1692;1268;13,6;48,9;0,7578",
        "10/03/2004;19.00.00;-200;1292;112;9,4;955;103;1174;92;1559;972;13,3;47,7;0,7255",
        "99/99/2004;20.00.00;2,2;1402;88;9,0;939;131;1140;114;1555;1074;11,9;54,0;0,7502",
    ]
    with open(path, "w") as f:
        f.write(head + "\n" + "\n".join(rows) + "\n")
    out = files.read_sensor_csv(spark, path).orderBy("ts").collect()
    assert len(out) == 2 and out[0].CO == 2.6 and out[1].CO is None and out[0].Benzene == 11.9
    assert out[0].PT08_S1_CO == 1360.0 and out[0].Target is None and out[0].ts.hour == 18
