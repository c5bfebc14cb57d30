import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import forecast as FC


def _arma_series(n=5000, ar=(0.5, -0.2), ma=(0.3, 0.1), seed=7):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    dy = np.zeros(n + 200)
    for t in range(2, n + 200):
        dy[t] = ar[0] * dy[t - 1] + ar[1] * dy[t - 2] + e[t] + ma[0] * e[t - 1] + ma[1] * e[t - 2]
    return 100 + np.cumsum(dy[200:])


def test_arma_recovers_coefficients(spark):
    y = _arma_series()
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "s string, idx long, v double")
    c = FC.arma_fit(df, ["s"], "idx", "v", 2, 2).collect()[0]
    assert c.ar_1 == pytest.approx(0.5, abs=0.12) and c.ar_2 == pytest.approx(-0.2, abs=0.12)
    assert c.ma_1 == pytest.approx(0.3, abs=0.12) and c.ma_2 == pytest.approx(0.1, abs=0.12)
    assert c.sigma2 == pytest.approx(1.0, abs=0.1)
    fc = FC.arma_forecast(df, FC.arma_fit(df, ["s"], "idx", "v").drop("sigma2", "n"), ["s"], "idx", "v").toPandas()
    fc = fc.sort_values("idx")
    err = fc["forecast"].to_numpy()[:-1] - y[1:]
    assert np.nanmean(err[50:] ** 2) < np.mean(np.diff(y)[50:] ** 2)  # beats persistence


def _plain_arma(y, ar, ma):
    """Innovations and one-step forecasts, row by row."""
    dy = np.concatenate([[0.0, 0.0, 0.0], np.diff(y)])  # three zeros: rows before the series and its first row
    e, out = [0.0, 0.0], []
    for t in range(len(y)):
        d = dy[t + 2 :: -1][:3]
        e.append(d[0] - ar[0] * d[1] - ar[1] * d[2] - ma[0] * e[-1] - ma[1] * e[-2])
        out.append(y[t] + ar[0] * d[0] + ar[1] * d[1] + ma[0] * e[-1] + ma[1] * e[-2])
    return np.array(e[2:]), np.array(out)


@pytest.mark.parametrize("fan", [4, 256])
def test_arma_innovations_by_blocks(spark, monkeypatch, fan):
    monkeypatch.setattr(FC, "FAN", fan)  # 4: several levels
    y = {"a": _arma_series(300), "b": _arma_series(37, seed=3), None: _arma_series(5, seed=4)}
    df = spark.createDataFrame([(k, i, float(v)) for k, x in y.items() for i, v in enumerate(x)], "s string, idx long, v double")
    want = {"a": (0.5, -0.2, 0.6, 0.2), "b": (0.1, 0.3, -0.4, 0.1), None: (0.0, 0.2, 0.3, 0.3)}
    coefs = spark.createDataFrame([(k, *c) for k, c in want.items()], "s string, ar_1 double, ar_2 double, ma_1 double, ma_2 double")
    got = FC.arma_residuals(df, coefs, ["s"], "idx", "v").select("s", "idx", F.col("__e")[0].alias("e"), FC.arma_step(coefs, "v").alias("f")).toPandas()
    for k, x in y.items():
        mine = got[got.s.isna() if k is None else got.s == k].sort_values("idx")
        e, f = _plain_arma(x, want[k][:2], want[k][2:])
        assert np.allclose(mine.e, e, rtol=1e-9, atol=1e-9) and np.allclose(mine.f, f, rtol=1e-9, atol=1e-9)


def test_arma_without_a_series_key(spark):
    y = _arma_series(2000)
    keyed = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "s string, idx long, v double")
    a, b = FC.arma_fit(keyed, ["s"], "idx", "v").collect()[0], FC.arma_fit(keyed.drop("s"), [], "idx", "v").collect()[0]
    assert [a[c] for c in ("ar_1", "ar_2", "ma_1", "ma_2", "sigma2", "n")] == pytest.approx([b[c] for c in ("ar_1", "ar_2", "ma_1", "ma_2", "sigma2", "n")])
    coefs = FC.arma_fit(keyed.drop("s"), [], "idx", "v").drop("sigma2", "n")
    got = FC.arma_forecast(keyed.drop("s"), coefs, [], "idx", "v").orderBy("idx").toPandas()
    assert np.allclose(got.forecast, _plain_arma(y, (a.ar_1, a.ar_2), (a.ma_1, a.ma_2))[1], rtol=1e-8)
    # the regressions themselves, on explicit rows
    dy = np.diff(y)
    rows = np.arange(12, len(dy))
    lag = lambda x, k: x[rows - k]
    ar = np.linalg.lstsq(np.stack([lag(dy, k) for k in range(1, 11)], 1), lag(dy, 0), rcond=None)[0]
    e = np.zeros_like(dy)
    for t in range(10, len(dy)):
        e[t] = dy[t] - ar @ dy[t - 10 : t][::-1]
    x = np.stack([lag(dy, 1), lag(dy, 2), lag(e, 1), lag(e, 2)], 1)
    beta = np.linalg.lstsq(x, lag(dy, 0), rcond=None)[0]
    assert [a.ar_1, a.ar_2, a.ma_1, a.ma_2] == pytest.approx(beta, rel=1e-6)
    assert a.sigma2 == pytest.approx(((lag(dy, 0) - x @ beta) ** 2).mean(), rel=1e-6) and a.n == len(rows)


def test_hash_draws_uniform(spark):
    df = spark.range(200000).select(FC.hash_draw(F.lit(3), F.col("id"), F.lit(10)).alias("j"))
    counts = sorted(r["count"] for r in df.groupBy("j").count().collect())
    assert len(counts) == 10 and counts[0] > 19000 and counts[-1] < 21000


def test_bootstraps(spark):
    rng = np.random.default_rng(1)
    d = rng.normal(0.2, 1.0, size=300)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(d)] + [("tiny", i, float(v)) for i, v in enumerate(d[:10])],
                               "s string, pos long, d double")
    iid = {r.s: r for r in FC.bootstrap_ci(df, ["s"], "pos", "d", 500).collect()}
    blk = {r.s: r for r in FC.block_bootstrap_ci(df, ["s"], "pos", "d", 24, 500, bucket_rows=32).collect()}
    for r in (iid["a"], blk["a"]):
        assert r.ci_low < d.mean() < r.ci_high and r.n_boot == 500 and r.n == 300
    se = d.std(ddof=1) / np.sqrt(300)
    assert (iid["a"].ci_high - iid["a"].ci_low) == pytest.approx(2 * 1.96 * se, rel=0.2)
    # fewer rows than one block: every replicate is the whole series
    assert blk["tiny"].ci_low == pytest.approx(d[:10].mean()) and blk["tiny"].ci_high == pytest.approx(d[:10].mean())


def test_folds_and_split(spark):
    df = spark.createDataFrame([("a", i, i) for i in range(10)], "s string, idx long, ts long")
    folds = sorted((r.fold, r.n_train, r.n_val) for r in FC.rolling_origin_folds(df, ["s"], "idx", "ts", 3).collect())
    assert folds == [(0, 4, 2), (1, 6, 2), (2, 8, 2)]  # n=10, k=3: test size 2
    sp = FC.chrono_split(df, ["s"], "idx", 0.2)
    assert sp.where(F.col("part") == "train").count() == 8


def test_feature_matrix_counts(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    data = [("a", i, base + dt.timedelta(hours=i), float(i % 5), float(i)) for i in range(100)]
    df = spark.createDataFrame(data, "s string, idx long, ts timestamp_ntz, x double, y double")
    fm, names = FC.feature_matrix(df, ["s"], "idx", "ts", "y", 1)
    assert fm.count() == 100 - 24 - 1
    assert names[:2] == ["x_lag1", "hour_lag1"] and "y_lag1" not in names
    row = fm.where(F.col("idx") == 30).first()
    assert row.y == 31.0 and row.x_lag24 == float(6 % 5)


def test_engineered_feature_switches(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", i, base + dt.timedelta(hours=i), float(i % 7)) for i in range(60)],
                               "s string, idx long, ts timestamp_ntz, v double")
    full = FC.engineered_features(df, ["s"], "idx", "ts", ["v"])
    cols = set(full.columns)
    assert {"hour_sin", "v_roll_std_24", "v_lag24", "v_ema_12", "v_slope_6", "v_lag1__v_lag24"} <= cols
    slim = FC.engineered_features(df, ["s"], "idx", "ts", ["v"], lags=(2,), add_ema=False, add_slopes=False)
    sc = set(slim.columns)
    assert "v_ema_3" not in sc and "v_slope_6" not in sc and "v_lag2" in sc
    assert "v_lag1" not in sc and "v_lag1__v_lag24" in sc  # interaction lags are not kept as columns
    row = full.where(F.col("idx") == 30).first()
    assert row.v_lag1__v_lag24 == float(29 % 7) * float(6 % 7)


def test_range_draws_are_a_multinomial(spark):
    """Counts add up, empty ranges get nothing, and means and variances are those of n uniform draws."""
    import numpy as np

    n, rows, reps = 1000, 60, 400
    got = spark.range(reps).select("id", FC.range_draws(F.col("id"), F.lit(n), rows).alias("c")).collect()
    counts = np.array([r.c for r in got])
    assert (counts.sum(axis=1) == n).all() and counts.shape[1] == 32 and (counts[:, 17:] == 0).all()
    size = np.array([60] * 16 + [40])
    p = size / n
    assert np.allclose(counts[:, :17].mean(axis=0), n * p, atol=5 * np.sqrt(n * p * (1 - p) / reps))
    assert np.allclose(counts[:, :17].var(axis=0) / (n * p * (1 - p)), 1, atol=0.4)
    one = spark.range(3).select(FC.range_draws(F.col("id"), F.lit(7), 60).alias("c")).collect()
    assert [r.c for r in one] == [[7]] * 3


def test_bootstrap_by_ranges_covers_the_normal_interval(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.standard_normal(1500) + 3
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)] + [("b", 0, 2.0)] + [("c", i, None) for i in range(3)],
                               "s string, k long, d double")
    for rows in (50, 4096):
        got = {r.s: r for r in FC.bootstrap_ci(df, ["s"], "k", "d", n_boot=600, range_rows=rows).collect()}
        se = x.std() / np.sqrt(len(x))
        assert got["a"].mean_diff == pytest.approx(x.mean()) and got["a"].n == 1500 and got["a"].n_boot == 600
        assert got["a"].ci_low == pytest.approx(x.mean() - 1.96 * se, abs=0.4 * se)
        assert got["a"].ci_high == pytest.approx(x.mean() + 1.96 * se, abs=0.4 * se)
        assert (got["b"].ci_low, got["b"].ci_high) == (2.0, 2.0) and got["c"].ci_low is None
    whole = FC.bootstrap_ci(df.where("s = 'a'"), [], "k", "d", n_boot=200, range_rows=100).collect()
    assert len(whole) == 1 and whole[0].ci_low < x.mean() < whole[0].ci_high
