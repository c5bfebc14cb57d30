import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourglass.operators import ema, windows


def _long(spark, n_hot=400, n_small=30, seed=0, nulls=True):
    rng = np.random.default_rng(seed)
    recs = []
    for s, n in (("hot", n_hot), ("small", n_small), ("one", 1)):
        x = rng.normal(size=n).cumsum()
        for i in range(n):
            v = None if (nulls and rng.random() < 0.05) else float(x[i])
            recs.append((s, i, v))
    return spark.createDataFrame(recs, "s string, idx long, v double"), pd.DataFrame(recs, columns=["s", "idx", "v"])


def _cmp(a: pd.DataFrame, b: pd.DataFrame, cols):
    a = a.sort_values(["s", "idx"]).reset_index(drop=True)
    b = b.sort_values(["s", "idx"]).reset_index(drop=True)
    for c in cols:
        np.testing.assert_allclose(a[c].astype(float).to_numpy(), b[c].astype(float).to_numpy(), rtol=1e-9, atol=1e-9,
                                   equal_nan=True, err_msg=c)


def test_halo_equals_plain(spark):
    df, _ = _long(spark)
    kw = dict(lags=(1, 3, 24), roll_windows=(3, 24), slope_windows=(6, 24), leads={"y": ("v", 2)})
    halo = windows.window_features(df, ["s"], "idx", ["v"], bucket_rows=25, **kw).toPandas()
    plain = windows.window_features(df, ["s"], "idx", ["v"], bucket_rows=None, **kw).toPandas()
    assert len(halo) == len(plain) == df.count()
    _cmp(halo, plain, [c for c in plain.columns if c not in ("s", "idx")])
    cma_h = windows.centered_moving_average(df, ["s"], "idx", "v", 24, bucket_rows=30).toPandas()
    cma_p = windows.centered_moving_average(df, ["s"], "idx", "v", 24, bucket_rows=None).toPandas()
    _cmp(cma_h, cma_p, ["trend"])


def test_rolling_matches_pandas(spark):
    df, pdf = _long(spark)
    out = windows.rolling_features(df, ["s"], "idx", ["v"], (3, 24), bucket_rows=50).toPandas()
    exp = pdf.sort_values(["s", "idx"]).copy()
    for w in (3, 24):
        r = exp.groupby("s")["v"].rolling(w, min_periods=1)
        exp[f"v_roll_mean_{w}"] = r.mean().reset_index(level=0, drop=True)
        exp[f"v_roll_std_{w}"] = r.std().reset_index(level=0, drop=True).fillna(0)
    _cmp(out, exp, ["v_roll_mean_3", "v_roll_std_3", "v_roll_mean_24", "v_roll_std_24"])


def test_slope_matches_polyfit(spark):
    df, pdf = _long(spark, n_hot=120)
    out = windows.rolling_slope(df, ["s"], "idx", ["v"], (6,), bucket_rows=40).toPandas()

    def slope(x):
        m = ~np.isnan(x)
        if m.sum() < 2:
            return np.nan
        return np.polyfit(np.arange(len(x))[m], x[m], 1)[0]

    exp = pdf.sort_values(["s", "idx"]).copy()
    exp["v_slope_6"] = exp.groupby("s")["v"].transform(lambda s: s.rolling(6, min_periods=2).apply(slope, raw=True))
    _cmp(out, exp, ["v_slope_6"])


def test_ramp_and_single(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(50)] + [("one", 0, 7.0)], "s string, idx long, v double")
    out = windows.window_features(df, ["s"], "idx", ["v"], lags=(1,), roll_windows=(3,), slope_windows=(6,))
    r = {(x.s, x.idx): x for x in out.collect()}
    assert r[("r", 10)].v_slope_6 == pytest.approx(1.0)
    assert r[("r", 0)].v_lag1 is None and r[("r", 0)].v_slope_6 is None
    assert r[("one", 0)].v_roll_std_3 == 0.0 and r[("one", 0)].v_slope_6 is None


@pytest.mark.parametrize("n_hot", [300, 20000])
def test_ema_matches_pandas(spark, n_hot):
    # 20000 rows = 79 blocks of 256, which needs an upper scan level
    df, pdf = _long(spark, n_hot=n_hot, nulls=False)
    out = ema.ema_features(df, ["s"], "idx", ["v"], (3, 6, 12, 24)).toPandas()
    exp = pdf.sort_values(["s", "idx"]).copy()
    for s in (3, 6, 12, 24):
        exp[f"v_ema_{s}"] = exp.groupby("s")["v"].transform(lambda x: x.ewm(span=s, adjust=False).mean())
    _cmp(out, exp, [f"v_ema_{s}" for s in (3, 6, 12, 24)])


def test_running_scans(spark):
    df, pdf = _long(spark)
    out = windows.running_scan(df, ["s"], "idx", "v", "sum", "cs", bucket_rows=16)
    out = windows.running_scan(out, ["s"], "idx", "v", "last", "ff", bucket_rows=16).toPandas()
    exp = pdf.sort_values(["s", "idx"]).copy()
    exp["cs"] = exp.groupby("s")["v"].transform(lambda x: x.fillna(0).cumsum())
    exp["ff"] = exp.groupby("s")["v"].transform(lambda x: x.ffill())
    _cmp(out, exp, ["cs", "ff"])


def test_interactions_and_baselines(spark):
    df = spark.createDataFrame([("a", i, float(i), float(10 * i)) for i in range(30)], "s string, idx long, x double, y double")
    out = windows.lag_interactions(df, ["s"], "idx", ["x", "y"], (1, 24))
    names = [f"{a}__{b}" for a, b in windows.interaction_names(["x", "y"], (1, 24))]
    assert len(names) == 6 and names[0] == "x_lag1__x_lag24"
    r = {x.idx: x for x in out.collect()}
    assert r[25]["x_lag1__y_lag24"] == 24.0 * 10.0
    pb = {x.idx: x.baseline for x in windows.persistence_baseline(df, ["s"], "idx", "x").collect()}
    assert pb[0] == 0.0 and pb[5] == 4.0
    assert F is not None


def test_ordered_features_match_plain_windows(spark):
    from pyspark.sql import Window

    rng = np.random.default_rng(4)
    data = [(f"k{i % 3}", int(rng.integers(0, 500)), i, float(rng.normal())) for i in range(900)]
    df = spark.createDataFrame(data, "s string, t long, id long, v double")
    kw = dict(lags=(1, 2), roll_windows=(5,), slope_windows=(5,))
    plain = df.withColumn("idx", F.row_number().over(Window.partitionBy("s").orderBy("t", "id")) - 1)
    a = windows.window_features(plain, ["s"], "idx", ["v"], bucket_rows=None, **kw).toPandas()
    b = windows.ordered_features(df, ["s"], ["t", "id"], ["v"], bucket_rows=16, **kw).toPandas()
    assert (a.sort_values(["s", "idx"])["id"].to_numpy() == b.sort_values(["s", "idx"])["id"].to_numpy()).all()
    _cmp(a, b, ["v_lag1", "v_lag2", "v_roll_mean_5", "v_roll_std_5", "v_slope_5"])


def test_poisson_bootstrap(spark):
    from hourglass.operators import forecast as FC

    rng = np.random.default_rng(9)
    d = rng.normal(0.5, 1.0, size=2000)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(d)], "s string, pos long, d double")
    r = FC.poisson_bootstrap_ci(df, ["s"], "pos", "d", 400).collect()[0]
    assert r.ci_low < d.mean() < r.ci_high
    theory = 2 * 1.959964 * d.std() / np.sqrt(len(d))
    assert abs((r.ci_high - r.ci_low) / theory - 1) < 0.15
    r2 = FC.poisson_bootstrap_ci(df, ["s"], "pos", "d", 400).collect()[0]
    assert (r.ci_low, r.ci_high) == (r2.ci_low, r2.ci_high)
    tiny = FC.poisson_bootstrap_ci(df.filter("pos < 2"), [], "pos", "d", 200).collect()[0]
    assert 0 < tiny.n_boot <= 200 and tiny.ci_low <= tiny.ci_high


def test_neighbouring_replicates_draw_independently(spark):
    from pyspark.sql import functions as F

    from hourglass.operators import forecast as FC

    n = 1_500_000  # beyond 1,000,003 draws
    t = spark.range(n).select(*[FC.hash_draw(F.lit(r), F.col("id"), n).alias(f"r{r}") for r in (0, 1)])
    counts = [t.groupBy(F.col(c).alias("j")).agg(F.count(F.lit(1)).alias(c)) for c in ("r0", "r1")]
    both = spark.range(n).withColumnRenamed("id", "j").join(counts[0], "j", "left").join(counts[1], "j", "left").fillna(0)
    s = both.agg(F.corr("r0", "r1").alias("c"), F.avg(F.col("r0") * F.col("r0")).alias("m2")).first()
    assert abs(s.c) < 0.01 and abs(s.m2 - 2.0) < 0.02  # Poisson(1) counts: E[x^2] = 2
    wide = spark.range(100_000).agg(F.max(FC.hash_draw(F.lit(3), F.col("id"), F.lit(1 << 40))).alias("m")).first()
    assert wide.m > 1 << 39
