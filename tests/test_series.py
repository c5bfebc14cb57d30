import numpy as np
import pandas as pd
import pytest

from hourglass.operators import series as TS


def _season24(spark, n_days=10, spikes=(50, 130, 200)):
    t = np.arange(24 * n_days)
    x = 10 + 0.01 * t + 3 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(0).normal(0, 0.3, t.size)
    for s in spikes:
        x[s] += 15
    return spark.createDataFrame([("a", int(i), float(v)) for i, v in zip(t, x)], "s string, idx long, v double"), x


def test_acf_matches_numpy(spark):
    df, x = _season24(spark)
    got = {r.lag: r for r in TS.acf(df, ["s"], "idx", "v", 40).collect()}
    d = x - x.mean()
    c0 = (d * d).sum()
    r = np.array([(d[k:] * d[:len(d) - k]).sum() / c0 for k in range(41)])
    for k in (0, 1, 12, 24, 40):
        assert got[k].r == pytest.approx(r[k], abs=1e-12)
    var = (1 + 2 * np.sum(r[1:24] ** 2)) / len(x)
    assert got[24].ci_half_width == pytest.approx(1.959963984540054 * np.sqrt(var))
    assert got[1].ci_half_width == pytest.approx(1.959963984540054 / np.sqrt(len(x)))
    assert max(range(13, 41), key=lambda k: got[k].r) == 24


def test_pacf_matches_yule_walker(spark):
    df, x = _season24(spark)
    a = TS.acf(df, ["s"], "idx", "v", 10).select("s", "lag", "r")
    n = df.groupBy("s").count().withColumnRenamed("count", "n")
    got = {r.lag: r.r for r in TS.pacf(a, ["s"], n).collect()}
    r = np.array(sorted((row.lag, row.r) for row in a.collect()))[:, 1]
    for k in (1, 2, 5, 10):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert got[k] == pytest.approx(phi[-1], abs=1e-10)


def test_classical_decomposition(spark):
    df, x = _season24(spark)
    got = TS.seasonal_decompose(df, ["s"], "idx", "v", 24, bucket_rows=50).toPandas().sort_values("idx")
    filt = np.array([0.5] + [1.0] * 23 + [0.5]) / 24
    trend = np.full(x.size, np.nan)
    for t in range(12, x.size - 12):
        trend[t] = np.dot(filt, x[t - 12:t + 13])
    det = x - trend
    pa = np.array([np.nanmean(det[i::24]) for i in range(24)])
    pa -= pa.mean()
    seas = np.tile(pa, x.size // 24 + 1)[:x.size]
    np.testing.assert_allclose(got["trend"].to_numpy(dtype=float), trend, atol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got["seasonal"].to_numpy(dtype=float), seas, atol=1e-9)
    np.testing.assert_allclose(got["resid"].to_numpy(dtype=float), det - seas, atol=1e-9, equal_nan=True)


def test_anomalies_spikes_and_forms_agree(spark):
    df, x = _season24(spark)
    scored = TS.anomaly_scores(df, ["s"], "idx", "v", 24)
    a = TS.anomaly_table(scored, ["s"], "idx", "v").toPandas()
    b = TS.anomaly_table_by_exclusion(scored, ["s"], "idx", "v").toPandas()
    key = ["idx", "method"]
    assert a.sort_values(key).reset_index(drop=True)[key].equals(b.sort_values(key).reset_index(drop=True)[key])
    assert {50, 130, 200} <= set(a["idx"])
    med = np.median(x)
    mad = np.median(np.abs(x - med))
    exp_mad = set(np.where(np.abs((x - med) / (1.4826 * mad)) > 3)[0]) - set(np.where(np.abs((x - x.mean()) / x.std(ddof=1)) > 3)[0])
    assert exp_mad == set(a.loc[a.method == "mad", "idx"])
    assert a.loc[a.method == "seasonal_residual", "z_score"].isna().all()


def test_constant_series_has_no_anomalies(spark):
    df = spark.createDataFrame([("c", i, 5.0) for i in range(30)], "s string, idx long, v double")
    scored = TS.anomaly_scores(df, ["s"], "idx", "v", 24).toPandas()
    assert (scored["z_score"] == 0).all() and (scored["mad_z"] == 0).all()
    assert TS.anomaly_table(TS.anomaly_scores(df, ["s"], "idx", "v", 24), ["s"], "idx", "v").count() == 0
    assert pd is not None


def test_halo_buckets_do_not_change_acf_or_decomposition(spark):
    df, _ = _season24(spark)
    a = TS.acf(df, ["s"], "idx", "v", 40, bucket_rows=50).toPandas().sort_values("lag")
    b = TS.acf(df, ["s"], "idx", "v", 40, bucket_rows=None).toPandas().sort_values("lag")
    np.testing.assert_allclose(a["r"], b["r"], atol=1e-12)
    c = TS.seasonal_decompose(df, ["s"], "idx", "v", 24, bucket_rows=30).toPandas().sort_values("idx")
    d = TS.seasonal_decompose(df, ["s"], "idx", "v", 24, bucket_rows=None).toPandas().sort_values("idx")
    np.testing.assert_allclose(c["resid"].astype(float), d["resid"].astype(float), atol=1e-12, equal_nan=True)
