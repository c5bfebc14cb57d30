"""End to end on the reference's own shape: one sensor table, no series key."""

import datetime as dt
import os
import tempfile

import numpy as np

from hourglass.operators import clean, ema, forecast, series, stats, timeaxis
from hourglass.sources import files


def _csv(n=120):
    rng = np.random.default_rng(11)
    base = dt.datetime(2004, 3, 10, 18)
    lines = [";".join(files.SENSOR_HEADERS)]
    for i in range(n):
        if i in (7, 8):  # two missing hours
            continue
        t = base + dt.timedelta(hours=i)
        co = 2 + np.sin(2 * np.pi * i / 24) + rng.normal(0, 0.2)
        vals = [co, 1200, 150, 9 + co, 1000, 150 + 20 * co, 1000, 100 + 5 * co, 1500, 1000, 15, 50, 0.8]
        if i % 17 == 0:
            vals[0] = -200  # sentinel
        txt = [f"{v:.3f}".replace(".", ",") for v in vals]
        lines.append(f"{t:%d/%m/%Y};{t:%H.%M.%S};" + ";".join(txt))
    d = tempfile.mkdtemp(dir="/tmp")
    p = os.path.join(d, "air.csv")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_single_series_flow(spark):
    raw = files.read_sensor_csv(spark, _csv())
    pol = ["CO", "NOx", "NO2", "Benzene"]
    cleaned = clean.clean_table(raw, pol, bounds=clean.SENSOR_RANGES, scale=False)
    hourly = timeaxis.resample(cleaned, [], "ts", pol, with_index=True, fill_mean=True)
    hourly = hourly.withColumnsRenamed({f"{c}_mean": c for c in pol})
    rows = hourly.orderBy("idx").collect()
    assert len(rows) == 120 and [r.idx for r in rows] == list(range(120))
    assert rows[7].n == 0 and rows[7].CO is not None  # empty hour imputed
    assert all(0.5 <= r.CO <= 5.0 for r in rows)

    feats = forecast.engineered_features(hourly, [], "idx", "ts_hour", ["CO", "NOx"], bucket_rows=50)
    f = {r.idx: r for r in feats.collect()}
    assert f[30].CO_lag24 == rows[6].CO and f[0].CO_ema_3 == rows[0].CO
    e = ema.ema_features(hourly, [], "idx", ["CO"], (6,)).orderBy("idx").toPandas()
    exp = hourly.orderBy("idx").toPandas()["CO"].ewm(span=6, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(e["CO_ema_6"].to_numpy(), exp, rtol=1e-10)

    scored = series.anomaly_scores(hourly, [], "idx", "CO", 24)
    table = series.anomaly_table(scored, [], "ts_hour", "CO")
    assert set(table.columns) == {"ts_hour", "value", "z_score", "mad_z", "method"}
    a = series.acf(hourly, [], "idx", "CO", 30).orderBy("lag").collect()
    assert a[0].r == 1.0 and max(range(13, 31), key=lambda k: a[k].r) == 24
    corr = {(r.col_a, r.col_b): r.r for r in stats.corr_matrix(hourly, pol).collect()}
    assert corr[("CO", "NO2")] > 0.9
    assert corr[("CO", "NOx")] is None  # NOx clipped to its upper bound everywhere: zero variance
    mm = stats.median_mad(hourly, [], "CO").collect()[0]
    co = np.array([r.CO for r in rows])
    assert abs(mm.median - np.median(co)) < 1e-12
