"""STL by windows against a plain NumPy version, point by point."""

import numpy as np
import pytest

from hourglass.operators import stl


def line(y, w, at, left, right, q):
    n = len(y)
    h = max(at - left, right - at) + ((q - n) // 2 if q > n else 0)
    x = np.arange(left, right + 1)
    r = np.abs(x - at)
    k = np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, (1 - (r / h) ** 3) ** 3, 0.0)) * w[left : right + 1]
    if k.sum() <= 0:
        return None
    k = k / k.sum()
    a = (k * x).sum()
    c = (k * (x - a) ** 2).sum()
    if np.sqrt(c) > 0.001 * (n - 1):
        k = k * ((at - a) / c * (x - a) + 1)
    return (k * y[left : right + 1]).sum()


def smooth(y, q, w, ends=False):
    n, out = len(y), []
    for at in range(-1, n + 1) if ends else range(n):
        inside = min(max(at, 0), n - 1)
        left = max(0, min(inside - (q - 1) // 2, n - q)) if q < n else 0
        right = min(n, left + q) - 1
        got = line(y, w, at, left, right, q)
        out.append(y[inside] if got is None else got)
    return np.array(out)


def plain(y, p, ns, nt, nl, inner, outer):
    n = len(y)
    trend, seasonal, rw = np.zeros(n), np.zeros(n), np.ones(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            c = np.zeros(n + 2 * p)
            for ph in range(p):
                c[ph::p][: len(y[ph::p]) + 2] = smooth((y - trend)[ph::p], ns, rw[ph::p], ends=True)
            m = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
            low = smooth(m(m(m(c, p), p), 3), nl, np.ones(n))
            seasonal = c[p : p + n] - low
            trend = smooth(y - seasonal, nt, rw)
        if turn < outer:
            r = np.abs(y - seasonal - trend)
            h = 6 * np.median(r)
            rw = np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, (1 - (r / h) ** 2) ** 2, 0.0))
    return trend, seasonal, rw


@pytest.mark.parametrize("robust", [False, True])
def test_stl_matches_plain_version(spark, robust):
    rng = np.random.default_rng(3)
    data = {k: 10 + 0.05 * np.arange(n) + 3 * np.sin(2 * np.pi * np.arange(n) / 5) + rng.normal(0, 0.4, n) for k, n in (("a", 70), ("b", 23), (None, 12))}
    data["a"][17] += 30
    df = spark.createDataFrame([(k, i, float(v), "x") for k, y in data.items() for i, v in enumerate(y)], "s string, i long, y double, note string")
    rounds = {"inner": 2, "outer": 1} if robust else {"inner": 2, "outer": 0}
    got = stl.stl_decompose(df, ["s"], "i", "y", period=5, seasonal=7, bucket_rows=30, robust=robust, **rounds)
    assert got.columns == ["s", "i", "y", "note", "trend", "seasonal", "resid", "weights"]
    got = got.toPandas()
    for k, y in data.items():
        mine = got[got.s.isna() if k is None else got.s == k].sort_values("i")
        trend, seasonal, rw = plain(y, 5, 7, stl.odd_above(1.5 * 5 / (1 - 1.5 / 7)), stl.odd_above(6), **rounds)
        assert np.allclose(mine.trend, trend, atol=1e-8) and np.allclose(mine.seasonal, seasonal, atol=1e-8)
        assert np.allclose(mine.resid, y - trend - seasonal, atol=1e-8) and np.allclose(mine.weights, rw, atol=1e-8)
    if robust:
        assert got[(got.s == "a") & (got.i == 17)].weights.iloc[0] == 0
