import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import stats


def _t_pvalue(r, n):
    """Two-sided p from the Student t density by fine numerical integration."""
    df = n - 2
    t = abs(r) * math.sqrt(df / (1 - r * r))
    xs = np.linspace(t, t + 400, 2_000_001)
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    ys = c * (1 + xs * xs / df) ** (-(df + 1) / 2)
    return 2 * float(np.sum((ys[1:] + ys[:-1]) / 2 * np.diff(xs)))


def test_corr_min_count_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 1.0, 5.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): (r.n, r.r) for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "a")] == (4, 1.0)
    assert got[("a", "b")][0] == 3 and got[("a", "b")][1] == pytest.approx(np.corrcoef([1, 3, 4], [2, 7, 1])[0, 1])
    assert got[("a", "c")][1] is None  # zero variance
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    assert {(r.col_a, r.col_b): r.r for r in stats.corr_matrix(two, ["a", "b"]).collect()}[("a", "b")] is None


def test_pvalues(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=40)
    y = 0.4 * x + rng.normal(size=40)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "a double, b double")
    out = {(r.col_a, r.col_b): r for r in stats.corr_pvalues(stats.corr_matrix(df, ["a", "b"])).collect()}
    r = out[("a", "b")]
    assert r.p == pytest.approx(_t_pvalue(r.r, 40), rel=1e-6)
    assert out[("a", "a")].p is None and out[("a", "a")].p_text is None
    assert r.p_text == f"{r.p:.12e}"
    assert r.stars == ("***" if r.p < 0.001 else "**" if r.p < 0.01 else "*" if r.p < 0.05 else "")


@pytest.mark.parametrize("n", [1, 2, 7, 10])
def test_exact_median_and_mad(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 5, size=n).astype(float)  # ties on purpose
    big = rng.normal(size=999)
    stuck = np.concatenate([np.full(900, 7.0), rng.normal(size=100)])  # a sensor that repeats one value
    data = [("s", float(v)) for v in vals] + [("hot", float(v)) for v in big] + [("s", None)] + [("stuck", float(v)) for v in stuck]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: (r.median, r.mad) for r in stats.median_mad(df, ["k"], "v").collect()}
    for k, arr in (("s", vals), ("hot", big), ("stuck", stuck)):
        med = float(np.median(arr))
        assert got[k][0] == pytest.approx(med)
        assert got[k][1] == pytest.approx(float(np.median(np.abs(arr - med))))


def test_qc_summary(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (3.0, "y"), (float("nan"), "z")], "a double, b string")
    got = {r.column: r for r in stats.qc_summary(df).collect()}
    assert got["a"].total == 4 and got["a"].missing == 2 and got["a"].pct_missing == 0.5
    assert got["a"].mean == 2.0 and got["a"].std == pytest.approx(math.sqrt(2))
    assert got["b"].missing == 1 and got["b"].mean is None


def test_top_correlations_order(spark):
    corr = spark.createDataFrame(
        [("a", "b", 3, 0.5), ("a", "c", 3, -0.9), ("b", "c", 3, 0.5), ("a", "d", 3, None)],
        "col_a string, col_b string, n long, r double")
    top = [(r.rank, r.col_a, r.col_b) for r in stats.top_correlations(corr, ["a", "b", "c", "d"], 3).orderBy("rank").collect()]
    assert top == [(1, "a", "c"), (2, "b", "c"), (3, "a", "b")]
    assert F is not None


def test_pvalues_against_numerical_integration(spark):
    """Student's t density integrated with fine steps, small to large samples."""
    import math

    import numpy as np

    rows = [(0.5, 3), (0.9, 4), (-0.3, 10), (0.05, 500), (0.2, 2000), (0.004, 1_000_000), (1.0, 9), (0.0, 9), (0.999, 30), (None, 8), (0.4, 2)]
    df = spark.createDataFrame(rows, "r double, n long")
    for r, n, p in [(x.r, x.n, x.p) for x in stats.pearson_pvalues(df, "r", "n").collect()]:
        if r is None or n <= 2:
            assert p is None
            continue
        free = n - 2
        t = math.inf if abs(r) == 1 else abs(r) * math.sqrt(free / (1 - r * r))
        # tail over u = arctan(x / sqrt(free)): density cos(u)^(free - 1)
        end = min(math.pi / 2, 40 / math.sqrt(free))  # nothing counts beyond
        top = np.linspace(0.0, end, 400_001)
        f = np.cos(top) ** (free - 1)
        whole = np.trapezoid(f, top)
        u = np.linspace(min(math.atan(t / math.sqrt(free)), end), end, 400_001)
        assert p == pytest.approx(np.trapezoid(np.cos(u) ** (free - 1), u) / whole, rel=1e-5, abs=1e-12)


def test_medians_of_several_columns_and_null_keys(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(k, float(v), None if i % 4 == 0 else float(i % 7)) for k in ("a", "b", None) for i, v in enumerate(rng.integers(0, 40, 301))]
    rows += [("c", None, 1.0), ("d", None, None), ("e", float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "s string, x double, y double").repartition(6)
    for accuracy in (10_000, 20):  # a coarse sketch leaves many values inside the bracket
        got = {r.s: (r.mx, r.my) for r in stats.exact_medians(df, ["s"], {"mx": "x", "my": "y"}, accuracy=accuracy).collect()}
        for k in ("a", "b", None):
            x = [v for s, v, _ in rows if s == k]
            y = [v for s, _, v in rows if s == k and v is not None]
            assert got[k] == (np.median(x), np.median(y))
        assert got["c"] == (None, 1.0) and got["e"] == (None, 2.0) and "d" not in got
    whole = stats.exact_medians(df, [], {"m": "x"}).collect()
    assert whole[0].m == np.median([v for _, v, _ in rows if v is not None and v == v])
