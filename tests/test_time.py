import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from hourglass.operators import timeaxis
from tests.conftest import rows


def _gaps(spark):
    base = dt.datetime(2024, 1, 1)
    data = []
    for s in ("a", "b"):
        for h in (0, 1, 3, 5):
            data.append((s, base + dt.timedelta(hours=h, minutes=10), float(h)))
        data.append((s, base + dt.timedelta(hours=1, minutes=40), 3.0))  # second reading in hour 1
    return spark.createDataFrame(data, "s string, ts timestamp_ntz, v double")


def test_resample_spine(spark):
    out = timeaxis.resample(_gaps(spark), ["s"], "ts", ["v"], with_index=True)
    got = rows(out.where(F.col("s") == "a"), "idx")
    assert [r[-1] for r in got] == [0, 1, 2, 3, 4, 5]
    assert [r[2] for r in got] == [0.0, 2.0, None, 3.0, None, 5.0]
    assert [r[3] for r in got] == [1, 2, 0, 1, 0, 1]


def test_temporal_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 2, 5), ), (dt.datetime(2024, 3, 3, 0),)], "ts timestamp_ntz")
    out = timeaxis.add_temporal_features(df, "ts").orderBy("ts").collect()
    assert (out[0].season, out[0].day_of_week) == (2, 6)  # March: spring, Sunday = 6
    assert (out[1].season, out[1].day_of_week, out[1].hour) == (1, 0, 5)  # December: winter, Monday = 0


def test_row_index_matches_rank_with_many_chunks(spark):
    random.seed(1)
    data = [("hot", random.randint(0, 10**6), i) for i in range(3000)]
    data += [(f"s{i % 7}", random.randint(0, 10**6), i) for i in range(500)]
    df = spark.createDataFrame(data, "s string, t long, id long")
    pdf = pd.DataFrame(data, columns=["s", "t", "id"])
    pdf["exp"] = pdf.sort_values(["t", "id"]).groupby("s").cumcount()
    for chunks in (17, 300, None):
        out = timeaxis.row_index(df, ["s"], ["t", "id"], chunks=chunks).toPandas()
        m = out.merge(pdf, on=["s", "t", "id"])
        assert len(m) == len(data) and (m["idx"] == m["exp"]).all()


def test_chunks_split_a_tied_time(spark):
    df = spark.range(40_000).selectExpr("'s' AS s", "if(id % 10 < 9, 5L, id) AS t", "id")
    sizes = [r["count"] for r in timeaxis.range_chunks(df, ["s", "t", "id"], 16).groupBy("__chunk").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * 40_000 / 16
    out = timeaxis.row_index(df, ["s"], ["t", "id"], chunks=16).orderBy("t", "id").select("idx").toPandas()
    assert (out["idx"] == range(40_000)).all()


def test_row_index_keeps_missing_series(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "s string, t int")
    assert sorted((r.s or "", r.idx) for r in timeaxis.row_index(df, ["s"], ["t"]).collect()) == [("", 0), ("", 1), ("a", 0)]


def test_synthetic_index(spark):
    df = spark.createDataFrame([(0, 3), (1, 3), (2, 3)], "idx long, n long")
    out = timeaxis.synthetic_time_index(df, "idx", "n", "2024-02-01 00:00:00").orderBy("idx").collect()
    assert [r.ts_synth.isoformat() for r in out] == ["2024-01-31T22:00:00", "2024-01-31T23:00:00", "2024-02-01T00:00:00"]


def test_resample_fill_mean_equals_impute(spark):
    from hourglass.operators import clean

    a = timeaxis.resample(_gaps(spark), ["s"], "ts", ["v"], with_index=True, fill_mean=True)
    b = clean.mean_impute(timeaxis.resample(_gaps(spark), ["s"], "ts", ["v"], with_index=True), ["v_mean"], ["s"])
    assert rows(a, "s", "idx") == rows(b.select(*a.columns), "s", "idx")


def test_reparse_timestamp(spark):
    df = spark.createDataFrame([("2024-01-01T05:00:00",), ("nope",)], "t string")
    got = [r.t for r in timeaxis.reparse_timestamp(df, "t").collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 5) and got[1] is None


def test_resample_positions_ignore_session_zone(spark):
    base = dt.datetime(2024, 3, 10, 0, 30)  # New York skips 02:00-03:00 local time that night
    df = spark.createDataFrame([("a", base + dt.timedelta(hours=h), 1.0) for h in (0, 1, 2, 3, 5)],
                               "s string, ts timestamp_ntz, v double")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = rows(timeaxis.resample(df, ["s"], "ts", ["v"], with_index=True), "idx")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r[-1] for r in got] == [0, 1, 2, 3, 4, 5]
    assert [r[1].hour for r in got] == [0, 1, 2, 3, 4, 5]
    assert [r[3] for r in got] == [1, 1, 1, 1, 0, 1]


def test_ten_year_gap_in_seconds_is_cut_into_stretches(spark):
    """Only counted: 315 million seconds, and no task gets more than its share of stretches."""
    base = dt.datetime(2010, 1, 1)
    df = spark.createDataFrame([("a", base, 1.0), ("a", base.replace(year=2020), 3.0), ("b", base, 2.0)], "s string, ts timestamp_ntz, v double")
    out = timeaxis.resample(df, ["s"], "ts", ["v"], unit="second", with_index=True)
    span = int((base.replace(year=2020) - base).total_seconds()) + 1
    got = out.groupBy("s", F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("n").alias("rows"), F.max("idx").alias("top")).collect()
    mine = [r for r in got if r.s == "a"]
    assert sum(r.n for r in mine) == span and sum(r.rows for r in mine) == 2 and max(r.top for r in mine) == span - 1
    assert [(r.n, r.rows) for r in got if r.s == "b"] == [(1, 1)]
    assert max(r.n for r in mine) < span / 4


def test_stretches_do_not_change_the_axis(spark):
    rng = random.Random(4)
    base = dt.datetime(1969, 12, 30)
    rows = [(k, base + dt.timedelta(minutes=rng.randint(0, 60 * 300) + (90_000 if rng.random() < 0.3 else 0)), rng.random())
            for k in ("a", "b", None) for _ in range(40)] + [("c", base, None)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double")
    key = lambda x: str(x)
    for fill in (False, True):
        want = sorted(map(tuple, timeaxis.resample(df, ["s"], "ts", ["v"], with_index=True, fill_mean=fill).collect()), key=key)
        for stretch in (1, 2, 7, 100):
            got = sorted(map(tuple, timeaxis.resample(df, ["s"], "ts", ["v"], with_index=True, fill_mean=fill, stretch=stretch).collect()), key=key)
            assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
            assert all(g[2] == w[2] or abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, want))
    # against a plain axis
    hours = {}
    for k, t, v in rows:
        hours.setdefault(k, {}).setdefault(t.replace(minute=0), []).append(v)
    got = {(r.s, r.ts_hour): (r.v_mean, r.n, r.idx) for r in timeaxis.resample(df, ["s"], "ts", ["v"], with_index=True, stretch=7).collect()}
    n = 0
    for k, h in hours.items():
        t = min(h)
        while t <= max(h):
            mean, count, idx = got[(k, t)]
            vals = [v for v in h.get(t, []) if v is not None]
            assert count == len(h.get(t, [])) and idx == (t - min(h)).total_seconds() // 3600
            assert (mean is None) == (not vals) and (mean is None or abs(mean - sum(vals) / len(vals)) < 1e-12)
            t, n = t + dt.timedelta(hours=1), n + 1
    assert n == len(got)
