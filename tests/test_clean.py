import math

from pyspark.sql import functions as F

from hourglass.operators import clean, timeaxis


def test_sentinel_coerce_nan(spark):
    df = spark.createDataFrame([(1, "-200"), (2, "abc"), (3, "NaN"), (4, None), (5, "2.5")], "id int, CO string")
    out = clean.numeric_coerce(clean.sentinel_to_null(df, ["CO"], -200.0), ["CO"])
    got = {r.id: r.CO for r in out.collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: 2.5}
    num = clean.sentinel_to_null(clean.numeric_coerce(df, ["CO"]), ["CO"], -200.0)
    assert {r.id: r.CO for r in num.collect()}[1] is None


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 7.0), (3, None), (4, 2.0)], "id int, CO double")
    got = {r.id: r.CO for r in clean.range_clip(df, {"CO": (0.5, 5.0)}).collect()}
    assert got == {1: 0.5, 2: 5.0, 3: None, 4: 2.0}


def test_minmax_constant_and_impute_all_missing(spark):
    df = spark.createDataFrame([(i, 5.0, None) for i in range(5)], "id int, a double, b double")
    out = clean.mean_impute(clean.minmax_scale(df, ["a"]), ["a", "b"])
    assert {r.a for r in out.collect()} == {0.0}
    assert {r.b for r in out.collect()} == {None}


def test_scale_first_quirk(spark):
    # scaling to [0,1] before clipping to [5, 100] sends every NOx to 5.0
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 50, 300, 80])], "id int, NOx double")
    out = clean.clean_table(df, ["NOx"], bounds={"NOx": (5.0, 100.0)}, scale_first=True)
    assert {r.NOx for r in out.collect()} == {5.0}
    normal = clean.clean_table(df, ["NOx"], bounds={"NOx": (5.0, 100.0)})
    got = sorted(r.NOx for r in normal.collect())
    assert [round(x, 12) for x in got] == [0.0, round(40 / 90, 12), round(70 / 90, 12), 1.0]


def test_per_series_impute(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", 10.0)], "s string, v double")
    out = clean.mean_impute(df, ["v"], ["s"])
    assert sorted((r.s, r.v) for r in out.collect()) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), ("b", 10.0)]


def test_parse_day_first(spark):
    df = spark.createDataFrame(
        [(1, " 31/12/2004", "23:00:00"), (2, "99/99/2004", "00:00:00"), (3, "10/03/2004", "18.00.00"), (4, "abc", None)],
        "id int, d string, t string")
    out = timeaxis.parse_timestamp(df, "d", "t")
    got = {r.id: r.ts.isoformat() for r in out.collect()}
    assert got == {1: "2004-12-31T23:00:00", 3: "2004-03-10T18:00:00"}


def test_usable_features(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 3.0)], "a double, b double, Target double, y double")
    assert clean.usable_features(df, ["a", "b", "Target", "y"], "y") == ["a"]


def test_field_alias_and_default(spark):
    df = spark.createDataFrame([("12", "1"), (None, "11.5"), ("x", None)], "CO string, `CO(GT)` string")
    got = [r[0] for r in df.select(clean.field_with_alias("CO", "CO(GT)")).collect()]
    assert got == [12.0, 11.5, None]
    got = [r[0] for r in df.select(clean.fill_default("CO")).collect()]
    assert got[0] == 12.0 and got[1] == 0.0 and got[2] == 0.0
    assert not any(isinstance(x, float) and math.isnan(x) for x in got)
    assert F is not None


def test_clean_table_keeps_the_callers_own_columns(spark):
    from hourglass.operators import clean

    df = spark.createDataFrame([(1.0, "x", 5), (-200.0, "y", 6), (3.0, "z", 7)], "v double, __tag string, __mean_v int")
    out = clean.clean_table(df, ["v"], sentinel=-200.0)
    assert out.columns == ["v", "__tag", "__mean_v"]
    assert sorted(map(tuple, out.collect())) == [(0.0, "x", 5), (0.5, "y", 6), (1.0, "z", 7)]


def test_column_selection_by_type_and_presence(spark):
    from hourglass.operators import clean

    df = spark.createDataFrame([(1, 2.0, "a", True, None)], "i int, d double, s string, b boolean, l long")
    assert clean.numeric_columns(df) == ["i", "d", "l"]
    assert clean.existing(df, ["l", "gone", "d"]) == ["l", "d"]
