"""Strict coercion, zone-free parsing and lenient message decoding."""

from pyspark.sql import functions as F

from hourglass.functions import exprs as X
from hourglass.streaming import jobs, messages


def test_suffixed_literals_are_not_numbers(spark):
    df = spark.createDataFrame([("1d",), ("10F",), ("2.5f ",), ("1.5",), ("1e3",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(X.to_double("v")).collect()] == [None, None, None, 1.5, 1000.0, None, None]


def test_parse_day_first_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
        df = spark.createDataFrame([("28/03/2004", "02:30:00"), ("31/02/2004", "01:00:00"), ("1/6/2004", "18.00.00")], "d string, t string")
        got = [r[0] for r in df.select(X.parse_day_first("d", "t").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2004-03-28 02:30:00", None, "2004-06-01 18:00:00"]


def test_decode_text_numbers_empty_text_and_alias(spark):
    df = spark.createDataFrame([('{"CO":"12.5"}',), ("",), ('{"CO(GT)": 11}',), ("oops",), ('{"CO": NaN}',)], "v string")
    got = messages.decode(df, "v")
    assert [(r["CO"], r["CO(GT)"], r["raw"]) for r in got.collect()] == [
        (12.5, None, None), (None, None, ""), (None, 11.0, None), (None, None, "oops"), (None, None, None)]
    assert jobs.threshold_alerts(got).count() == 2
    assert got.filter(F.col("raw").isNotNull()).count() == 2
