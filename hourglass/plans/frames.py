"""Shared input frames built from the driver tables.

``events`` plays the sensor stream (series = ``event_type``); ``lineitem``
supplies four numeric "sensors" and an irregular series per supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators import timeaxis
from hourglass.sources.tables import read_table

SERIES = ["series"]
LINEITEM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Plausibility ranges for the lineitem stand-in sensors (parameters of B11).
LINEITEM_RANGES = {
    "l_quantity": (5.0, 45.0),
    "l_extendedprice": (2000.0, 90000.0),
    "l_discount": (0.01, 0.09),
    "l_tax": (None, 0.07),
}
# Value treated as the missing-reading sentinel in the lineitem stand-in.
LINEITEM_SENTINEL = 0.0


def events(spark: SparkSession, sf_dir: str, cols=("event_id", "ts", "event_type", "value")) -> DataFrame:
    return read_table(spark, sf_dir, "events", list(cols))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 on events: series, ts_hour, value_mean, n, idx (dense hour position)."""
    ev = events(spark, sf_dir).withColumnRenamed("event_type", "series")
    return timeaxis.resample(ev, SERIES, "ts", ["value"], with_index=True)


def hourly_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means with empty hours filled by the series mean: series, ts_hour, idx, n, value."""
    ev = events(spark, sf_dir).withColumnRenamed("event_type", "series")
    h = timeaxis.resample(ev, SERIES, "ts", ["value"], with_index=True, fill_mean=True)
    return h.withColumnRenamed("value_mean", "value").select("series", "ts_hour", "idx", "n", "value")


def lineitem4(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem", [*extra, *LINEITEM4])
