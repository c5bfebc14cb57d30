"""File sources and sinks: the raw sensor CSV (A1), report exports as CSV
(A6) and JSON (A7), CSV read-back (A8) and model save/load (A9)."""

from __future__ import annotations

import os
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X
from hourglass.operators import clean

# Fixed values that must equal the reference for equal results: raw sensor
# headers in file order.
SENSOR_HEADERS = [
    "Date", "Time", "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)", "PT08.S2(NMHC)", "NOx(GT)",
    "PT08.S3(NOx)", "NO2(GT)", "PT08.S4(NO2)", "PT08.S5(O3)", "T", "RH", "AH",
]
# Snake-case names for the headers that need back-ticks in Spark.
SAFE_NAMES = {
    "PT08.S1(CO)": "PT08_S1_CO", "PT08.S2(NMHC)": "PT08_S2_NMHC", "PT08.S3(NOx)": "PT08_S3_NOx",
    "PT08.S4(NO2)": "PT08_S4_NO2", "PT08.S5(O3)": "PT08_S5_O3",
}


def read_sensor_csv(spark: SparkSession, path: str, sep: str = ";", decimal: str = ",",
                    target: DataFrame | None = None) -> DataFrame:
    """A1 + A2 + B1 + B3 + B4 + C1: raw sensor CSV -> typed, renamed table.

    Every field is read as text under a declared schema (no inference),
    decimal commas become points, -200 and bad text become NULL, Date+Time
    are parsed day-first into ``ts`` (rows without a time are dropped) and
    an absent target becomes a NULL ``Target`` column.
    """
    schema = T.StructType([T.StructField(h, T.StringType()) for h in SENSOR_HEADERS])
    raw = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    values = [h for h in SENSOR_HEADERS if h not in ("Date", "Time")]
    out = raw.select(
        X.parse_day_first("Date", "Time").alias("ts"),
        *[F.regexp_replace(F.col(f"`{h}`"), decimal, ".").alias(h) if decimal != "." else F.col(f"`{h}`").alias(h)
          for h in values],
    ).where(F.col("ts").isNotNull())
    out = out.withColumnsRenamed(SAFE_NAMES)
    out = clean.rename_columns(out, clean.SENSOR_RENAME)
    cols = [c for c in out.columns if c != "ts"]
    out = clean.numeric_coerce(clean.sentinel_to_null(out, cols), cols)
    if target is None:
        return out.withColumn("Target", F.lit(None).cast("double"))
    return out.join(target, "ts", "left")


def write_csv(df: DataFrame, path: str, sci_cols: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> None:
    """A6 + H1: header CSV; ``sci_cols`` written as ``%.12e`` text, NULL as
    blank; ``sort_by`` orders the files globally (a range-partitioned sort,
    e.g. anomalies by timestamp then series)."""
    out = df.withColumns({c: X.sci12(c) for c in sci_cols})
    if sort_by:
        out = out.orderBy(*sort_by)
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read an exported CSV back with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """Nested report rows (structs/maps) as JSON lines."""
    df.write.mode("overwrite").json(path)


def resolve_path(explicit: str | None, env_var: str, default: str) -> str:
    """A9 path precedence: argument, then environment variable, then default."""
    return explicit or os.environ.get(env_var) or default


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)

