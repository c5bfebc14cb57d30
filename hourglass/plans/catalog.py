"""Registry of named queries over the driver tables.

Each key maps to a function ``(spark, sf_dir) -> DataFrame`` and, when the
query is expressible in plain SQL, to the equivalent DuckDB SQL text kept
next to it. Computed doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to 6 digits (presentation for comparison)."""
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def load_all() -> None:
    # importing the modules registers their queries
    from hourglass.plans import (  # noqa: F401
        q_clean_time,
        q_forecast,
        q_series,
        q_stats,
        q_stream,
        q_windows,
    )
