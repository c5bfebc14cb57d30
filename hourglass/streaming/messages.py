"""Keyed JSON messages: decode (with a dead-letter ``raw`` column), encode
and per-message checks. The same functions serve batch and streaming
DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X

SENSORS = [
    "CO", "PT08_S1_CO", "NMHC", "Benzene", "PT08_S2_NMHC", "NOx", "PT08_S3_NOx", "NO2", "PT08_S4_NO2",
    "PT08_S5_O3", "T", "RH", "AH",
]

# Superset of every message variant: 13 sensors, Target, timestamp text and
# the model payload's calendar fields; absent fields decode to NULL.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField(s, T.DoubleType()) for s in [*SENSORS, "CO(GT)"]]  # the raw name is the alert's fallback
    + [T.StructField("Target", T.DoubleType()), T.StructField("timestamp", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in ("hour", "day", "month", "season")]
)

# Fixed values that must equal the reference for equal results.
ALERT_FIELD, ALERT_FALLBACK, ALERT_THRESHOLD = "CO", "CO(GT)", 10.0
DRIFT_THRESHOLD = 3.0

JSON_OPTIONS = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true"}
CORRUPT = "_corrupt_record"


def decode(df: DataFrame, text_col: str, schema: T.StructType = MESSAGE_SCHEMA, prefix: str = "") -> DataFrame:
    """L1 + L2: parse JSON text into typed columns (bare NaN accepted, then
    NULL); text that does not parse, empty text included, keeps its value in
    ``raw`` (dead letter) and gets NULL fields."""
    txt = F.col(text_col).cast("string")
    # numbers are read as text first, so that "12.5" in quotes counts as 12.5
    loose = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.DoubleType) else f for f in schema.fields]
    full = T.StructType([*loose, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(txt, full, {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT})
    fields = {}
    for f in schema.fields:
        v = parsed[f.name]
        fields[f"{prefix}{f.name}"] = X.to_double(v) if isinstance(f.dataType, T.DoubleType) else v
    raw = F.when(F.trim(txt) == "", txt).otherwise(F.coalesce(parsed[CORRUPT], F.when(parsed.isNull(), txt)))
    return df.withColumns(fields).withColumn("raw", raw)


def encode(cols: Sequence[str]) -> Column:
    """A4 payload: JSON text of the named columns (NULL fields are omitted;
    NaN must already be NULL, which the reader side enforces)."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def payload(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """A4: (key, value) rows ready for a Kafka sink."""
    return df.select(F.col(key).cast("string").alias("key"), encode(cols).alias("value"))


def alert_value(primary: str = ALERT_FIELD, fallback: str = ALERT_FALLBACK) -> Column:
    """The primary field when present, else the fallback; bad text -> NULL."""
    return F.coalesce(X.to_double(F.col(primary)), X.to_double(F.col(fallback)))


def drift_columns(df: DataFrame, stats: dict[str, tuple[float, float]], threshold: float = DRIFT_THRESHOLD,
                  out_z: str = "max_abs_z", out_flag: str = "drift") -> DataFrame:
    """L7 + I4: max over known features of |v - mean| / std; features with
    std <= 0 or a missing/non-numeric value are skipped; drift when the max
    is strictly above ``threshold``. ``stats`` holds one (mean, std) per
    feature - bounded by the schema width, inlined as literals."""
    zs = []
    for name, (mean, std) in stats.items():
        if name not in df.columns or std is None or not std > 0:
            continue
        v = X.to_double(F.col(name))
        zs.append(F.abs(v - F.lit(float(mean))) / F.lit(float(std)))
    mx = F.greatest(*zs) if len(zs) > 1 else (zs[0] if zs else F.lit(None).cast("double"))
    return df.withColumns({out_z: mx, out_flag: F.coalesce(mx > threshold, F.lit(False))})


def stats_dict(feature_stats: DataFrame) -> dict[str, tuple[float, float]]:
    """Read a training-statistics table (feature, mean, std, ...) once; it has
    one row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in feature_stats.select("feature", "mean", "std").collect()}
