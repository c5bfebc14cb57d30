"""Cleaning operators: rename, drop, sentinel, coercion, clip, impute, scale.

Global statistics (imputation means, scaling bounds) are attached as scalar
subqueries: Spark merges them into one partial/final aggregate over the
input and inlines the one-row result, so the big side is never joined or
shuffled. Per-series statistics are a grouped aggregate joined back on the
series key; AQE broadcasts that side only when its measured size is under
the broadcast threshold and otherwise keeps a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import exprs as X

# Fixed values that must equal the reference for equal results.
# Sentinel for a missing reading.
SENSOR_SENTINEL = -200.0
# Rename map from raw sensor headers to clean names (absent names ignored).
SENSOR_RENAME = {
    "CO(GT)": "CO",
    "NOx(GT)": "NOx",
    "NO2(GT)": "NO2",
    "C6H6(GT)": "Benzene",
    "NMHC(GT)": "NMHC",
}
# Physical plausibility ranges (low, high) per pollutant.
SENSOR_RANGES = {
    "CO": (0.5, 5.0),
    "NOx": (5.0, 100.0),
    "NO2": (0.0, 200.0),
    "Benzene": (0.5, 10.0),
}

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns by declared type (schema only, no data access)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def existing(df: DataFrame, wanted: Sequence[str], required: bool = True) -> list[str]:
    """Wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    out = [c for c in wanted if c in have]
    if required and not out:
        raise ValueError(f"none of {list(wanted)} present in {df.columns}")
    return out


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = SENSOR_RENAME) -> DataFrame:
    """B1: rename by map; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """B2."""
    return df.drop(*[c for c in cols if c in df.columns])


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel: float = SENSOR_SENTINEL) -> DataFrame:
    """Exact equality with the sentinel becomes NULL."""
    return df.withColumns({c: X.null_if_sentinel(c, sentinel) for c in cols})


def numeric_coerce(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text or numbers to DOUBLE; bad text and NaN become NULL (never an error)."""
    return df.withColumns({c: X.to_double(F.col(c).cast("string") if _is_string(df, c) else F.col(c)) for c in cols})


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def range_clip(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]] = SENSOR_RANGES) -> DataFrame:
    """Clip each present column to its range; missing stays missing."""
    present = {c: b for c, b in bounds.items() if c in df.columns}
    return df.withColumns({c: X.clip(c, lo, hi) for c, (lo, hi) in present.items()})


def _global_scalar(df: DataFrame, agg: Column) -> Column:
    return df.select(agg.alias("v")).scalar()


def attach_stats(df: DataFrame, stats: DataFrame, series: Sequence[str]) -> DataFrame:
    """Join a per-series statistics table (one row per key) back onto rows."""
    return df.join(stats, list(series), "left")


def mean_impute(df: DataFrame, cols: Sequence[str], series: Sequence[str] = ()) -> DataFrame:
    """Fill NULL with the column mean (per series if given); an all-missing column stays missing."""
    if not series:
        return df.withColumns({c: F.coalesce(F.col(c), _global_scalar(df, F.avg(c))) for c in cols})
    stats = df.groupBy(*series).agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    out = attach_stats(df, stats, series)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__mean_{c}")) for c in cols}).drop(
        *[f"__mean_{c}" for c in cols]
    )


def _scaled(c: str, lo: Column, hi: Column) -> Column:
    rng = hi - lo
    return (F.col(c) - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)


def minmax_scale(df: DataFrame, cols: Sequence[str], series: Sequence[str] = ()) -> DataFrame:
    """(x - min) / (max - min), a zero range divides by 1."""
    if not series:
        return df.withColumns(
            {c: _scaled(c, _global_scalar(df, F.min(c)), _global_scalar(df, F.max(c))) for c in cols}
        )
    stats = df.groupBy(*series).agg(
        *[F.min(c).alias(f"__lo_{c}") for c in cols], *[F.max(c).alias(f"__hi_{c}") for c in cols]
    )
    out = attach_stats(df, stats, series)
    return out.withColumns({c: _scaled(c, F.col(f"__lo_{c}"), F.col(f"__hi_{c}")) for c in cols}).drop(
        *[f"__lo_{c}" for c in cols], *[f"__hi_{c}" for c in cols]
    )


def clean_table(
    df: DataFrame,
    cols: Sequence[str],
    *,
    sentinel: float | None = SENSOR_SENTINEL,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
    impute: bool = True,
    scale: bool = True,
    scale_first: bool = False,
    series: Sequence[str] = (),
) -> DataFrame:
    """Sentinel -> coerce -> impute -> (clip, scale) in either order.

    ``scale_first=True`` keeps the literal order of the reference's first
    phase (scale to [0,1], then clip to physical ranges).

    One statistics pass serves every step: mean, min, max and the missing
    count per column. Imputing adds only the mean to a column, and clipping
    is monotone, so the bounds after imputation (and clipping) follow from
    those four numbers; the data is read once for the statistics and once
    for the output.
    """
    series = list(series)
    own = "__"  # prefix of the columns added on the way, of none of the caller's
    while any(n.startswith(own) for n in df.columns):
        own += "_"
    base = df
    if sentinel is not None:
        base = sentinel_to_null(base, cols, sentinel)
    base = numeric_coerce(base, cols)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{own}mean_{c}"), F.min(c).alias(f"{own}lo_{c}"), F.max(c).alias(f"{own}hi_{c}"),
                 (F.count(F.lit(1)) - F.count(c)).alias(f"{own}nn_{c}")]
    if series:
        t = attach_stats(base, base.groupBy(*series).agg(*aggs), series)
    else:
        # one scalar subquery returning every statistic as a struct
        one = base.agg(F.struct(*aggs).alias("s")).scalar()
        t = base.withColumns({f"{own}{k}_{c}": one[f"{own}{k}_{c}"] for c in cols for k in ("mean", "lo", "hi", "nn")})
    # each step is its own projection over named columns, so no step inlines
    # (and multiplies) the expressions of the one before
    if impute:
        t = t.withColumns({
            **{c: F.coalesce(F.col(c), F.col(f"{own}mean_{c}")) for c in cols},
            **{f"{own}lo_{c}": F.when(F.col(f"{own}nn_{c}") > 0, F.least(f"{own}lo_{c}", f"{own}mean_{c}"))
               .otherwise(F.col(f"{own}lo_{c}")) for c in cols},
            **{f"{own}hi_{c}": F.when(F.col(f"{own}nn_{c}") > 0, F.greatest(f"{own}hi_{c}", f"{own}mean_{c}"))
               .otherwise(F.col(f"{own}hi_{c}")) for c in cols},
        })
    bounds = {c: b for c, b in (bounds or {}).items() if c in cols}

    def clip_step(d, with_bounds):
        upd = {c: X.clip(c, *b) for c, b in bounds.items()}
        if with_bounds:
            upd.update({f"{own}{k}_{c}": X.clip(f"{own}{k}_{c}", *b) for c, b in bounds.items() for k in ("lo", "hi")})
        return d.withColumns(upd) if upd else d

    def scale_step(d):
        return d.withColumns({c: _scaled_expr(F.col(c), F.col(f"{own}lo_{c}"), F.col(f"{own}hi_{c}")) for c in cols})

    if scale and scale_first:
        t = clip_step(scale_step(t), with_bounds=False)
    else:
        t = clip_step(t, with_bounds=True)
        if scale:
            t = scale_step(t)
    return t.drop(*[n for n in t.columns if n.startswith(own)])


def _scaled_expr(v: Column, lo: Column, hi: Column) -> Column:
    rng = hi - lo
    return (v - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)


def fill_default(c: str, default: float = 0.0) -> Column:
    """A missing or non-numeric field scores as ``default``."""
    return F.coalesce(X.to_double(F.col(c)), F.lit(float(default)))


def field_with_alias(primary: str, fallback: str) -> Column:
    """Read ``primary`` else ``fallback``; coercion failure gives NULL."""
    return F.coalesce(X.to_double(F.col(primary)), X.to_double(F.col(fallback)))


def usable_features(df: DataFrame, candidates: Sequence[str], target: str) -> list[str]:
    """Drop the target (any case) and columns with no value at all.

    One aggregate pass returns a single row of non-null counts.
    """
    cands = [c for c in candidates if c != target and c.lower() != "target"]
    if not cands:
        return []
    row = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(cands)]).first()
    return [c for i, c in enumerate(cands) if row[f"c{i}"] > 0]
