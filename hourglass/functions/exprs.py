"""Scalar column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-sided 95% normal quantile used by confidence bands (norm.ppf(0.975)).
Z_975 = 1.959963984540054


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL; Spark treats NaN as a present value that wins comparisons."""
    c = col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c) -> Column:
    """Numeric coercion: text that is not a number becomes NULL, NaN becomes
    NULL. Literal suffixes that the cast would accept ("1d", "10F") are not
    numbers; the type test folds away for numeric columns."""
    c = col(c)
    suffixed = (F.typeof(c) == "string") & F.coalesce(c.cast("string").rlike("[0-9.][dDfF]\\s*$"), F.lit(False))
    return nan_to_null(F.when(~suffixed, c.try_cast("double")))


def null_if_sentinel(c, sentinel: float) -> Column:
    """Exact equality with the sentinel becomes NULL; text columns compare
    their numeric reading (bad text is left for coercion)."""
    c = col(c)
    return F.when(c.try_cast("double") == F.lit(float(sentinel)), F.lit(None)).otherwise(c)


def clip(c, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi]; a missing value stays missing (least/greatest skip NULLs)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def season(month) -> Column:
    """Meteorological season 1..4 with Dec-Feb = 1: (month % 12) div 3 + 1."""
    m = col(month)
    return ((m % 12).cast("int") / 3).cast("int") + 1


def cyclic(x, period: float, shift: float = 0.0) -> tuple[Column, Column]:
    a = 2 * math.pi * (col(x) - F.lit(shift)) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def day_of_week(ts) -> Column:
    """Monday = 0 .. Sunday = 6 (``weekday``; ``dayofweek`` is Sunday = 1)."""
    return F.weekday(col(ts))


def significance_stars(p) -> Column:
    p = col(p)
    return (
        F.when(p.isNull(), F.lit(""))
        .when(p < 0.001, F.lit("***"))
        .when(p < 0.01, F.lit("**"))
        .when(p < 0.05, F.lit("*"))
        .otherwise(F.lit(""))
    )


def sci12(p) -> Column:
    """Text form ``%.12e``; NULL stays NULL (written as a blank cell)."""
    p = col(p)
    return F.when(p.isNull(), F.lit(None).cast("string")).otherwise(F.format_string("%.12e", p))


# Day-first layouts accepted for a combined "date time" text, tried in order.
DAY_FIRST_FORMATS = (
    "d/M/yyyy H:mm:ss",
    "d/M/yyyy H.mm.ss",
    "d/M/yyyy H:mm",
    "d/M/yyyy",
)


def parse_day_first(date_text, time_text=None, formats=DAY_FIRST_FORMATS) -> Column:
    """Combine trimmed date and time text with one blank and parse day-first.

    Unparseable or impossible dates (31/02) give NULL instead of an error.
    The result is TIMESTAMP_NTZ (wall-clock time): the text is read at offset
    zero, so no session zone or DST rule moves it.
    """
    text = F.trim(col(date_text))
    if time_text is not None:
        text = F.concat_ws(" ", text, F.trim(col(time_text)))
    return F.coalesce(
        *[ntz_from_wall_seconds(F.unix_seconds(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{f} xxx"))))
          for f in formats]
    )


def wall_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00 of the wall-clock value (TIMESTAMP_NTZ
    fields), computed from date and time-of-day fields, so no session time
    zone or DST rule is involved."""
    t = col(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.floor(F.second(t)).cast("long"))


def wall_micros(ts) -> Column:
    """``wall_seconds`` in microseconds, keeping the sub-second part."""
    t = col(ts)
    frac = F.unix_micros(t.cast("timestamp")) % 1_000_000
    return wall_seconds(t) * 1_000_000 + frac


def ntz_from_wall_seconds(x) -> Column:
    """Inverse of ``wall_seconds`` (whole seconds) as TIMESTAMP_NTZ."""
    x = col(x).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(x / 86400).cast("int"))
    rem = x - F.floor(x / 86400) * 86400
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), (rem / 3600).cast("int"),
                                ((rem % 3600) / 60).cast("int"), rem % 60)
