"""Lenient typing of raw text columns: what can't be read becomes null, nothing raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that stand for a missing value.
MISSING = ("", "None", "none", "NaN", "nan")
MISSING_NUMBERS = ("", "-", "--", "None", "nan")
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "yyyy/M/d", "yyyy-M-d")
TRUE, FALSE = ("true", "t", "1", "yes"), ("false", "f", "0", "no")


def no_missing(c: Column, missing: tuple[str, ...] = MISSING) -> Column:
    return F.when(~F.trim(c).isin(*missing), c)


def to_number(c: Column) -> Column:
    """A number from text, null for dashes and the like; never NaN."""
    value = F.trim(no_missing(c.cast("string"), MISSING_NUMBERS)).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_date(c: Column) -> Column:
    text = F.trim(no_missing(c.cast("string")))
    return F.coalesce(*[F.try_to_date(F.substring(text, 1, 10) if f == "yyyy-MM-dd" else text, f) for f in DATE_FORMATS])


def to_boolean(c: Column) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin(*TRUE), F.lit(True)).when(text.isin(*FALSE), F.lit(False))


def to_long(c: Column) -> Column:
    """Whole numbers; text with a fraction is no whole number unless the fraction is zero."""
    value = to_number(c)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def to_timestamp(c: Column) -> Column:
    """Local time, cut to milliseconds."""
    stamp = F.trim(no_missing(c.cast("string"))).try_cast("timestamp_ntz")
    return F.date_trunc("millisecond", stamp).cast("timestamp_ntz")


def coerced(c: Column, kind: T.DataType, source: T.DataType | None = None) -> Column:
    """``c`` as ``kind``. Columns that have the type already only lose NaN."""
    if isinstance(kind, T.StringType):
        return c.cast("string")
    if source is not None and source == kind:
        return F.when(~F.isnan(c), c) if isinstance(kind, T.DoubleType) else c
    if isinstance(kind, T.DateType):
        return c.cast("date") if isinstance(source, (T.TimestampType, T.TimestampNTZType)) else to_date(c)
    if isinstance(kind, T.DoubleType):
        return to_number(c)
    if isinstance(kind, T.LongType):
        return to_long(c)
    if isinstance(kind, T.BooleanType):
        return to_boolean(c)
    if isinstance(kind, T.TimestampNTZType):
        return to_timestamp(c)
    return c.try_cast(kind)
