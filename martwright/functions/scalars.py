"""Small scalar helpers shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """Number written with a decimal comma, as double; NULL when unreadable."""
    return F.regexp_replace(text, ",", ".").try_cast("double")


def year_week(day: Column) -> Column:
    """``YYYYWW`` as int, week 1 starting on 1 January (not the ISO week)."""
    week = F.ceil(F.dayofyear(day) / F.lit(7)).cast("int")
    return F.year(day) * 100 + week


def year_month(day: Column) -> Column:
    """``yyyy-MM`` text of a date."""
    return F.substring(day.cast("string"), 1, 7)


def minute(ts: Column) -> Column:
    """Text of a timestamp without zone cut to the minute; sorts as the time does."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 16)


def number_text(text: Column) -> Column:
    """JSON number text without an exponent: ``1.25E7`` becomes ``12500000.0``."""
    plain = F.regexp_replace(text.try_cast("decimal(38,12)").cast("string"), "0+$", "")
    whole = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return F.when(text.contains("E"), whole).otherwise(text)


def local_time(utc: Column, zone: Column) -> Column:
    """Wall-clock time in ``zone`` for a UTC timestamp without time zone."""
    return F.convert_timezone(F.lit("UTC"), zone, utc.cast("timestamp_ntz"))


def parse_timestamp(text: Column) -> Column:
    """Timestamp with or without a fraction of a second; NULL when unreadable."""
    return text.try_cast("timestamp_ntz")


def ratio(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` rounded half up; NULL for a zero count."""
    exact = F.try_divide(total.cast("decimal(28,6)"), count.cast("decimal(20,0)"))
    return exact.cast(f"decimal(18,{scale})")
