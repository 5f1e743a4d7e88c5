"""Column functions: plain compositions of built-in Spark expressions, no UDFs."""

from martwright.functions.geo import haversine, unit_vector
from martwright.functions.keys import hash_key, uuid5
from martwright.functions.scalars import (
    decimal_comma,
    local_time,
    minute,
    number_text,
    parse_timestamp,
    ratio,
    year_month,
    year_week,
)

__all__ = [
    "decimal_comma",
    "hash_key",
    "haversine",
    "local_time",
    "minute",
    "number_text",
    "parse_timestamp",
    "ratio",
    "unit_vector",
    "uuid5",
    "year_month",
    "year_week",
]
