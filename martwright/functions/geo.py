"""Great-circle geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km, part of the distance definition.
EARTH_RADIUS_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees.

    The half-chord is clamped to 1 so that rounding on antipodal points cannot
    push ``asin`` out of its domain.
    """
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    half_chord_sq = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    )
    return F.asin(F.least(F.lit(1.0), F.sqrt(half_chord_sq))) * (2 * EARTH_RADIUS_KM)


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Position on the unit sphere as three coordinates.

    The straight-line distance of two such points grows with their great-circle
    distance, so it ranks candidates as the haversine does, at the cost of
    three products per candidate.
    """
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)
