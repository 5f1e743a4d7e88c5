"""Distance operators: nearest place and pairs within a radius."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.geo import EARTH_RADIUS_KM, haversine, unit_vector
from martwright.operators.skew import HOT_ROWS, hot_key_join
from martwright.operators.workspace import cut_lineage

KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180

# Places up to this number become literals of the plan; more go through the grid.
MAX_LITERAL_PLACES = 256

_AXES = ("_x", "_y", "_z")
_PLACE_AXES = ("_place_x", "_place_y", "_place_z")

# Search radii of the grid in km; the last one spans half the globe, so no point is left over.
SEARCH_RADII_KM = (25.0, 200.0, 1600.0, 20100.0)


def _band(lat: Column, radius_km: float) -> Column:
    """Latitude band of a height of at least ``radius_km``."""
    height = radius_km / KM_PER_DEGREE * (1 + 1e-9)
    return F.floor((lat + 90) / F.lit(height)).cast("int")


def _cells_around(band: Column, radius_km: float) -> Column:
    """Number of longitude cells in a band, each wide enough for ``radius_km``.

    The width follows from the haversine with the latitude nearest a pole that
    a point of this or a neighbouring band can have; next to a pole a single
    cell remains.
    """
    height = radius_km / KM_PER_DEGREE * (1 + 1e-9)
    south = (band - 1) * height - 90
    north = (band + 2) * height - 90
    extreme = F.least(F.lit(90.0), F.greatest(F.abs(south), F.abs(north)))
    cos_min = F.cos(F.radians(extreme))
    half = math.sin(min(radius_km / (2 * EARTH_RADIUS_KM), math.pi / 2)) * (1 + 1e-9)
    width = F.when(cos_min > half, F.degrees(2 * F.asin(F.lit(half) / cos_min))).otherwise(360.0)
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width).cast("int"))


def _lon_cell(lon: Column, cells: Column) -> Column:
    turned = F.pmod(lon + 180, F.lit(360.0))
    return F.least(cells - 1, F.floor(turned / (F.lit(360.0) / cells)).cast("int"))


def with_cell(df: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    """Add the grid cell (``_band``, ``_cell``) a point lies in."""
    return df.withColumn("_band", _band(F.col(lat), radius_km)).withColumn(
        "_cell", _lon_cell(F.col(lon), _cells_around(F.col("_band"), radius_km))
    )


def with_neighbour_cells(df: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    """One row per cell that can hold a point within ``radius_km`` (at most nine)."""
    own = _band(F.col(lat), radius_km)
    banded = df.withColumn("_band", F.explode(F.array(own - 1, own, own + 1)))
    cells = _cells_around(F.col("_band"), radius_km)
    here = _lon_cell(F.col(lon), cells)
    around = F.array_distinct(
        F.array(F.pmod(here - 1, cells), here, F.pmod(here + 1, cells))
    )
    return banded.withColumn("_cell", F.explode(around))


def _chord_limits(radius_km: float) -> tuple[float, float]:
    """Squared chords below the first are within ``radius_km`` for certain, those above the second are not.

    Chords of unit vectors are right to about 4e-15, so a pair between the two takes the haversine.
    """
    chord = 2 * math.sin(min(radius_km / (2 * EARTH_RADIUS_KM), math.pi / 2))
    return (chord - 1e-12) ** 2 if chord > 1e-12 else -1.0, max(chord + 1e-12, 0.0) ** 2


def pairs_within(
    members: DataFrame,
    group: str,
    member: str,
    lat: str,
    lon: str,
    radius_km: float,
    hot_rows: int = HOT_ROWS,
    carry_left: Sequence[str] = (),
    carry_right: Sequence[str] = (),
) -> DataFrame:
    """Pairs ``left < right`` of one group that are at most ``radius_km`` apart.

    The join key is (group, grid cell): members of a group that are too far
    apart never meet, so the work follows the size of the answer and not the
    square of the group. Pairs of crowded cells are cut both ways and spread over tasks. Members carry
    their unit vectors: the pairs that meet are told apart by three products, and the haversine is
    computed only for those within 0.01 mm of the radius.
    ``carry_left`` and ``carry_right`` are columns that the pairs take from either member, so that
    they need not be joined, and shuffled, again.
    """
    located = members.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumns(
        dict(zip(_AXES, unit_vector(F.col(lat), F.col(lon))))
    )
    here = with_cell(located, lat, lon, radius_km).select(
        F.col(group),
        F.col(member).alias("left"),
        F.col(lat).alias("_lat1"),
        F.col(lon).alias("_lon1"),
        *_AXES,
        "_band",
        "_cell",
        *carry_left,
    )
    around = with_neighbour_cells(located, lat, lon, radius_km).select(
        F.col(group),
        F.col(member).alias("right"),
        F.col(lat).alias("_lat2"),
        F.col(lon).alias("_lon2"),
        *[F.col(axis).alias(f"{axis}2") for axis in _AXES],
        "_band",
        "_cell",
        *carry_right,
    )
    distance = haversine(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))
    chord = F.expr(_chord_sql([f"{axis}2" for axis in _AXES]))
    inside, outside = _chord_limits(radius_km)
    near = (
        F.when(chord <= inside, True)
        .when((chord > outside) & (chord <= 8.0), False)
        .otherwise(distance <= radius_km)
    )
    return (
        hot_key_join(here, around, [group, "_band", "_cell"], hot_rows)
        .where((F.col("left") < F.col("right")) & near)
        .withColumn("distance_km", distance)
        .select(group, "left", "right", "distance_km", *carry_left, *carry_right)
    )


def nearest(
    points: DataFrame,
    places: DataFrame,
    place_cols: Sequence[str],
    lat: str = "lat",
    lon: str = "lon",
    max_literals: int = MAX_LITERAL_PLACES,
) -> DataFrame:
    """Add the nearest place to every point that has coordinates.

    ``places`` has ``city_lat``, ``city_lng`` and ``place_cols``, which break ties in their order,
    NULL last. Points and places whose coordinates are NULL, NaN or infinite take no part. Up to
    ``max_literals`` places the comparison is an expression over literals: no join and no shuffle.
    Beyond it the places are searched through grid joins of growing radius. Both compare the same
    squared chords, computed by the same expressions, so that they agree to the last tie.
    """
    located = points.where(_finite(lat) & _finite(lon))
    chosen = (
        places.where(_finite("city_lat") & _finite("city_lng"))
        .select("city_lat", "city_lng", *place_cols)
        .withColumns(dict(zip(_PLACE_AXES, unit_vector(F.col("city_lat"), F.col("city_lng")))))
    )
    known = chosen.limit(max_literals + 1).collect()
    if known and len(known) <= max_literals:
        return _nearest_literal(located, known, chosen, list(place_cols), lat, lon)
    return _nearest_grid(located, chosen, list(place_cols), lat, lon)


def _finite(column: str) -> Column:
    """Whether a coordinate is a number: neither NULL nor NaN nor infinite."""
    return F.abs(F.col(column).cast("double")) < F.lit(math.inf)


def _literal(value, kind: str) -> str:
    """SQL literal of a value of a simple type."""
    if value is None:
        return f"CAST(NULL AS {kind})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def _nearest_literal(located, known, chosen, place_cols, lat, lon) -> DataFrame:
    """Position of the smallest squared chord among all places, then its labels.

    The chords are an array of plain doubles, which generated code fills
    without allocating objects per candidate. They are given as SQL text:
    building a few hundred nodes one call at a time would take longer than a
    small query. Places are ordered by their labels, which break ties.
    """
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    ordered = sorted(known, key=lambda place: [_last_if_none(place[c]) for c in place_cols])
    chords = [_chord_sql([f"({place[axis]!r}D)" for axis in _PLACE_AXES]) for place in ordered]
    labels = {
        c: F.expr(f"ELEMENT_AT(ARRAY({', '.join(_literal(p[c], kinds[c]) for p in ordered)}), _at)")
        for c in place_cols
    }
    return (
        located.withColumns(dict(zip(_AXES, unit_vector(F.col(lat), F.col(lon)))))
        .withColumn("_chords", F.expr(f"ARRAY({', '.join(chords)})"))
        .withColumn("_at", F.expr("CAST(ARRAY_POSITION(_chords, ARRAY_MIN(_chords)) AS INT)"))
        .select(*located.columns, *[label.alias(c) for c, label in labels.items()])
    )


def _chord_sql(place: Sequence[str]) -> str:
    """Squared chord from a point's axes to those of a place, given as SQL."""
    return " + ".join(f"({axis} - {v}) * ({axis} - {v})" for axis, v in zip(_AXES, place))


def _last_if_none(label) -> tuple:
    if isinstance(label, str):
        label = label.encode()  # strings compare by their bytes, as in Spark
    return (label is None, label if label is not None else 0)


def _nearest_grid(located, places, place_cols, lat, lon) -> DataFrame:
    """Search each distinct coordinate in cells of growing size until a place is in reach."""
    spots = located.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    spots = spots.withColumns(dict(zip(_AXES, unit_vector(F.col("_lat"), F.col("_lon")))))
    labels = [part for c in place_cols for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    rank = F.struct(F.expr(_chord_sql(_PLACE_AXES)).alias("_chord"), *labels)
    km = F.asin(F.least(F.lit(1.0), F.sqrt("_best._chord") / 2)) * (2 * EARTH_RADIUS_KM)
    found = None
    pending = spots
    for radius in SEARCH_RADII_KM:
        cells = with_cell(places, "city_lat", "city_lng", radius)
        best = (
            with_neighbour_cells(pending, "_lat", "_lon", radius)
            .join(cells, ["_band", "_cell"], "left")
            .groupBy("_lat", "_lon", *_AXES)
            .agg(F.min(F.when(F.col("city_lat").isNotNull(), rank)).alias("_best"))
        )
        # A hit outside the radius may have a closer rival in a cell not looked at.
        tried = cut_lineage(best.withColumn("_done", km <= radius))
        hits = tried.where(F.col("_done")).drop("_done")
        found = hits if found is None else found.unionByName(hits)
        pending = tried.where(~F.coalesce("_done", F.lit(False))).select("_lat", "_lon", *_AXES)
    matched = found.select("_lat", "_lon", *[F.col(f"_best.{c}").alias(c) for c in place_cols])
    joined = located.join(
        matched, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "inner"
    )
    return joined.select(*located.columns, *place_cols)
