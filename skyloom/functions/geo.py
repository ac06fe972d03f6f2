"""Points, distances and containment as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Mean earth radius in metres, fixed value.
EARTH_RADIUS_M = 6_371_008.8

_NUMBER = r"([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)"
WKT_POINT = rf"(?i)^\s*POINT\s*\(\s*{_NUMBER}\s+{_NUMBER}\s*\)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _point(lon: Column, lat: Column) -> Column:
    """A point struct, or null when either coordinate is missing or off the globe."""

    def valid(p: Column) -> Column:
        return (F.abs(p["lon"]) <= 180.0) & (F.abs(p["lat"]) <= 90.0)

    return _let(F.struct(lon.alias("lon"), lat.alias("lat")), lambda p: F.when(valid(p), p))


def make_point(lon: Column | str, lat: Column | str) -> Column:
    return _point(_col(lon).cast("double"), _col(lat).cast("double"))


def parse_wkt_point(text: Column | str) -> Column:
    """``POINT(lon lat)`` to a point; malformed text gives null."""
    text = _col(text)
    lon = F.regexp_extract(text, WKT_POINT, 1).try_cast("double")
    lat = F.regexp_extract(text, WKT_POINT, 2).try_cast("double")
    return _point(lon, lat)


def format_wkt_point(lon: Column | str, lat: Column | str) -> Column:
    """A point as ``POINT(lon lat)``; null when a coordinate is null."""
    return F.concat(
        F.lit("POINT("), _col(lon).cast("string"), F.lit(" "), _col(lat).cast("string"), F.lit(")")
    )


def _pair(parts: Column) -> Column:
    """First two elements as a point when there are exactly two."""
    return _let(
        parts,
        lambda p: F.when(
            F.size(p) == 2,
            _point(F.get(p, F.lit(0)).try_cast("double"), F.get(p, F.lit(1)).try_cast("double")),
        ),
    )


def parse_point_text(text: Column | str) -> Column:
    """``(x,y)`` or ``[x,y]`` to a point; other lengths and bad numbers give null."""
    return _pair(F.split(F.regexp_replace(_col(text), r"^[\s(\[]+|[\s)\]]+$", ""), r"\s*,\s*"))


def point_from_array(pair: Column | str) -> Column:
    """A two-element number array to a point; other lengths give null."""
    return _pair(_col(pair))


def longitude(point: Column | str) -> Column:
    return _col(point).getField("lon")


def latitude(point: Column | str) -> Column:
    return _col(point).getField("lat")


def location_key(degrees: Column | str) -> Column:
    """Micro-degrees as bigint: the equi-join key for coordinates that went through quantised storage."""
    return F.round(_col(degrees) * F.lit(1e6)).cast("bigint")


def geo_distance(
    lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str
) -> Column:
    """Great-circle (haversine) distance in metres."""
    lon1, lat1, lon2, lat2 = (_col(c) for c in (lon1, lat1, lon2, lat2))
    half_dlat = F.radians(lat2 - lat1) / 2.0
    half_dlon = F.radians(lon2 - lon1) / 2.0
    a = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def crosses_eastward(
    lon: Column, lat: Column, x1: Column, y1: Column, x2: Column, y2: Column
) -> Column:
    """True when the edge is hit by the ray from the point towards the east.

    An edge owns its lower end and not its upper end, so a ray through a shared vertex is counted once.
    """
    return ((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)


def within(lon: Column | str, lat: Column | str, rings: Column | str) -> Column:
    """Even-odd containment in ``rings`` (array of rings, each an array of lon/lat structs).

    For a handful of shapes carried on the row; tables of shapes go through ``within_join``.
    """
    lon, lat, rings = _col(lon), _col(lat), _col(rings)

    def ring_crossings(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        edges = F.arrays_zip(ring.alias("a"), following.alias("b"))
        return F.size(
            F.filter(
                edges,
                lambda e: crosses_eastward(
                    lon, lat,
                    e["a"]["lon"], e["a"]["lat"],
                    e["b"]["lon"], e["b"]["lat"],
                ),
            )
        )

    total = F.aggregate(rings, F.lit(0), lambda acc, ring: acc + ring_crossings(ring))
    return F.when(lon.isNotNull() & lat.isNotNull(), total % 2 == 1)


def shape_rings(shape: Column | str) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon text; null for anything else."""
    shape = _col(shape)
    kind = F.get_json_object(shape, "$.type")
    coords = F.get_json_object(shape, "$.coordinates")
    polygon = F.from_json(coords, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(coords, "array<array<array<array<double>>>>"))
    rings = F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi)
    return F.transform(
        rings,
        lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))),
    )
