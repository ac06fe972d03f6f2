"""The geo and weather expressions under their SQL names, for ad-hoc queries and panels."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skyloom.functions.geo import EARTH_RADIUS_M, WKT_POINT
from skyloom.functions.scalar import ZERO_CELSIUS_K

_POINT = "STRUCT<lon: DOUBLE, lat: DOUBLE>"

_DISTANCE = f"""{2 * EARTH_RADIUS_M}D * asin(least(1D, sqrt(
    pow(sin(radians(q.lat - p.lat) / 2D), 2)
    + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2D), 2))))"""

_RINGS = """CASE get_json_object(shape, '$.type')
    WHEN 'Polygon' THEN from_json(get_json_object(shape, '$.coordinates'), 'array<array<array<double>>>')
    WHEN 'MultiPolygon' THEN flatten(
      from_json(get_json_object(shape, '$.coordinates'), 'array<array<array<array<double>>>>')) END"""

_WITHIN = f"""aggregate({_RINGS}, 0, (n, ring) -> n + size(filter(
    transform(ring, (a, i) -> named_struct('a', a, 'b', ring[(i + 1) % size(ring)])),
    e -> (e.a[1] > p.lat) <> (e.b[1] > p.lat)
      AND p.lon < (e.b[0] - e.a[0]) * (p.lat - e.a[1]) / (e.b[1] - e.a[1]) + e.a[0]))) % 2 = 1"""

_WKT = f"r'{WKT_POINT}'"


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions ``geo_point, longitude, latitude, distance, within, kelvin_to_celsius,
    wind_speed, wind_direction``.

    Spark inlines their bodies, so they cost what the written-out expression costs. ``within`` in a join
    condition compares every pair; over large tables use ``operators.spatial.within_join``.
    """
    functions = {
        f"geo_point(wkt STRING) RETURNS {_POINT}": (
            "get(filter(array(named_struct("
            f"'lon', try_cast(regexp_extract(wkt, {_WKT}, 1) AS DOUBLE), "
            f"'lat', try_cast(regexp_extract(wkt, {_WKT}, 2) AS DOUBLE))), "
            "p -> abs(p.lon) <= 180D AND abs(p.lat) <= 90D), 0)"
        ),
        f"longitude(p {_POINT}) RETURNS DOUBLE": "p.lon",
        f"latitude(p {_POINT}) RETURNS DOUBLE": "p.lat",
        f"distance(p {_POINT}, q {_POINT}) RETURNS DOUBLE": _DISTANCE,
        f"within(p {_POINT}, shape STRING) RETURNS BOOLEAN": _WITHIN,
        "kelvin_to_celsius(k DOUBLE) RETURNS DOUBLE": f"k - {ZERO_CELSIUS_K}D",
        "wind_speed(u DOUBLE, v DOUBLE) RETURNS DOUBLE": "sqrt(u * u + v * v)",
        "wind_direction(u DOUBLE, v DOUBLE) RETURNS DOUBLE":
            "CASE WHEN u <> 0 OR v <> 0 THEN pmod(degrees(atan2(-u, -v)), 360D) END",
    }
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
