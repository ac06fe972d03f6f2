"""Containment joins, location joins and proximity queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions.geo import (
    EARTH_RADIUS_M,
    crosses_eastward,
    geo_distance,
    location_key,
    shape_rings,
)
from skyloom.operators.joins import SALTS, materialize, salted_join

CELL_DEG = 1.0
BAND_DEG = 0.25


def polygon_edges(regions: DataFrame, name: str, shape: str) -> DataFrame:
    """Boundary edges ``(name, ring, edge, x1, y1, x2, y2)`` of GeoJSON polygons and multipolygons.

    Rings are closed whether or not the text repeats the first vertex.
    """
    rings = regions.select(name, F.posexplode(shape_rings(shape)).alias("ring", "points"))
    n = F.size("points")
    pairs = F.transform(
        "points",
        lambda p, i: F.struct(
            p["lon"].alias("x1"),
            p["lat"].alias("y1"),
            F.get("points", (i + 1) % n)["lon"].alias("x2"),
            F.get("points", (i + 1) % n)["lat"].alias("y2"),
        ),
    )
    edges = rings.select(name, "ring", F.posexplode(pairs).alias("edge", "e"))
    flat = edges.select(name, "ring", "edge", "e.x1", "e.y1", "e.x2", "e.y2")
    return flat.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def rejected_shapes(regions: DataFrame, shape: str) -> DataFrame:
    """Rows whose shape gives no boundary: missing, malformed, or neither a Polygon nor a MultiPolygon."""
    rings = F.filter(shape_rings(shape), lambda ring: F.size(ring) >= 3)
    return regions.where(F.coalesce(F.size(rings), F.lit(0)) <= 0)


def update_located(
    located: DataFrame, points: DataFrame, edges: DataFrame, name: str = "region_name", **kw
) -> DataFrame:
    """Rows to append to a stored ``located``: the regions of locations it has no row for.

    A location outside every region has no row either and is tested again.
    """
    new = distinct_locations(points).join(located.select("lon", "lat").distinct(), ["lon", "lat"], "left_anti")
    return locate_regions(new, edges, name, **kw)


def distinct_locations(readings: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Each location once; rows without a location are left out."""
    known = readings.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return known.select(F.col(lon).alias("lon"), F.col(lat).alias("lat")).distinct()


def _region_boxes(edges: DataFrame, name: str, *more: Column) -> DataFrame:
    return edges.groupBy(name).agg(
        F.min(F.least("x1", "x2")).alias("xmin"),
        F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"),
        F.max(F.greatest("y1", "y2")).alias("ymax"),
        *more,
    )


def _steps(low: Column, high: Column, size: float) -> tuple[Column, Column]:
    """First and last grid step of an interval."""
    return F.floor(low / size), F.floor(high / size)


def _region_cells(edges: DataFrame, name: str, cell_deg: float) -> DataFrame:
    """Each region's box once per grid cell it touches."""

    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(*_steps(F.col(low), F.col(high), cell_deg)))

    boxes = _region_boxes(edges, name)
    return boxes.withColumn("cx", span("xmin", "xmax")).withColumn("cy", span("ymin", "ymax"))


def _edge_bands(edges: DataFrame, name: str, band_deg: float) -> DataFrame:
    """Each sloped edge once per latitude band it touches."""
    sloped = edges.where(F.col("y1") != F.col("y2")).select(name, "x1", "y1", "x2", "y2")
    bands = F.sequence(*_steps(F.least("y1", "y2"), F.greatest("y1", "y2"), band_deg))
    return sloped.withColumn("band", F.explode(bands))


def locate_regions(
    locations: DataFrame,
    edges: DataFrame,
    name: str = "region_name",
    strategy: str = "auto",
    cell_deg: float = CELL_DEG,
    band_deg: float = BAND_DEG,
    salts: int = SALTS,
) -> DataFrame:
    """Which regions contain which location: ``(lon, lat, name)``, one row per pair.

    Two equi-joins: location to the grid cells of each region's box, then candidate to the edges whose
    latitude band it lies in. A pair is kept when the ray to the east meets an odd number of edges.
    ``auto`` leaves the kind of join to Spark, ``grid`` salts the keys, for cells with very many locations.
    """
    if strategy not in ("auto", "grid"):
        raise ValueError(f"unknown strategy {strategy!r}")
    cells = _region_cells(edges, name, cell_deg)
    bands = _edge_bands(edges, name, band_deg)

    def join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.join(right, on) if strategy == "auto" else salted_join(left, right, on, salts=salts)

    lon, lat = F.col("lon"), F.col("lat")
    on_globe = distinct_locations(locations).where(lon.between(-180, 180) & lat.between(-90, 90))
    celled = on_globe.withColumn("cx", F.floor(lon / cell_deg)).withColumn("cy", F.floor(lat / cell_deg))
    in_box = lon.between(F.col("xmin"), F.col("xmax")) & lat.between(F.col("ymin"), F.col("ymax"))
    candidates = (
        join(celled, cells, ["cx", "cy"])
        .where(in_box)
        .select("lon", "lat", name, F.floor(lat / band_deg).alias("band"))
    )
    crossed = join(candidates, bands, [name, "band"]).where(
        crosses_eastward(lon, lat, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    )
    counts = crossed.groupBy("lon", "lat", name).agg(F.count(F.lit(1)).alias("crossings"))
    return counts.where(F.col("crossings") % 2 == 1).drop("crossings")


def located_or_new(points: DataFrame, edges: DataFrame | None, located: DataFrame | None, **kw) -> DataFrame:
    """The caller's location table, or a fresh one, stored so that its size is known to the join."""
    if located is not None:
        return located
    if edges is None:
        raise ValueError("either edges or located is required")
    return materialize(locate_regions(points, edges, **kw))


def within_join(
    points: DataFrame,
    edges: DataFrame | None = None,
    located: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """Points with every region that contains them; overlapping regions give several rows.

    Containment is tested once per distinct location. ``located`` (from ``locate_regions``) may be
    stored and passed in to skip the test.
    """
    return points.join(located_or_new(points, edges, located, **kw), ["lon", "lat"])


def region_locations(located: DataFrame, region: str = "ALL", name: str = "region_name") -> DataFrame:
    """Distinct locations of one region, or of any region for ``ALL``; unknown names give none."""
    if region != "ALL":
        located = located.where(F.col(name) == region)
    return located.select("lon", "lat").distinct()


def within_semi(
    points: DataFrame,
    edges: DataFrame | None = None,
    located: DataFrame | None = None,
    region: str = "ALL",
    **kw,
) -> DataFrame:
    """Points inside any region (or the named one), each once."""
    places = region_locations(located_or_new(points, edges, located, **kw), region)
    return points.join(places, ["lon", "lat"], "left_semi")


def outside_anti(
    points: DataFrame,
    edges: DataFrame | None = None,
    located: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """Points inside no region: the complement of ``within_semi``."""
    places = region_locations(located_or_new(points, edges, located, **kw))
    return points.join(places, ["lon", "lat"], "left_anti")


def location_join(readings: DataFrame, geo_points: DataFrame, how: str = "inner") -> DataFrame:
    """Readings with the named points at their location: both coordinates within one micro-degree.

    Two values that close may fall into neighbouring micro-degrees, so each point stands in its own and the
    adjoining ones; the difference is checked after the equi-join. Works for inner and left joins.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of join {how!r}")
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    named = geo_points.select(
        F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), "nearest_town",
        location_key("lon").alias("_x"), location_key("lat").alias("_y"),
    )
    named = named.withColumn("_dx", F.explode(near)).withColumn("_dy", F.explode(near))
    named = named.select(
        "_lon", "_lat", "nearest_town", (F.col("_x") + F.col("_dx")).alias("_kx"), (F.col("_y") + F.col("_dy")).alias("_ky")
    )
    keyed = readings.withColumns({"_kx": location_key("lon"), "_ky": location_key("lat")})
    # half a unit of double precision at 180 degrees more than a micro-degree
    reach = F.lit(1e-6 + 1e-12)
    at = (
        keyed["_kx"].eqNullSafe(named["_kx"]) & keyed["_ky"].eqNullSafe(named["_ky"])
        & (F.abs(keyed["lon"] - named["_lon"]) <= reach) & (F.abs(keyed["lat"] - named["_lat"]) <= reach)
    )
    return keyed.join(named, at, how).select(*[keyed[c] for c in readings.columns], "nearest_town")


def _reach_deg(radius_m: float) -> float:
    """Latitude span of the radius in degrees, a hair wider to absorb rounding."""
    return math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-12


def distance_filter(
    df: DataFrame, lon: float, lat: float, radius_m: float, lon_col: str = "lon", lat_col: str = "lat"
) -> DataFrame:
    """Rows strictly nearer than ``radius_m``; a coordinate box goes to the scan first."""
    reach = _reach_deg(radius_m)
    near = df.where(F.col(lat_col).between(lat - reach, lat + reach))
    nearest_pole = abs(lat) + reach
    if nearest_pole < 90:
        widest = math.sin(min(math.radians(reach), math.pi / 2)) / math.cos(math.radians(lat))
        dlon = math.degrees(math.asin(min(1.0, widest))) * (1 + 1e-9) + 1e-12
        west, east = lon - dlon, lon + dlon
        if -180 <= west and east <= 180:
            near = near.where(F.col(lon_col).between(west, east))
        elif dlon < 180:
            west, east = (west + 360 if west < -180 else west), (east - 360 if east > 180 else east)
            near = near.where((F.col(lon_col) >= west) | (F.col(lon_col) <= east))
    return near.where(geo_distance(lon_col, lat_col, F.lit(lon), F.lit(lat)) < radius_m)


def proximity_minmax(
    readings: DataFrame,
    lon: float,
    lat: float,
    at,
    radius_m: float = 1.0,
    value: str = "temperature",
    time_col: str = "measurement_time",
    partition_col: str | None = None,
) -> DataFrame:
    """Least and greatest value near a point at an instant; one row always, nulls when nothing matches.

    ``partition_col`` names a date column the table is partitioned by.
    """
    instant = F.lit(at).cast(readings.schema[time_col].dataType)
    at_time = readings.where(F.col(time_col) == instant)
    if partition_col is not None:
        at_time = at_time.where(F.col(partition_col) == F.to_date(instant))
    near = distance_filter(at_time, lon, lat, radius_m)
    return near.agg(F.min(value).alias("min_t"), F.max(value).alias("max_t"))


def _grid_row(lat: Column, cell: float) -> Column:
    return F.floor((lat + 90.0) / cell)


def _row_cells(row: Column, cell: float) -> tuple[Column, Column]:
    """Number of longitude cells in a latitude row and the least cosine of latitude in it."""
    south, north = F.abs(row * cell - 90.0), F.abs((row + 1) * cell - 90.0)
    cosine = F.cos(F.radians(F.least(F.lit(90.0), F.greatest(south, north))))
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(360.0) * cosine / cell)), cosine


def _probe_cells(probes: DataFrame, radius_m: float, cell: float) -> DataFrame:
    """Probes repeated for each grid cell their radius can reach."""
    half_angle = min(radius_m / EARTH_RADIUS_M / 2, math.pi / 2)
    reach = _reach_deg(radius_m)
    first, last = _grid_row(F.col("lat") - reach, cell), _grid_row(F.col("lat") + reach, cell)
    rows = F.explode(F.sequence(first, last))
    spread = probes.withColumn("_iy", rows)
    n, cosine = _row_cells(F.col("_iy"), cell)
    ratio = F.lit(math.sin(half_angle)) / F.sqrt(F.cos(F.radians("lat")) * cosine)
    dlon = F.when(
        ratio < 1, F.degrees(F.lit(2.0) * F.asin(ratio)) * (1 + 1e-9) + 1e-12
    ).otherwise(180.0)
    spread = spread.withColumn("_n", n).withColumn("_dlon", dlon)
    west = F.floor((F.col("lon") + 180.0 - F.col("_dlon")) / (360.0 / F.col("_n")))
    east = F.floor((F.col("lon") + 180.0 + F.col("_dlon")) / (360.0 / F.col("_n")))
    spread = spread.withColumn("_west", west).withColumn(
        "_east", F.least(east, F.col("_west") + F.col("_n") - 1)
    )
    columns = F.transform(F.sequence("_west", "_east"), lambda c: F.pmod(c, F.col("_n")))
    spread = spread.withColumn("_ix", F.explode(columns))
    return spread.drop("_n", "_dlon", "_west", "_east")


def proximity_batch(
    readings: DataFrame,
    probes: DataFrame,
    radius_m: float = 1.0,
    value: str = "temperature",
    time_col: str = "measurement_time",
    partition_col: str | None = None,
) -> DataFrame:
    """Many ``(probe_id, lon, lat, probe_time)`` probes in one job: each with ``min_t`` and ``max_t``.

    Readings meet probes on ``(time, grid cell)``; cell width follows the latitude and wraps at 180
    degrees. Probes without a match keep nulls. ``partition_col`` names a date column the readings are partitioned
    by: the distinct days of the probes (one row each) become a filter on its partitions, so only those are read.
    """
    # Cells of a few metres would repeat each probe nine times; ten times the radius seldom repeats it.
    reach = _reach_deg(radius_m)
    cell = max(reach, min(10 * reach, 0.01))
    probes = probes.select("probe_id", "lon", "lat", "probe_time")
    cells = _probe_cells(probes, radius_m, cell).select(
        "probe_id",
        F.col("lon").alias("_plon"),
        F.col("lat").alias("_plat"),
        F.col("probe_time").alias("_time"),
        "_iy",
        "_ix",
    )
    on = ["_time", "_iy", "_ix"]
    kept = ["lon", "lat"]
    if partition_col is not None:
        cells = cells.withColumn("_date", F.to_date("_time"))
        kept, on = [*kept, F.col(partition_col).alias("_date")], [*on, "_date"]
        # one row per day of the probes: the partitions to read, as a filter on the scan
        days = [r[0] for r in probes.select(F.to_date("probe_time")).distinct().collect() if r[0] is not None]
        readings = readings.where(F.col(partition_col).isin(days))

    rows = readings.where(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90)).select(
        F.col(time_col).alias("_time"), *kept, F.col(value).alias("_low"), F.col(value).alias("_high")
    )
    n, _ = _row_cells(F.col("_iy"), cell)
    rows = rows.withColumn("_iy", _grid_row(F.col("lat"), cell))
    rows = rows.withColumn("_ix", F.pmod(F.floor((F.col("lon") + 180.0) / (360.0 / n)), n))

    met = rows.join(cells, on)
    met = met.where(geo_distance("lon", "lat", "_plon", "_plat") < radius_m)
    hits = met.select(
        "probe_id",
        F.col("_plon").alias("lon"),
        F.col("_plat").alias("lat"),
        F.col("_time").alias("probe_time"),
        "_low",
        "_high",
    )
    nothing = F.lit(None).cast(readings.schema[value].dataType)
    all_probes = probes.select("*", nothing.alias("_low"), nothing.alias("_high"))
    return (
        hits.unionByName(all_probes)
        .groupBy("probe_id", "lon", "lat", "probe_time")
        .agg(F.min("_low").alias("min_t"), F.max("_high").alias("max_t"))
    )
