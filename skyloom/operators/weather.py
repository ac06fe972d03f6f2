"""Latest-epoch snapshots, region series, place rankings and time buckets.

Readings are flat rows ``measurement_time, lon, lat, temperature, pressure, u10, v10``. Operators that
depend on regions take ``edges`` (from ``polygon_edges``) or a stored ``located`` table (from
``locate_regions``), which saves the containment test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from skyloom.functions.scalar import (
    kelvin_to_celsius,
    temperature_label,
    wind_direction,
    wind_speed,
)
from skyloom.operators.spatial import (
    distance_filter,
    located_or_new,
    location_join,
    region_locations,
    within_semi,
)

TIME = "measurement_time"
METRICS = ("temperature", "pressure", "wind_speed")


def metric_column(metric: str) -> Column:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    return wind_speed("u10", "v10") if metric == "wind_speed" else F.col(metric)


def time_equals(df: DataFrame, col: str, at, partition_col: str | None = None) -> DataFrame:
    """Rows at an instant. ``partition_col`` names a date column the table is partitioned by."""
    instant = F.lit(at).cast(df.schema[col].dataType)
    if partition_col is not None:
        df = df.where(F.col(partition_col) == F.to_date(instant))
    return df.where(F.col(col) == instant)


def time_range(df: DataFrame, col: str, t_from, t_to, partition_col: str | None = None) -> DataFrame:
    """Rows between two instants, both ends included; a bare date means its midnight.

    ``partition_col`` names a date column the table is partitioned by: other dates are not read.
    """
    if not t_from or not t_to:
        raise ValueError("both time bounds are required")
    kind = df.schema[col].dataType
    low, high = F.lit(t_from).cast(kind), F.lit(t_to).cast(kind)
    if partition_col is not None:
        df = df.where(F.col(partition_col).between(F.to_date(low), F.to_date(high)))
    return df.where(F.col(col).between(low, high))


def region_or_all(df: DataFrame, region: str, name: str = "region_name") -> DataFrame:
    """Rows of one region; ``ALL`` keeps every row, an unknown name none."""
    return df if region == "ALL" else df.where(F.col(name) == region)


def latest_epoch(df: DataFrame, time_col: str = TIME, partition_col: str | None = None) -> DataFrame:
    """Rows at the greatest time of the whole table.

    The maximum is a scalar subquery, so the comparison reaches the scan. ``partition_col`` names a
    partition column computed from the time and never decreasing with it (its date): then the maximum
    is taken over the last partition only, and nothing else of the table is read but partition values.
    """
    if partition_col is not None:
        df = df.where(F.col(partition_col) == df.agg(F.max(partition_col)).scalar())
    return df.where(F.col(time_col) == df.agg(F.max(time_col)).scalar())


def latest_epoch_in_range(
    df: DataFrame, t_from, t_to, time_col: str = TIME, partition_col: str | None = None
) -> DataFrame:
    in_range = time_range(df, time_col, t_from, t_to, partition_col)
    return in_range.where(F.col(time_col) == in_range.agg(F.max(time_col)).scalar())


def last_measurement_time(
    readings: DataFrame, t_from, t_to, time_col: str = TIME, partition_col: str | None = None
) -> DataFrame:
    in_range = time_range(readings, time_col, t_from, t_to, partition_col)
    return in_range.agg(F.max(time_col).alias("last_measurement_time"))


def distinct_times(readings: DataFrame, time_col: str = TIME) -> DataFrame:
    """Each time once, ascending."""
    return readings.where(F.col(time_col).isNotNull()).select(time_col).distinct().orderBy(time_col)


def region_names(regions: DataFrame, name: str = "region_name") -> DataFrame:
    return regions.where(F.col(name).isNotNull()).select(name)


def _at_named_places(readings: DataFrame, located: DataFrame, geo_points: DataFrame) -> DataFrame:
    """Readings at located and named places. The small tables meet first, so readings are joined once."""
    return readings.join(location_join(located, geo_points), ["lon", "lat"])


def _snapshot_columns(df: DataFrame, *first: str) -> DataFrame:
    return df.select(
        *first,
        F.col(TIME).alias("time"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        kelvin_to_celsius("temperature").alias("temperature"),
        "nearest_town",
    )


def region_snapshot(
    readings: DataFrame,
    edges: DataFrame | None,
    geo_points: DataFrame,
    region: str,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Temperature in Celsius at every named location of a region at the latest epoch of all readings."""
    if edges is not None:
        edges = region_or_all(edges, region)
    latest = latest_epoch(readings, TIME, partition_col)
    chosen = region_or_all(located_or_new(latest, edges, located), region)
    return _snapshot_columns(_at_named_places(latest, chosen, geo_points))


def region_snapshot_all(
    readings: DataFrame,
    edges: DataFrame | None,
    geo_points: DataFrame,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """``region_snapshot`` of every region in one job, with the region's name."""
    latest = latest_epoch(readings, TIME, partition_col)
    places = located_or_new(latest, edges, located)
    return _snapshot_columns(_at_named_places(latest, places, geo_points), "region_name")


def _min_avg_max(metric: str) -> list[Column]:
    value = metric_column(metric)
    return [
        F.min(value).alias("min_value"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value")
    ]


def _in_region(
    readings: DataFrame, edges: DataFrame | None, region: str, located: DataFrame | None
) -> DataFrame:
    if located is None and edges is not None:
        edges = region_or_all(edges, region)
    return within_semi(readings, edges, located, region)


def minavgmax_for_region(
    readings: DataFrame,
    edges: DataFrame | None,
    metric: str,
    region: str,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Least, mean and greatest value per measurement time; ``ALL`` counts a reading once."""
    inside = _in_region(time_range(readings, TIME, t_from, t_to, partition_col), edges, region, located)
    return inside.groupBy(F.col(TIME).alias("time")).agg(*_min_avg_max(metric))


def minavgmax_total(
    readings: DataFrame,
    edges: DataFrame | None,
    metric: str,
    region: str,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Least, mean and greatest value of the whole time range, one row."""
    inside = _in_region(time_range(readings, TIME, t_from, t_to, partition_col), edges, region, located)
    return inside.agg(*_min_avg_max(metric))


def metric_snapshot(
    readings: DataFrame,
    edges: DataFrame | None,
    geo_points: DataFrame,
    metric: str,
    region: str,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Value per location at the latest epoch in range; ``wind`` gives speed and direction."""
    if edges is not None:
        edges = region_or_all(edges, region)
    latest = latest_epoch_in_range(readings, t_from, t_to, TIME, partition_col)
    places = region_locations(located_or_new(latest, edges, located), region)
    named = _at_named_places(latest, places, geo_points)
    if metric == "wind":
        values = [
            wind_speed("u10", "v10").alias("wind_speed"),
            wind_direction("u10", "v10").alias("wind_direction"),
        ]
    else:
        values = [metric_column(metric).alias(metric)]
    place = [F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "nearest_town"]
    return named.select(F.col(TIME).alias("time"), *place, *values)


def latest_gauge(
    readings: DataFrame,
    edges: DataFrame | None,
    metric: str,
    region: str,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Mean value at the latest epoch in range, one row."""
    latest = latest_epoch_in_range(readings, t_from, t_to, TIME, partition_col)
    inside = _in_region(latest, edges, region, located)
    return inside.agg(F.max(TIME).alias("time"), F.avg(metric_column(metric)).alias("avg_value"))


def rank_places(
    readings: DataFrame,
    edges: DataFrame | None,
    geo_points: DataFrame,
    metric: str,
    kind: str,
    n: int,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """The ``n`` locations inside any region with the highest or lowest value at the latest epoch in range.

    A location with several readings counts with its most extreme one; ties go by latitude, longitude.
    """
    if kind not in ("highest", "lowest", "warmest", "coldest"):
        raise ValueError(f"unknown kind {kind!r}")
    if kind in ("warmest", "coldest") and metric != "temperature":
        raise ValueError(f"{kind!r} needs the metric 'temperature'")
    if n <= 0:
        raise ValueError("n must be positive")
    high = kind in ("highest", "warmest")
    latest = latest_epoch_in_range(readings, t_from, t_to, TIME, partition_col)
    inside = _in_region(latest, edges, "ALL", located)
    extreme = (F.max if high else F.min)(metric_column(metric)).alias("value")
    places = inside.groupBy("lon", "lat").agg(extreme).where(F.col("value").isNotNull())
    order = [F.desc("value") if high else F.asc("value"), F.asc("lat"), F.asc("lon")]
    top = places.orderBy(*order).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    columns = [
        "rank", "nearest_town", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "value"
    ]
    if metric == "temperature":
        columns += [
            kelvin_to_celsius("value").alias("celsius"), temperature_label("value").alias("label")
        ]
    return location_join(ranked, geo_points, "left").select(*columns)


def extreme_place(
    readings: DataFrame,
    edges: DataFrame | None,
    geo_points: DataFrame,
    metric: str,
    kind: str,
    t_from,
    t_to,
    located: DataFrame | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """The single coldest, warmest, lowest or highest place."""
    top = rank_places(readings, edges, geo_points, metric, kind, 1, t_from, t_to, located, partition_col)
    return top.drop("rank")


def daily_avg_at_location(
    readings: DataFrame,
    lat: float,
    lon: float,
    metric: str,
    t_from,
    t_to,
    radius_m: float = 1.0,
    time_col: str = TIME,
    partition_col: str | None = None,
) -> DataFrame:
    """Mean value per day at a location."""
    near = distance_filter(time_range(readings, time_col, t_from, t_to, partition_col), lon, lat, radius_m)
    day = F.to_date(time_col).cast("timestamp_ntz").alias("day")
    return near.groupBy(day).agg(F.avg(metric_column(metric)).alias("avg_value"))


def hourly_agg(readings: DataFrame, metric: str = "temperature", time_col: str = TIME) -> DataFrame:
    """Count, least, mean and greatest value per hour. Also runs on a stream with a watermark."""
    hour = F.window(time_col, "1 hour")
    counted = readings.groupBy(hour).agg(F.count(metric_column(metric)).alias("n"), *_min_avg_max(metric))
    return counted.select(F.col("window.start").alias("hour"), "n", "min_value", "avg_value", "max_value")
