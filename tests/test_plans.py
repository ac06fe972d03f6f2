"""What the physical plans must and must not contain."""

import pytest

from skyloom.operators import ranking, spatial, weather
from skyloom.plans import inputs
from skyloom.sources import tables


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filters_reach_the_scan(spark, sf):
    events = inputs.table(spark, sf, "events").withColumnRenamed("ts", "measurement_time")
    plan = _plan(weather.time_range(events, "measurement_time", "2024-01-05", "2024-01-06").select("value"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan and "event_type" not in plan
    latest = _plan(weather.latest_epoch(events).select("value"))
    assert "EqualTo(ts,ScalarSubquery" in latest
    assert "ReadSchema: struct<ts:timestamp_ntz>" in latest


def test_distance_box_reaches_the_scan(spark, sf, tmp_path):
    inputs.readings(spark, sf).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    plan = _plan(spatial.proximity_minmax(stored, 7.75, 49.25, "2024-01-10"))
    for pushed in ("GreaterThanOrEqual(lat", "LessThanOrEqual(lon", "EqualTo(measurement_time"):
        assert pushed in plan
    assert "pressure" not in plan


def test_groups_are_trimmed_before_the_shuffle(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_type", "event_id")
    df = ranking.top_k_per_group(events, ["event_type"], [events.event_id.asc()], 3)
    plan = _plan(df)
    assert plan.index("WindowGroupLimit [event_type") < plan.rindex("WindowGroupLimit [event_type")


def test_top_k_is_not_a_full_sort(spark, sf):
    events = inputs.table(spark, sf, "events").selectExpr("event_id AS id", "value AS score")
    assert "TakeOrderedAndProject" in _plan(ranking.top_k_by_score(events, 5, "id"))


def test_stored_readings_are_pruned_by_date(spark, sf, tmp_path):
    """Every operator with a time reads no other date, and starts no job before the action once locations are stored."""
    date, points = "measurement_date", inputs.geo_points(spark, sf)
    tables.write_readings(inputs.readings(spark, sf), str(tmp_path / "r"), files_per_day=1)
    stored = spark.read.parquet(str(tmp_path / "r"))
    spatial.locate_regions(stored, inputs.edges(spark)).write.parquet(str(tmp_path / "l"))
    located = spark.read.parquet(str(tmp_path / "l"))
    probes = spark.createDataFrame([("p", 7.75, 49.25)], "probe_id string, lon double, lat double").selectExpr(
        "*", "TIMESTAMP_NTZ'2024-01-10' AS probe_time"
    )
    span = ("2024-01-05", "2024-01-20")
    spark.sparkContext.setJobGroup("pruning", "plans only")
    made = {
        "equals": weather.time_equals(stored, "measurement_time", "2024-01-10", date),
        "range": weather.time_range(stored, "measurement_time", *span, date),
        "last": weather.last_measurement_time(stored, *span, partition_col=date),
        "series": weather.minavgmax_for_region(stored, None, "pressure", "Holed", *span, located, date),
        "total": weather.minavgmax_total(stored, None, "pressure", "ALL", *span, located, date),
        "daily": weather.daily_avg_at_location(stored, 49.25, 7.75, "pressure", *span, partition_col=date),
        "snapshot": weather.metric_snapshot(stored, None, points, "wind", "ALL", *span, located, date),
        "gauge": weather.latest_gauge(stored, None, "pressure", "ALL", *span, located, date),
        "rank": weather.rank_places(stored, None, points, "pressure", "lowest", 3, *span, located, date),
        "extreme": weather.extreme_place(stored, None, points, "pressure", "lowest", *span, located, date),
        "all": weather.region_snapshot_all(stored, None, points, located, date),
        "minmax": spatial.proximity_minmax(stored, 7.75, 49.25, "2024-01-10", partition_col=date),
    }
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("pruning") == []
    spark.sparkContext.setJobGroup("tests", "")
    for name, df in made.items():
        scans = [line for line in _plan(df).splitlines() if "FileScan" in line and "measurement_time" in line]
        assert scans and all("PartitionFilters: []" not in line for line in scans), name
    batch = _plan(spatial.proximity_batch(stored, probes, 1.0, partition_col=date))
    scans = [line for line in batch.splitlines() if "FileScan" in line and "measurement_time" in line]
    assert scans and all("measurement_date" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans), batch
