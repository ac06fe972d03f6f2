import pytest
from pyspark.sql import functions as F

from skyloom.functions import scalar
from skyloom.operators import spatial, weather

SQUARES = [
    ("West", '{"type":"Polygon","coordinates":[[[0.5,0.5],[3.5,0.5],[3.5,3.5],[0.5,3.5]]]}'),
    ("East", '{"type":"Polygon","coordinates":[[[2.5,0.5],[6.5,0.5],[6.5,3.5],[2.5,3.5]]]}'),
    ("Far", '{"type":"Polygon","coordinates":[[[50,50],[51,50],[51,51]]]}'),
]
# (time, lon, lat, temperature, pressure, u10, v10); (3, 1) lies in West and East, (9, 9) in none.
ROWS = [
    ("2024-01-01", 1.0, 1.0, 280.0, 1000.0, 3.0, 4.0),
    ("2024-01-01", 3.0, 1.0, 290.0, 1010.0, 0.0, 0.0),
    ("2024-01-02", 1.0, 1.0, 270.0, 1001.0, -3.0, 4.0),
    ("2024-01-02", 3.0, 1.0, 260.0, 1002.0, 0.0, -1.0),
    ("2024-01-02", 5.0, 2.0, 260.0, 1003.0, 1.0, 0.0),
    ("2024-01-02", 9.0, 9.0, 200.0, 1004.0, 1.0, 1.0),
    ("2024-01-02", 6.0, 2.0, None, None, None, None),
    ("2024-01-02", None, None, 100.0, 900.0, 9.0, 9.0),
    ("2024-01-03", 9.0, 9.0, 250.0, 1005.0, 1.0, 1.0),
    (None, 1.0, 1.0, 999.0, 999.0, 1.0, 1.0),
]
T = ("2024-01-01", "2024-01-02")


@pytest.fixture(scope="module")
def readings(spark):
    schema = "t string, lon double, lat double, temperature double, pressure double, u10 double, v10 double"
    df = spark.createDataFrame(ROWS, schema)
    return df.withColumn("measurement_time", F.col("t").cast("timestamp_ntz")).drop("t")


@pytest.fixture(scope="module")
def edges(spark):
    return spatial.polygon_edges(
        spark.createDataFrame(SQUARES, "region_name string, geo_coords string"), "region_name", "geo_coords"
    )


@pytest.fixture(scope="module")
def points(spark):
    rows = [(1.0, 1.0, "A"), (3.0, 1.0, "B"), (5.0, 2.0, "C"), (9.0, 9.0, "D")]
    return spark.createDataFrame(rows, "lon double, lat double, nearest_town string")


def test_latest_epoch_is_global(readings, edges, points):
    assert weather.latest_epoch(readings).select("lon").collect() == [(9.0,)]
    assert weather.latest_epoch_in_range(readings, *T).count() == 6
    # The newest reading lies outside every region, so the snapshot is empty.
    assert weather.region_snapshot(readings, edges, points, "West").count() == 0
    assert weather.latest_epoch(readings.where("false")).count() == 0


def test_latest_epoch_by_partition(readings):
    dated = readings.withColumn("d", F.to_date("measurement_time"))
    assert weather.latest_epoch(dated, partition_col="d").select("lon").collect() == [(9.0,)]


def test_region_snapshot(readings, edges, points):
    upto = readings.where("measurement_time < '2024-01-03'")
    rows = weather.region_snapshot(upto, edges, points, "West").orderBy("nearest_town").collect()
    assert [(r.nearest_town, round(r.temperature, 2), r.longitude) for r in rows] == [("A", -3.15, 1.0), ("B", -13.15, 3.0)]
    everywhere = weather.region_snapshot_all(upto, edges, points).collect()
    found = sorted((r.region_name, r.nearest_town) for r in everywhere)
    assert found == [("East", "B"), ("East", "C"), ("West", "A"), ("West", "B")]
    assert weather.region_snapshot(upto, edges, points, "Germany").count() == 0


def test_all_counts_an_overlap_once(readings, edges):
    rows = weather.minavgmax_for_region(readings, edges, "temperature", "ALL", *T).collect()
    got = {str(r.time)[:10]: (r.min_value, r.avg_value, r.max_value) for r in rows}
    assert got == {
        "2024-01-01": (280.0, 285.0, 290.0),
        "2024-01-02": (260.0, pytest.approx(790 / 3), 270.0),
    }
    total = weather.minavgmax_total(readings, edges, "pressure", "East", *T).collect()
    assert total == [(1002.0, pytest.approx(1005.0), 1010.0)]
    assert weather.minavgmax_total(readings, edges, "wind_speed", "Far", *T).collect() == [(None, None, None)]


def test_snapshot_and_gauge(readings, edges, points):
    wind = weather.metric_snapshot(readings, edges, points, "wind", "ALL", *T).orderBy("nearest_town").collect()
    assert [(r.nearest_town, r.wind_speed, r.wind_direction) for r in wind] == [
        ("A", 5.0, pytest.approx(143.130102)), ("B", 1.0, 0.0), ("C", 1.0, 270.0),
    ]
    gauge = weather.latest_gauge(readings, edges, "temperature", "East", *T).head()
    assert gauge.avg_value == 260.0 and str(gauge.time)[:10] == "2024-01-02"


def test_extreme_places(readings, edges, points):
    coldest = weather.extreme_place(readings, edges, points, "temperature", "coldest", *T).head()
    assert (coldest.nearest_town, coldest.value, coldest.label) == ("B", 260.0, "-13.15 C (260.00 K)")
    ranked = weather.rank_places(readings, edges, points, "wind_speed", "highest", 2, *T).collect()
    assert sorted((r["rank"], r.nearest_town, r.value) for r in ranked) == [(1, "A", 5.0), (2, "B", 1.0)]
    for bad in (dict(kind="best"), dict(kind="warmest", metric="pressure"), dict(n=0), dict(metric="rain")):
        given = {"metric": "temperature", "kind": "lowest", "n": 1} | bad
        with pytest.raises(ValueError):
            weather.rank_places(readings, edges, points, given["metric"], given["kind"], given["n"], *T)


def test_time_range(readings):
    assert weather.time_range(readings, "measurement_time", *T).count() == 8
    assert weather.time_range(readings, "measurement_time", "2024-01-02", "2024-01-02").count() == 6
    assert weather.time_equals(readings, "measurement_time", "2024-01-03").count() == 1
    for bounds in ((None, "2024-01-01"), ("2024-01-01", "")):
        with pytest.raises(ValueError):
            weather.time_range(readings, "measurement_time", *bounds)


def test_region_or_all(spark):
    df = spark.createDataFrame([("West",), ("East",)], "region_name string")
    assert [weather.region_or_all(df, r).count() for r in ("ALL", "West", "Germany")] == [2, 1, 0]


def test_pools(readings):
    assert [str(r[0])[:10] for r in weather.distinct_times(readings).collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert spatial.distinct_locations(readings).count() == 5


def test_daily_average(readings):
    rows = weather.daily_avg_at_location(readings, 1.0, 1.0, "wind_speed", *T).collect()
    assert sorted((str(r.day)[:10], r.avg_value) for r in rows) == [("2024-01-01", 5.0), ("2024-01-02", 5.0)]


def test_scalars(spark):
    df = spark.createDataFrame([(264.16, 0.0, 0.0), (None, None, 1.0), (273.145, -1.0, 0.0)], "k double, u double, v double")
    rows = df.select(scalar.temperature_label("k").alias("label"), scalar.wind_direction("u", "v").alias("d")).collect()
    assert [tuple(r) for r in rows] == [("-8.99 C (264.16 K)", None), (None, None), ("-0.01 C (273.15 K)", 90.0)]


@pytest.mark.parametrize(
    ("title", "slug"),
    [
        ("Min, Average and Max temperature for $region", "min_average_and_max_temperature_for_region"),
        ("Daily average wind speed for ${town_name}, ${latitude}, ${longitude}",
         "daily_average_wind_speed_for_town_name_latitude_longitude"),
        ("Last Measurement Time", "last_measurement_time"),
        ("'$keyword' relevance to '$search_categories'", "keyword_relevance_to_search_categories"),
        ("?!", "panel"), ("", "panel"), ("$", "panel"), ("Été 2", "t_2"),
    ],
)
def test_slugs(spark, title, slug):
    assert spark.createDataFrame([(title,)], "t string").select(scalar.slugify("t")).head()[0] == slug


def test_normalized_query(spark):
    df = spark.createDataFrame([(" a\nb \n",)], "t string")
    assert df.select(scalar.normalize_query_text("t")).head()[0] == "a b"
