import json

import pytest
from pyspark.sql import functions as F, types as T

from skyloom.operators import weather
from skyloom.operators.joins import materialize, salted_join
from skyloom.sources import tables
from skyloom.sources.schemas import KEYS, TABLES, create_tables, register_views

SHAPE = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("json")
    climate = [
        {"measurement_time": 1735689600000, "geo_location": [9.5, 47.3], "data": {"temperature": 280.5, "rain": 3}},
        {"measurement_time": "2025-01-02T00:00:00", "geo_location": "POINT(12.25 53.99)", "data": {"u10": 1}},
        {"measurement_time": "soon", "geo_location": "(1,2,3)", "data": None},
    ]
    lines = [json.dumps(r) for r in climate] + ["{broken"]
    (folder / "climate_data.json").write_text("\n".join(lines))
    regions = [{"region_name": "West", "geo_coords": SHAPE, "economics": "cars", "embedding": [0.5, 1]}]
    (folder / "german_regions.json").write_text("\n".join(map(json.dumps, regions)))
    points = [
        {"latitude": 47.3, "longitude": 9.5, "nearest_town": "A"},
        {"latitude": 53.99, "longitude": 12.25, "geo_location": [12.25, 53.99], "nearest_town": "B"},
    ]
    (folder / "geo_points.json").write_text("\n".join(map(json.dumps, points)))
    return tables.load_tables(spark, str(folder))


def test_load(loaded):
    rows = loaded["climate_data"].select(
        "*", F.try_variant_get("data_extra", "$.rain", "int").alias("rain")
    ).collect()
    good = [(str(r.measurement_time), r.geo_location and tuple(r.geo_location), r.rain) for r in rows]
    assert good[0] == ("2025-01-01 00:00:00", (9.5, 47.3), 3)
    assert good[1] == ("2025-01-02 00:00:00", (12.25, 53.99), None)
    assert good[2] == ("None", None, None) == good[3]
    assert [r._corrupt_record for r in rows] == [None, None, None, "{broken"]
    assert rows[0].data.temperature == 280.5 and rows[1].data.u10 == 1.0
    region = loaded["german_regions"].head()
    assert json.loads(region.geo_coords) == SHAPE and region.embedding == [0.5, 1.0]
    assert [tuple(r.geo_location) for r in loaded["geo_points"].collect()] == [(9.5, 47.3), (12.25, 53.99)]


def test_flat_readings(loaded):
    flat = tables.flatten_readings(loaded["climate_data"])
    assert flat.columns == ["measurement_time", "lon", "lat", "temperature", "pressure", "u10", "v10"]
    assert flat.where("lon = 9.5").head().temperature == 280.5


def test_create_and_register(spark, loaded):
    create_tables(spark, "fresh")
    create_tables(spark, "fresh")
    for name, schema in TABLES.items():
        stored = {f.name: f.dataType for f in spark.table(f"fresh.{name}").schema.fields}
        assert stored == {f.name: f.dataType for f in schema.fields if not isinstance(f.dataType, T.VariantType)}
    register_views(loaded)
    assert spark.sql("SELECT count(*) FROM geo_points").head()[0] == 2


def test_stored_readings_are_partitioned(spark, tmp_path):
    rows = [(f"2024-01-0{1 + i % 3} 00:00:00", float(i), 1.0, 280.0 + i, 1.0, 1.0, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "t string, lon double, lat double, temperature double, pressure double, u10 double, v10 double")
    df = df.withColumn("measurement_time", F.col("t").cast("timestamp_ntz")).drop("t")
    tables.write_readings(df, str(tmp_path / "r"), files_per_day=2)
    stored = spark.read.parquet(str(tmp_path / "r"))
    assert stored.count() == 60 and stored.select("measurement_date").distinct().count() == 3
    latest = weather.latest_epoch(stored, partition_col="measurement_date")
    assert latest.count() == 20
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_date" in plan


def test_enforce_key(spark):
    rows = [(1, "a", 5), (1, "b", 3), (1, "b", 3), (2, "c", 1), (None, "d", 1), (1, "a", 3)]
    df = spark.createDataFrame(rows, "k int, v string, o int")
    kept, rejected = tables.enforce_key(df, ["k"], ["o"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a", 3), (2, "c", 1)]
    assert sorted(map(str, map(tuple, rejected.collect()))) == sorted(
        map(str, [(1, "a", 5), (1, "b", 3), (1, "b", 3), (None, "d", 1)])
    )
    only_keys = df.select("k")
    kept, rejected = tables.enforce_key(only_keys, KEYS["german_regions"][:0] or ["k"])
    assert kept.count() == 2 and rejected.count() == 4


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_agrees_with_the_plain_join(spark, how):
    fact = spark.createDataFrame([(i % 4, i) for i in range(200)] + [(None, 7)], "k int, v int")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "d")], "k int, d string")
    expected = sorted(map(str, fact.join(dim, ["k"], how).collect()))
    assert sorted(map(str, salted_join(fact, dim, ["k"], how, 5).collect())) == expected


def test_stored_tables_have_a_size(spark):
    small = materialize(spark.range(10).withColumnRenamed("id", "k"))
    joined = spark.range(10).withColumnRenamed("id", "k").join(small, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_enforce_key_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("o"), (F.col("id") % 3).alias("v"),
    )
    kept, rejected = tables.enforce_key(df, ["k"], ["o"])
    assert kept.count() == 10_001 and rejected.count() == 9_999
    assert kept.where("k = 0").collect()[0]["o"] == 0
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "Except" not in plan and "Window" not in plan
    dup = spark.createDataFrame([(1, 2)] * 5 + [(1, 3)], "k int, o int")
    kept, rejected = tables.enforce_key(dup, ["k"], ["o"])
    assert sorted(map(tuple, rejected.collect())) == [(1, 2)] * 4 + [(1, 3)]
