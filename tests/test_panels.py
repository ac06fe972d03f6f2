import json

import pytest
from pyspark.sql import functions as F

from skyloom.functions.sql import register_sql_functions
from skyloom.operators import spatial
from skyloom.plans import inputs, panels
from skyloom.plans.queries import QUERIES

DASHBOARD = {
    "title": "Weather",
    "panels": [
        {"id": 1, "type": "row", "title": "Now", "targets": [{"refId": "A", "rawSql": "SELECT 0"}]},
        {"id": 2, "type": "geomap", "title": "Temperature",
         "targets": [{"refId": "A"}, {"refId": "B", "rawSql": "SELECT 1"}, {"refId": "C", "rawSql": "SELECT 2"}]},
        {"id": 3, "type": "gauge", "title": "Temperature", "targets": [{"refId": "A", "rawSql": "SELECT 3"}]},
        {"id": 4, "type": "text", "title": "Notes"},
        {"id": 5, "type": "table", "title": "Empty", "targets": [{"refId": "A", "rawSql": ""}]},
        {"id": 6, "type": "table", "targets": [{"refId": "A", "rawSql": "SELECT $region, ${latitude} + $region"}]},
        {"id": 7, "title": "Temperature 3", "targets": [
            {"rawSql": 'SELECT t FROM x WHERE $__timeFilter("t") AND r = \'$region_name\' AND $__interval > 0'}]},
        {"id": 8, "type": "stat", "title": "$Temperature", "targets": [{"rawSql": "SELECT 8"}]},
    ],
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dashboards")
    (folder / "a.json").write_text(json.dumps(DASHBOARD, indent=2))
    (folder / "b.json").write_text(json.dumps({"panels": DASHBOARD["panels"][1:2]}))
    (folder / "c.json").write_text("{}")
    return panels.load_panels(spark, str(folder))


def test_load(loaded):
    rows = loaded.where(F.col("dashboard").endswith("a.json")).orderBy("position").collect()
    assert [(r.id, r.title, r.name, r.raw_sql[:8]) for r in rows] == [
        (2, "Temperature", "temperature", "SELECT 1"),
        (3, "Temperature", "temperature_3", "SELECT 3"),
        (6, "panel_6", "panel_6", "SELECT $"),
        # The slug of the fourth panel was minted for the second one.
        (7, "Temperature 3", "temperature_3_7", "SELECT t"),
        (8, "$Temperature", "temperature_8", "SELECT 8"),
    ]
    assert loaded.where(F.col("dashboard").endswith("b.json")).select("name").collect() == [("temperature",)]
    assert loaded.where(F.col("dashboard").endswith("c.json")).count() == 0


def test_variables(loaded):
    rows = panels.panel_variables(loaded).collect()
    assert sorted((r.name, r.parameter, r.type) for r in rows) == [
        ("panel_6", "latitude", "number"),
        ("panel_6", "region", "string"),
        ("temperature_3_7", "time_from", "string"),
        ("temperature_3_7", "time_to", "string"),
    ]


def test_render():
    sql, values = panels.render_panel(
        'SELECT x FROM t WHERE $__timeFilter( "t" ) AND r = \'$region\' AND y > ${latitude} '
        "AND z LIKE '%${keyword}%' AND w = 'it''s' AND $search_categories IS NOT NULL",
        {"region": "O'Hara", "latitude": 3, "keyword": "a", "search_categories": "economics",
         "time_from": "2025-01-01", "time_to": "2025-12-31", "stray": "x"},
    )
    assert sql == (
        "SELECT x FROM t WHERE (`t` BETWEEN :time_from AND :time_to) AND r = :region AND y > :latitude "
        "AND z LIKE concat('%', :keyword, '%') AND w = 'it''s' AND IDENTIFIER(:search_categories) IS NOT NULL"
    )
    assert values == {"time_from": "2025-01-01", "time_to": "2025-12-31", "region": "O'Hara", "latitude": 3.0,
                      "keyword": "a", "search_categories": "economics"}


@pytest.mark.parametrize(
    ("sql", "args"),
    [
        ("SELECT $region", {}),
        ("SELECT $region_name", {"region": "x"}),
        ("SELECT '$town_name'", {"town_name": "x"}),
        ("SELECT $search_categories", {"search_categories": "economics, transportation"}),
        ("SELECT 1 WHERE $__timeFilter(t)", {"time_from": "2025-01-01"}),
    ],
)
def test_render_errors(sql, args):
    with pytest.raises(ValueError):
        panels.render_panel(sql, args)


def test_run_with_hostile_value(spark):
    spark.createDataFrame([("a", "2025-01-01 00:00:00"), ("b", "2025-12-31 01:00:00")], "r string, s string").selectExpr(
        "r", "s::timestamp_ntz AS t", "r AS economics"
    ).createOrReplaceTempView("panel_t")
    run = lambda sql, **args: sorted(r[0] for r in panels.panel_query(spark, sql, **args).collect())
    sql = "SELECT r FROM panel_t WHERE $__timeFilter(\"t\") AND ('$region' = 'ALL' OR r = '$region')"
    # The end of the range is the midnight of its day.
    assert run(sql, region="ALL", time_from="2025-01-01", time_to="2025-12-31") == ["a"]
    assert run(sql, region="ALL", time_from="2025-01-01", time_to="2026-01-01") == ["a", "b"]
    assert run(sql, region="x' OR '1'='1", time_from="2025-01-01", time_to="2026-01-01") == []
    assert run("SELECT r FROM panel_t WHERE $search_categories = '$keyword'", search_categories="economics", keyword="b") == ["b"]


def test_query_sql_and_discover(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS demo")
    spark.sql("CREATE TABLE IF NOT EXISTS demo.towns (name STRING, n INT) USING parquet")
    spark.sql("INSERT OVERWRITE demo.towns VALUES ('x', 1), ('y', 2)")
    before = spark.catalog.currentDatabase()
    assert panels.query_sql(spark, "SELECT name FROM towns WHERE n = :n", {"n": 2}, "demo").collect() == [("y",)]
    assert spark.catalog.currentDatabase() == before
    found = panels.discover(spark, "demo").where("table_name = 'towns'").collect()
    assert sorted(map(tuple, found)) == [("towns", "n", "int"), ("towns", "name", "string")]


def test_dedupe_slug(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a")], "id int, slug string")
    got = panels.dedupe_slug(df, "slug", "id", "id").orderBy("id").collect()
    assert [r.name for r in got] == ["a", "b", "a_3", "a_4"]


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT distance(p, q) AS d, longitude(p) AS x, latitude(q) AS y, wind_direction(0D, -1D) AS w, "
        "wind_speed(3D, 4D) AS s, kelvin_to_celsius(273.15D) AS c FROM VALUES "
        "(named_struct('lon', 0D, 'lat', 0D), named_struct('lon', 1D, 'lat', 0D)) AS t(p, q)"
    ).head()
    assert row.d == pytest.approx(111_195.08, rel=1e-6)
    assert tuple(row)[1:] == (0.0, 0.0, 0.0, 5.0, 0.0)


def test_three_table_query_in_sql(spark):
    """Ad-hoc SQL in the terms of the data model gives what the operator gives."""
    register_sql_functions(spark)
    sf = "/root/testdata/sf0.001"
    point = F.struct("lon", "lat").alias("geo_location")
    readings = inputs.readings(spark, sf)
    readings.select("measurement_time", point, F.struct("temperature").alias("data")).createOrReplaceTempView("climate_data")
    inputs.regions(spark).createOrReplaceTempView("german_regions")
    inputs.geo_points(spark, sf).select(point, "nearest_town").createOrReplaceTempView("geo_points")
    got = panels.query_sql(
        spark,
        "SELECT d.measurement_time AS time, latitude(d.geo_location) AS latitude, longitude(d.geo_location) AS longitude, "
        "round(kelvin_to_celsius(d.data.temperature), 6) AS temperature, gp.nearest_town "
        "FROM climate_data d, german_regions r, geo_points gp WHERE within(d.geo_location, r.geo_coords) "
        "AND gp.geo_location = d.geo_location AND r.region_name = :region "
        "AND d.measurement_time = (SELECT max(d2.measurement_time) FROM climate_data d2)",
        {"region": "Concave"},
    )
    expected = QUERIES["region_snapshot"](spark, sf)
    assert got.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    near = spark.sql(
        "SELECT min(data.temperature) AS min_t, max(data.temperature) AS max_t FROM climate_data "
        "WHERE distance(geo_location, geo_point('POINT(7.75 49.25)')) < 1 AND measurement_time = '2024-01-10'"
    ).head()
    assert tuple(near) == tuple(spatial.proximity_minmax(readings, 7.75, 49.25, "2024-01-10").head())


@pytest.mark.parametrize(
    ("raw", "sql"),
    [
        ("WHERE $__timeFilter(date_trunc('day', t)) AND x", "WHERE (date_trunc('day', t) BETWEEN :time_from AND :time_to) AND x"),
        ('$__timeFilter( "a)b" )', "(`a)b` BETWEEN :time_from AND :time_to)"),
        ("-- don't $region\n a = '$region'", "-- don't $region\n a = :region"),
        ("/* it's $region */ a = '$region'", "/* it's $region */ a = :region"),
        ("`it's` = '$region' AND `$region` = 1", "`it's` = :region AND `$region` = 1"),
    ],
)
def test_rendering_knows_comments_quotes_and_parentheses(raw, sql):
    got, _ = panels.render_panel(raw, {"region": "R", "time_from": "2024-01-01", "time_to": "2024-01-02"})
    assert got == sql


def test_unclosed_macro():
    with pytest.raises(ValueError):
        panels.render_panel("$__timeFilter(t", {"time_from": "2024-01-01", "time_to": "2024-01-02"})


def test_names_stay_unique_when_a_numbered_one_is_taken(spark):
    target = [("A", "SELECT 1")]
    rows = [("d", [(1, "x", "a 2", target), (3, "x", "a", target), (2, "x", "A", target)])]
    df = spark.createDataFrame(rows, "dashboard string, panels array<struct<id: bigint, type: string, title: string, "
                               "targets: array<struct<refId: string, rawSql: string>>>>")
    names = [r.name for r in panels.panels_of(df).orderBy("position").collect()]
    assert names == ["a_2", "a", "a_2_2"]
