import math
import random

import pytest
from pyspark.sql import functions as F

from skyloom.functions import geo
from skyloom.operators import spatial

HOLED = '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[3,3],[7,3],[7,7],[3,7],[3,3]]]}'
CONCAVE = '{"type":"Polygon","coordinates":[[[-20,0],[-10,0],[-10,10],[-15,2],[-20,10]]]}'
MULTI = (
    '{"type":"MultiPolygon","coordinates":[[[[20,0],[22,0],[22,2],[20,2],[20,0]]],'
    '[[[5,5],[25,5],[25,6],[5,6],[5,5]]]]}'
)


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [("holed", HOLED), ("concave", CONCAVE), ("multi", MULTI), ("none", None), ("odd", '{"type":"Point"}')]
    return spark.createDataFrame(rows, "region_name string, geo_coords string")


def test_parse_points(spark):
    rows = [
        ("POINT(12.25 53.99)", "(9.5,47.3)", [9.5, 47.3]),
        (" point ( -1e1  .5 ) ", "[9.5, 47.3]", [1.0]),
        ("POINT(12.25)", "(1,2,3)", [1.0, 2.0, 3.0]),
        ("POINT(200 10)", "(x,2)", None),
        (None, None, []),
    ]
    df = spark.createDataFrame(rows, "wkt string, txt string, arr array<double>")
    out = df.select(
        geo.parse_wkt_point("wkt").alias("w"), geo.parse_point_text("txt").alias("t"),
        geo.point_from_array("arr").alias("a"),
    ).collect()
    as_pairs = [[tuple(p) if p else None for p in row] for row in out]
    assert as_pairs[0] == [(12.25, 53.99), (9.5, 47.3), (9.5, 47.3)]
    assert as_pairs[1] == [(-10.0, 0.5), (9.5, 47.3), None]
    assert as_pairs[2:] == [[None] * 3] * 3


def test_format_round_trip(spark):
    df = spark.createDataFrame([(12.25, 53.99), (None, 1.0)], "lon double, lat double")
    rows = df.select(geo.format_wkt_point("lon", "lat").alias("w")).collect()
    assert [r.w for r in rows] == ["POINT(12.25 53.99)", None]


@pytest.mark.parametrize(
    ("a", "b", "metres"),
    [
        ((0, 0), (1, 0), 111_195.08),
        ((179.5, 0), (-179.5, 0), 111_195.08),
        ((0, 90), (120, 90), 0.0),
        ((0, 0), (180, 0), math.pi * geo.EARTH_RADIUS_M),
        ((8.68, 50.11), (13.4, 52.52), 423_600.0),
    ],
)
def test_distance(spark, a, b, metres):
    lits = [F.lit(float(x)) for x in (*a, *b)]
    got = spark.range(1).select(geo.geo_distance(*lits).alias("d")).head().d
    assert got == pytest.approx(metres, rel=2e-3, abs=0.01)


def _inside(rings, lon, lat):
    crossings = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                crossings += 1
    return crossings % 2 == 1


RINGS = {
    "holed": [[(0, 0), (10, 0), (10, 10), (0, 10)], [(3, 3), (7, 3), (7, 7), (3, 7)]],
    "concave": [[(-20, 0), (-10, 0), (-10, 10), (-15, 2), (-20, 10)]],
    "multi": [[(20, 0), (22, 0), (22, 2), (20, 2)], [(5, 5), (25, 5), (25, 6), (5, 6)]],
}


@pytest.fixture(scope="module")
def cloud(spark):
    rng = random.Random(3)
    points = [(round(rng.uniform(-25, 30), 3), round(rng.uniform(-3, 13), 3)) for _ in range(600)]
    points += [(5.5, 5.5), (0.0, 5.0), (-15.0, 2.0), (21.0, 2.0), (21.0, 0.0), (6.0, 10.0), (-15.0, 1.999)]
    points += [(None, 5.0), (float("nan"), 5.0), (5.0, 400.0), (float("inf"), 5.0)]
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lon double, lat double")


def _expected(rows):
    pairs = set()
    for r in rows:
        if r.lon is not None and math.isfinite(r.lon) and abs(r.lat) <= 90:
            pairs |= {(r.id, name) for name, rings in RINGS.items() if _inside(rings, r.lon, r.lat)}
    return pairs


@pytest.mark.parametrize("strategy", ["auto", "grid"])
@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_within_join_is_ray_casting(spark, shapes, cloud, strategy, cell):
    edges = spatial.polygon_edges(shapes, "region_name", "geo_coords")
    got = spatial.within_join(cloud, edges, strategy=strategy, cell_deg=cell, band_deg=cell / 3).collect()
    assert len(got) == len({(r.id, r.region_name) for r in got})
    assert {(r.id, r.region_name) for r in got} == _expected(cloud.collect())


def test_within_expression_agrees(spark, shapes, cloud):
    for name, text in (("holed", HOLED), ("concave", CONCAVE), ("multi", MULTI)):
        rings = geo.shape_rings(F.lit(text))
        got = cloud.select("id", geo.within("lon", "lat", rings).alias("i")).where("i").collect()
        assert {r.id for r in got} == {i for i, n in _expected(cloud.collect()) if n == name}


def test_semi_and_anti_split_the_points(spark, shapes, cloud):
    edges = spatial.polygon_edges(shapes, "region_name", "geo_coords")
    located = spatial.locate_regions(cloud, edges)
    inside = spatial.within_semi(cloud, located=located)
    outside = spatial.outside_anti(cloud, located=located)
    inside_ids, outside_ids = [r.id for r in inside.collect()], [r.id for r in outside.collect()]
    assert sorted(inside_ids + outside_ids) == list(range(cloud.count()))
    assert set(inside_ids) == {i for i, _ in _expected(cloud.collect())}
    one = spatial.within_semi(cloud, located=located, region="multi").collect()
    assert {r.id for r in one} == {i for i, n in _expected(cloud.collect()) if n == "multi"}
    assert spatial.within_semi(cloud, located=located, region="Germany").count() == 0


def test_edges_close_the_ring_and_skip_other_types(spark, shapes):
    edges = spatial.polygon_edges(shapes, "region_name", "geo_coords").collect()
    counts = {}
    for e in edges:
        counts[e.region_name] = counts.get(e.region_name, 0) + 1
    assert counts == {"holed": 8, "concave": 5, "multi": 8}


def test_unknown_strategy(spark, shapes, cloud):
    edges = spatial.polygon_edges(shapes, "region_name", "geo_coords")
    with pytest.raises(ValueError):
        spatial.locate_regions(cloud, edges, strategy="magic")
    with pytest.raises(ValueError):
        spatial.within_join(cloud)


def _metres(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [1.0, 40_000.0, 900_000.0, 30_000_000.0])
def test_proximity_batch_is_brute_force(spark, radius):
    rng = random.Random(11)
    spots = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(150)]
    spots += [(179.99, 10.0), (-179.99, 10.0), (180.0, 10.1), (-180.0, 10.1), (0.0, 89.9), (180.0, 89.9), (5.0, 90.0),
              (77.0, -90.0), (0.0, -89.99), (10.0, 50.0), (10.0, 50.0)]
    readings = [(t, *s, rng.choice([None, round(rng.uniform(250, 310), 2)])) for s in spots for t in (1, 2)]
    probes = [(i, *s, rng.choice([1, 2, 3])) for i, s in enumerate(spots[100:])]
    df = spark.createDataFrame(readings, "measurement_time int, lon double, lat double, temperature double")
    asked = spark.createDataFrame(probes, "probe_id int, lon double, lat double, probe_time int")
    got = {r.probe_id: (r.min_t, r.max_t) for r in
           spatial.proximity_batch(df, asked, radius).collect()}
    for i, lon, lat, t in probes:
        near = [v for rt, x, y, v in readings if rt == t and v is not None and _metres((lon, lat), (x, y)) < radius]
        assert got[i] == ((min(near), max(near)) if near else (None, None))
    assert len(got) == len(probes)


@pytest.mark.parametrize(
    ("lon", "lat"), [(10.0, 50.0), (179.95, 10.0), (-179.95, -10.0), (3.0, 89.95), (0.0, -90.0)]
)
def test_distance_filter_is_brute_force(spark, lon, lat):
    rng = random.Random(5)
    spots = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)]
    spots += [(lon + rng.uniform(-1, 1), max(-90.0, min(90.0, lat + rng.uniform(-1, 1)))) for _ in range(300)]
    spots = [((x + 180) % 360 - 180, y) for x, y in spots]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id int, lon double, lat double")
    for radius in (1.0, 50_000.0, 3_000_000.0):
        got = {r.id for r in spatial.distance_filter(df, lon, lat, radius).collect()}
        assert got == {i for i, s in enumerate(spots) if _metres((lon, lat), s) < radius}


def test_proximity_of_nothing_is_one_row_of_nulls(spark):
    df = spark.createDataFrame([], "measurement_time timestamp_ntz, lon double, lat double, temperature double")
    assert spatial.proximity_minmax(df, 1.0, 2.0, "2024-01-01").collect() == [(None, None)]


def test_location_join_ignores_quantisation_noise(spark):
    readings = spark.createDataFrame([(8.999999966472387, 53.0, 1)], "lon double, lat double, id int")
    points = spark.createDataFrame([(9.0, 53.0, "Town")], "lon double, lat double, nearest_town string")
    assert spatial.location_join(readings, points).head().nearest_town == "Town"


def test_location_join_across_a_half_micro_degree(spark):
    points = spark.createDataFrame(
        [(8.1234565001, 50.0, "Town"), (1.0, 1.0, "Else")], "lon double, lat double, nearest_town string"
    )
    readings = spark.createDataFrame(
        [(8.1234564999, 50.0), (8.1234575001, 50.0), (8.1234585, 50.0), (None, 50.0)], "lon double, lat double"
    )
    found = {r.lon: r.nearest_town for r in spatial.location_join(readings, points, "left").collect()}
    assert found == {8.1234564999: "Town", 8.1234575001: "Town", 8.1234585: None, None: None}
    assert spatial.location_join(readings, points).count() == 2


def test_shapes_without_a_boundary_are_reported(spark, shapes):
    odd = spark.createDataFrame(
        [("feature", '{"type": "Feature", "geometry": {}}'), ("wkt", "POLYGON((0 0, 1 1, 1 0))"), ("none", None),
         ("line", '{"type": "Polygon", "coordinates": [[[0, 0], [1, 1]]]}')],
        "region_name string, geo_coords string",
    )
    bad = spatial.rejected_shapes(shapes.select("region_name", "geo_coords").union(odd), "geo_coords")
    assert {r.region_name for r in bad.collect()} == {"feature", "wkt", "none", "line", "odd"}


def test_new_locations_are_added_to_a_stored_table(spark, shapes, cloud):
    edges = spatial.polygon_edges(shapes, "region_name", "geo_coords")
    whole = {tuple(r) for r in spatial.locate_regions(cloud, edges).collect()}
    some = spatial.locate_regions(cloud.where("id % 2 = 0"), edges)
    more = spatial.update_located(some, cloud, edges)
    assert {tuple(r) for r in some.union(more).collect()} == whole
