"""The registered queries: each operator over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.functions import geo, scalar, text
from skyloom.functions.sql import register_sql_functions
from skyloom.operators import fulltext, ranking, spatial, stats, vectors, weather
from skyloom.operators.joins import materialize
from skyloom.plans import inputs, panels
from skyloom.session import new_work_path
from skyloom.sources import tables
from skyloom.sources.schemas import DATA

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, repeated in their SQL twins.
T_FROM, T_TO = "2024-01-05", "2024-01-20"
AT = "2024-01-10"
POINT_LON, POINT_LAT = 7.75, 49.25
CENTRE_LON, CENTRE_LAT = 10.0, 50.0
TEXT_COLUMNS = list(fulltext.TEXT_COLUMNS)

QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(c: Column | str, name: str | None = None, digits: int = 6) -> Column:
    return F.round(c, digits).alias(name or c)


# Locations and points


@register
def region_snapshot(spark, sf):
    df = weather.region_snapshot(
        inputs.readings(spark, sf), inputs.edges(spark), inputs.geo_points(spark, sf), "Concave"
    )
    return df.withColumn("temperature", _r("temperature"))


@register
def region_snapshot_all(spark, sf):
    df = weather.region_snapshot_all(
        inputs.readings(spark, sf), inputs.edges(spark), inputs.geo_points(spark, sf)
    )
    return df.withColumn("temperature", _r("temperature"))


@register
def within_join(spark, sf):
    df = spatial.within_join(inputs.readings(spark, sf), inputs.edges(spark))
    return df.select("event_id", "region_name")


@register
def within_join_grid(spark, sf):
    df = spatial.within_join(inputs.readings(spark, sf), inputs.edges(spark), strategy="grid")
    return df.select("event_id", "region_name")


@register
def within_semi(spark, sf):
    return spatial.within_semi(inputs.readings(spark, sf), inputs.edges(spark)).select("event_id")


@register
def outside_anti(spark, sf):
    return spatial.outside_anti(inputs.readings(spark, sf), inputs.edges(spark)).select("event_id")


@register
def location_join(spark, sf):
    df = spatial.location_join(inputs.readings(spark, sf), inputs.geo_points(spark, sf))
    return df.select("event_id", "nearest_town")


@register
def polygon_edges(spark, sf):
    """Boundaries derived from the customers: a square each, every third one with a second part."""
    key = F.col("c_custkey").cast("string")
    square = F.concat(
        F.lit("[[["), key, F.lit(",1],["), key, F.lit(",2],[0,2],[0,1]]"), F.lit("]")
    )
    shape = F.when(
        F.col("c_custkey") % 3 == 0,
        F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), square, F.lit(","), square, F.lit("]}")),
    ).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), square, F.lit("}")))
    shapes = inputs.table(spark, sf, "customer").select("c_custkey", shape.alias("shape"))
    edges = spatial.polygon_edges(shapes, "c_custkey", "shape")
    return edges.withColumn("ring", F.col("ring").cast("int")).withColumn("edge", F.col("edge").cast("int"))


@register
def point_in_polygon(spark, sf):
    rings = geo.shape_rings(F.lit(inputs._geojson("Holed")))
    df = inputs.readings(spark, sf)
    return df.select("event_id", geo.within("lon", "lat", rings).alias("inside"))


@register
def geo_distance(spark, sf):
    metres = geo.geo_distance("lon", "lat", F.lit(CENTRE_LON), F.lit(CENTRE_LAT))
    return inputs.readings(spark, sf).select("event_id", _r(metres, "metres", 3))


@register
def distance_filter(spark, sf):
    df = spatial.distance_filter(inputs.readings(spark, sf), CENTRE_LON, CENTRE_LAT, 150_000.0)
    return df.select("event_id")


@register
def parse_wkt_point(spark, sf):
    wkt = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("POINT("), F.col("event_type"), F.lit(" 1)")))
    df = inputs.readings(spark, sf)
    point = geo.parse_wkt_point(F.coalesce(wkt, geo.format_wkt_point("lon", "lat")))
    return df.select("event_id", geo.longitude(point).alias("lon"), geo.latitude(point).alias("lat"))


@register
def format_wkt_point(spark, sf):
    return inputs.readings(spark, sf).select("event_id", geo.format_wkt_point("lon", "lat").alias("wkt"))


@register
def parse_point_text(spark, sf):
    lon, lat = F.col("lon").cast("string"), F.col("lat").cast("string")
    form = F.col("event_id") % 4
    shown = (
        F.when(form == 0, F.concat(F.lit("("), lon, F.lit(","), lat, F.lit(")")))
        .when(form == 1, F.concat(F.lit("["), lon, F.lit(", "), lat, F.lit("]")))
        .when(form == 2, F.concat(F.lit("("), lon, F.lit(","), lat, F.lit(",1)")))
        .otherwise(F.concat(F.lit("("), F.col("event_type"), F.lit(","), lat, F.lit(")")))
    )
    point = geo.parse_point_text(shown)
    df = inputs.readings(spark, sf)
    return df.select("event_id", geo.longitude(point).alias("lon"), geo.latitude(point).alias("lat"))


@register
def proximity_minmax(spark, sf):
    df = spatial.proximity_minmax(inputs.readings(spark, sf), POINT_LON, POINT_LAT, AT)
    return df.select(_r("min_t"), _r("max_t"))


def _probes(spark, sf):
    """One probe per customer; some lie off the sensor grid or after the last day."""
    key = F.col("c_custkey")
    return inputs.table(spark, sf, "customer").select(
        key.alias("probe_id"),
        (F.lit(5.75) + F.lit(0.25) * (key % 41)).alias("lon"),
        (F.lit(47.25) + F.lit(0.25) * (key % 31)).alias("lat"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 35).cast("int")).cast("timestamp_ntz").alias("probe_time"),
    )


@register
def proximity_batch(spark, sf):
    df = spatial.proximity_batch(inputs.readings(spark, sf), _probes(spark, sf), 30_000.0)
    return df.select("probe_id", "lon", "lat", "probe_time", _r("min_t"), _r("max_t"))


@register
def proximity_batch_exact_point(spark, sf):
    df = spatial.proximity_batch(inputs.readings(spark, sf), _probes(spark, sf), 1.0)
    return df.select("probe_id", "lon", "lat", "probe_time", _r("min_t"), _r("max_t"))


@register
def proximity_batch_shuffled(spark, sf):
    """The probes by a shuffle, whatever their size."""
    probes = _probes(spark, sf).hint("shuffle_merge")
    df = spatial.proximity_batch(inputs.readings(spark, sf), probes, 30_000.0)
    return df.select("probe_id", "lon", "lat", "probe_time", _r("min_t"), _r("max_t"))


@register
def sample_probes(spark, sf):
    return stats.sample_probes(inputs.readings(spark, sf), 200, seed=7)


@register
def distinct_locations(spark, sf):
    return spatial.distinct_locations(inputs.readings(spark, sf))


@register
def distinct_times(spark, sf):
    return weather.distinct_times(inputs.readings(spark, sf))


@register
def region_names(spark, sf):
    return weather.region_names(inputs.region_texts(spark, sf))


# Time and region filters


@register
def time_equals(spark, sf):
    return weather.time_equals(inputs.readings(spark, sf), "measurement_time", AT).select("event_id")


@register
def time_range(spark, sf):
    df = weather.time_range(inputs.readings(spark, sf), "reading_ts", T_FROM, T_TO)
    return df.select("event_id", "reading_ts")


@register
def region_or_all(spark, sf):
    texts = inputs.region_texts(spark, sf)
    one, every = weather.region_or_all(texts, "R7"), weather.region_or_all(texts, "ALL")
    none = weather.region_or_all(texts, "Germany")
    parts = [df.select(F.lit(k).alias("asked"), "region_name") for k, df in
             (("one", one), ("every", every), ("none", none))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def latest_epoch(spark, sf):
    return weather.latest_epoch(inputs.readings(spark, sf)).select("event_id", "measurement_time")


@register
def latest_epoch_in_range(spark, sf):
    df = weather.latest_epoch_in_range(inputs.readings(spark, sf), T_FROM, T_TO)
    return df.select("event_id", "measurement_time")


@register
def last_measurement_time(spark, sf):
    return weather.last_measurement_time(inputs.readings(spark, sf), T_FROM, T_TO, "reading_ts")


# Scalar functions


@register
def nested_field(spark, sf):
    data = F.struct("temperature", "pressure", "u10", "v10")
    df = inputs.readings(spark, sf).select("event_id", data.alias("data"))
    return df.select("event_id", _r(scalar.nested_field("data", "temperature"), "temperature"))


@register
def kelvin_to_celsius(spark, sf):
    df = inputs.readings(spark, sf)
    return df.select("event_id", _r(scalar.kelvin_to_celsius("temperature"), "celsius"))


@register
def temperature_label(spark, sf):
    return inputs.readings(spark, sf).select("event_id", scalar.temperature_label("temperature").alias("label"))


@register
def wind_speed(spark, sf):
    return inputs.readings(spark, sf).select("event_id", _r(scalar.wind_speed("u10", "v10"), "wind_speed"))


@register
def wind_direction(spark, sf):
    direction = scalar.wind_direction("u10", "v10")
    return inputs.readings(spark, sf).select("event_id", _r(direction, "wind_direction", 4))


@register
def normalize_query_text(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return docs.select("doc_id", scalar.normalize_query_text("text").alias("query_text"))


def _titles(spark, sf):
    """A panel title per part: plain words, a variable, brackets."""
    title = F.concat(
        F.col("p_name"), F.lit(" for $"), F.col("p_type"), F.lit(", ${"), F.col("p_size").cast("string"), F.lit("} !")
    )
    return inputs.table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 50 != 0, title).otherwise("?!").alias("title")
    )


@register
def slugify(spark, sf):
    return _titles(spark, sf).select("p_partkey", scalar.slugify("title").alias("slug"))


@register
def dedupe_slug(spark, sf):
    slugs = _titles(spark, sf).select("p_partkey", scalar.slugify("title").alias("slug"))
    return panels.dedupe_slug(slugs, "slug", "p_partkey", "p_partkey").select("p_partkey", "name")


# Region series, snapshots, rankings


def _series(spark, sf, metric, region):
    df = weather.minavgmax_for_region(
        inputs.readings(spark, sf), inputs.edges(spark), metric, region, T_FROM, T_TO
    )
    return df.select("time", _r("min_value"), _r("avg_value"), _r("max_value"))


@register
def minavgmax_temperature(spark, sf):
    return _series(spark, sf, "temperature", "Concave")


@register
def minavgmax_pressure(spark, sf):
    return _series(spark, sf, "pressure", "Holed")


@register
def minavgmax_wind_speed_all(spark, sf):
    return _series(spark, sf, "wind_speed", "ALL")


@register
def minavgmax_total(spark, sf):
    df = weather.minavgmax_total(
        inputs.readings(spark, sf), inputs.edges(spark), "temperature", "ALL", T_FROM, T_TO
    )
    return df.select(_r("min_value"), _r("avg_value"), _r("max_value"))


def _snapshot(spark, sf, metric, region):
    return weather.metric_snapshot(
        inputs.readings(spark, sf), inputs.edges(spark), inputs.geo_points(spark, sf),
        metric, region, T_FROM, T_TO,
    )


@register
def snapshot_temperature(spark, sf):
    return _snapshot(spark, sf, "temperature", "ALL").withColumn("temperature", _r("temperature"))


@register
def snapshot_pressure(spark, sf):
    return _snapshot(spark, sf, "pressure", "Holed").withColumn("pressure", _r("pressure"))


@register
def snapshot_wind(spark, sf):
    df = _snapshot(spark, sf, "wind", "ALL").withColumn("wind_speed", _r("wind_speed"))
    return df.withColumn("wind_direction", _r("wind_direction", digits=4))


@register
def latest_gauge(spark, sf):
    df = weather.latest_gauge(
        inputs.readings(spark, sf), inputs.edges(spark), "temperature", "ALL", T_FROM, T_TO
    )
    return df.select("time", _r("avg_value"))


@register
def extreme_place(spark, sf):
    df = weather.extreme_place(
        inputs.readings(spark, sf), inputs.edges(spark), inputs.geo_points(spark, sf),
        "temperature", "coldest", T_FROM, T_TO,
    )
    return df.withColumn("value", _r("value")).withColumn("celsius", _r("celsius"))


@register
def rank_places(spark, sf):
    df = weather.rank_places(
        inputs.readings(spark, sf), inputs.edges(spark), inputs.geo_points(spark, sf),
        "wind_speed", "highest", 10, T_FROM, T_TO,
    )
    return df.withColumn("value", _r("value"))


@register
def daily_avg_at_location(spark, sf):
    df = weather.daily_avg_at_location(
        inputs.readings(spark, sf), POINT_LAT, POINT_LON, "wind_speed", T_FROM, T_TO, time_col="reading_ts"
    )
    return df.select("day", _r("avg_value"))


@register
def hourly_agg(spark, sf):
    df = weather.hourly_agg(inputs.readings(spark, sf), "temperature", "reading_ts")
    return df.select("hour", "n", _r("min_value"), _r("avg_value", digits=7), _r("max_value"))


# Tables


@register
def load_tables(spark, sf):
    """Readings written as JSON lines with an undeclared key, then loaded back."""
    path = new_work_path(spark, "load")
    df = inputs.readings(spark, sf)
    data = F.struct(
        "temperature", "pressure", "u10", "v10",
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "event_type", "event_id",
    )
    odd = F.col("event_id") % 2 == 1
    exported = df.select(
        F.date_format("measurement_time", "yyyy-MM-dd HH:mm:ss").alias("measurement_time"),
        F.when(odd, geo.format_wkt_point("lon", "lat")).otherwise(
            F.concat(F.lit("["), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
        ).alias("geo_location"),
        data.alias("data"),
    )
    exported.write.json(f"{path}/climate_data.json")
    towns = inputs.geo_points(spark, sf)
    towns.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "nearest_town").write.json(
        f"{path}/geo_points.json"
    )
    inputs.regions(spark).write.json(f"{path}/german_regions.json")
    loaded = tables.load_tables(spark, path)
    flat = loaded["climate_data"].select(
        "measurement_time",
        F.col("geo_location.lon").alias("lon"),
        F.col("geo_location.lat").alias("lat"),
        F.col("data.temperature").alias("temperature"),
        F.try_variant_get("data_extra", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("data_extra", "$.event_type", "string").alias("event_type"),
    )
    named = spatial.location_join(flat, tables.flatten_points(loaded["geo_points"]))
    return named.select(
        "event_id", "event_type", "measurement_time", "lon", "lat", _r("temperature"), "nearest_town"
    )


@register
def dynamic_object(spark, sf):
    """Event properties as a nested object with an undeclared key."""
    data = F.to_json(F.struct(F.col("value").alias("temperature"), F.col("event_type").alias("kind")))
    text_or_bad = F.when(F.col("event_id") % 13 == 0, F.lit("no json")).otherwise(data)
    df = inputs.table(spark, sf, "events").select("event_id", text_or_bad.alias("data"))
    df = tables.dynamic_object(df, "data", DATA)
    return df.select(
        "event_id",
        F.col("data.temperature").alias("temperature"),
        F.col("data.pressure").alias("pressure"),
        F.try_variant_get("data_extra", "$.kind", "string").alias("kind"),
    )


def _keyed(spark, sf):
    key = F.when(F.col("event_id") % 101 != 0, F.col("user_id"))
    return inputs.table(spark, sf, "events").select(key.alias("user_id"), "event_type", "ts", "event_id", "value")


@register
def enforce_key_kept(spark, sf):
    return tables.enforce_key(_keyed(spark, sf), ["user_id", "event_type"], ["ts"])[0]


@register
def enforce_key_rejected(spark, sf):
    return tables.enforce_key(_keyed(spark, sf), ["user_id", "event_type"], ["ts"])[1]


@register
def preview(spark, sf):
    df = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    shown = ranking.preview(df, 50, ["o_orderkey"])
    return shown.withColumn("omitted_rows", F.col("omitted_rows").cast("bigint"))


# Full text


def _index(spark, sf, columns=TEXT_COLUMNS):
    return fulltext.build_postings(inputs.region_texts(spark, sf), "region_id", columns).materialize()


@register
def analyze_english(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    terms = docs.select("doc_id", F.posexplode(text.analyze_english("text")).alias("pos", "term"))
    return terms.withColumn("pos", F.col("pos").cast("int"))


@register
def build_postings(spark, sf):
    index = fulltext.build_postings(inputs.region_texts(spark, sf), "region_id", TEXT_COLUMNS)
    return index.postings.select("doc", "column", "term", "tf", F.col("doc_len").cast("bigint").alias("doc_len"))


@register
def index_columns(spark, sf):
    columns = _index(spark, sf).columns
    return columns.select("column", "n_docs", _r("avg_len"))


@register
def match_bm25(spark, sf):
    return fulltext.match_bm25(_index(spark, sf, ["economics"]), "economics", "tion ther thon")


@register
def match_bm25_multi(spark, sf):
    return fulltext.match_bm25_multi(_index(spark, sf), TEXT_COLUMNS, "Tion erin")


@register
def match_bm25_sum(spark, sf):
    return fulltext.match_bm25_multi(_index(spark, sf), TEXT_COLUMNS, "Tion erin", combine="sum")


@register
def fts_topk(spark, sf):
    return fulltext.fts_topk(fulltext.match_bm25(_index(spark, sf, ["economics"]), "economics", "thon"), 3)


@register
def ranked_result(spark, sf):
    texts = inputs.region_texts(spark, sf)
    hits = fulltext.match_bm25_multi(_index(spark, sf), TEXT_COLUMNS, "tion ther")
    named = texts.select(F.col("region_id").alias("doc"), "region_name")
    return ranking.ranked_result(hits.join(named, "doc"), "region_name", 5)


@register
def match_batch(spark, sf):
    return fulltext.match_batch(_index(spark, sf, ["economics"]), "economics", inputs.text_queries(spark), 3)


@register
def match_batch_shuffled(spark, sf):
    """The queries by a shuffle, whatever their size."""
    queries = inputs.text_queries(spark).hint("shuffle_merge")
    return fulltext.match_batch(_index(spark, sf, ["economics"]), "economics", queries, 3)


@register
def keyword_relevance(spark, sf):
    texts = inputs.region_texts(spark, sf)
    return fulltext.keyword_relevance(texts, _index(spark, sf, ["economics"]), "economics", "ther", "region_id")


@register
def keyword_relevance_name(spark, sf):
    texts = inputs.region_texts(spark, sf)
    index = fulltext.build_postings(texts, "region_id", ["economics"])
    return fulltext.keyword_relevance(texts, index, "region_name", "R9", "region_id")


@register
def category_for_region(spark, sf):
    return fulltext.category_for_region(inputs.region_texts(spark, sf), "transportation")


# Vectors


def _query_vector(spark, sf):
    vector = inputs.table(spark, sf, "embeddings").where(F.col("vec_id") == 42).select("embedding")
    return vector.head().embedding


@register
def knn_exact(spark, sf):
    df = inputs.table(spark, sf, "embeddings")
    return vectors.knn_exact(df, "vec_id", "embedding", _query_vector(spark, sf), 5)


@register
def knn_exact_cosine(spark, sf):
    df = inputs.region_texts(spark, sf)
    return vectors.knn_exact(df, "region_id", "embedding", _query_vector(spark, sf), 10, "cosine")


@register
def knn_batch(spark, sf):
    df, queries = inputs.table(spark, sf, "embeddings"), inputs.vector_queries(spark, sf)
    return vectors.knn_batch(df, "vec_id", "embedding", queries, 5)


@register
def knn_batch_blocks(spark, sf):
    """Every vector as a query, in chunks of 1 MB: many chunk pairs."""
    df = inputs.table(spark, sf, "embeddings")
    queries = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return vectors.knn_batch(df, "vec_id", "embedding", queries, 3, chunk_bytes=1 << 20)


def _ann(spark, sf):
    df = inputs.table(spark, sf, "embeddings")
    model = vectors.fit_lsh(df, "embedding")
    buckets = vectors.lsh_buckets(model, df, "vec_id", "embedding")
    return vectors.knn_ann(model, buckets, inputs.vector_queries(spark, sf), 5)


@register
def knn_ann(spark, sf):
    return _ann(spark, sf)


@register
def recall_at_k(spark, sf):
    return vectors.recall_at_k(_ann(spark, sf), knn_batch(spark, sf))


@register
def count_non_null(spark, sf):
    return vectors.count_non_null(inputs.region_texts(spark, sf), "embedding")


@register
def embed_text(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return vectors.embed_text(docs, "text", 64).select("doc_id", "embedding")


# Percentiles


@register
def percentile_summary(spark, sf):
    df = stats.percentile_summary(inputs.latencies(spark, sf), "query_type", "latency_ms")
    return df.select("query_type", "n", *[_r(c) for c in ("avg", "p50", "p99", "p999")], "max")


@register
def percentile_summary_sketch(spark, sf):
    return stats.percentile_summary(inputs.latencies(spark, sf), "query_type", "latency_ms", exact=False)


@register
def percentile_curve(spark, sf):
    df = stats.percentile_curve(inputs.latencies(spark, sf), "query_type", "latency_ms")
    return df.select("query_type", "percentile", *[_r(c) for c in ("tail", "log_tail", "value")])


@register
def log_histogram(spark, sf):
    return stats.log_histogram(inputs.latencies(spark, sf), "query_type", "latency_ms")


@register
def merge_histograms(spark, sf):
    df = inputs.latencies(spark, sf)
    low, high = df.where("latency_ms < 300"), df.where("latency_ms >= 300")
    parts = [stats.log_histogram(d, "query_type", "latency_ms") for d in (low, high)]
    return stats.merge_histograms("query_type", *parts)


@register
def histogram_percentiles(spark, sf):
    histogram = stats.log_histogram(inputs.latencies(spark, sf), "query_type", "latency_ms")
    return stats.histogram_percentiles(histogram, "query_type")


# Panels


def _dashboards(spark, sf):
    """A dashboard document per event: a row header and three panels, two of the same title."""
    target = "struct<refId:string,rawSql:string>"

    def sql(text: Column) -> Column:
        return F.struct(F.lit("B").alias("refId"), text.alias("rawSql")).cast(target)

    def panel(number, kind, title, *targets):
        return F.struct(
            F.lit(number).cast("bigint").alias("id"), F.lit(kind).alias("type"), title.alias("title"),
            F.array(*targets).cast(f"array<{target}>").alias("targets"),
        )

    kind = F.col("event_type")
    filtered = F.concat(
        F.lit("SELECT "), kind, F.lit(" FROM t WHERE $__timeFilter(\"ts\") AND r = '$region' AND x > ${latitude}")
    )
    title = F.concat(F.lit("Average "), kind, F.lit(" for ${region}"))
    nothing = F.lit(None).cast("string")
    array = F.array(
        panel(1, "row", F.lit("Change over time")),
        panel(2, "timeseries", title, sql(nothing), sql(filtered)),
        panel(3, "gauge", title, sql(F.lit("SELECT ${other}, $region_name, $keyword, $keyword"))),
        panel(4, "geomap", nothing, sql(F.lit("SELECT 1"))),
        panel(5, "text", F.lit("Notes"), sql(F.lit(""))),
    )
    return inputs.table(spark, sf, "events").select(F.col("event_id").alias("dashboard"), array.alias("panels"))


@register
def load_panels(spark, sf):
    df = panels.panels_of(_dashboards(spark, sf))
    return df.withColumn("position", F.col("position").cast("int"))


@register
def panel_variables(spark, sf):
    return panels.panel_variables(panels.panels_of(_dashboards(spark, sf)))


@register
def panel_query(spark, sf):
    """A templated panel run with named parameters over registered tables."""
    inputs.readings(spark, sf).createOrReplaceTempView("climate_data")
    sql = (
        "SELECT event_type AS kind, measurement_time AS time, min(temperature) AS min_t, count(*) AS n "
        "FROM climate_data WHERE $__timeFilter(\"measurement_time\") AND lat < $latitude "
        "AND ('$region' = 'ALL' OR event_type = '${region}') GROUP BY event_type, measurement_time"
    )
    df = panels.panel_query(spark, sql, region="ALL", latitude=51, time_from=T_FROM, time_to=T_TO)
    return df.withColumn("min_t", _r("min_t"))


@register
def panel_query_column(spark, sf):
    """A panel whose variable is the column to search."""
    inputs.region_texts(spark, sf).createOrReplaceTempView("german_regions")
    sql = (
        "SELECT region_name, length($search_categories) AS chars FROM german_regions "
        "WHERE contains($search_categories, '$keyword')"
    )
    df = panels.panel_query(spark, sql, search_categories="economics", keyword="tion")
    return df.withColumn("chars", F.col("chars").cast("bigint"))


@register
def query_sql(spark, sf):
    inputs.readings(spark, sf).createOrReplaceTempView("climate_data")
    return panels.query_sql(
        spark,
        "SELECT event_type, count(*) AS n, max(measurement_time) AS latest FROM climate_data "
        "WHERE lon >= :west GROUP BY event_type",
        {"west": 8.0},
    )


# The same over tables stored by date, which read the dates they need only

DATE = "measurement_date"


def _stored(spark, sf):
    """Readings partitioned by date, and the regions of their locations."""
    path = new_work_path(spark, "readings")
    tables.write_readings(inputs.readings(spark, sf), path, files_per_day=1)
    stored = spark.read.parquet(path)
    return stored, materialize(spatial.locate_regions(stored, inputs.edges(spark)), "located")


@register
def stored_region_snapshot(spark, sf):
    readings, located = _stored(spark, sf)
    points = inputs.geo_points(spark, sf)
    df = weather.region_snapshot(readings, None, points, "Concave", located, DATE)
    return df.withColumn("temperature", _r("temperature"))


@register
def stored_minavgmax_temperature(spark, sf):
    readings, located = _stored(spark, sf)
    df = weather.minavgmax_for_region(readings, None, "temperature", "Concave", T_FROM, T_TO, located, DATE)
    return df.select("time", _r("min_value"), _r("avg_value"), _r("max_value"))


@register
def stored_snapshot_temperature(spark, sf):
    readings, located = _stored(spark, sf)
    points = inputs.geo_points(spark, sf)
    df = weather.metric_snapshot(readings, None, points, "temperature", "ALL", T_FROM, T_TO, located, DATE)
    return df.withColumn("temperature", _r("temperature"))


@register
def stored_rank_places(spark, sf):
    readings, located = _stored(spark, sf)
    points = inputs.geo_points(spark, sf)
    df = weather.rank_places(
        readings, None, points, "wind_speed", "highest", 10, T_FROM, T_TO, located, DATE
    )
    return df.withColumn("value", _r("value"))


@register
def stored_proximity_minmax(spark, sf):
    readings, _ = _stored(spark, sf)
    df = spatial.proximity_minmax(readings, POINT_LON, POINT_LAT, AT, partition_col=DATE)
    return df.select(_r("min_t"), _r("max_t"))


@register
def stored_proximity_batch(spark, sf):
    readings, _ = _stored(spark, sf)
    df = spatial.proximity_batch(readings, _probes(spark, sf), 30_000.0, partition_col=DATE)
    return df.select("probe_id", "lon", "lat", "probe_time", _r("min_t"), _r("max_t"))


@register
def sql_geo_point(spark, sf):
    """The SQL names on good points, points off the globe and texts that are none."""
    register_sql_functions(spark)
    odd = F.when(F.col("event_id") % 11 == 0, "nope").when(F.col("event_id") % 13 == 0, "POINT(200 95)")
    texts = inputs.readings(spark, sf).select(
        "event_id", F.coalesce(odd, geo.format_wkt_point("lon", "lat")).alias("wkt")
    )
    return texts.selectExpr(
        "event_id", "longitude(geo_point(wkt)) AS lon", "latitude(geo_point(wkt)) AS lat",
        "geo_point(wkt) IS NULL AS missing",
    )
