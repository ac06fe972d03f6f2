"""The library's tables derived from the given ones: readings, named points, regions, region texts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.operators.spatial import polygon_edges

# Region boundaries for the derived tables, fixed values. Vertices lie off the quarter-degree grid.
REGION_RINGS = {
    "Concave": [[[(6.1, 47.1), (12.1, 47.1), (12.1, 52.1), (9.1, 49.2), (6.1, 52.1)]]],
    "Holed": [
        [
            [(9.1, 50.1), (14.9, 50.1), (14.9, 54.9), (9.1, 54.9)],
            [(11.1, 51.1), (13.1, 51.1), (13.1, 53.1), (11.1, 53.1)],
        ]
    ],
    "Islands": [
        [[(5.6, 53.1), (7.1, 53.1), (7.1, 54.6), (5.6, 54.6)]],
        [[(7.6, 53.1), (8.6, 53.1), (8.6, 54.6), (7.6, 54.6)]],
    ],
    "Empty": [[[(20.1, 60.1), (21.1, 60.1), (21.1, 61.1)]]],
}

TEXT_QUERIES = {
    "q1": "tion ther", "q2": "thon", "q3": "Erin thble that", "q4": "absentterm", "q5": "that with",
}


def _geojson(name: str) -> str:
    polygons = [[[*ring, ring[0]] for ring in rings] for rings in REGION_RINGS[name]]
    if len(polygons) == 1:
        return json.dumps({"type": "Polygon", "coordinates": polygons[0]})
    return json.dumps({"type": "MultiPolygon", "coordinates": polygons})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; a user is a sensor on a quarter-degree grid."""
    user, event, value = F.col("user_id"), F.col("event_id"), F.col("value")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("timestamp_ntz").alias("measurement_time"),
        F.col("ts").alias("reading_ts"),
        (F.lit(5.75) + F.lit(0.25) * (user % 37)).alias("lon"),
        (F.lit(47.25) + F.lit(0.25) * (user % 29)).alias("lat"),
        F.when(event % 97 != 0, F.lit(268.15) + F.lit(0.1) * value).alias("temperature"),
        (F.lit(101325.0) - F.lit(10.0) * value).alias("pressure"),
        (F.lit(0.5) * ((event % 41) - 20)).alias("u10"),
        (F.lit(0.5) * ((event % 29) - 14)).alias("v10"),
        "event_id",
        "event_type",
    )


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    users = table(spark, sf_dir, "events").select(user).distinct()
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("_n"), "n_name")
    towns = users.withColumn("_n", user % 25).join(nations, "_n")
    return towns.groupBy(
        (F.lit(5.75) + F.lit(0.25) * (user % 37)).alias("lon"),
        (F.lit(47.25) + F.lit(0.25) * (user % 29)).alias("lat"),
    ).agg(F.min(F.concat(F.lit("Town_"), "n_name")).alias("nearest_town"))


def regions(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', '{_geojson(name)}')" for name in REGION_RINGS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(region_name, geo_coords)")


def edges(spark: SparkSession) -> DataFrame:
    return polygon_edges(regions(spark), "region_name", "geo_coords")


def region_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four text columns per region from four documents, and its vector where there is one."""
    docs = table(spark, sf_dir, "documents")
    names = ["tourism_info", "transportation", "economics", "introduced_species"]
    texts = docs.groupBy(F.expr("doc_id div 4").alias("region_id")).agg(
        *[F.max(F.when(F.col("doc_id") % 4 == i, F.col("text"))).alias(n) for i, n in enumerate(names)]
    )
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("region_id"), "embedding")
    named = texts.withColumn("region_name", F.concat(F.lit("R"), F.col("region_id").cast("string")))
    return named.join(vectors, "region_id", "left")


def text_queries(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{i}', '{q}')" for i, q in TEXT_QUERIES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(query_id, query_text)")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isin(7, 42, 99))
    return wanted.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.floor(F.col("value") * 10).cast("bigint")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("query_type"), ms.alias("latency_ms"))
