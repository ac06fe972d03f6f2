"""The three tables: readings, regions, named points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

# Declared keys of the nested object, fixed values.
DATA = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("temperature", "pressure", "u10", "v10", "latitude", "longitude")]
)

CLIMATE_SCHEMA = T.StructType(
    [
        T.StructField("measurement_time", T.TimestampNTZType()),
        T.StructField("geo_location", POINT),
        T.StructField("data", DATA),
        T.StructField("data_extra", T.VariantType()),
    ]
)

REGIONS_SCHEMA = T.StructType(
    [
        T.StructField("region_name", T.StringType()),
        T.StructField("geo_coords", T.StringType()),
        T.StructField("tourism_info", T.StringType()),
        T.StructField("transportation", T.StringType()),
        T.StructField("economics", T.StringType()),
        T.StructField("introduced_species", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

GEO_POINTS_SCHEMA = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("geo_location", POINT),
        T.StructField("nearest_town", T.StringType()),
    ]
)

TABLES = {"climate_data": CLIMATE_SCHEMA, "german_regions": REGIONS_SCHEMA, "geo_points": GEO_POINTS_SCHEMA}
KEYS = {"german_regions": ["region_name"], "geo_points": ["latitude", "longitude"]}


def create_tables(spark: SparkSession, schema: str = "demo") -> None:
    """The schema and its empty tables, where they do not exist yet."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name, columns in TABLES.items():
        # Variant columns have no Parquet form in the session catalog's default source on every version.
        fields = [f for f in columns.fields if not isinstance(f.dataType, T.VariantType)]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{schema}`.`{name}` ({ddl}) USING parquet")


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
