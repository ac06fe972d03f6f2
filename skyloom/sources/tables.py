"""Loading, flattening, storing and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyloom.functions.geo import make_point, parse_point_text, parse_wkt_point
from skyloom.sources.schemas import DATA, TABLES

CORRUPT = "_corrupt_record"


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])


def _parse_point(text: Column) -> Column:
    return F.coalesce(parse_wkt_point(text), parse_point_text(text))


def _parse_time(text: Column) -> Column:
    """Epoch milliseconds or ISO text, without regard to the session's time zone."""
    seconds = (text.try_cast("decimal(17,0)") / 1000).try_cast("decimal(18,6)")
    since_epoch = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.coalesce(since_epoch, text.try_cast("timestamp_ntz"))


def dynamic_object(df: DataFrame, json_col: str, declared: T.StructType, extra: str | None = None) -> DataFrame:
    """A JSON text column as a struct of its declared keys, and the whole object as a variant.

    Undeclared keys stay readable: ``try_variant_get(<extra>, '$.key', 'double')``. Text that is no JSON
    gives nulls.
    """
    extra = extra or f"{json_col}_extra"
    whole = F.try_parse_json(json_col)
    return df.withColumn(extra, whole).withColumn(json_col, F.from_json(json_col, declared))


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three tables from JSON-lines files ``<path>/<table>.json`` (file or folder).

    Points may be WKT, ``(x,y)``, ``[x,y]`` or an array, times epoch milliseconds or ISO text, shapes
    GeoJSON objects or text. Lines that are not JSON are kept with the text in ``_corrupt_record``.
    """

    def read(name: str, schema: T.StructType) -> DataFrame:
        reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
        return reader.option("columnNameOfCorruptRecord", CORRUPT).json(f"{path}/{name}.json")

    climate = read("climate_data", _text_schema("measurement_time", "geo_location", "data"))
    climate = dynamic_object(climate, "data", DATA).select(
        _parse_time(F.col("measurement_time")).alias("measurement_time"),
        _parse_point(F.col("geo_location")).alias("geo_location"),
        "data", "data_extra", CORRUPT,
    )

    texts = [f for f in TABLES["german_regions"].fields]
    regions = read("german_regions", T.StructType([*texts, T.StructField(CORRUPT, T.StringType())]))

    points = read(
        "geo_points",
        T.StructType(
            [
                T.StructField("latitude", T.DoubleType()),
                T.StructField("longitude", T.DoubleType()),
                *_text_schema("geo_location", "nearest_town").fields,
            ]
        ),
    )
    stated = _parse_point(F.col("geo_location"))
    points = points.withColumn("geo_location", F.coalesce(stated, make_point("longitude", "latitude")))
    return {"climate_data": climate, "german_regions": regions, "geo_points": points}


def flatten_readings(climate: DataFrame) -> DataFrame:
    """Nested readings as flat rows, the form the weather operators take."""
    measures = [F.col(f"data.{n}").alias(n) for n in ("temperature", "pressure", "u10", "v10")]
    return climate.select(
        "measurement_time",
        F.col("geo_location.lon").alias("lon"),
        F.col("geo_location.lat").alias("lat"),
        *measures,
    )


def flatten_points(points: DataFrame) -> DataFrame:
    return points.select(
        F.col("geo_location.lon").alias("lon"), F.col("geo_location.lat").alias("lat"), "nearest_town"
    )


def write_readings(readings: DataFrame, path: str, files_per_day: int = 16, mode: str = "errorifexists") -> None:
    """Store flat readings partitioned by date.

    Rows of a day are spread over ``files_per_day`` tasks by location, so one large day is not one task,
    and sorted by time so a time filter skips row groups.
    """
    dated = readings.withColumn("measurement_date", F.to_date("measurement_time"))
    slot = F.pmod(F.xxhash64("lon", "lat", "measurement_time"), F.lit(files_per_day))
    spread = dated.withColumn("_slot", slot).repartition("measurement_date", "_slot").drop("_slot")
    ordered = spread.sortWithinPartitions("measurement_date", "measurement_time", "lat", "lon")
    ordered.write.mode(mode).partitionBy("measurement_date").parquet(path)


def enforce_key(
    df: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: one row per key, the first by ``order_by``, then by all other columns.

    Rows with a null in the key are rejected. The source is read once into the shared folder. The winner is an
    aggregate, so a key with very many rows shrinks before the shuffle. Every row is then set against its key's
    winner by a join that adaptive execution splits for a hot key: rows unlike the winner are rejected, and of the
    rows equal to it (counted per key, again an aggregate) all but one copy, so no exceptAll and no window over a key.
    """
    from skyloom.operators.joins import materialize

    source = materialize(df, "keyed-source")
    first = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    complete, missing = source.where(~null_key), source.where(null_key)
    if not (first or rest):
        counted = complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        kept = counted.select(*keys)
        copies = counted.select(*keys, F.explode(F.array_repeat(F.lit(1), (F.col("_n") - 1).cast("int"))).alias("_copy"))
        rejected = copies.select(*df.columns).unionByName(missing.select(*df.columns))
        return kept.select(*df.columns), rejected
    row = F.struct(*first, *rest)
    winner = complete.groupBy(*keys).agg(F.min(row).alias("_row"))
    kept = winner.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (*first, *rest)]).select(*df.columns)
    against = complete.join(winner, keys).withColumn("_same", row.eqNullSafe(F.col("_row")))
    unlike = against.where(~F.col("_same")).select(*df.columns)
    same = against.where("_same").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first("_row").alias("_row"))
    repeats = same.select(*keys, "_row", F.explode(F.array_repeat(F.lit(1), (F.col("_n") - 1).cast("int"))).alias("_copy")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in (*first, *rest)]
    )
    rejected = unlike.unionByName(repeats.select(*df.columns)).unionByName(missing.select(*df.columns))
    return kept, rejected
