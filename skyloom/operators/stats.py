"""Percentiles, mergeable histograms and probe sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from skyloom.functions.geo import location_key
from skyloom.functions.scalar import tail_axis, tail_position
from skyloom.operators.ranking import check_k
from skyloom.operators.joins import materialize as stored
from skyloom.operators.spatial import distinct_locations

# Percentiles of the curve, fixed values.
CURVE_PERCENTILES = (50.0, 75.0, 90.0, 95.0, 99.0, 99.9, 99.99)

_STEPS_PER_OCTAVE = 2048


def _value_bucket(v: Column) -> Column:
    """Integer that never decreases with ``v``; 2048 steps per power of two, so few values share one."""
    size = F.floor(F.log2(F.abs(v)) * _STEPS_PER_OCTAVE) + F.lit(2_300_000)
    return (
        F.when(F.isnan(v), F.lit(20_000_000))
        .when(v == 0, F.lit(0))
        .when(F.abs(v) == float("inf"), F.signum(v) * 10_000_000)
        .otherwise(F.signum(v) * size)
        .cast("bigint")
    )


SPLIT_BUCKETS = 1024
FINAL_ROWS = 4096


def _same_group(left: DataFrame, right: DataFrame) -> Column:
    return left["_g"].eqNullSafe(right["_tg"])


def exact_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    percentiles: list[float],
    split_buckets: int = SPLIT_BUCKETS,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """Interpolated percentiles per group: ``(group, percentile, value)``.

    Distributed selection by repeated counting. Equal values are counted first. Every wanted rank keeps an interval
    of values and the count below it; a round counts the values of the interval in buckets (monotone log buckets
    first, then ``split_buckets`` equal parts), and only the bucket that holds the rank becomes the next interval.
    When an interval holds at most ``final_rows`` distinct values they are ordered in a window: no window sees more
    rows than that or than the buckets of one round. The driver only asks, once a round, whether intervals are left.
    """
    counted = stored(
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c")),
        "percentile-values",
    )
    totals = counted.groupBy("_g").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    position = F.col("_p") / 100.0 * (F.col("_n") - 1)
    asked = totals.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in percentiles]))).select(
        "_g", "_p", "_lo", "_hi", position.alias("_pos")
    )
    wanted = asked.select(
        "_g", "_p", (F.col("_pos") - F.floor("_pos")).alias("_frac"),
        F.explode(F.array_distinct(F.array(F.floor("_pos").cast("long"), F.ceil("_pos").cast("long")))).alias("_r"),
        "_lo", "_hi",
    )
    state = stored(
        wanted.select(F.col("_g").alias("_tg"), "_r", "_lo", "_hi", F.lit(0).cast("long").alias("_below")).distinct(),
        "percentile-state",
    )
    done = None
    first = True
    while True:
        inside = counted.join(state, _same_group(counted, state)).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        sizes = inside.groupBy("_tg", "_r").agg(F.count(F.lit(1)).alias("_distinct"))
        small = sizes.where(F.col("_distinct") <= final_rows).select(F.col("_tg").alias("_sg"), F.col("_r").alias("_sr"))
        key = inside["_tg"].eqNullSafe(small["_sg"]) & (inside["_r"] == small["_sr"])
        # intervals small enough: ordered in a window of at most final_rows rows
        few = inside.join(small, key, "left_semi")
        in_order = Window.partitionBy("_tg", "_r").orderBy("_v")
        found = few.withColumn("_to", F.sum("_c").over(in_order)).where(
            (F.col("_to") - F.col("_c") <= F.col("_r") - F.col("_below")) & (F.col("_r") - F.col("_below") < F.col("_to"))
        ).select("_tg", "_r", "_v")
        found = stored(found, "percentile-found")
        done = found if done is None else done.unionByName(found)
        rest = inside.join(small, key, "left_anti")
        if rest.isEmpty():
            break
        width = F.col("_hi") - F.col("_lo")
        part = F.floor((F.col("_v") - F.col("_lo")) / width * split_buckets)
        bucket = (
            _value_bucket(F.col("_v")) if first
            else F.when(width > 0, F.least(part, F.lit(split_buckets - 1))).otherwise(F.lit(0)).cast("bigint")
        )
        counts = rest.groupBy("_tg", "_r", "_below", bucket.alias("_b")).agg(
            F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        by_bucket = Window.partitionBy("_tg", "_r").orderBy("_b")
        ends = counts.withColumn("_to", F.sum("_c").over(by_bucket))
        state = stored(
            ends.where(
                (F.col("_to") - F.col("_c") <= F.col("_r") - F.col("_below"))
                & (F.col("_r") - F.col("_below") < F.col("_to"))
            ).select("_tg", "_r", "_lo", "_hi", (F.col("_below") + F.col("_to") - F.col("_c")).alias("_below")),
            "percentile-state",
        )
        first = False
    hits = wanted.join(done, wanted["_g"].eqNullSafe(done["_tg"]) & (wanted["_r"] == done["_r"]))
    low, high = F.min("_v"), F.max("_v")
    return hits.groupBy(F.col("_g").alias(group), F.col("_p").alias("percentile")).agg(
        (low + (high - low) * F.max("_frac")).alias("value")
    )


def percentile_summary(df: DataFrame, group: str, value: str, exact: bool = True) -> DataFrame:
    """Per group: ``n, avg, p50, p99, p999, max``."""
    named = {"p50": 50.0, "p99": 99.0, "p999": 99.9}
    basics = [
        F.count(value).alias("n"), F.avg(value).alias("avg"), F.max(value).alias("max")
    ]
    order = [group, "n", "avg", *named, "max"]
    if not exact:
        sketched = [F.percentile_approx(value, p / 100, 10_000).alias(c) for c, p in named.items()]
        return df.groupBy(group).agg(*basics, *sketched).select(*order)
    found = exact_percentiles(df, group, value, list(named.values()))
    wide = found.groupBy(group).agg(
        *[F.max(F.when(F.col("percentile") == p, F.col("value"))).alias(c) for c, p in named.items()]
    )
    base, wide = df.groupBy(group).agg(*basics), wide.withColumnRenamed(group, "_g")
    return base.join(wide, base[group].eqNullSafe(wide["_g"]), "left").select(*order)


def percentile_curve(
    df: DataFrame, group: str, value: str, percentiles: tuple[float, ...] = CURVE_PERCENTILES
) -> DataFrame:
    """Per group one row per percentile, with its tail position and the value raised to at least 1."""
    found = exact_percentiles(df, group, value, list(percentiles))
    return found.select(
        group,
        "percentile",
        tail_position("percentile").alias("tail"),
        tail_axis("percentile").alias("log_tail"),
        F.greatest("value", F.lit(1.0)).alias("value"),
    )


def _shift(v: Column) -> Column:
    """Low bits a bucket ignores: none below 2048, one more for each doubling."""
    return reduce(lambda acc, bit: acc + (v >= F.lit(1 << bit)).cast("int"), range(11, 63), F.lit(0))


def log_histogram(df: DataFrame, group: str, value: str) -> DataFrame:
    """Counts per bucket with three significant digits: ``(group, bucket_low, bucket_high, n)``.

    Values are whole numbers; negative ones count as 0.
    """
    whole = df.where(F.col(value).isNotNull()).select(
        group, F.greatest(F.col(value).cast("bigint"), F.lit(0).cast("bigint")).alias("_v")
    )
    width = F.pow(F.lit(2.0), _shift(F.col("_v"))).cast("bigint")
    placed = whole.withColumn("_w", width).withColumn("bucket_low", F.col("_v") - F.col("_v") % F.col("_w"))
    placed = placed.withColumn("bucket_high", F.col("bucket_low") + F.col("_w") - 1)
    return placed.groupBy(group, "bucket_low", "bucket_high").agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(group: str, *parts: DataFrame) -> DataFrame:
    """One histogram of several with the same groups."""
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy(group, "bucket_low", "bucket_high").agg(F.sum("n").alias("n"))


def histogram_percentiles(
    histogram: DataFrame, group: str, percentiles: tuple[float, ...] = CURVE_PERCENTILES
) -> DataFrame:
    """Upper end of the first bucket that reaches each percentile: ``(group, percentile, value)``."""
    order = Window.partitionBy(group).orderBy("bucket_low")
    running = histogram.withColumn("_to", F.sum("n").over(order)).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(group))
    )
    asked = F.explode(F.array(*[F.lit(float(p)) for p in percentiles])).alias("percentile")
    spread = running.select(group, "bucket_high", "_to", "_all", asked)
    reached = spread.where(F.col("_to") * 100.0 >= F.col("percentile") * F.col("_all"))
    return reached.groupBy(group, "percentile").agg(F.min("bucket_high").alias("value"))


def sample_probes(readings: DataFrame, n: int, seed: int = 0, time_col: str = "measurement_time") -> DataFrame:
    """``n`` pairs of an existing location and an existing time: ``(probe_id, lon, lat, probe_time)``.

    Both sets are put in the order of a seeded hash and paired by position, starting over when one is
    shorter than ``n``. The order is numbered by range partitions of the hash and the offsets of the partitions, so
    no task and no window holds all rows; only one count per partition goes to the driver.
    """
    check_k(n)

    def first(distinct: DataFrame, key: Column) -> DataFrame:
        """The first ``n`` rows by hash, numbered from 0 by range partitions and partition offsets."""
        hashed = distinct.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), key)))
        parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        in_range = hashed.repartitionByRange(parts, "_h").sortWithinPartitions("_h")
        local = F.monotonically_increasing_id() - F.spark_partition_id().cast("long") * F.lit(1 << 33)
        numbered = stored(
            in_range.select("*", F.spark_partition_id().alias("_pid"), local.alias("_in")), "probe-order"
        )
        # one count per range partition
        sizes = sorted((r["_pid"], r["count"]) for r in numbered.groupBy("_pid").count().collect())
        offsets, total = {}, 0
        for pid, count in sizes:
            offsets[pid] = total
            total += count
        if not offsets:
            return numbered.select(*distinct.columns, F.lit(0).cast("long").alias("_i")).where(F.lit(False)), 0
        start = F.create_map(*[F.lit(x) for pid, off in offsets.items() for x in (pid, off)])
        ordered = numbered.withColumn("_i", F.element_at(start, F.col("_pid")) + F.col("_in"))
        return ordered.where(F.col("_i") < n).drop("_h", "_pid", "_in"), min(n, total)

    where = F.concat_ws(":", location_key("lon").cast("string"), location_key("lat").cast("string"))
    points, n_points = first(distinct_locations(readings), where)
    when = F.date_format(time_col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    times, n_times = first(readings.where(F.col(time_col).isNotNull()).select(time_col).distinct(), when)
    draws = readings.sparkSession.range(n).select(F.col("id").alias("probe_id"))
    if not n_points or not n_times:
        draws = draws.where(F.lit(False))
    draws = draws.withColumn("_pi", F.col("probe_id") % max(n_points, 1))
    draws = draws.withColumn("_ti", F.col("probe_id") % max(n_times, 1))
    paired = draws.join(points.withColumnRenamed("_i", "_pi"), "_pi")
    paired = paired.join(times.withColumnRenamed("_i", "_ti"), "_ti")
    return paired.select("probe_id", "lon", "lat", F.col(time_col).alias("probe_time"))
