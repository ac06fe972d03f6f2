"""Mixing sources to target weights by systematic sampling.

Each source's target comes from its weight, capped at a multiple of the source's own size. A document's expected
copies are target / size of its source. Within a source the expected copies are prefix-summed, one random offset
is added, and the document is emitted once per integer boundary its stretch of the sum crosses, so the number of
copies is always one of the two integers next to the expectation and the source's total follows its target.

The prefix sum is taken in two levels, so that no source has to fit into a task: documents fall into buckets of
about ``BUCKET_ROWS`` by a hash of their id, bucket totals are summed along the source, and rows are numbered
inside each bucket by size. All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.llm.work import WORD, free_name, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1"
BUCKET_ROWS = 4096


def _unit(text: Column) -> Column:
    """A fixed pseudo-random number of [0, 1) for a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, share: float = SHARE, cap: int = CAP, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, n, target) from (source, size): one row per source.

    Weights go to the sources by code point, null last, and repeat. Targets are ``share`` of all sizes split by
    weight; a target stops at ``cap`` times its source's size and the excess is shared again. The fixed point is
    min(cap, level * weight): sources are filled in the order of cap / weight until the level holds for the rest.
    A source of size zero has target zero.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weighted = per_source.withColumn("_rank", F.row_number().over(by_name) - 1)
    chosen = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighted = weighted.withColumn("_weight", chosen.cast("long")).withColumn("_cap", F.col("source_size") * cap)

    order = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("_rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.lit(share) * F.sum("source_size").over(everything)
    left = wanted - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    filled = weighted.withColumn("_level", left / weight_left).withColumn("_place", F.row_number().over(order))
    fits = F.col("_level") * F.col("_weight") <= F.col("_cap")
    level = F.min_by("_level", F.when(fits, F.col("_place"))).over(everything)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(level * F.col("_weight"), F.col("_cap").cast("double")))
    return filled.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) as a struct ``row``, with ``size``, ``source_size``, ``target`` and ``copies``.

    ``copies`` is 0, 1 or 2 with the default cap. A null text has size 0; a null source is a source of its own;
    repeated rows are mixed like any others and may differ in their copies. An empty table gives an empty result.
    The seed fixes the outcome: a rerun, or a task that runs again, takes the same documents.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size"))
    targets = stored(source_targets(sizes), "mix-targets")

    names = docs.columns
    source, targeted = free_name(names, "mix_source"), free_name(names, "mix_target")
    plan = targets.select(F.col("source").alias(source), F.struct("source_size", "n", "target").alias(targeted))

    def bucketed(df: DataFrame) -> DataFrame:
        joined = df.join(plan, df[source_col].cast("string").eqNullSafe(F.col(source)), "left")
        buckets = F.ceil(F.col(f"{targeted}.n") / bucket_rows).cast("long")
        draw = F.floor(_unit(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) * buckets).cast("long")
        return joined.withColumn(free_name(names, "mix_bucket"), draw)

    bucket = free_name(names, "mix_bucket")
    counts = bucketed(docs.select(id_col, source_col)).groupBy(source, bucket).count()
    along = Window.partitionBy(source).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        counts.select(
            F.col(source).alias("_source"), F.col(bucket).alias("_bucket"),
            F.coalesce(F.sum("count").over(along), F.lit(0)).alias("_start"),
        ),
        "mix-starts",
    )
    rows = bucketed(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in columns or names]).alias("row"),
        F.col(source).alias("_source"), F.col(bucket).alias("_bucket"), F.col(targeted).alias("_t"),
        size.alias("size"), F.col(id_col).alias("_id"),
    )
    place = Window.partitionBy("_source", "_bucket").orderBy("size", F.col("_id").asc_nulls_first())
    numbered = rows.withColumn("_place", F.row_number().over(place))
    same = numbered["_source"].eqNullSafe(starts["_source"]) & (numbered["_bucket"] == starts["_bucket"])
    ranked = numbered.join(starts, same, "left").withColumn("_rank", F.col("_start") + F.col("_place"))

    expected = F.when(F.col("_t.source_size") > 0, F.col("_t.target") / F.col("_t.source_size")).otherwise(0.0)
    offset = _unit(F.concat(F.lit(f"{seed}:"), F.coalesce(numbered["_source"], F.lit(""))))
    crossed = F.floor(offset + expected * F.col("_rank")) - F.floor(offset + expected * (F.col("_rank") - 1))
    return ranked.select(
        "row", "size", F.col("_t.source_size").alias("source_size"), F.col("_t.target").alias("target"),
        crossed.cast("long").alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document repeated ``copies`` times, others left out."""
    taken = mix(docs, **options).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
