"""Joins of a large table with a smaller one, and tables stored between steps.

Sizes in bytes decide, and Spark knows them: a stored table has a size before planning
(``spark.sql.autoBroadcastJoinThreshold``), any other after its shuffle, where adaptive execution may still turn the
join into a broadcast. A key that holds a large share of the rows makes one shuffle partition oversized; adaptive
execution (``spark.sql.adaptive.skewJoin.enabled``, on by default) reads it in many tasks. Where the smaller side stays
small next to the other (query terms, edges of regions), keys can be salted instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from skyloom.session import new_work_path

SALTS = 16

_HASHABLE = (T.AtomicType, T.NullType)


def materialize(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` as a Parquet table in the shared work folder: computed once, kept when executors are lost."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffle join in which every key of ``fact`` is spread over ``salts`` tasks.

    ``dim`` is repeated once per salt. The salt is a hash of the row, so a retried task gives the same one.
    Works for inner, left, left_semi and left_anti: each fact row carries exactly one salt.
    """
    others = [
        f.name for f in fact.schema.fields
        if f.name not in on and isinstance(f.dataType, _HASHABLE)
        and not isinstance(f.dataType, T.VariantType)
    ]
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)) if others else F.lit(0)
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = fact.withColumn("_salt", salt.cast("int"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
