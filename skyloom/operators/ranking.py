"""Top-k per group, ranked hit lists and bounded previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

# From this k on Spark no longer trims groups before the shuffle by itself, fixed value.
_NATIVE_LIMIT = 1000


def check_k(k: int) -> None:
    if k <= 0:
        raise ValueError("k must be positive")


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank", salts: int = 32
) -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1.

    Below k = 1000 Spark trims every group to k rows per task before it shuffles, so one large group does
    not land in one task whole. For larger k the groups are first trimmed per salt.
    """
    check_k(k)
    if k >= _NATIVE_LIMIT:
        spread = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = spread.withColumn("_part", F.row_number().over(part)).where(F.col("_part") <= k)
        df = df.drop("_salt", "_part")
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def top_k_by_score(df: DataFrame, k: int, tiebreak: str, score: str = "score") -> DataFrame:
    """The ``k`` rows with the greatest score; ties go to the smaller ``tiebreak``."""
    check_k(k)
    return df.orderBy(F.desc(score), F.asc(tiebreak)).limit(k)


def rank_hits(df: DataFrame, k: int, tiebreak: str, score: str = "score") -> DataFrame:
    """``top_k_by_score`` with a rank from 1; only those k rows meet in one task."""
    order = Window.orderBy(F.desc(score), F.asc(tiebreak))
    return top_k_by_score(df, k, tiebreak, score).withColumn("rank", F.row_number().over(order))


def ranked_result(df: DataFrame, name_col: str, k: int, score: str = "score") -> DataFrame:
    """Hit list for display: rank, name and score to four decimals."""
    return rank_hits(df, k, name_col, score).select("rank", name_col, F.round(score, 4).alias("score"))


def preview(df: DataFrame, n: int = 50, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, each with the total row count and the number of rows left out."""
    total = df.agg(F.count(F.lit(1))).scalar()
    first = (df.orderBy(*order_by) if order_by else df).limit(n)
    return first.select(
        "*", total.alias("total_rows"), F.greatest(total - F.lit(n), F.lit(0)).alias("omitted_rows")
    )
