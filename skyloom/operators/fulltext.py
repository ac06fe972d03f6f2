"""BM25 search over a postings table.

``postings`` has one row per document, column and term: ``doc, column, term, tf, doc_len, first``. The
flag ``first`` marks the posting of a text's first term, so counting it counts the texts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.functions.text import analyze_english
from skyloom.operators.joins import materialize
from skyloom.operators.ranking import check_k, top_k_by_score, top_k_per_group

# BM25 parameters, fixed values.
K1 = 1.2
B = 0.75
SCORE_DIGITS = 6
# Columns searched by default and columns a keyword panel may choose, fixed values.
TEXT_COLUMNS = ("tourism_info", "transportation", "economics", "introduced_species")
KEYWORD_COLUMNS = ("region_name", "economics", "transportation", "introduced_species")
# Bytes of text whose terms are counted in one task, fixed value: a hash map of terms is many times its text.
PART_BYTES = 4 << 20


class TextIndex(NamedTuple):
    """Postings with the statistics of their columns and terms."""

    postings: DataFrame
    terms: DataFrame
    columns: DataFrame

    @classmethod
    def of(cls, postings: DataFrame) -> TextIndex:
        """Index whose statistics are computed from its postings."""
        terms = postings.groupBy("column", "term").agg(F.count(F.lit(1)).alias("df"))
        columns = postings.groupBy("column").agg(
            F.sum(F.col("first").cast("bigint")).alias("n_docs"),
            (F.sum("tf") / F.sum(F.col("first").cast("bigint"))).alias("avg_len"),
        )
        return cls(postings, terms, columns)

    def materialize(self) -> TextIndex:
        """The postings stored in the checkpoint folder, for several uses within one program."""
        return TextIndex.of(materialize(self.postings))

    def write(self, path: str) -> None:
        """Store the index; rows are range-partitioned by term and document, so a frequent term is split."""
        ordered = self.postings.repartitionByRange("column", "term", "doc")
        ordered.sortWithinPartitions("column", "term", "doc").write.parquet(f"{path}/postings")
        stored = TextIndex.of(self.postings.sparkSession.read.parquet(f"{path}/postings"))
        sorted_terms = stored.terms.repartitionByRange("column", "term")
        sorted_terms.sortWithinPartitions("column", "term").write.parquet(f"{path}/terms")
        stored.columns.coalesce(1).write.parquet(f"{path}/columns")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> TextIndex:
        return cls(*(spark.read.parquet(f"{path}/{part}") for part in cls._fields))


def missing_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Requested columns the table does not have."""
    return [c for c in cols if c not in df.columns]


def fulltext_preflight(df: DataFrame, cols: list[str]) -> None:
    """Every requested text column exists and there is at least one."""
    if not cols:
        raise ValueError("no text columns given")
    if missing := missing_columns(df, cols):
        raise ValueError(f"missing text column(s): {missing}")


def build_postings(df: DataFrame, id_col: str, cols: list[str], part_bytes: int = PART_BYTES) -> TextIndex:
    """Full-text index of several columns.

    The texts are measured first; their terms are dealt by document, column and length, the keys that postings share,
    into as many parts as hold ``part_bytes`` of text each. A task's memory therefore does not grow with the table, and
    the terms are counted after that one shuffle, where a text is smaller than its postings.
    """
    fulltext_preflight(df, list(cols))
    texts = df.select(F.col(id_col).alias("doc"), *cols).unpivot("doc", list(cols), "column", "text")
    texts = texts.where(F.col("text").isNotNull())
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    analyzed = texts.select("doc", "column", analyze_english("text").alias("terms"))
    dealt = analyzed.select("doc", "column", F.size("terms").alias("doc_len"), "terms").repartition(
        max(1, math.ceil(total / part_bytes)), "doc", "column", "doc_len"
    )
    tokens = dealt.select("doc", "column", "doc_len", F.posexplode("terms").alias("pos", "term"))
    postings = tokens.groupBy("doc", "column", "term", "doc_len").agg(
        F.count(F.lit(1)).alias("tf"), F.max(F.col("pos") == 0).alias("first")
    )
    return TextIndex.of(postings)


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct terms of one query string, through the analyzer of the documents."""
    row = spark.range(1).select(F.array_distinct(analyze_english(F.lit(query))).alias("terms")).head()
    return row.terms


def _bm25(tf: Column, df: Column, doc_len: Column, n_docs: Column, avg_len: Column, k1: float, b: float) -> Column:
    idf = F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))
    return idf * tf * F.lit(k1 + 1) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * doc_len / avg_len))


def _weighted(index: TextIndex, matched: DataFrame, terms: DataFrame, k1: float, b: float) -> DataFrame:
    """Matched postings with their term's share of the score."""
    weighted = matched.join(terms, ["column", "term"])
    # One row per indexed column of the source table.
    weighted = weighted.join(F.broadcast(index.columns), "column")
    weight = _bm25(*(F.col(c) for c in ("tf", "df", "doc_len", "n_docs", "avg_len")), k1, b)
    return weighted.withColumn("weight", weight)


def match_bm25_multi(
    index: TextIndex,
    cols: list[str],
    query: str,
    combine: str = "max",
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """Documents with at least one query term in any of ``cols``: ``(doc, score)``.

    The score of a document is its best column (``max``) or the total of its columns (``sum``).
    """
    if combine not in ("max", "sum"):
        raise ValueError(f"unknown combine {combine!r}")
    cols = list(cols)
    wanted = F.col("term").isin(query_terms(index.postings.sparkSession, query)) & F.col("column").isin(cols)
    matched = index.postings.where(wanted)
    weighted = _weighted(index, matched, index.terms.where(wanted), k1, b)
    sums = [F.sum(F.when(F.col("column") == c, F.col("weight"))).alias(f"_s{i}") for i, c in enumerate(cols)]
    by_column = weighted.groupBy("doc").agg(*sums)
    parts = [F.col(f"_s{i}") for i in range(len(cols))]
    if combine == "sum":
        score = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    else:
        score = F.greatest(*parts) if len(parts) > 1 else parts[0]
    return by_column.select("doc", F.round(score, SCORE_DIGITS).alias("score"))


def match_bm25(index: TextIndex, column: str, query: str, k1: float = K1, b: float = B) -> DataFrame:
    """Documents whose ``column`` has at least one query term: ``(doc, score)``."""
    return match_bm25_multi(index, [column], query, k1=k1, b=b)


def fts_topk(scored: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best documents; fewer when fewer match."""
    return top_k_by_score(scored, k, "doc")


def match_batch(
    index: TextIndex,
    column: str,
    queries: DataFrame,
    k: int = 3,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """Many ``(query_id, query_text)`` searches in one job: ``(query_id, rank, doc, score)``."""
    check_k(k)
    wanted = queries.select("query_id", F.explode(analyze_english("query_text")).alias("term")).distinct()
    postings = index.postings.where(F.col("column") == column)
    stats = index.terms.where(F.col("column") == column)
    asked = wanted.select("term").distinct()
    matched = postings.join(wanted, "term")
    weighted = _weighted(index, matched, stats.join(asked, "term", "left_semi"), k1, b)
    scored = weighted.groupBy("query_id", "doc").agg(F.round(F.sum("weight"), SCORE_DIGITS).alias("score"))
    top = top_k_per_group(scored, ["query_id"], [F.desc("score"), F.asc("doc")], k)
    return top.select("query_id", "rank", "doc", "score")


def keyword_relevance(
    regions: DataFrame, index: TextIndex, column: str, keyword: str, id_col: str, name: str = "region_name"
) -> DataFrame:
    """Relevance of a keyword in one column, by region: ``(name, score)``.

    ``region_name`` is matched whole and scores 1; other columns go through BM25.
    """
    if column not in KEYWORD_COLUMNS:
        raise ValueError(f"column must be exactly one of {KEYWORD_COLUMNS}, not {column!r}")
    if column == "region_name":
        return regions.where(F.col(name) == keyword).select(name, F.lit(1.0).alias("score"))
    hits = match_bm25(index, column, keyword)
    named = regions.select(F.col(id_col).alias("doc"), name)
    return hits.join(named, "doc").select(name, "score")


def category_for_region(
    regions: DataFrame, column: str, region: str = "ALL", name: str = "region_name"
) -> DataFrame:
    """Text of one category column for a region, or for every region."""
    if column not in TEXT_COLUMNS:
        raise ValueError(f"column must be exactly one of {TEXT_COLUMNS}, not {column!r}")
    chosen = regions if region == "ALL" else regions.where(F.col(name) == region)
    return chosen.select(name, F.col(column).alias("text"))
