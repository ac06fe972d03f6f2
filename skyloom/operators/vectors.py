"""Nearest-neighbour search, exact and approximate, and text embedding."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import (
    BucketedRandomProjectionLSH,
    BucketedRandomProjectionLSHModel,
    HashingTF,
    Normalizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

import skyloom
from skyloom.functions.scalar import normalize_query_text
from skyloom.functions.text import analyze_english
from skyloom.operators.ranking import check_k, top_k_by_score, top_k_per_group

# Task functions travel with their code, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(skyloom)

METRICS = ("euclidean", "cosine")
SCORE_DIGITS = 6


def knn_preflight(df: DataFrame, vec: str) -> tuple[int, int]:
    """Number and length of the vectors; raises when the column is absent, empty or of mixed length."""
    if vec not in df.columns:
        raise ValueError(f"no column {vec!r}")
    sizes = df.where(F.col(vec).isNotNull()).select(F.size(vec).alias("n"))
    row = sizes.agg(F.count("n"), F.min("n"), F.max("n")).head()
    if row[0] == 0:
        raise ValueError(f"column {vec!r} has no vectors")
    if row[1] != row[2]:
        raise ValueError(f"vectors of length {row[1]} and {row[2]} in {vec!r}")
    return row[0], row[1]


def count_non_null(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(col).alias("n"))


def _batch_matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """One Arrow batch of equal-length lists as a matrix, without a copy per row."""
    flat = column.flatten()
    sizes = np.diff(column.offsets.to_numpy())
    if flat.null_count or (sizes != dim).any():
        raise ValueError(f"every vector must have {dim} numbers")
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _distances(rows: np.ndarray, query: np.ndarray, metric: str) -> np.ndarray:
    """Squared distance, or 1 - cosine; equal rows get equal numbers, so ties stay ties."""
    if metric == "euclidean":
        gap = rows - query
        return np.einsum("ij,ij->i", gap, gap)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows)) * math.sqrt(float(query @ query))
    dots = np.einsum("ij,j->i", rows, query)
    return 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)


def _rough_distances(rows: np.ndarray, queries: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """All distances by one matrix product and a bound on their rounding error."""
    row_sq = np.einsum("ij,ij->i", rows, rows)
    query_sq = np.einsum("ij,ij->i", queries, queries)
    dots = rows @ queries.T
    if metric == "euclidean":
        slack = 1e-12 * rows.shape[1] * float(row_sq.max(initial=0.0) + query_sq.max() + 1.0)
        return row_sq[:, None] + query_sq[None, :] - 2.0 * dots, slack
    norms = np.sqrt(row_sq[:, None] * query_sq[None, :])
    return 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0), 1e-12 * rows.shape[1]


def _nearest_in_task(
    query_ids: list, queries: np.ndarray, k: int, metric: str, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scan of one task's vectors that keeps the k nearest per query and emits only those."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [None] * len(query_ids)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = _batch_matrix(batch.column(1), queries.shape[1])
            rough, slack = _rough_distances(rows, queries, metric)
            for j, query in enumerate(queries):
                column = rough[:, j]
                if len(column) > k:
                    limit = np.partition(column, k - 1)[k - 1] + 2 * slack
                    if best[j] is not None and len(best[j][0]) == k:
                        limit = min(limit, best[j][0][-1] + slack)
                    near = np.flatnonzero(column <= limit)
                else:
                    near = np.arange(len(column))
                if len(near) == 0:
                    continue
                dist, found = _distances(rows[near], query, metric), ids[near]
                if best[j] is not None:
                    dist = np.concatenate([best[j][0], dist])
                    found = np.concatenate([best[j][1], found])
                order = np.lexsort((found, dist))[:k]
                best[j] = (dist[order], found[order])
        kept = [(query_ids[j], *b) for j, b in enumerate(best) if b is not None]
        if kept:
            owners = [q for q, dist, _ in kept for _ in range(len(dist))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owners, type=schema.field(0).type),
                    pa.array(np.concatenate([f for _, _, f in kept]), type=schema.field(1).type),
                    pa.array(np.concatenate([d for _, d, _ in kept])),
                ],
                schema=schema,
            )

    return scan


def _score(distance: Column, metric: str) -> Column:
    raw = 1.0 / (1.0 + distance) if metric == "euclidean" else (2.0 - distance) / 2.0
    return F.round(raw, SCORE_DIGITS)


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")


def _task_candidates(
    df: DataFrame, id_col: str, vec: str, query_type: T.DataType, query_ids: list, vectors: list, k: int, metric: str
) -> DataFrame:
    if len({len(v) for v in vectors}) != 1:
        raise ValueError("query vectors differ in length")
    out = T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("id", df.schema[id_col].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    scan = _nearest_in_task(query_ids, np.asarray(vectors, dtype=np.float64), k, metric, to_arrow_schema(out))
    stored = df.where(F.col(vec).isNotNull()).select(id_col, vec)
    return stored.mapInArrow(scan, out)


CHUNK_BYTES = 32 << 20
# Bytes of one side of a pair that meets in a task, and the number of blocks that small tables are dealt into.
BLOCK_BYTES = 32 << 20
FEW_BLOCKS = 4
QUERY_STEP = 256


def _chunks(rows: int, dim: int, chunk_bytes: int) -> int:
    """Number of hash chunks so that one holds about ``chunk_bytes`` of float64 vectors."""
    return max(1, math.ceil(rows * dim * 8 / chunk_bytes))


def _blocks(rows: int, dim: int, chunk_bytes: int) -> int:
    """Number of blocks a side is dealt into: every one is sent once per block of the other side."""
    few = min(FEW_BLOCKS, _chunks(rows, dim, chunk_bytes))
    return max(few, _chunks(rows, dim, max(chunk_bytes, BLOCK_BYTES)))


def _pair_top_k(k: int, metric: str, schema: pa.Schema, chunk_bytes: int) -> Callable:
    """k nearest per query of one block pair; vectors are taken in chunks of ``chunk_bytes`` and queries ``QUERY_STEP``
    at a time to bound the matrix."""

    def pair(left, right):
        import pandas as pd

        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({f.name: pd.Series(dtype=object) for f in schema})
        ids = pa.array(left["id"].to_numpy(), type=schema.field(1).type)
        rows = pa.array([np.asarray(v, dtype=np.float64) for v in left["vec"]], type=pa.list_(pa.float64()))
        batch = pa.RecordBatch.from_arrays([ids, rows], ["id", "vec"])
        queries = np.stack([np.asarray(v, dtype=np.float64) for v in right["query_vec"]])
        if queries.shape[1] != len(left["vec"].iloc[0]):
            raise ValueError("query vectors and vectors differ in length")
        step = max(1, chunk_bytes // (8 * max(1, queries.shape[1])))
        chunks = [batch.slice(at, step) for at in range(0, batch.num_rows, step)]
        query_ids = right["query_id"].tolist()
        out = []
        for at in range(0, len(query_ids), QUERY_STEP):
            scan = _nearest_in_task(query_ids[at : at + QUERY_STEP], queries[at : at + QUERY_STEP], k, metric, schema)
            out += [b.to_pandas() for b in scan(iter(chunks))]
        if not out:
            return pd.DataFrame({f.name: pd.Series(dtype=object) for f in schema})
        return pd.concat(out, ignore_index=True)

    return pair


def _as_sent(df: DataFrame, vec: str) -> Column:
    """The vectors as they are shuffled: four bytes a number where the column has no more, else eight."""
    kind = df.schema[vec].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vec) if single else F.col(vec).cast("array<double>")


def knn_batch(
    df: DataFrame,
    id_col: str,
    vec: str,
    queries: DataFrame,
    k: int = 5,
    metric: str = "euclidean",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The ``k`` nearest vectors of every ``(query_id, query_vec)``: ``(query_id, rank, id, score)``.

    Vectors and queries are dealt into blocks by a hash of the row; every pair of a vector block and a query block
    meets under one integer key (each side sent once per block of the other side), where a grouped Arrow function
    takes the vectors in chunks of ``chunk_bytes`` and keeps the k best per query, and the k best of all pairs are
    merged per query. A block holds ``BLOCK_BYTES`` or a chunk, whichever is more, so small chunks do not multiply what
    is sent. Vectors are read once whatever the number of queries and nothing passes through the driver but two row
    counts. A task holds one block pair and a distance matrix of ``QUERY_STEP`` queries and a chunk. Score is ``1/(1+d²)`` or ``(1+cos)/2``; ties go to
    the smaller id. Null vectors and null query vectors take no part.
    """
    check_k(k)
    _check_metric(metric)
    vectors = df.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("id"), _as_sent(df, vec).alias("vec")
    )
    asked = queries.where(F.col("query_vec").isNotNull()).select(
        "query_id", _as_sent(queries, "query_vec").alias("query_vec")
    )
    sizes = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).head()
    n_asked = asked.count()
    if not sizes[0] or not n_asked:
        return asked.select(
            "query_id", F.lit(1).alias("rank"), F.lit(None).cast(df.schema[id_col].dataType).alias("id"),
            F.lit(0.0).alias("score"),
        ).where(F.lit(False))
    n_v, n_q = _blocks(sizes[0], sizes[1], chunk_bytes), _blocks(n_asked, sizes[1], chunk_bytes)
    v_chunk = F.pmod(F.xxhash64("id", "vec"), F.lit(n_v))
    q_chunk = F.pmod(F.xxhash64("query_id", "query_vec"), F.lit(n_q))
    left = vectors.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).select(
        "id", "vec", (v_chunk * n_q + F.col("other")).alias("pair")
    )
    right = asked.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1)))).select(
        "query_id", "query_vec", (F.col("other") * n_q + q_chunk).alias("pair")
    )
    out = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", df.schema[id_col].dataType),
        T.StructField("distance", T.DoubleType()),
    ])
    found = left.groupBy("pair").cogroup(right.groupBy("pair")).applyInPandas(
        _pair_top_k(k, metric, to_arrow_schema(out), chunk_bytes), out
    )
    top = top_k_per_group(found, ["query_id"], [F.asc("distance"), F.asc("id")], k)
    return top.select("query_id", "rank", "id", _score(F.col("distance"), metric).alias("score"))


def knn_exact(
    df: DataFrame, id_col: str, vec: str, query: list[float], k: int = 5, metric: str = "euclidean"
) -> DataFrame:
    """The ``k`` vectors nearest to one query vector: ``(id, score)``, best first."""
    check_k(k)
    _check_metric(metric)
    found = _task_candidates(df, id_col, vec, T.IntegerType(), [0], [list(query)], k, metric)
    top = found.orderBy(F.asc("distance"), F.asc("id")).limit(k)
    return top.select("id", _score(F.col("distance"), metric).alias("score"))


def fit_lsh(
    df: DataFrame, vec: str, bucket_length: float = 0.5, tables: int = 8, seed: int = 42
) -> BucketedRandomProjectionLSHModel:
    """Random-projection hash tables for vectors of this column's length."""
    lsh = BucketedRandomProjectionLSH(
        inputCol="_vector", outputCol="_hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    sample = df.where(F.col(vec).isNotNull()).select(array_to_vector(vec).alias("_vector")).limit(1)
    return lsh.fit(sample)


def lsh_buckets(model: BucketedRandomProjectionLSHModel, df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """One row per vector with its bucket in every hash table: ``(id, vec, buckets)``. May be stored as the index."""
    vectors = df.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vec).alias("vec"), array_to_vector(vec).alias("_vector")
    )
    tables = range(model.getNumHashTables())
    numbers = [F.get(vector_to_array(F.get("_hashes", F.lit(i))), F.lit(0)).cast("bigint") for i in tables]
    return model.transform(vectors).select("id", "vec", F.array(*numbers).alias("buckets"))


def knn_ann(
    model: BucketedRandomProjectionLSHModel,
    buckets: DataFrame,
    queries: DataFrame,
    k: int = 5,
) -> DataFrame:
    """Approximate ``knn_batch`` (Euclidean): only vectors that share a hash bucket with a query compete."""
    check_k(k)
    in_tables = F.posexplode("buckets").alias("table", "bucket")
    probes = lsh_buckets(model, queries, "query_id", "query_vec").select(
        F.col("id").alias("query_id"), F.col("vec").alias("query_vec"), in_tables
    )
    stored = buckets.select("id", "vec", in_tables)
    on = ["table", "bucket"]
    pairs = stored.join(probes, on)
    gaps = F.zip_with("vec", "query_vec", lambda a, b: a.cast("double") - b.cast("double"))
    distance = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)
    near = pairs.select("query_id", "id", distance.alias("distance")).groupBy("query_id", "id").agg(
        F.min("distance").alias("distance")
    )
    top = top_k_per_group(near, ["query_id"], [F.asc("distance"), F.asc("id")], k)
    return top.select("query_id", "rank", "id", _score(F.col("distance"), "euclidean").alias("score"))


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate search found, per query."""
    found = approximate.select("query_id", "id", F.lit(1).alias("_hit"))
    joined = exact.select("query_id", "id").join(found, ["query_id", "id"], "left")
    return joined.groupBy("query_id").agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def embed_text(
    df: DataFrame, col: str, dim: int = 1536, out: str = "embedding", fn: Callable | None = None
) -> DataFrame:
    """Text to a float vector of length ``dim`` in column ``out``.

    Default: hashed term counts scaled to length 1 (a text without terms gives zeros). ``fn`` replaces it:
    ``fn()`` is called once per task and returns a function from a list of texts to a list of vectors.
    """
    if fn is None:
        terms = F.coalesce(analyze_english(col), F.array().cast("array<string>"))
        hashed = HashingTF(numFeatures=dim, inputCol="_terms", outputCol="_counts").transform(
            df.withColumn("_terms", terms)
        )
        scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(hashed)
        return scaled.withColumn(out, vector_to_array("_unit", "float32")).drop("_terms", "_counts", "_unit")

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
    text = "_text"

    def encode(batches):
        model = fn()
        for pdf in batches:
            texts = pdf.pop(text).fillna("").tolist()
            vectors = [np.asarray(v, dtype=np.float32) for v in model(texts)]
            if any(len(v) != dim for v in vectors):
                raise ValueError(f"the model must return vectors of length {dim}")
            pdf[out] = vectors
            yield pdf

    return df.withColumn(text, normalize_query_text(col)).mapInPandas(encode, schema)
