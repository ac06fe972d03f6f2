"""Approximate nearest neighbours by largest inner product, with cross-polytope hashing.

Vectors of similar norm form a range and are lifted to unit vectors: x / M with a further component that completes
the length, M the largest norm of the range. A query, scaled to length one with a zero there, keeps the order of
inner products. Signs and fast Hadamard transforms, three times each, make a pseudo-random rotation; the hash of a
vector is the signed axis nearest to its rotated form. If a range outgrows the signed axes of one rotation, further
hashes refine the cells. In each of ``TABLES`` tables a query visits the ``PROBE_SHARE`` of cells whose axes are
nearest to it, and all vectors in them are candidates. Candidates are ranked by the exact inner product.

Cells are dealt in blocks of about ``BLOCK`` vectors; a block too full, as with many near copies in one cell, is split,
and so are its queries. A unit of work hands on no more than the best of each of its queries. Equal vectors count as
one, with the smallest of their ids. A range of up to ``HASH_FROM`` vectors has a single cell, where the search is exact.
Queries that find fewer neighbours than there are go through all vectors, again in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skyloom.llm.vectors import matrix, usable
from skyloom.llm.work import map_arrow, ship, stored

TABLES = 2
PROBE_SHARE = 0.4
HASH_FROM = 4096
BLOCK = 32_768
CELL = 1024
QUERY_BLOCK = 1024
SEED = 7


# Hashing


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pair = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotate(x: np.ndarray, table: int, level: int) -> np.ndarray:
    """The pseudo-rotation of one hash: random signs, then the transform, three times."""
    signs = np.random.default_rng([SEED, table, level]).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(n: int, width: int, least: int, cell: int) -> list[int]:
    """Axes used by each hash for a range of ``n`` vectors; hashes are added until cells hold about ``cell`` vectors."""
    if n <= least:
        return []
    used, cells = [], 1
    while not used or n > cells * cell:
        wanted = width if not used else min(width, -(-n // (cells * cell * 2)))
        used.append(wanted)
        cells *= 2 * wanted
    return used


def _lift(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Unit vectors of one more component, padded to a power of two. Without ``largest``: as queries."""
    norm = np.sqrt((x * x).sum(axis=1))
    width = 1 << int(x.shape[1]).bit_length()
    out = np.zeros((len(x), width))
    if largest is None:
        out[:, : x.shape[1]] = x / norm[:, None]
    else:
        out[:, : x.shape[1]] = x / largest
        out[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (norm / largest) ** 2))
    return out


def cell_of(unit: np.ndarray, used: list[int], table: int) -> np.ndarray:
    """Cell number of each unit vector: the nearest signed axis of each hash, as digits."""
    cell = np.zeros(len(unit), np.int64)
    for level, m in enumerate(used):
        turned = rotate(unit, table, level)[:, :m]
        axis = np.abs(turned).argmax(axis=1)
        negative = turned[np.arange(len(unit)), axis] < 0
        cell = cell * (2 * m) + 2 * axis + negative
    return cell


def probes_of(unit: np.ndarray, used: list[int], table: int, share: float) -> np.ndarray:
    """The cells each query visits, nearest first: smallest sum of what its axes lack to the nearest one."""
    cells = np.zeros((len(unit), 1), np.int64)
    lack = np.zeros((len(unit), 1))
    total = 1
    for level, m in enumerate(used):
        turned = rotate(unit, table, level)[:, :m]
        near = np.stack([turned, -turned], axis=2).reshape(len(unit), 2 * m)
        missing = (near.max(axis=1, keepdims=True) - near) ** 2
        total *= 2 * m
        lack = (lack[:, :, None] + missing[:, None, :]).reshape(len(unit), -1)
        cells = (cells[:, :, None] * (2 * m) + np.arange(2 * m)).reshape(len(unit), -1)
        keep = min(lack.shape[1], max(1, int(np.ceil(share * total))))
        best = np.argpartition(lack, keep - 1, axis=1)[:, :keep]
        lack, cells = np.take_along_axis(lack, best, 1), np.take_along_axis(cells, best, 1)
    return cells


def _cells(used: list[int]) -> int:
    return int(np.prod([2 * m for m in used], dtype=np.int64)) if used else 1


def _blocks(n: int, used: list[int], block: int) -> int:
    return min(_cells(used), max(1, -(-n // block)))


def _by_range(batch: pa.RecordBatch):
    """Rows of a batch by range: (row numbers, n, largest)."""
    n, largest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "largest"))
    for value in np.unique(largest):
        at = np.flatnonzero(largest == value)
        yield at, int(n[at[0]]), float(value)


def _hash_vectors(
    batches: Iterator[pa.RecordBatch], tables: int, least: int, block: int, cell: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            dims = part.column("dims").to_numpy()
            for d in np.unique(dims):
                own = part.take(pa.array(np.flatnonzero(dims == d)))
                x = matrix(own.column("vec"))
                for at, n, largest in _by_range(own):
                    unit, used = _lift(x[at], largest), axes(n, _width(d), least, cell)
                    for t in range(1 if not used else tables):
                        own_cell = cell_of(unit, used, t)
                        number = own_cell * _blocks(n, used, block) // _cells(used)
                        yield _rows(own.take(pa.array(at)), t, number, own_cell, False)


def _hash_queries(
    batches: Iterator[pa.RecordBatch], tables: int, share: float, least: int, block: int, cell: int
) -> Iterator[pa.RecordBatch]:
    """A row for each block a query has cells in, with those cells."""
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            dims = part.column("dims").to_numpy()
            for d in np.unique(dims):
                own = part.take(pa.array(np.flatnonzero(dims == d)))
                x = matrix(own.column("vec"))
                for at, n, _ in _by_range(own):
                    unit, used = _lift(x[at], None), axes(n, _width(d), least, cell)
                    for t in range(1 if not used else tables):
                        cells = probes_of(unit, used, t, share)
                        row = np.repeat(np.arange(len(at)), cells.shape[1])
                        flat = cells.ravel()
                        number = flat * _blocks(n, used, block) // _cells(used)
                        order = np.lexsort((flat, number, row))
                        row, number, flat = row[order], number[order], flat[order]
                        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (number[1:] != number[:-1])])
                        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), pa.array(flat))
                        yield _rows(own.take(pa.array(at[row[first]])), t, number[first], lists, True)


def _width(dims: int) -> int:
    return 1 << int(dims).bit_length()


def _rows(batch: pa.RecordBatch, table: int, block: np.ndarray, cells, query: bool) -> pa.RecordBatch:
    n = batch.num_rows
    if not query:
        cells = pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), pa.array(cells))
    return pa.RecordBatch.from_arrays(
        [batch.column("dims"), batch.column("range"), pa.array(np.full(n, table, np.int32)),
         pa.array(block.astype(np.int64)), batch.column("class_id"), batch.column("vec"), cells,
         pa.array(np.full(n, query))],
        ["dims", "range", "table", "block", "class_id", "vec", "cells", "query"],
    )


# Ranking


def best_of(score: np.ndarray, q: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int):
    """(row, column, exact score) of the ``k`` best of each row; ties by id. -inf marks what is no candidate."""
    width = score.shape[1]
    if width > k:
        kth = np.partition(score, width - k, axis=1)[:, width - k]
        kth = np.where(np.isneginf(kth), kth, kth - 1e-9 * np.maximum(1.0, np.abs(kth)))
        i, j = np.nonzero((score >= kth[:, None]) & ~np.isneginf(score))
    else:
        i, j = np.nonzero(~np.isneginf(score))
    exact = np.einsum("nd,nd->n", q[i], v[j])
    order = np.lexsort((ids[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    start = np.searchsorted(i, i)
    keep = np.arange(len(i)) - start < k
    return i[keep], j[keep], exact[keep]


def _search_unit(rows: pa.Table, k: int) -> pa.Table:
    """The best candidates of each query of a unit, among the vectors in the cells it visits."""
    query = rows.column("query").to_numpy(zero_copy_only=False)
    at_q, at_v = np.flatnonzero(query), np.flatnonzero(~query)
    out = {"query_class": [], "class_id": [], "score": []}
    if len(at_q) and len(at_v):
        x, ids = matrix(rows.column("vec")), rows.column("class_id").to_numpy()
        cells = rows.column("cells").combine_chunks()
        offsets, flat = cells.offsets.to_numpy(), cells.flatten().to_numpy()
        offsets = offsets - offsets[0]
        cell_of_v = flat[offsets[at_v]]
        by_cell = np.argsort(cell_of_v, kind="stable")
        at_v, cell_of_v = at_v[by_cell], cell_of_v[by_cell]
        v = x[at_v]
        names, first = np.unique(cell_of_v, return_index=True)
        ends = np.r_[first[1:], len(cell_of_v)]
        for start in range(0, len(at_q), 128):
            rows_q = at_q[start : start + 128]
            q = x[rows_q]
            visits = np.concatenate([flat[offsets[r] : offsets[r + 1]] for r in rows_q])
            owner = np.repeat(np.arange(len(rows_q)), offsets[rows_q + 1] - offsets[rows_q])
            score = np.full((len(rows_q), len(v)), -np.inf)
            for c, s, e in zip(names, first, ends):
                who = owner[visits == c]
                if len(who):
                    score[who, s:e] = q[who] @ v[s:e].T
            i, j, exact = best_of(score, q, v, ids[at_v], k)
            out["query_class"].append(ids[rows_q[i]])
            out["class_id"].append(ids[at_v[j]])
            out["score"].append(exact)
    types = {"query_class": pa.int64(), "class_id": pa.int64(), "score": pa.float64()}
    return pa.table({c: pa.array(np.concatenate(out[c]) if out[c] else [], t) for c, t in types.items()})


def _search(vectors: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """(query_class, class_id, score): at least the ``k`` best candidates of each query.

    Both sides come as (dims, range, table, block, class_id, vec, cells, query). Blocks with many rows are split on
    both sides, every part of one meeting every part of the other.
    """
    key = ["dims", "range", "table", "block"]
    n_v = vectors.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("v_parts"))
    n_q = queries.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("q_parts"))
    parts = stored(n_v.join(n_q, key), "ann-parts")

    def part(n: str):
        return F.pmod(F.xxhash64("class_id"), F.col(n)).cast("int")

    def spread(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rest = ["class_id", "vec", "cells", "query"]
    left = vectors.join(parts, key).select(*key, part("v_parts").alias("v"), spread("q_parts").alias("q"), *rest)
    right = queries.join(parts, key).select(*key, spread("v_parts").alias("v"), part("q_parts").alias("q"), *rest)
    ship(vectors.sparkSession)
    units = left.unionByName(right).groupBy(*key, "v", "q")

    def search(rows: pa.Table) -> pa.Table:
        return _search_unit(rows, k)

    return units.applyInArrow(search, "query_class long, class_id long, score double")


_HASHED = (
    "dims int, range int, table int, block long, class_id long, vec array<double>, cells array<long>, query boolean"
)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    tables: int = TABLES,
    probe_share: float = PROBE_SHARE,
    hash_from: int = HASH_FROM,
    block_rows: int = BLOCK,
    cell_rows: int = CELL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, its own row left out.

    Nearness is the inner product of the original vectors in double precision; ties go to the smaller id. Rows of
    both tables without id, and vectors that are null, empty, zero or hold null or non-finite components take no
    part. Vectors are compared with those of equal length. Ids are integers and a repeated id is one neighbour per
    different vector. A query row that is repeated, id and vector, is answered once. With fewer than ``k`` candidates all are returned.
    """

    def fit(df: DataFrame) -> DataFrame:
        vec = F.transform(F.col(vec_col), lambda v: v.cast("double"))
        rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vec")))

    points = fit(vectors)
    by_vector = Window.partitionBy("vec").orderBy("id")
    members = points.distinct().withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    members = stored(members, "ann-members")
    firsts = members.where("place = 1").select(F.col("id").alias("class_id"), "vec")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    ranged = firsts.select(
        "class_id", "vec", F.size("vec").alias("dims"), norm.alias("norm"),
        F.floor(F.log2(norm) + 0.5).cast("int").alias("range"),
    )
    ranges = stored(
        ranged.groupBy("dims", "range").agg(F.max("norm").alias("largest"), F.count(F.lit(1)).alias("n")), "ann-ranges"
    )
    asked = stored(fit(queries).distinct(), "ann-queries")
    different = asked.groupBy("vec").agg(F.min("id").alias("class_id")).withColumn("dims", F.size("vec"))
    different = stored(different, "ann-query-classes")

    columns = ["class_id", "vec", "dims", "range", "largest", "n"]
    hashed = map_arrow(
        ranged.join(ranges, ["dims", "range"]).select(*columns),
        partial(_hash_vectors, tables=tables, least=hash_from, block=block_rows, cell=cell_rows), _HASHED,
    )
    probing = map_arrow(
        different.join(ranges, "dims").select(*columns),
        partial(
            _hash_queries, tables=tables, share=probe_share, least=hash_from, block=block_rows, cell=cell_rows
        ),
        _HASHED,
    )
    ids = members.select("vec", F.col("id").alias("vec_id"))
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")

    def expanded(found: DataFrame) -> DataFrame:
        """Classes as the ids in them, the best of each query class."""
        once = found.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
        top = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
        once = once.withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= k + 1).drop("_n")
        named = once.join(firsts, "class_id").join(ids, "vec").select("query_class", "vec_id", "score")
        return named.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")

    found = stored(expanded(_search(hashed, probing, k + 1, block_rows)), "ann-found")
    most = F.least(F.count(F.lit(1)), F.lit(k + 1)).alias("most")
    there = points.distinct().groupBy(F.size("vec").alias("dims")).agg(most)
    got = found.groupBy("query_class").agg(F.count(F.lit(1)).alias("got"))
    short = different.join(there, "dims").join(got, F.col("class_id") == F.col("query_class"), "left")
    short = short.where(F.coalesce("got", F.lit(0)) < F.col("most")).select("class_id", "vec", "dims")
    short = stored(short, "ann-short")
    if not short.isEmpty():
        every = [F.lit(0).alias("range"), F.lit(0).alias("table"), F.lit(0).cast("long").alias("block")]
        one = F.array(F.lit(0).cast("long")).alias("cells")
        dims, asks = F.size("vec").alias("dims"), F.lit(True).alias("query")
        all_vectors = firsts.select(dims, *every, "class_id", "vec", one, F.lit(False).alias("query"))
        all_short = short.select("dims", *every, "class_id", "vec", one, asks)
        again = stored(expanded(_search(all_vectors, all_short, k + 1, block_rows)), "ann-again")
        found = found.join(short, found["query_class"] == short["class_id"], "left_anti").unionByName(again)

    classes = different.select(F.col("class_id").alias("query_class"), "vec")
    answered = asked.withColumnRenamed("id", "query_id").join(classes, "vec").join(found, "query_class")
    order = Window.partitionBy("query_id", "query_class").orderBy(F.desc("score"), "vec_id")
    ranked = answered.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
