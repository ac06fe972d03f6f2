"""Near-duplicate embeddings within labels, by products of int8 tiles.

Vectors of a label are dealt into tiles of about ``TILE`` and every pair of tiles is one unit of work, so no group
has to fit into a task. A unit normalises its vectors, rounds them to int8 codes and multiplies the codes. What the
rounding lost is known for each vector: with u = s q + e and v = t p + f the true cosine differs from s t (q . p) by
at most |s q| |f| + |e| |t p| + |e| |f|. Only pairs that may reach the threshold within this bound are computed again
from the original vectors in double precision.

Equal vectors are compared once. A unit returns the number of links of each of its vectors and spanning links for
the components, never the pairs themselves, so a large group of near copies adds rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.components import connected_components, spanning_links
from skyloom.llm.vectors import classes, matrix, usable
from skyloom.llm.work import ship, stored

THRESHOLD = 0.98
TILE = 2048
STRIP = 256
AGAIN = 1 << 15
# Room for the rounding of double precision in the bound itself.
_SLACK = 1e-9
# Sums of so many products of two int8 codes stay below 2^24 and are exact in single precision.
_EXACT_TERMS = 1024

_LINKS = "a long, b long, links long"


class Codes:
    """Unit vectors as int8 codes with scale, length of the coded vector and length of what the coding lost."""

    def __init__(self, vectors: np.ndarray):
        largest = np.abs(vectors).max(axis=1, keepdims=True)
        scaled = vectors / largest  # no overflow or underflow in the lengths
        self.norm = np.sqrt((scaled * scaled).sum(axis=1))
        self.unit = scaled / self.norm[:, None]
        self.scale = np.abs(self.unit).max(axis=1) / 127.0
        self.code = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        coded = self.code * self.scale[:, None]
        self.length = np.sqrt((coded * coded).sum(axis=1))
        self.lost = np.sqrt(((self.unit - coded) ** 2).sum(axis=1))


def _code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], _EXACT_TERMS):
        part = slice(at, at + _EXACT_TERMS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def close_pairs(x: Codes, y: Codes, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs with cosine >= ``threshold``, in portions."""
    for at in range(0, len(x.unit), STRIP):
        s = slice(at, at + STRIP)
        near = _code_products(x.code[s], y.code) * x.scale[s, None] * y.scale
        near += x.length[s, None] * y.lost + x.lost[s, None] * (y.length + y.lost)
        i, j = np.nonzero(near >= threshold - _SLACK)
        for k in range(0, len(i), AGAIN):
            p, q = i[k : k + AGAIN] + at, j[k : k + AGAIN]
            close = np.einsum("nd,nd->n", x.unit[p], y.unit[q]) >= threshold
            yield p[close], q[close]


def _unit(key: tuple, rows: pa.Table, threshold: float) -> pa.Table:
    """One pair of tiles; a tile against itself when both have the same number."""
    first, second = key[-2].as_py(), key[-1].as_py()
    tile = rows.column("tile").to_numpy()
    ids, copies = rows.column("class_id").to_numpy(), rows.column("copies").to_numpy()
    vectors = matrix(rows.column("vec"))
    mine, other = np.flatnonzero(tile == first), np.flatnonzero(tile == second)
    x = Codes(vectors[mine]) if len(mine) else None
    y = x if first == second else Codes(vectors[other]) if len(other) else None
    links = np.zeros(len(ids), np.int64)
    a, b, held = [], [], 0
    for i, j in close_pairs(x, y, threshold) if x is not None and y is not None else ():
        p, q = mine[i], other[j]
        if first == second:
            p, q = p[i < j], q[i < j]
        np.add.at(links, p, copies[q])
        np.add.at(links, q, copies[p])
        a.append(ids[p])
        b.append(ids[q])
        held += len(p)
        if held > 1 << 20:
            p, q = spanning_links(np.concatenate(a), np.concatenate(b))
            a, b, held = [p], [q], len(p)
    p, q = spanning_links(np.concatenate(a), np.concatenate(b)) if held else (ids[:0], ids[:0])
    linked = np.flatnonzero(links)
    return pa.table(
        {
            "a": pa.array(np.concatenate([ids[linked], p]), pa.int64()),
            "b": pa.array(np.concatenate([np.zeros(len(linked), np.int64), q]), pa.int64(),
                          mask=np.arange(len(linked) + len(p)) < len(linked)),
            "links": pa.array(np.concatenate([links[linked], np.zeros(len(p), np.int64)]), pa.int64()),
        }
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tile_rows: int = TILE,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row, by cosine >= ``threshold`` within equal labels.

    Vectors that are null, zero, empty or hold null or non-finite components, rows without label and rows without
    id link with nothing: no links, their own id as component, kept. Vectors of different lengths never link.
    Equal vectors of a label link with one another. Ids are integers; a repeated id with equal vectors counts each
    row as a link. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")
    )
    fit = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    different = stored(classes(fit, ["label"], "vec", "id").withColumn("dims", F.size("vec")), "vectors")

    group = ["label", "dims"]
    sizes = different.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    tiled = different.join(sizes, group).withColumn(
        "tile", F.pmod(F.xxhash64("class_id"), F.col("tiles")).cast("int")
    )
    partner = tiled.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = partner.select(
        *group, F.least("tile", "partner").alias("first"), F.greatest("tile", "partner").alias("second"),
        "tile", "class_id", "copies", F.transform("vec", lambda v: v.cast("double")).alias("vec"),
    )
    ship(spark)

    def compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _unit(key, rows, threshold)

    found = units.groupBy(*group, "first", "second").applyInArrow(compare, _LINKS)
    found = stored(found, "vector-links")

    counted = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("others"))
    counted = counted.withColumnRenamed("a", "class_id")
    roots = connected_components(found.where(F.col("b").isNotNull())).withColumnRenamed("node", "class_id")
    least = roots.groupBy("root").agg(F.min("class_id").alias("component_id"))
    components = roots.join(least, "root").select("class_id", "component_id")
    known = different.join(counted, "class_id", "left").join(components, "class_id", "left").select(
        F.col("label").alias("_label"), F.col("vec").alias("_vec"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "class_id").alias("component_id"),
    )
    same = (fit["label"] == known["_label"]) & (fit["vec"] == known["_vec"])
    linked = fit.join(known, same).select("id", "n_links", "component_id")
    alone = F.col("id").isNull() | F.col("label").isNull() | ~usable(F.col("vec"))
    rest = rows.where(alone).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.unionByName(rest)
    return every.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
