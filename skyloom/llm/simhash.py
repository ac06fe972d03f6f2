"""SimHash near-duplicates found through the anchors of a covering code.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit of one of two blocks of 31
bits. On a block the Hamming code of length 31 is the covering code: every word lies within radius one of exactly one
code word, its home anchor. A word one bit away from it lies within radius plus threshold, two, of that same anchor.
So a fingerprint stands once at home and is replicated to all anchors within two bits (1 or 16 per block), and every
pair to be linked meets at an anchor, where all 64 bits are compared.

Only distinct fingerprints are compared. What a task finds it hands on as spanning links, so a group of near copies
yields links in proportion to its size, not its square. Anchors beside words that very many fingerprints share are
split into tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.components import connected_components, spanning_links
from skyloom.llm.work import free_name, hold, map_arrow, stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SLICE_BYTES = 1 << 20
TILE = 4096
HOT_WORD = 512
PAIRS_AT_ONCE = 1 << 21

_BLOCK = 31
_POSITIONS = np.arange(1, _BLOCK + 1)
# Parity checks: mask j covers the positions (from 1) whose number has bit j.
_CHECKS = [np.uint64(sum(1 << (int(p) - 1) for p in _POSITIONS if p >> j & 1)) for j in range(5)]


def _pair_masks() -> np.ndarray:
    """For each syndrome but zero, the 15 pairs of bits whose positions have it as their exclusive or."""
    rows = [[0] * 15]
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if i < i ^ s]
        rows.append([1 << (i - 1) | 1 << (j - 1) for i, j in pairs])
    return np.array(rows, np.uint64)


_PAIRS = _pair_masks()
_BITS = np.array([0] + [1 << (int(p) - 1) for p in _POSITIONS], np.uint64)


# Fingerprints


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """Words of lower-cased ``data``, slice by slice; a slice ends at white space."""
    start = 0
    while start < len(data):
        end = min(len(data), start + SLICE_BYTES)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].lower().split()
        start = end


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, joined by a space."""
    joined = b" ".join(words)
    after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], after[:-width]]).tolist()
    ends = (after[width - 1 :] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends)], np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: a bit is set if it is set in over half of the shingles' hashes."""
    counts, n = np.zeros(64, np.int64), 0
    carried: list[bytes] = []
    for block in _word_blocks((text or "").encode()):
        words = carried + block
        if len(words) >= width:
            hashes = _hashes(words, width)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
            carried = words[len(words) - width + 1 :]
        else:
            carried = words
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(carried), SEED) if carried else 0
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hold("simhash", int)  # keeps no words
    for batch in batches:
        prints = [fingerprint(text.as_py(), width) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["id", "fp"]
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row. A text without words, or null, has fingerprint zero."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, partial(_fingerprints, width=width), "id long, fp long")


# Anchors


def _syndrome(word: np.ndarray) -> np.ndarray:
    s = np.zeros(len(word), np.int64)
    for j, mask in enumerate(_CHECKS):
        s |= (np.bitwise_count(word & mask) & 1).astype(np.int64) << j
    return s


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of fingerprints: each at its home anchors and at all within radius plus threshold."""
    rows, found, home = [], [], []
    index = np.arange(len(fp))
    for block in (0, 1):
        word = fp >> np.uint64(block * _BLOCK) & np.uint64((1 << _BLOCK) - 1)
        s = _syndrome(word)
        nearest = word ^ _BITS[s]
        off = s > 0
        around = word[off, None] ^ _PAIRS[s[off]]
        mark = np.uint64(block << _BLOCK)
        reached = np.repeat(index[off], 15), around.ravel()
        for r, a, h in ((index, nearest, True), (index, nearest, False), (*reached, False)):
            rows.append(r)
            found.append(a | mark)
            home.append(np.full(len(r), h))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 20_000):
            fp = prints[at : at + 20_000]
            row, anchor, home = anchors_of(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(fp[row]), pa.array(home)], ["anchor", "fp", "home"]
            )


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors within reach of a block's word, with the rows it brings to each."""
    for batch in batches:
        block, word, count = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        shifted = word.astype(np.uint64) << (block * _BLOCK).astype(np.uint64)
        row, anchor, home = anchors_of(shifted)
        own = ~home & ((anchor >> np.uint64(_BLOCK)).astype(np.int64) == block[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[own].view(np.int64)), pa.array(count[row[own]])], ["anchor", "rows"]
        )


def _split_anchors(distinct: DataFrame) -> DataFrame:
    """(anchor, tiles): anchors beside words that more than ``HOT_WORD`` fingerprints share, and their tiles a side.

    At any other anchor at most 497 words of ``HOT_WORD`` fingerprints meet.
    """
    bits = F.lit((1 << _BLOCK) - 1)
    words = [
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("fp", b * _BLOCK).bitwiseAND(bits).alias("word"))
        for b in (0, 1)
    ]
    shared = distinct.select(F.explode(F.array(*words)).alias("w")).groupBy("w.block", "w.word").count()
    hot = shared.where(F.col("count") > HOT_WORD)

    around = map_arrow(hot.select(F.col("block").cast("long"), "word", "count"), _around, "anchor long, rows long")
    return around.groupBy("anchor").agg(F.ceil(F.sum("rows") / TILE).cast("int").alias("tiles"))


# Comparison


def _linked(fp: np.ndarray, homes: np.ndarray, first: np.ndarray, n: np.ndarray, max_bits: int):
    """Links between each home row and the ``n`` rows from ``first`` on, in portions of bounded size."""
    ends = np.cumsum(n)
    at = 0
    while at < len(homes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        count = n[at:stop]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        x, y = fp[np.repeat(homes[at:stop], count)], fp[np.repeat(first[at:stop], count) + within]
        differ = np.bitwise_count((x ^ y).view(np.uint64))
        near = (differ <= max_bits) & (differ > 0)
        if near.any():
            yield x[near], y[near]
        at = stop


def _compare_runs(anchor: np.ndarray, tile: np.ndarray, home: np.ndarray, fp: np.ndarray, max_bits: int):
    """Spanning links of whole runs of (anchor, tile); home rows stand first in their run."""
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])]))
    size = np.diff(np.concatenate([new, [len(anchor)]]))
    at_home = np.add.reduceat(home.astype(np.int64), new)
    run = np.repeat(np.arange(len(new)), size)
    homes = np.flatnonzero(home)
    first, n = (new + at_home)[run[homes]], (size - at_home)[run[homes]]
    a, b, held = [], [], 0
    for x, y in _linked(fp, homes, first, n, max_bits):
        a.append(x)
        b.append(y)
        held += len(x)
        if held > PAIRS_AT_ONCE:
            x, y = spanning_links(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
    return spanning_links(np.concatenate(a), np.concatenate(b)) if a else None


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Runs may go on in the next batch: the last one of a batch waits for it."""
    held: list[np.ndarray] | None = None

    def out(columns):
        found = _compare_runs(*columns, max_bits)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        anchor, tile = columns[0], columns[1]
        last = int(np.flatnonzero((anchor == anchor[-1]) & (tile == tile[-1]))[0])
        if last:
            yield from out([c[:last] for c in columns])
        held = [c[last:] for c in columns]
    if held is not None:
        yield from out(held)


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs of ``fp`` with at most ``max_bits`` differing bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two blocks cover at most three differing bits")
    split = stored(_split_anchors(distinct), "simhash-anchors")
    placed = map_arrow(distinct.select("fp"), _place, "anchor long, fp long, home boolean")
    met = placed.join(split, "anchor", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiles = F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("tiles") - 1),
            lambda k: F.when(F.col("home"), mine * F.col("tiles") + k).otherwise(k * F.col("tiles") + mine),
        )
    )
    units = met.select("anchor", F.explode(tiles).alias("tile"), "home", "fp")
    dealt = units.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile", F.desc("home"))
    return map_arrow(dealt, partial(_compare, max_bits=max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id reachable over links of at most ``max_bits`` bits.

    Rows with equal fingerprints are linked, texts without words among them. Repeated rows come out repeated. A row
    without id is compared too, but never names a component; a component of such rows alone has a null id. Ids are
    integers.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    roots = connected_components(near_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    least = distinct.join(roots, "fp").groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = stored(roots.join(least, "root").select("fp", "component_id"), "simhash-components")
    classes = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")
    )
    return prints.join(classes, "fp").select("id", "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, once if the id is repeated.

    Rows without id cannot be told apart, and are all kept.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    key = free_name(docs.columns, "kept_id")
    kept = found.where(F.col("id") == F.col("component_id")).select(F.col("id").alias(key))
    named = docs.where(F.col(id_col).isNotNull())
    chosen = named.join(kept, F.col(id_col).cast("long") == F.col(key), "left_semi").dropDuplicates([id_col])
    return chosen.unionByName(docs.where(F.col(id_col).isNull()))
