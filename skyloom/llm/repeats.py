"""Removal of bytes covered by 200-byte strings that occur more than once in the corpus.

A 200-byte window holds 169 k-mers of 32 bytes; its anchor is the k-mer of least hash (leftmost on ties), which
depends on the window's bytes alone. Two equal windows therefore have the same anchor k-mer at the same offset, and
all windows of one anchor position form a contiguous range, its context. Anchors carry a digest of their context, not
its bytes. Contexts are counted per k-mer: a k-mer met once decides nothing; a k-mer whose occurrences all share one
context has all those windows repeated, without reading bytes; only k-mers with several different contexts fetch the
bytes of one row per context and compare the windows of the group by two 64-bit polynomial hashes (a false match needs
both to collide). The removed spans go back to their rows by join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from skyloom.llm.work import map_arrow, stored

# Fixed value of the contract: the length of a repeated string.
LENGTH = 200
KMER = 32
_WIDTH = LENGTH - KMER + 1
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LOW = np.uint64(0xFFFFFFFF)
# Rows handled at once, so that a task's Python lists stay far below an Arrow batch of texts and anchors.
BATCH_ROWS = 500


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``BATCH_ROWS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of every k-mer of the byte array (length n - KMER + 1)."""
    m = len(data) - KMER + 1
    h = np.zeros(m, np.uint64)
    x = data.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(KMER):
            h = h * _MULT + x[j : j + m]
        h ^= h >> np.uint64(29)
        h *= _MIX
        h ^= h >> np.uint64(32)
    return h


def _window_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, by block prefix and suffix minima."""
    n = len(key)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(suffix[:count], prefix[width - 1 : width - 1 + count])


def anchors(data: bytes) -> list[tuple[int, int, int, int]]:
    """(kmer hash, anchor offset in its context, first window start, last window start) of one text."""
    if len(data) < LENGTH:
        return []
    arr = np.frombuffer(data, np.uint8)
    h = kmer_hashes(arr)
    key = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    chosen = (_window_min(key, _WIDTH) & _LOW).astype(np.int64)
    change = np.flatnonzero(np.diff(chosen)) + 1
    starts = np.concatenate([[0], change])
    ends = np.concatenate([change - 1, [len(chosen) - 1]])
    at = chosen[starts]
    return list(zip(h[at].view(np.int64).tolist(), (at - starts).tolist(), starts.tolist(), ends.tolist()))


def _digest(ctx: bytes, off: int) -> int:
    return int.from_bytes(hashlib.blake2b(ctx + off.to_bytes(4, "little"), digest_size=8).digest(), "little", signed=True)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per anchor position: the row's key, k-mer, anchor offset, first window, windows, context digest."""
    names = ("key_a", "key_b", "kmer", "off", "s_lo", "n_win", "digest")
    for batch in _parts(batches):
        cols = {name: [] for name in names}
        ka, kb = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b, text in zip(ka, kb, batch.column(2).to_pylist()):
            data = (text or "").encode()
            for kmer, off, s_lo, s_hi in anchors(data):
                for name, v in zip(names, (a, b, kmer, off, s_lo, s_hi - s_lo + 1,
                                           _digest(data[s_lo : s_hi + LENGTH], off))):
                    cols[name].append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(cols[n], t) for n, t in zip(names, types)], list(names))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked contexts of each row."""
    for batch in _parts(batches):
        out = {"kmer": [], "off": [], "digest": [], "c": [], "ctx": []}
        for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = (text or "").encode()
            for a in asked or []:
                out["kmer"].append(a["kmer"])
                out["off"].append(a["off"])
                out["digest"].append(a["digest"])
                out["c"].append(a["c"])
                out["ctx"].append(data[a["s_lo"] : a["s_lo"] + a["n_win"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["kmer"], pa.int64()), pa.array(out["off"], pa.int32()), pa.array(out["digest"], pa.int64()),
             pa.array(out["c"], pa.int64()), pa.array(out["ctx"], pa.binary())],
            list(out),
        )


_BASES = (np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15 | 1))


def _window_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of every 200-byte window, from prefix sums with inverse powers."""
    out = []
    x = data.astype(np.uint64) + np.uint64(1)
    m = len(data) - LENGTH + 1
    with np.errstate(over="ignore"):
        for base in _BASES:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data) - 1, inverse, np.uint64)]))
            g = np.concatenate([[np.uint64(0)], np.cumsum(x * back, dtype=np.uint64)])
            ahead = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, base, np.uint64)]))
            out.append((g[LENGTH : LENGTH + m] - g[:m]) * ahead)
    return out[0], out[1]


# Bytes of contexts compared at once; their hashes and windows take some hundred times as much.
CHUNK_BYTES = 1 << 19


def _compare(batches: Iterator[pa.RecordBatch], chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Removed spans of the contexts of a partition dealt and sorted by k-mer, in chunks of whole k-mers.

    A chunk holds about ``chunk_bytes`` of contexts and is cut only where the k-mer changes, so every k-mer's contexts
    are compared together; a single k-mer with more bytes than that is one chunk.
    """
    parts: list[pa.Table] = []  # rows not compared yet
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = pa.Table.from_batches([batch.slice(at, BATCH_ROWS)])
            parts.append(part)
            held += pa.compute.sum(pa.compute.binary_length(part.column("ctx"))).as_py()
            if held < chunk_bytes or part.column("kmer")[-1] == parts[0].column("kmer")[0]:
                continue
            table = pa.concat_tables(parts)
            kmer = table.column("kmer").to_numpy()
            cut = int(np.searchsorted(kmer, kmer[-1], side="left"))
            yield from _compare_chunk(table.slice(0, cut))
            parts = [table.slice(cut)]
            held = pa.compute.sum(pa.compute.binary_length(parts[0].column("ctx"))).as_py()
    if parts:
        yield from _compare_chunk(pa.concat_tables(parts))


def _compare_chunk(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Windows keyed by their k-mer and two 64-bit polynomial hashes, counted over the chunk; each context's runs of
    repeated windows become spans. Windows never cross two contexts."""
    names = ("kmer", "off", "digest", "a", "b")
    contexts = table.column("ctx").to_pylist()
    kmer = table.column("kmer").to_numpy()
    counts = table.column("c").to_numpy()
    lengths = np.array([len(c) for c in contexts], np.int64)
    n_win = lengths - LENGTH + 1
    data = np.frombuffer(b"".join(contexts), np.uint8)
    h1, h2 = _window_keys(data)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    # the windows that start in a context and end inside it
    owner = np.repeat(np.arange(len(contexts)), n_win)
    at = np.arange(n_win.sum()) - np.repeat(np.cumsum(n_win) - n_win, n_win) + np.repeat(starts, n_win)
    windows = pd.DataFrame({"k": kmer[owner], "h1": h1[at], "h2": h2[at], "c": counts[owner]})
    repeated = windows.groupby(["k", "h1", "h2"], sort=False)["c"].transform("sum").to_numpy() >= 2
    # a False after every context's windows, so runs never join two contexts
    flags = np.zeros(n_win.sum() + len(contexts), bool)
    place = np.arange(len(repeated)) + owner
    flags[place] = repeated
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8)))
    first, last = edges[::2], edges[1::2]
    ends = np.cumsum(n_win + 1)
    which = np.searchsorted(ends, first, side="right")
    base = ends[which] - n_win[which] - 1
    out = [
        kmer[which], table.column("off").to_numpy()[which].astype(np.int32), table.column("digest").to_numpy()[which],
        first - base, last - 1 - base + LENGTH,
    ]
    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c)) for c in out], list(names))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        d = batch.to_pydict()
        n_bytes, removed, n_spans, digest = [], [], [], []
        for text, a_list, b_list in zip(d["text"], d["span_a"], d["span_b"]):
            data = (text or "").encode()
            cut = np.zeros(len(data) + 1, np.int64)
            for a, b in zip(a_list or [], b_list or []):
                cut[a] += 1
                cut[b] -= 1
            gone = np.cumsum(cut)[: len(data)] > 0
            arr = np.frombuffer(data, np.uint8)
            n_bytes.append(len(data))
            removed.append(int(gone.sum()))
            n_spans.append(int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1)))
            digest.append(hashlib.sha256(arr[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(n_spans, pa.int64()), pa.array(digest, pa.string())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes (null: empty). A byte is removed when a 200-byte string covering it also starts at another
    place of the table, in the same row or another, repeated rows included (two equal rows of 200 bytes or more lose
    all their bytes); strings never cross rows and are judged on the input. n_spans counts maximal removed runs;
    kept_sha256 digests the remaining bytes in order (of the empty string where nothing is left). Texts under 200 bytes
    keep everything. An empty table gives no rows; other columns are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"),
        F.xxhash64(F.col(id_col), text).alias("key_a"), F.hash(text, F.col(id_col)).cast("long").alias("key_b"),
    )
    longs = ("key_a", "key_b", "kmer", "off", "s_lo", "n_win", "digest")
    occurrence_schema = T.StructType(
        [T.StructField(n, T.IntegerType() if n == "off" else T.LongType()) for n in longs]
    )
    occurrences = stored(map_arrow(rows.select("key_a", "key_b", "text"), _anchor_rows, occurrence_schema), "repeat-anchors")
    contexts = ["kmer", "off", "digest"]
    per_ctx = occurrences.groupBy(*contexts, "n_win").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("key_a", "key_b", "s_lo")).alias("rep")
    )
    per_kmer = per_ctx.groupBy("kmer").agg(F.count(F.lit(1)).alias("n_ctx"), F.sum("c").alias("total"))
    classes = stored(per_ctx.join(per_kmer, "kmer").where("total >= 2"), "repeat-contexts")
    # one context of a k-mer, met twice or more: all its windows repeat, no bytes needed
    whole = classes.where("n_ctx = 1").select(
        *contexts, F.lit(0).cast("long").alias("a"), (F.col("n_win") + LENGTH - 1).alias("b")
    )
    # several contexts of a k-mer: their bytes, from one row each, compared window by window
    asked = classes.where("n_ctx >= 2").groupBy(F.col("rep.key_a").alias("key_a"), F.col("rep.key_b").alias("key_b")).agg(
        F.collect_list(F.struct(*contexts, "c", F.col("rep.s_lo").alias("s_lo"), "n_win")).alias("asked")
    )
    fetched_schema = T.StructType([
        T.StructField("kmer", T.LongType()), T.StructField("off", T.IntegerType()), T.StructField("digest", T.LongType()),
        T.StructField("c", T.LongType()), T.StructField("ctx", T.BinaryType()),
    ])
    fetched = map_arrow(rows.join(asked, ["key_a", "key_b"]).select("text", "asked"), _contexts, fetched_schema)
    span_schema = T.StructType([
        T.StructField("kmer", T.LongType()), T.StructField("off", T.IntegerType()), T.StructField("digest", T.LongType()),
        T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    ])
    compared = map_arrow(fetched.repartition("kmer").sortWithinPartitions("kmer"), _compare, span_schema)
    spans = stored(whole.unionByName(compared), "repeat-spans")
    placed = occurrences.join(spans, contexts).select(
        "key_a", "key_b", F.struct((F.col("a") + F.col("s_lo")).alias("a"), (F.col("b") + F.col("s_lo")).alias("b")).alias("span")
    )
    per_row = placed.groupBy("key_a", "key_b").agg(F.collect_set("span").alias("spans")).select(
        "key_a", "key_b", F.col("spans.a").alias("span_a"), F.col("spans.b").alias("span_b")
    )
    joined = rows.join(per_row, ["key_a", "key_b"], "left").select("id", "text", "span_a", "span_b")
    schema = T.StructType([
        rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    ])
    return map_arrow(joined, _finish, schema).withColumnRenamed("id", id_col)
