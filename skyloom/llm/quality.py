"""Quality classifier: naive Bayes support vectors.

A document's features are indicators of its word and mark n-grams (n = 1, 2), hashed to ``BITS`` bits. Each is scaled
by the log-count ratio of the classes, counted over a bounded sample of labelled training rows; a linear model with
hinge loss is then fitted to the scaled indicators by dual coordinate descent, on fewer rows of the sample. A logistic
curve on rows that neither has seen turns margins into scores.

Words are runs of letters, digits and bytes beyond ASCII, letters lower-cased and digits alike; marks are runs of one
other character. They are hashed for whole batches at once by polynomial prefix sums modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.labelled import Logistic, Sample, held_out, sample
from skyloom.llm.work import hold, map_arrow, ship

BITS = 18
# Bounds of the sample: rows of each class for the ratios, bytes of a row, rows of either class for the linear model.
CLASS_ROWS, ROW_BYTES, LINEAR_ROWS = 8000, 1 << 15, 6000
COST, PASSES, SMOOTHING = 1.0, 20, 1.0
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
# One feature for any token that follows itself.
_TWICE = np.uint64(0x5851F42D4C957F2D)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: what kind of run it belongs to (0 none, 1 word, else the mark itself), and its value."""
    kind, value = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint64)
    for c in range(33, 127):
        kind[c] = 1 if chr(c).isalnum() else c
    kind[128:] = 1
    value[65:91] += 32
    value[48:58] = 48
    return kind, value + 1


_KIND, _VALUE = _classes()


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    def run(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _MIX
    return (h ^ h >> np.uint64(29)) * _MIX


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each token of a byte array."""
    kind = _KIND[data]
    new = np.flatnonzero((kind[1:] != kind[:-1])) + 1
    starts = np.r_[0, new] if len(kind) else new
    ends = np.r_[starts[1:], len(kind)].astype(np.int64)
    solid = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    size = 1 << max(10, int(len(data)).bit_length())
    power, inverse = _powers(size)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * power[: len(data)], dtype=np.uint64)]
    return starts, _mixed((sums[ends] - sums[starts]) * inverse[starts])


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, feature) pairs; a long text comes in slices that end at white space, and may repeat features."""
    parts: list[bytes] = []
    owners: list[int] = []
    size = 0

    def flush():
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts])
        starts, h = tokens(data)
        owner = np.array(owners)[np.searchsorted(ends, starts, "right")]
        pair = owner[1:] == owner[:-1]
        both = _mixed(h[:-1] * np.uint64(3) + (h[1:] ^ h[1:] >> np.uint64(31)))
        both = np.where(h[:-1] == h[1:], _TWICE, both)[pair]
        feature = (np.r_[h, both] >> np.uint64(64 - BITS)).astype(np.int64)
        key = np.unique(np.r_[owner, owner[:-1][pair]].astype(np.int64) << BITS | feature)
        return key >> BITS, key & ((1 << BITS) - 1)

    for i, text in enumerate(texts):
        start = 0
        while start < len(text):
            end = min(len(text), start + CHUNK_BYTES)
            while end < len(text) and text[end] not in b" \t\n\r":
                end += 1
            parts.append(text[start:end])
            owners.append(i)
            size += end - start
            start = end
            if size >= CHUNK_BYTES:
                yield flush()
                parts, owners, size = [], [], 0
    if parts:
        yield flush()


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every n-gram present, each once, sorted."""
    found = list(_chunks(texts))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique(np.concatenate([owner << BITS | feature for owner, feature in found]))
    return key >> BITS, key & ((1 << BITS) - 1)


def _texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


# Counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature by class, summed over the rows of a task."""
    hold("quality", int)
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for at in range(0, batch.num_rows, 256):
            row, feature = indicators(_texts(batch.column(0).slice(at, 256)))
            for c in (0, 1):
                counts[c] += np.bincount(feature[label[at + row] == c], minlength=1 << BITS)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], ["feature", "n0", "n1"]
    )


def log_count_ratios(rows: DataFrame) -> np.ndarray | None:
    """One number per hashed feature, from (text, label) rows; None if a class is missing.

    The table of counts has at most 2^BITS rows, whatever the corpus.
    """
    counted = map_arrow(rows.select("text", "label"), _count, "feature long, n0 long, n1 long")
    total = counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    n = np.zeros((2, 1 << BITS))
    at = total.column("feature").to_numpy()
    for c in (0, 1):
        n[c, at] = total.column(f"n{c}").to_numpy()
    if not n.sum(axis=1).all():
        return None
    p = n + SMOOTHING
    p /= p.sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0])


# Linear model


def dual_coordinate_descent(
    start: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, dims: int
) -> np.ndarray:
    """Weights (bias last) of the hinge-loss model, for rows given as slices ``start[i]:start[i + 1]``.

    Each step solves the dual problem for one row and moves the weights along it; rows are visited in a random order
    and the bias is a constant feature of value one.
    """
    w, rng = np.zeros(dims + 1), np.random.default_rng(0)
    alpha, most = np.zeros(len(y)), COST * weight
    slices = [(feature[s:e], value[s:e]) for s, e in zip(start, start[1:])]
    square = [v @ v + 1.0 for _, v in slices]
    for _ in range(PASSES):
        largest = 0.0
        for i in rng.permutation(len(y)):
            f, v = slices[i]
            gradient = y[i] * (w[f] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), most[i])
            step = new - alpha[i]
            if step:
                w[f] += step * y[i] * v
                w[-1] += step * y[i]
                alpha[i] = new
                largest = max(largest, abs(step) * square[i])
        if largest < 1e-3:
            break
    return w


def _scaled(texts: list[bytes], ratio: np.ndarray):
    """Rows of scaled indicators of length one: slices, features, values."""
    row, feature = indicators(texts)
    value = ratio[feature]
    length = np.sqrt(np.bincount(row, value * value, len(texts)))
    return np.searchsorted(row, np.arange(len(texts) + 1)), feature, value / np.maximum(length[row], 1e-12)


class Model:
    """One weight per hashed feature, the ratio folded in, and the calibration."""

    def __init__(self, ratio: np.ndarray, w: np.ndarray):
        self.ratio = ratio.astype(np.float32)
        self.weight = (w[:-1] * ratio).astype(np.float32)
        self.bias = float(w[-1])
        self.curve: Logistic | None = None

    def margins(self, texts: list[bytes]) -> np.ndarray:
        row, feature = indicators(texts)
        n = len(texts)
        length = np.sqrt(np.bincount(row, self.ratio[feature] ** 2, n))
        return np.bincount(row, self.weight[feature], n) / np.maximum(length, 1e-12) + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        texts = _texts(column)
        parts = [self.margins(texts[at : at + 256]) for at in range(0, len(texts), 256)]
        return self.curve.score(np.concatenate(parts)[:, None]) if parts else np.zeros(0)


def _fit(rows: pa.Table, ratio: np.ndarray) -> pa.Table:
    """Weights from the rows of part 0 of the (bounded) sample, and the margins of the other rows."""
    label, part = rows.column("label").to_numpy(), rows.column("part").to_numpy()
    texts = _texts(rows.column("text"))
    fit, rest = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
    y = np.where(label[fit] == 1, 1.0, -1.0)
    start, feature, value = _scaled([texts[i] for i in fit], ratio)
    weight = len(y) / 2 / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    model = Model(ratio, dual_coordinate_descent(start, feature, value, y, weight, 1 << BITS))
    margins = model.margins([texts[i] for i in rest])
    return pa.table(
        {
            "weight": pa.array([model.weight.tobytes()], pa.binary()), "bias": [model.bias],
            "margins": pa.array([margins.tolist()], pa.list_(pa.float64())),
            "labels": pa.array([label[rest].tolist()], pa.list_(pa.int32())),
        }
    )


def train(chosen: Sample) -> Model | None:
    """A model from a bounded sample; None unless both classes are there, also to calibrate on.

    The linear model is fitted in one task, on about ``LINEAR_ROWS`` of the rows, chosen by a hash of the id.
    """
    ratio = log_count_ratios(chosen.rows.where("part = 0"))
    if ratio is None:
        return None
    total = chosen.totals
    prior = total[1] / (total[0] + total[1])
    spark = chosen.rows.sparkSession
    ship(spark)
    share_of_rows = LINEAR_ROWS / (2 * CLASS_ROWS)
    few = chosen.rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) < int(1000 * share_of_rows))
    shared = spark.sparkContext.broadcast(ratio)

    def fit(rows: pa.Table) -> pa.Table:
        return _fit(rows.sort_by("id"), shared.value)

    schema = "weight binary, bias double, margins array<double>, labels array<int>"
    found = few.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit, schema).collect()
    if not found or len(set(found[0].labels)) < 2:
        return None
    learned = np.frombuffer(bytes(found[0].weight), np.float32)
    model = Model(ratio, np.zeros(len(learned) + 1))
    model.weight, model.bias = learned, found[0].bias
    y = np.array(found[0].labels, float)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    model.curve = Logistic(np.array(found[0].margins)[:, None], y, weight)
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    hold("quality", int)  # keeps no words
    known: Model | None = model.value
    for batch in batches:
        score = known.scores(batch.column(1)) if known is not None else np.ones(batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["id", "score"])


def _keep(batches: Iterator[pa.RecordBatch], model: Broadcast, at: int) -> Iterator[pa.RecordBatch]:
    hold("quality", int)  # keeps no words
    known: Model | None = model.value
    for batch in batches:
        yield batch if known is None else batch.filter(pa.array(known.scores(batch.column(at)) >= CUT))


FOLDS, HELD_OUT, CUT = 5, 0, 0.3


def model_of(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Trained on the labelled rows of ``docs`` outside the fold held out."""
    rows = {0: CLASS_ROWS, 1: CLASS_ROWS}
    return train(sample(docs, labels, "quality", ~held_out(HELD_OUT, FOLDS), rows, ROW_BYTES))


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: from 0 to 1, higher where quality is likelier.

    A text that is null or has no token gets the score of the bias alone. Without a model every score is 1. Texts are
    read whole; repeated rows are repeated, other columns ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, partial(_score, model=shared), f"id {kind}, score double")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    found = scores(docs, model_of(docs, labels)).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", held_out(HELD_OUT, FOLDS).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be of quality, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model_of(docs, labels))
    return map_arrow(docs, partial(_keep, model=shared, at=docs.columns.index("text")), docs.schema)
