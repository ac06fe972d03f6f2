"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic, one on ordinary text.

A window is several words, and windows overlap; text without spaces is cut into pieces that count as words. Between a
lead-in and a tail that both dictionaries hold, a window is compressed with either dictionary; the difference of the
lengths says how much more the toxic dictionary knew of it. Without lead-in and tail a block this short would be stored
raw, and a match near its end not be looked for. A document's features are the numbers of its windows whose difference
reaches each of several thresholds; a logistic curve calibrates them.

Both dictionaries are trained by zstandard's own trainer, on a part of every sampled row of their class, and share a
base trained on ordinary text. A dictionary of whole toxic texts mostly holds what both classes have in common, so the
toxic part is trained on passages: runs of bytes, within a word or over several, that follow many more different
beginnings in toxic text than in ordinary text. Counting different beginnings, not documents, keeps groups of copies
from making their own wording a sign. The ordinary part, as long, is trained on the windows of ordinary text.

The model is fitted on a bounded sample of labelled rows; a fourth of it is kept for the calibration.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import islice
from operator import sub

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.labelled import Logistic, Sample, held_out, sample
from skyloom.llm.work import hold, map_arrow

# Bounds of the training sample: rows of each class, bytes of a row, and characters of a row that dictionaries see.
TOXIC_ROWS, ORDINARY_ROWS, ROW_BYTES = 4000, 6000, 1 << 15
DICTIONARY_CHARS = 3000
CONTRAST, DEVIATIONS = 10.0, 1.5
# Bytes of the runs that are counted, with as many bytes before them as a beginning has; powers of two of counters.
RUNS, BEGINNING = (5, 6, 8, 12, 24), 6
COUNTERS, SEEN, COUNTERS_AT_ONCE = 1 << 22, 1 << 26, 1 << 18
BASE_BYTES, ADDED_BYTES, LEAST_BYTES = 4096, 8192, 512
BASE_WINDOWS = 50_000
SEGMENT, PART = 24, 6
# What the trainer writes between the entropy tables and the content of a dictionary.
OFFSETS = b"".join(n.to_bytes(4, "little") for n in (1, 4, 8))
THRESHOLDS = tuple(range(2, 10))
SLICE_CHARS = 1 << 20
PIECE, WORDS, STEP = 32, 4, 2
# Windows compressed in one call, and texts cut into windows together.
BATCH, TEXTS = 4000, 100
# Windows whose difference a Python worker keeps.
KNOWN_WINDOWS = 100_000
_known: dict[bytes, int] = {}
_known_of: list[Model] = []


class Model:
    """Dictionaries and calibration; small enough to send to every executor."""

    def __init__(self, base: bytes, toxic: bytes, ordinary: bytes):
        self.lead, self.tail = base[len(base) // 2 :][:16], base[len(base) // 4 :][:24]
        self.dictionaries = [base + ordinary, base + toxic]
        self.curve: Logistic | None = None
        self._compress = None

    def __getstate__(self):
        return {**self.__dict__, "_compress": None}

    def _compressors(self):
        if self._compress is None:
            parameters = zstandard.ZstdCompressionParameters(
                compression_level=6, window_log=15, hash_log=14, chain_log=14, search_log=6, min_match=5,
                target_length=16, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False,
                write_checksum=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            found = []
            for content in self.dictionaries:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=parameters)
                compressor = zstandard.ZstdCompressor(dict_data=d, compression_params=parameters)
                found.append(compressor.multi_compress_to_buffer)
            self._compress = found
        return self._compress

    def differences(self, windows: list[bytes]) -> list[int]:
        """Bytes that the toxic dictionary saves on each window against the ordinary one."""
        if not windows:
            return []
        lead, tail = self.lead + b" ", b" " + self.tail
        size = np.fromiter(map(len, windows), np.uint64, len(windows)) + np.uint64(len(lead) + len(tail))
        at = np.stack([size.cumsum() - size, size], axis=1)
        framed = zstandard.BufferWithSegments(lead + (tail + lead).join(windows) + tail, at.tobytes())
        ordinary, toxic = (compress(framed, threads=1) for compress in self._compressors())
        return list(map(sub, map(len, ordinary), map(len, toxic)))

    def saved(self, windows: list[bytes]) -> list[int]:
        """The differences of windows; those met before are looked up."""
        if _known_of != [self] or len(_known) > KNOWN_WINDOWS:
            _forget()
            _known_of.append(self)
        found = list(map(_known.get, windows))
        new = list({w for w, d in zip(windows, found) if d is None})
        if new:
            _known.update(zip(new, self.differences(new)))
            found = list(map(_known.__getitem__, windows))
        return found

    def features(self, text: str | None) -> np.ndarray:
        return self.features_of([text])[0]

    def features_of(self, texts: list[str | None]) -> np.ndarray:
        """A row of features for each text; windows of several texts are compressed in one call."""
        most = max(THRESHOLDS)
        counts = np.zeros((len(texts), most + 1), np.int64)
        waiting: list[bytes] = []
        owner: list[tuple[int, int]] = []

        def count() -> None:
            rows = np.repeat(*np.array(owner, np.int64).reshape(-1, 2).T)
            cells = rows * (most + 1) + np.clip(np.array(self.saved(waiting), np.int64), 0, most)
            counts[:] += np.bincount(cells, minlength=counts.size).reshape(counts.shape)
            waiting.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for windows in _windows(text or ""):
                waiting += windows
                owner.append((i, len(windows)))
                if len(waiting) >= BATCH:
                    count()
        count()
        reached = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        return np.log1p(np.c_[reached[:, list(THRESHOLDS)], reached[:, 0]])


def _windows(text: str) -> Iterator[list[bytes]]:
    """Overlapping windows of a lower-cased text, as lists of bounded length."""
    whole = b""
    for start in range(0, len(text), SLICE_CHARS):
        whole = _cut(whole, text, start)
        last = start + SLICE_CHARS >= len(text)
        # where the words begin, and one place more than the length after the last
        begins = np.r_[0, np.flatnonzero(np.frombuffer(whole, np.uint8) == 32) + 1, len(whole) + 1]
        n = len(begins) - 1 if whole else 0
        # the windows that more words follow, and of the last words one that reaches the end
        many = max(0, -(-(n - WORDS) // STEP)) + (last and n > 0)
        ends = begins[np.minimum(np.arange(many) * STEP + WORDS, n)] - 1
        windows = [whole[b:e] for b, e in zip(begins[: many * STEP : STEP].tolist(), ends.tolist())]
        for at in range(0, max(many, 1), BATCH):
            yield windows[at : at + BATCH]
        whole = whole[begins[many * STEP] :] if many * STEP < n else b""


def _cut(before: bytes, text: str, start: int) -> bytes:
    """The words carried over and those of the next slice, long ones in pieces, with a space between words."""
    words = text[start : start + SLICE_CHARS].lower().encode().split()
    if max(map(len, words), default=0) > PIECE:
        words = [w[at : at + PIECE] for w in words for at in range(0, len(w), PIECE)]
    return b" ".join([before, *words] if before else words)


def _forget() -> None:
    """Drops the differences kept; ``hold`` calls it when another operator takes the worker."""
    _known.clear()
    _known_of.clear()


def _features_of(model: Model, column: pa.Array) -> np.ndarray:
    """Features of the texts of a column, of which few are Python texts at a time."""
    starts = range(0, len(column), TEXTS)
    return np.concatenate([model.features_of(column.slice(at, TEXTS).to_pylist()) for at in starts])


def _features(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    hold("toxicity", _forget)
    for batch in batches:
        rows = _features_of(model.value, batch.column(0)).tolist() if batch.num_rows else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["features", "label"]
        )


def _score(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    hold("toxicity", _forget)
    known: Model | None = model.value
    for batch in batches:
        score = np.zeros(batch.num_rows)
        if known is not None and batch.num_rows:
            score = known.curve.score(_features_of(known, batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["id", "score"])


def _runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Counter of the run of ``length`` bytes at each place of a text, and a hash of it with its beginning."""
    x = np.frombuffer(b"\x00" * BEGINNING + text, np.uint8).astype(np.uint64)
    n = len(x) - BEGINNING - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.full(n, length, np.uint64)
    for i in range(length):
        run = (run ^ x[BEGINNING + i : BEGINNING + i + n]) * np.uint64(0x9E3779B97F4A7C15)
        run ^= run >> np.uint64(29)
    whole = run
    for i in range(BEGINNING):
        whole = (whole ^ x[i : i + n]) * np.uint64(0xBF58476D1CE4E5B9)
        whole = whole ^ (whole >> np.uint64(31))
    return (run & np.uint64(COUNTERS - 1)).astype(np.int64), (whole & np.uint64(SEEN - 1)).astype(np.int64)


def _plain(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().split()) + b" "


def _counted(texts: list[bytes], length: int) -> np.ndarray:
    """Different beginnings of each run in the texts; hashed, so a few runs share a counter."""
    seen, counts = np.zeros(SEEN >> 3, np.uint8), np.zeros(COUNTERS, np.int32)
    for text in texts:
        run, whole = _runs(text, length)
        # each hash once, with the first place that has it
        order = np.sort(whole << 32 | np.arange(len(whole)))
        whole, first = order >> 32, order & 0xFFFFFFFF
        once = np.r_[True, whole[1:] != whole[:-1]][: len(whole)]
        whole, first = whole[once], first[once]
        byte, bit = whole >> 3, np.left_shift(1, whole & 7).astype(np.uint8)
        new = (seen[byte] & bit) == 0
        if not new.any():
            continue
        # the bits are in order, so those of one byte stand together
        byte, bit = byte[new], bit[new]
        starts = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
        seen[byte[starts]] |= np.bitwise_or.reduceat(bit, starts)
        at, times = np.unique(run[first[new]], return_counts=True)
        counts[at] += times.astype(np.int32)
    return counts


def _strong(ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which counters are of strong contrast; a part of them at a time, so the logarithms of all never stand together."""
    totals = [max(1, int(c.sum())) for c in (ordinary, toxic)]
    strong = np.zeros(len(toxic), bool)
    for at in range(0, len(toxic), COUNTERS_AT_ONCE):
        o, t = (c[at : at + COUNTERS_AT_ONCE] + 0.5 for c in (ordinary, toxic))
        odds = np.log(t / o) + math.log(totals[0] / totals[1])
        strong[at : at + COUNTERS_AT_ONCE] = odds - DEVIATIONS * np.sqrt(1 / t + 1 / o) >= math.log(CONTRAST)
    return strong


def _passages(texts: list[bytes], strong: dict[int, np.ndarray]) -> list[bytes]:
    """The stretches of the texts that runs of strong contrast cover; once for each different surrounding."""
    found: dict[bytes, bytes] = {}
    for text in texts:
        covered = np.zeros(len(text) + 2, np.int32)
        for length, is_strong in strong.items():
            at = np.flatnonzero(is_strong[_runs(text, length)[0]])
            np.add.at(covered, at + 1, 1)
            np.add.at(covered, at + 1 + length, -1)
        edge = np.flatnonzero(np.diff((covered.cumsum() > 0).astype(np.int8)))
        for s, e in zip(edge[::2], edge[1::2]):
            found[text[max(0, s - BEGINNING) : e + BEGINNING]] = text[s:e]
    return list(found.values())


def _trained(size: int, samples: list[bytes]) -> bytes:
    """Content of a dictionary that zstandard trains; of too few samples the samples themselves."""
    try:
        d = zstandard.train_dictionary(size, samples, k=SEGMENT, d=PART).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    return d[d.index(OFFSETS) + len(OFFSETS) :]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes, bytes] | None:
    """Base, toxic and ordinary content trained on texts of both classes; None if no passage tells them apart."""
    texts = [[_plain(t) for t in ordinary], [_plain(t) for t in toxic]]
    strong = {length: _strong(*(_counted(t, length) for t in texts)) for length in RUNS}
    passages = _passages(texts[1], strong)
    if not passages:
        return None
    base = _trained(BASE_BYTES, _some(ordinary))
    added = _trained(ADDED_BYTES, passages)
    return base, added, _trained(max(len(added), LEAST_BYTES), _some(ordinary))[-len(added) :]


def _some(texts: list[str]) -> list[bytes]:
    """An even share of the texts' windows, about as many as the trainer gets."""
    step = max(1, sum(map(len, texts)) // (BASE_WINDOWS * 12))
    return list(islice((w for t in texts for part in _windows(t) for w in part), 0, None, step))


def train(chosen: Sample) -> Model | None:
    """A model from a bounded sample; None without rows of both classes or any contrast."""
    for_words, for_curve = chosen.rows.where("part = 0"), chosen.rows.where("part = 1")
    length = F.length("text")
    room = F.greatest(length - DICTIONARY_CHARS, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.xxhash64("id", F.lit(3)), room).cast("int") + 1, F.lit(DICTIONARY_CHARS))
    seen = for_words.select("label", piece.alias("text"), F.xxhash64("id").alias("_h")).orderBy("_h", "text").toArrow()
    label, text = seen.column("label").to_pylist(), seen.column("text").to_pylist()
    by_class = [[t for t, y in zip(text, label) if y == c] for c in (1, 0)]
    del seen, label, text
    parts = dictionaries(*by_class)
    del by_class
    if parts is None or len(parts[0]) < 128:
        return None
    base, toxic, ordinary = parts
    # bytes after the last word: the end of a dictionary is not looked up
    model = Model(base, toxic + b" " + base[:16], ordinary + b" " + base[:16])
    shared = for_curve.sparkSession.sparkContext.broadcast(model)
    found = map_arrow(
        for_curve.select("text", "label"), partial(_features, model=shared), "features array<double>, label int"
    ).toArrow()
    y = found.column("label").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    total = chosen.totals
    weight = np.where(y == 1, total[1] / y.sum(), total[0] / (1 - y).sum())
    model.curve = Logistic(np.array(found.column("features").to_pylist()), y, weight * len(y) / weight.sum())
    return model


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: from 0 to 1, higher where toxicity is likelier.

    A null text counts as empty, and an empty one has the calibrated score of no toxic window. Without a model every
    score is 0. Texts are read whole; repeated rows are repeated, other columns ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, partial(_score, model=shared), f"id {kind}, score double")


FOLDS, HELD_OUT, CUT = 3, 1, 0.7


def model_of(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Trained on the labelled rows of ``docs`` outside the fold held out."""
    rows = {1: TOXIC_ROWS, 0: ORDINARY_ROWS}
    return train(sample(docs, labels, "toxic", ~held_out(HELD_OUT, FOLDS), rows, ROW_BYTES))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    found = scores(docs, model_of(docs, labels)).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", held_out(HELD_OUT, FOLDS).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = model_of(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, partial(_keep, model=shared, at=docs.columns.index("text")), docs.schema)


def _keep(batches: Iterator[pa.RecordBatch], model: Broadcast, at: int) -> Iterator[pa.RecordBatch]:
    hold("toxicity", _forget)
    known: Model | None = model.value
    for batch in batches:
        if known is None or not batch.num_rows:
            yield batch
            continue
        score = known.curve.score(_features_of(known, batch.column(at)))
        yield batch.filter(pa.array(score < CUT))
