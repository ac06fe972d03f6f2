"""Language identification by prediction by partial matching.

For each language the bytes of training texts make a context tree of up to ``ORDER`` bytes. A byte is coded by the
longest known context; where it has not been seen there, an escape (method C: distinct successors over occurrences
plus distinct successors) leads to the next shorter context, down to a uniform byte. Statistics are frozen after
training, so a text's code length is a sum over its windows of ``ORDER`` + 1 bytes, and the code length of every
window of the training texts is computed once, for all languages together. Other windows are composed from their
escapes. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from skyloom.llm.work import crc_mod, free_name, map_arrow, ship, stored

ORDER = 3
# Bounds of the training sample, for each language: rows, and bytes of a row that may enter it.
TRAIN_ROWS = 400
TRAIN_BYTES = 1 << 16
SEGMENT = 1 << 18
UNDETERMINED = "und"
_PAD = b"\n" * ORDER
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _grams(data: np.ndarray, width: int) -> np.ndarray:
    """Each window of ``width`` bytes as a number; windows end at every byte after the padding."""
    out = np.zeros(len(data) - ORDER, np.uint32)
    for k in range(width):
        start = ORDER - width + 1 + k
        out = out << np.uint32(8) | data[start : start + len(out)]
    return out


def _count(key: tuple, rows: pa.Table) -> pa.Table:
    """(lang, gram, count) of the longest windows of one language's texts."""
    grams = [np.zeros(0, np.uint32)]
    for text in rows.column("text").to_pylist():
        data = np.frombuffer(_PAD + text.encode().translate(_LOWER), np.uint8)
        grams.append(_grams(data, ORDER + 1))
    found, count = np.unique(np.concatenate(grams), return_counts=True)
    lang = pa.array([key[0].as_py()] * len(found), pa.string())
    return pa.table({"lang": lang, "gram": pa.array(found.astype(np.int64)), "count": pa.array(count)})


class _Index:
    """Positions of 32-bit keys, by a sparse table with linear probing over whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 3)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        left, at, self.rounds = np.arange(len(keys)), self._home(keys), 0
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several the last one stays
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)
            self.rounds += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435761) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        at = self._home(keys)
        out = self.slots[at]
        if not len(self.keys):
            return out
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        for step in range(1, self.rounds):
            if not len(wrong):
                break
            found = self.slots[(at[wrong] + step) & (len(self.slots) - 1)]
            out[wrong] = found
            wrong = wrong[(found >= 0) & (self.keys[found] != keys[wrong])]
        out[wrong] = -1
        return out


class Model:
    """Code lengths in bits, for all languages, from counts of (language number, window)."""

    def __init__(self, languages: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.languages = languages
        n = len(languages)
        self.orders: list[tuple[_Index, np.ndarray, _Index, np.ndarray]] = []
        for order in range(ORDER + 1):
            # a suffix of the longest window, of order + 1 bytes
            mask = np.uint32((1 << 8 * (order + 1)) - 1)
            keys, at = np.unique(gram & mask, return_inverse=True)
            seen = np.zeros((len(keys), n))
            np.add.at(seen, (at, lang), count)
            contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(distinct, of, (seen > 0).astype(float))
            all_of = np.maximum(total + distinct, 1)
            escape = np.where(total > 0, -np.log2(np.maximum(distinct, 1) / all_of), 0.0)
            shorter = self._bits(keys, order - 1)
            coded = -np.log2(np.maximum(seen, 1) / all_of[of])
            bits = np.where(seen > 0, coded, escape[of] + shorter)
            self.orders.append((_Index(keys), bits.astype(np.float32), _Index(contexts), escape.astype(np.float32)))

    def _bits(self, gram: np.ndarray, order: int) -> np.ndarray:
        """Code length of the last byte of each window, in contexts of up to ``order`` bytes before it."""
        if order < 0:
            return np.full((len(gram), len(self.languages)), 8.0, np.float32)
        index, bits, contexts, escape = self.orders[order]
        key = gram & np.uint32((1 << 8 * (order + 1)) - 1)
        at = index.find(key)
        out = bits[at] if len(bits) else np.zeros((len(gram), len(self.languages)), np.float32)
        new = np.flatnonzero(at < 0)
        if len(new):
            shorter = self._bits(gram[new], order - 1)
            context = contexts.find(key[new] >> np.uint32(8))
            known = context >= 0
            shorter[known] += escape[context[known]]
            out[new] = shorter
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language. Long texts are taken in segments, each after its context."""
        out = np.zeros((len(texts), len(self.languages)))
        parts, owners, size = [], [], 0

        def flush():
            grams = np.concatenate([_grams(p, ORDER + 1) for p in parts])
            ends = np.cumsum([len(p) - ORDER for p in parts])
            sums = np.add.reduceat(self._bits(grams, ORDER), np.r_[0, ends[:-1]], axis=0, dtype=np.float64)
            np.add.at(out, owners, sums)

        for i, text in enumerate(texts):
            data = np.frombuffer(_PAD + text.translate(_LOWER), np.uint8)
            for start in range(0, len(data) - ORDER, SEGMENT):
                parts.append(data[start : start + SEGMENT + ORDER])
                owners.append(i)
                size += len(parts[-1])
                if size >= SEGMENT:
                    flush()
                    parts, owners, size = [], [], 0
        if parts:
            flush()
        return out


def _predict(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    known: Model = model.value
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        lang, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        written = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
        if written and known.languages:
            data = [texts[i].encode() for i in written]
            bits = known.lengths(data)
            best = bits.argmin(axis=1)
            size = np.maximum(64, [len(d) for d in data])
            share = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * (64 / size)[:, None]).sum(axis=1)
            lang[written] = np.array(known.languages, object)[best]
            score[written] = 1 / share
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
        )


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
) -> Model:
    """A model of up to ``rows`` texts of each language, chosen by a hash of the id.

    Rows without language, and texts that are null or longer than ``most_bytes``, don't enter the sample. The model's
    size is bounded by the sample's.
    """
    some = docs.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= most_bytes))
    keyed = some.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    drawn = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = keyed.withColumn("_n", F.row_number().over(drawn)).where(F.col("_n") <= rows)
    chosen = stored(chosen.select("id").distinct(), "language-sample")
    key = free_name(docs.columns, "sample_id")
    sample = some.join(chosen.withColumnRenamed("id", key), F.col(id_col) == F.col(key), "left_semi")
    sample = sample.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)

    def count(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _count(key, rows)

    counts = sample.groupBy("lang").applyInArrow(count, "lang string, gram long, count long").toArrow()
    names = counts.column("lang").to_numpy()
    languages, number = np.unique(names.astype(str), return_inverse=True)
    gram = counts.column("gram").to_numpy().astype(np.uint32)
    return Model(languages.tolist(), number, gram, counts.column("count").to_numpy())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every row.

    A text that is null or has no letter is ``und`` with score 0, and so is any text if the model has no language.
    Equal code lengths go to the first language by name. The score is the winner's share when code lengths are
    compared per 64 bytes. Long texts are read whole; other columns are ignored, repeated rows repeated.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = map_arrow(
        rows, partial(_predict, model=shared), f"id {rows.schema['id'].dataType.simpleString()}, "
        "lang_pred string, score double",
    )
    return found.withColumnRenamed("id", id_col)


def identified(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Predictions for all of ``docs`` by a model that has not seen the fold held out."""
    fold = crc_mod(F.col("doc_id"), folds)
    model = train(docs.where(fold != held_out))
    return predict(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score"
    )
