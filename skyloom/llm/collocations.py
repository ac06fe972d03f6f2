"""Phrase collocations per language, mined by SON partitioning.

Pass 1 mines every shard completely. The table has a fixed number of shards, dealt by a hash of the text, so the
lowered support (the support divided by the number of shards) does not fall as the table grows: a phrase counted
``support`` times has at least that share in one of the shards. A shard is spread over all tasks and counted by Spark,
level by level: a phrase of k words is counted in a shard only where the two phrases of k - 1 words in it were frequent
there. Phrases are counted as hashes of 62 bits beside two bits of the shard, so a row is two numbers; the hashes
frequent at a level go to the tasks as a filter of bounded size, which may let others pass but never leaves out one.
Each shard that does not report a phrase holds it at most as often as one less than the lowered support: a phrase whose
reported counts plus that slack of the other shards stay under the support is left out (the rest stays closed under
prefixes). Pass 2 counts the remaining candidates by their words: what a filter or a collision of hashes lets pass in
pass 1 has its own count here and is dropped by the support. Within the texts that a task counts together (about
``shard_chars`` characters), phrases are told apart by their 64-bit hashes. Scores, cuts, the drop of phrases inside
longer ones and the ranking are DataFrame operations, the scores exact in decimal(38, 0).

The rows of pass 1 are at most the words of the table at each level, and those frequent at most a share of them fixed by
the lowered support; where a very large table fills the filter, more phrases are counted, each still exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F, types as T

from skyloom.llm.work import map_arrow, stored

# Fixed values of the contract: piece separators, phrase lengths, support, list length, the letters lower-cased.
PIECE_SEPARATORS = ".,;:!?\x0a\x0b\x0c\x0d"
LONGEST = 5
SUPPORT = 100
TOP = 2000
# Shards, whose number takes the two lowest bits of a hash; characters counted together in a task; 64-bit words of a filter.
SHARDS = 4
SHARD_CHARS = 16 << 20
BROADCAST_PHRASES = 1 << 21

_TOKEN = re.compile(r"[^\x20\x09.,;:!?\x0a-\x0d]+|[.,;:!?\x0a-\x0d]")
_SEPARATORS = list(PIECE_SEPARATORS)
_HASHED = "key long, f long"
_COUNTED = "lang string, phrase string, f long"
_BATCH_ROWS = 200_000
# Bytes of phrases cut out of the texts at once.
_PHRASE_BYTES = 4 << 20
# Bytes: 0 of a word, 1 between words, 2 between pieces; A-Z lower-cased.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(PIECE_SEPARATORS.encode())] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words of more bytes are hashed one by one.
_SHORT = 64
_ODD, _ODDER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# ``words_of``, ``mine`` and ``Matcher`` are the same counts in memory, on words instead of hashes.
def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts (already lower-cased) and the number of the piece of each; texts never share a piece."""
    tokens = pd.Series(_TOKEN.findall("\n".join(texts)), dtype=object)
    sep = tokens.isin(_SEPARATORS).to_numpy()
    piece = np.cumsum(sep)
    return tokens.to_numpy()[~sep], piece[~sep]


def _phrase(words: np.ndarray, at: int, k: int) -> str:
    return " ".join(words[at : at + k])


def mine(words: np.ndarray, piece: np.ndarray, least: int) -> Iterator[tuple[str, int]]:
    """(phrase, count) of every phrase of 1 to 5 words within a piece counted ``least`` times or more."""
    if len(words) == 0:
        return
    ids = pd.factorize(words)[0].astype(np.int64)
    width = np.int64(ids.max() + 1)
    uniq, first, counts = np.unique(ids, return_index=True, return_counts=True)
    keep = counts >= least
    lookup = np.full(int(width), -1, np.int64)
    lookup[uniq[keep]] = np.arange(keep.sum())
    code = lookup[ids]
    for at, c in zip(first[keep].tolist(), counts[keep].tolist()):
        yield str(words[at]), c
    for k in range(2, LONGEST + 1):
        m = len(words) - k + 1
        if m <= 0 or not (code >= 0).any():
            return
        ok = (code[:m] >= 0) & (piece[:m] == piece[k - 1 :]) & (lookup[ids[k - 1 :]] >= 0)
        pos = np.flatnonzero(ok)
        if len(pos) == 0:
            return
        key = code[pos] * width + ids[pos + k - 1]
        uniq, first, inv, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        keep = counts >= least
        index = np.full(len(uniq), -1, np.int64)
        index[keep] = np.arange(keep.sum())
        code = np.full(m, -1, np.int64)
        code[pos] = index[inv]
        for at, c in zip(pos[first[keep]].tolist(), counts[keep].tolist()):
            yield _phrase(words, at, k), c


class Matcher:
    """Counts of known phrases in a shard, matched level by level through their prefixes."""

    def __init__(self, phrases: list[str]) -> None:
        by_length: list[list[list[str]]] = [[] for _ in range(LONGEST + 1)]
        for p in phrases:
            parts = p.split(" ")
            by_length[len(parts)].append(parts)
        self.words = pd.Index([p[0] for p in by_length[1]])
        self.levels: list[tuple[pd.Index, list[str]]] = []
        previous = {p[0]: i for i, p in enumerate(by_length[1])}
        word_index = dict(previous)
        width = max(len(self.words), 1)
        self.width = np.int64(width)
        for k in range(2, LONGEST + 1):
            keys, names, here = [], [], {}
            for parts in by_length[k]:
                head = previous.get(" ".join(parts[:-1]))
                last = word_index.get(parts[-1])
                if head is None or last is None:
                    continue
                here[" ".join(parts)] = len(keys)
                keys.append(head * width + last)
                names.append(" ".join(parts))
            self.levels.append((pd.Index(np.array(keys, np.int64)), names))
            previous = here

    def counts(self, words: np.ndarray, piece: np.ndarray) -> Iterator[tuple[str, int]]:
        if len(words) == 0 or len(self.words) == 0:
            return
        wid = self.words.get_indexer(words).astype(np.int64)
        found = np.bincount(wid[wid >= 0], minlength=len(self.words))
        for i in np.flatnonzero(found).tolist():
            yield self.words[i], int(found[i])
        code = wid
        for k, (index, names) in enumerate(self.levels, start=2):
            m = len(words) - k + 1
            if m <= 0 or len(names) == 0:
                return
            ok = (code[:m] >= 0) & (wid[k - 1 :] >= 0) & (piece[:m] == piece[k - 1 :])
            pos = np.flatnonzero(ok)
            hit = index.get_indexer(code[pos] * self.width + wid[pos + k - 1]) if len(pos) else np.array([], int)
            code = np.full(m, -1, np.int64)
            code[pos] = hit
            found = np.bincount(hit[hit >= 0], minlength=len(names))
            for i in np.flatnonzero(found).tolist():
                yield names[i], int(found[i])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODDER
    return h ^ (h >> np.uint64(29))


def _hash_of(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little")


class Words:
    """Words of texts of one language as 64-bit hashes; ``data`` holds their bytes, lower-cased."""

    def __init__(self, texts: list[str], lang: str) -> None:
        x = _LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)]
        kind = _KIND[x]
        edges = np.flatnonzero(np.diff(np.r_[False, kind == 0, False].view(np.int8)))
        self.data, self.begin, self.end = x.tobytes(), edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.begin]
        size = self.end - self.begin
        # in order of length, so the words that have one more byte stand together
        order = np.argsort(np.minimum(size, _SHORT + 1).astype(np.int16), kind="stable")[::-1]
        shorter = np.cumsum(np.bincount(np.minimum(size, _SHORT + 1), minlength=_SHORT + 2))
        some = order[len(size) - shorter[_SHORT] :]
        begin, ordered = self.begin[some], np.full(len(some), _hash_of(lang.encode()), np.uint64)
        for k in range(_SHORT):
            many = int(shorter[_SHORT] - shorter[k])
            if many == 0:
                break
            part = ordered[:many]
            part ^= x[begin[:many] + k]
            part *= _ODD
            part ^= part >> np.uint64(32)
        h = np.full(len(size), _hash_of(lang.encode()), np.uint64)
        h[some] = ordered
        for i in np.flatnonzero(size > _SHORT).tolist():
            h[i] ^= np.uint64(_hash_of(self.data[self.begin[i] : self.end[i]]))
        self.hashes = _mixed(h)
        self.plain: np.ndarray | None = None

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to 5 words: a hash for every place that has as many words from it on, and where one piece holds them."""
        h = self.hashes
        for k in range(1, LONGEST + 1):
            m = len(self.hashes) - k + 1
            if m <= 0:
                return
            if k > 1:
                h = _mixed((h[:m] + np.uint64(k)) * _ODD + self.hashes[k - 1 :])
            yield h, self.piece[:m] == self.piece[k - 1 :]

    def phrase(self, at: int, k: int) -> str:
        return b" ".join(self.data[self.begin[at] : self.end[at + k - 1]].split()).decode()

    def phrases(self, at: np.ndarray, k: int) -> Iterator[tuple[slice, pa.Array]]:
        """The phrases of ``k`` words at places in one piece each, and which of the places: about a few MB at a time."""
        if self.plain is None:
            # the words with one space after each, so a phrase stands there as it is
            x = np.frombuffer(self.data + b" ", np.uint8).copy()
            held = _KIND[x] == 0
            x[self.end], held[self.end] = 32, True
            self.plain = x[held]
        after = np.cumsum(self.end - self.begin + 1)
        stop = after[at + k - 1] - 1
        start = after[at] - 1 - (self.end[at] - self.begin[at])
        upto = np.cumsum(stop - start)
        done = 0
        while done < len(at):
            before = upto[done - 1] if done else 0
            next_ = max(done + 1, int(np.searchsorted(upto, before + _PHRASE_BYTES)))
            part = slice(done, min(next_, done + _BATCH_ROWS))
            done = part.stop
            offsets = np.r_[0, upto[part] - before].astype(np.int32)
            places = np.arange(offsets[-1]) + np.repeat(start[part] - offsets[:-1], np.diff(offsets))
            data = pa.py_buffer(self.plain[places])
            yield part, pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data)


def _blocks(batches: Iterator[pa.RecordBatch], shard_chars: int) -> Iterator[dict[tuple[str, int], list[str]]]:
    """Texts by language and shard, about ``shard_chars`` characters at a time."""
    block: dict[tuple[str, int], list[str]] = {}
    size = 0
    for batch in batches:
        for lang, shard, text in zip(*(c.to_pylist() for c in batch.columns)):
            block.setdefault((lang, shard), []).append(text)
            size += len(text)
            if size >= shard_chars:
                yield block
                block, size = {}, 0
    if block:
        yield block


def _passes(keys: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    """Whether keys may be among those a filter was made of; without a filter all may."""
    if bits is None:
        return np.ones(len(keys), bool)
    held = bits[(keys & np.uint64(len(bits) - 1)).astype(np.int64)]
    return (held >> (keys >> np.uint64(50) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _filter(keys: DataFrame, longs: int) -> Broadcast | None:
    """A filter of the column ``key`` for the tasks, of as many 64-bit words as there are keys or ``longs`` at most."""
    if longs <= 0:
        return None
    size = 1 << (max(1, min(keys.count(), longs)).bit_length() - 1)
    slots = keys.groupBy(F.expr(f"key & {size - 1}L").alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(key, 50) & 63 as int)))").alias("held")
    ).toArrow()
    bits = np.zeros(size, np.uint64)
    bits[slots.column("slot").to_numpy()] = slots.column("held").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bits)


def _value(bits: Broadcast | None) -> np.ndarray | None:
    return None if bits is None else bits.value


def _keys(words: Words, shard: int, level: int, bits: np.ndarray | None) -> np.ndarray:
    """Keys of the phrases of ``level`` words whose parts of one word less pass the filter."""
    passing = None
    for k, (h, whole) in enumerate(words.levels(), start=1):
        key = (h & ~np.uint64(SHARDS - 1)) | np.uint64(shard)
        if k == level:
            return key[whole if passing is None else whole & passing[:-1] & passing[1:]]
        if k == level - 1:
            passing = _passes(key, bits)
    return np.zeros(0, np.uint64)


def _local(batches, level: int, frequent: Broadcast | None, shard_chars: int):
    """Pass 1: hashes of the phrases of ``level`` words in the shards, with their counts in each block of texts."""
    bits = _value(frequent)
    for block in _blocks(batches, shard_chars):
        found = [_keys(Words(texts, lang), shard, level, bits) for (lang, shard), texts in block.items()]
        key, f = np.unique(np.concatenate(found), return_counts=True)
        for at in range(0, len(key), _BATCH_ROWS):
            part = slice(at, at + _BATCH_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[part].view(np.int64)), pa.array(f[part].astype(np.int64))], ["key", "f"]
            )


def _matched(batches, candidates: Broadcast | None, shard_chars: int):
    """Pass 2: counts of the candidates in each block of texts; a row without phrase counts the words of a language."""
    bits = _value(candidates)
    for block in _blocks(batches, shard_chars):
        for (lang, _), texts in block.items():
            words = Words(texts, lang)
            if len(words.hashes):
                yield _rows(lang, pa.nulls(1, pa.string()), np.array([len(words.hashes)]))
            before = np.ones(len(words.hashes), bool)
            for k, (h, whole) in enumerate(words.levels(), start=1):
                key = h // np.uint64(SHARDS)
                # candidates are closed under prefixes
                before = whole & before[: len(h)]
                at = np.flatnonzero(before)
                at = at[_passes(key[at], bits)]
                before = np.zeros(len(h), bool)
                before[at] = True
                codes, found = pd.factorize(h[at])
                # codes go by first appearance
                first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
                f = np.bincount(codes, minlength=len(found))
                for part, phrases in words.phrases(at[first], k):
                    yield _rows(lang, phrases, f[part])


def _rows(lang: str, phrases: pa.Array, f: np.ndarray) -> pa.RecordBatch:
    langs = pa.repeat(pa.scalar(lang, pa.string()), len(phrases))
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(f, pa.int64())], ["lang", "phrase", "f"])


def phrase_counts(
    texts: DataFrame,
    support: int = SUPPORT,
    shard_chars: int = SHARD_CHARS,
    broadcast_phrases: int = BROADCAST_PHRASES,
) -> tuple[DataFrame, DataFrame]:
    """(frequent, totals): exact counts f of every phrase of 1 to 5 words with f >= support, and words n, per lang.

    ``texts`` has columns lang and text, both not null; A-Z are lower-cased here. ``broadcast_phrases`` bounds the
    filters, in 64-bit words; with 0 there is none and every phrase is counted.
    """
    rows = texts.select("lang", F.pmod(F.xxhash64("text"), F.lit(SHARDS)).cast("int").alias("shard"), "text")
    least = max(1, -(-support // SHARDS))
    local, bits = [], None
    for level in range(1, LONGEST + 1):
        hashed = map_arrow(rows, partial(_local, level=level, frequent=bits, shard_chars=shard_chars), _HASHED)
        found = stored(
            hashed.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least), f"collocation-local-{level}"
        )
        local.append(found)
        if level < LONGEST:
            if found.isEmpty():
                break
            bits = _filter(found, broadcast_phrases)
    # a shard that does not report a phrase holds it at most least - 1 times
    phrase_key = F.expr(f"shiftrightunsigned(key, {SHARDS.bit_length() - 1})").alias("key")
    reported = reduce(DataFrame.unionAll, local).groupBy(phrase_key).agg(
        F.sum("f").alias("f"), F.count("f").alias("shards")
    )
    bound = F.col("f") + (SHARDS - F.col("shards")) * (least - 1)
    candidates = stored(reported.where(bound >= support).select("key"), "collocation-candidates")
    matched = partial(_matched, candidates=_filter(candidates, broadcast_phrases), shard_chars=shard_chars)
    counted = stored(
        map_arrow(rows, matched, _COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        .where(F.col("phrase").isNull() | (F.col("f") >= support)),
        "collocation-frequent",
    )
    totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    return counted.where(F.col("phrase").isNotNull()), totals


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    top: int = TOP,
    **options,
) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts split at . , ; : ! ? and U+000A to U+000D into pieces, pieces into words at U+0020
    and U+0009. A null text is empty and a null language is ``und``; every row counts, repeated rows included, and
    other columns are neither read nor returned. Candidates have 2 to 5 words and a = f >= support. Each cut after k
    words gives l and r, the counts of both parts, and floor(1000 a n / (l r)); the lowest counts, ties to the
    smallest k. A candidate inside a longer candidate with f(longer) >= a is dropped. Ranks go by score, then a
    descending, then phrase in byte order. An empty table or one without candidates gives no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    frequent, totals = phrase_counts(texts, support, **options)
    with_words = frequent.withColumn("words", F.split("phrase", " ")).withColumn("k", F.size("words"))
    cand = with_words.where(F.col("k") >= 2).withColumnRenamed("f", "a")
    cuts = cand.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", 1, F.col("cut")), " ").alias("left_phrase"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right_phrase"),
    )
    left = frequent.select("lang", F.col("phrase").alias("left_phrase"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right_phrase"), F.col("f").alias("r"))
    big = T.DecimalType(38, 0)
    scored = (
        cuts.join(left, ["lang", "left_phrase"]).join(right, ["lang", "right_phrase"]).join(totals, "lang")
        .withColumn(
            "score",
            F.expr(f"(cast(a as {big.simpleString()}) * cast(n as {big.simpleString()}) * 1000) div "
                   f"(cast(l as {big.simpleString()}) * cast(r as {big.simpleString()}))"),
        )
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")
    ).select("lang", "phrase", "best.*")
    # candidates of 3 or more words, with every contiguous part of 2 words or more shorter than themselves
    subs = cand.where(F.col("k") >= 3).select(
        "lang", "a", "words", "k",
        F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"),
    ).select(
        "lang", "a", "words", "k", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("s")
    ).select("lang", F.array_join(F.slice("words", F.col("s"), F.col("m")), " ").alias("phrase"), F.col("a").alias("fl"))
    cover = subs.groupBy("lang", "phrase").agg(F.max("fl").alias("fl"))
    kept = best.join(cover, ["lang", "phrase"], "left").where(F.col("fl").isNull() | (F.col("fl") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
