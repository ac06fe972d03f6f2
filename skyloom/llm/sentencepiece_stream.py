"""SentencePiece encoding and decoding, with a streaming Viterbi search for BPE models.

Every boundary of the text holds one backpointer: the last piece of the BPE encoding of the text up to there. It is
the one piece whose start boundary is reachable and whose pair with the piece before it is stable, that is, encoded
to itself; a sequence of pieces is the BPE encoding exactly if every pair of neighbours is. Only boundaries within the
longest piece matter for what follows, so the window holds no more than those and the paths not yet agreed on: as soon
as the backpointers of all boundaries in the window lead through one boundary, the ids before it are committed.

No piece runs from a character into the white space after it, so words are such stretches between agreed boundaries;
ids of words already seen are looked up. A backpointer depends on the text before its boundary only, so the new words of
several texts are searched side by side, one boundary of each at a time (``Search``). What no piece splits into parts of
the longest piece goes through the stream. Ids equal those of the sentencepiece library, byte fallback included.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import md5
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.work import hold, map_arrow, texts_of

SPACE = "▁"
# Words of each of two generations that a Python worker keeps, their length, and pairs of pieces.
KNOWN_WORDS, KNOWN_LENGTH, KNOWN_PAIRS = 250_000, 48, 400_000
# Characters whose words are looked up together, and texts read together.
SLICE_CHARS, TEXTS = 1 << 18, 100
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_loaded: dict[bytes, Pieces] = {}


class Pieces:
    """The vocabulary of a model: ids and ranks of pieces, pair checks, and the encoder over them."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.ids = {
            p: i for i, p in enumerate(self.pieces)
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        }
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        # flags 1: a piece, 2: the end of a longer one; above them the number that stands for the piece in a pair
        self.kinds = {p: (i << 2) + 1 for i, p in enumerate(self.ids, 1)}
        for end in {p[k:] for p in self.ids for k in range(1, len(p))}:
            self.kinds[end] = self.kinds.get(end, 0) | 2
        self.joints = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = sp.unk_id()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.decoded = [self._bytes_of(sp, i) for i in range(n)]
        self.search = Search(self)
        # by the numbers of both pieces: strings as keys would take several times the memory
        self.pairs: dict[int, bool] = {}
        # ids of words met before, as the bytes of 32-bit integers; when full, they become the older ones
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.room = KNOWN_WORDS

    def _bytes_of(self, sp, i: int) -> bytes:
        if sp.is_byte(i):
            return bytes([int(self.pieces[i][3:5], 16)])
        if sp.is_control(i):
            return b""
        if sp.is_unknown(i):
            return " ⁇ ".encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def merged(self, text: str) -> list[str]:
        """BPE by its definition: the best pair of neighbours, the first of equals, is merged until none is a piece."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def number(self, piece: str, kind: int) -> int:
        """The number of a piece, or one above all of them for a character that is none; 0 for the empty piece."""
        if kind & 1:
            return kind >> 2
        return (1 << 24) + ord(piece) if piece else 0

    def stable(self, left: str, right: str, key: int) -> bool:
        """Whether two neighbouring pieces encode to themselves; the left one may be empty."""
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        found = self.merged(left + right) == ([left, right] if left else [right])
        self.pairs[key] = found
        return found

    def word(self, word: str) -> bytes | None:
        """Ids of a word met before; one of the older words becomes a newer one."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is not None:
                self.keep(word, ids)
        return ids

    def keep(self, word: str, ids: bytes) -> None:
        if len(word) > KNOWN_LENGTH:
            return
        if len(self.known) >= self.room:
            self.older = dict(self.known)
            self.known.clear()
        self.known[word] = ids

    def extend(self, text: str, last: list[str | None], lefts: list[int]) -> None:
        """Sets the backpointers of the boundaries of ``text`` that ``last`` does not hold yet.

        ``last`` holds the piece that ends at each boundary, if one can, and ``lefts`` what that piece adds to the
        key of a pair as its left one.
        """
        kinds, pairs = self.kinds, self.pairs
        for end in range(len(last), len(text) + 1):
            found, left = None, 0
            start = end - 1
            while start >= 0:
                piece = text[start:end]
                kind = kinds.get(piece, 0)
                if kind & 1 or start == end - 1:
                    before = last[start]
                    if before is not None:
                        number = kind >> 2 if kind & 1 else self.number(piece, kind)
                        key = lefts[start] + number
                        stable = pairs.get(key)
                        if self.stable(before, piece, key) if stable is None else stable:
                            found, left = piece, number << 32
                            break
                if not kind & 2:
                    break
                start -= 1
            last.append(found)
            lefts.append(left)

    def ids_of(self, piece: str) -> list[int]:
        """A piece's id, or the bytes of a character that is none."""
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if len(self.bytes) == 256:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]


class Table:
    """Small numbers by keys of 62 bits, in open addressing; ``room`` keys fill half of it at most."""

    def __init__(self, room: int):
        bits = (2 * room).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values, self.n = np.full(1 << bits, -1), np.full(1 << bits, -1, np.int32), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands, or the free place for it."""
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        held = self.keys[slot]
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            slot[rest] = slot[rest] + 1 & self.mask
            held = self.keys[slot[rest]]
            rest = rest[(held != keys[rest]) & (held >= 0)]
        return slot

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for one that is not held."""
        return self.values[self._slots(keys)]

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are not held yet, each once."""
        self.n += len(keys)
        while len(keys):
            slot, first = np.unique(self._slots(keys), return_index=True)
            self.keys[slot], self.values[slot] = keys[first], values[first]
            keys, values = np.delete(keys, first), np.delete(values, first)


class Search:
    """The backpointers of many words at once: numbers of pieces in arrays instead of strings."""

    def __init__(self, p: Pieces):
        self.p = p
        self.names = ["", *p.ids]
        self.ids = np.array([0, *p.ids.values()], np.int32)
        # 1 for a character that is no piece
        self.size = np.array([max(1, len(name)) for name in self.names])
        # a character's place in the alphabet of the pieces, 0 for others
        alphabet = sorted({c for name in self.names for c in name})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.letters = len(alphabet) + 1
        letter_of = dict(zip(alphabet, range(1, self.letters)))
        self.alone = np.array([True, *(c in p.ids for c in alphabet)])
        # pieces from their last character on: what a node and the letter before it lead to, and the piece at a node
        nodes, piece_at, steps = {"": 0}, [0], {}
        for number, name in enumerate(self.names[1:], 1):
            for k in range(1, len(name) + 1):
                end = name[-k:]
                if end not in nodes:
                    steps[nodes[end[1:]] * self.letters + letter_of[end[0]]] = nodes[end] = len(piece_at)
                    piece_at.append(0)
            piece_at[nodes[name]] = number
        self.piece_at = np.array(piece_at)
        self.steps = Table(len(steps))
        self.steps.put(*(np.fromiter(x, np.int64, len(steps)) for x in (steps.keys(), steps.values())))
        self.joints = Table(len(p.joints))
        joints = np.array([letter_of[a] * self.letters + letter_of[b] for a, b in p.joints], np.int64)
        self.joints.put(joints, np.ones(len(joints), np.int32))
        self.pairs = Table(KNOWN_PAIRS)

    def _stable(self, keys: np.ndarray) -> np.ndarray:
        """Whether pairs are stable, by the number of the left piece in the upper and of the right one in the lower half."""
        found = self.pairs.get(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, which = np.unique(keys[missing], return_inverse=True)
            stable = np.zeros(len(new), np.int32)
            for i, key in enumerate(new.tolist()):
                left, right = self.names[key >> 32], self.names[key & 0xFFFFFFFF]
                stable[i] = self.p.merged(left + right) == ([left, right] if left else [right])
            found[missing] = stable[which]
            if self.pairs.n + len(new) > KNOWN_PAIRS:
                self.pairs = Table(KNOWN_PAIRS)
            self.pairs.put(new[:KNOWN_PAIRS], stable[:KNOWN_PAIRS])
        return found > 0

    def _pieces(self, letter: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, number) of every piece that ends at a character and begins in its part, the shorter ones first."""
        end = np.flatnonzero(letter)
        node = np.zeros(len(end), np.int64)
        ends, numbers, size = [end[:0]], [end[:0]], 0
        while len(end):
            node = self.steps.get(node * self.letters + letter[end - size])
            here = node > 0
            node, end, size = node[here].astype(np.int64), end[here], size + 1
            number = self.piece_at[node]
            ends.append(end[number > 0])
            numbers.append(number[number > 0])
            more = place[end] >= size
            node, end = node[more], end[more]
        return np.concatenate(ends), np.concatenate(numbers)

    def _last(self, letter: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number of the piece that ends with each character in the encoding up to there; 0 if none can."""
        end, number = self._pieces(letter, place)
        order = np.argsort(place[end].astype(np.int16), kind="stable")
        end, number = end[order], number[order]
        before = end - self.size[number]
        first = place[end] + 1 == self.size[number]
        last = np.zeros(len(letter), np.int64)
        start = 0
        for stop in np.cumsum(np.bincount(place[end])).tolist():
            left = np.where(first[start:stop], 0, last[before[start:stop]])
            at = np.flatnonzero(first[start:stop] | (left > 0))
            # of several the shortest, which comes last here
            at = at[self._stable(left[at] << 32 | number[start + at])][::-1]
            last[end[start + at]] = number[start + at]
            start = stop
        return last

    def found(self, words: list[str]) -> list[bytes | None]:
        """Ids of words; None for one that is to be searched by itself.

        That is one with a part longer than the longest piece. Parts are what no piece runs over: no piece holds two
        characters that are no joint.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = sizes.cumsum()
        starts = ends - sizes
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        letter = self.letter[code].astype(np.int64)
        begins = letter == 0
        begins[1:] |= begins[:-1]
        begins[starts] = True
        # the parts of words that are not short anyway
        inner = np.flatnonzero(~begins & np.repeat(sizes > self.p.longest, sizes))
        begins[inner] = self.joints.get(letter[inner - 1] * self.letters + letter[inner]) < 0
        opened = np.flatnonzero(begins)
        place = np.arange(len(letter)) - np.repeat(opened, np.diff(opened, append=len(letter)))
        fits = np.logical_and.reduceat(self.alone[letter] & (place < self.p.longest), starts)
        if not fits.all():
            some = iter(self.found([w for w, f in zip(words, fits.tolist()) if f]) if fits.any() else ())
            return [next(some) if f else None for f in fits.tolist()]
        last = self._last(letter, place)
        # how many ids stand for a character: one where a piece ends, found from the end of each part back
        many = np.zeros(len(letter), np.int64)
        at = np.append(opened[1:], len(letter)) - 1
        while len(at):
            many[at] = 1
            at = at[place[at] >= self.size[last[at]]]
            at = at - self.size[last[at]]
        others = {c: self.p.ids_of(chr(c)) for c in np.unique(code[letter == 0]).tolist()}
        for c, ids in others.items():
            many[code == c] = len(ids)
        stops = many.cumsum()
        ids = np.repeat(self.ids[last], many)
        for c, its in others.items():
            at = np.flatnonzero(code == c)
            ids[(stops[at] - len(its))[:, None] + np.arange(len(its))] = its
        joined, stops = ids.tobytes(), (4 * stops[ends - 1]).tolist()
        return [joined[a:b] for a, b in zip([0, *stops], stops)]


class Stream:
    """Encodes a text handed over in parts; memory is bounded by the window of undecided boundaries."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.text = ""  # from the last agreed boundary on
        self.last: list[str | None] = [""]  # the piece that ends at each boundary, if one can
        self.lefts = [0]  # what it adds to the key of a pair
        self.done: list[int] = []
        self.widest = 0

    def push(self, part: str) -> list[int]:
        """Takes more text and returns the ids agreed on since the last call."""
        longest = self.p.longest
        for k in range(0, len(part), longest):
            self.text += part[k : k + longest]
            self.p.extend(self.text, self.last, self.lefts)
            self.widest = max(self.widest, len(self.last))
            if len(self.text) > longest:
                self._commit(len(self.text) - longest)
        out, self.done = self.done, []
        return out

    def _path(self, end: int) -> list[int]:
        """Boundaries of the best path to ``end``, from the last one back."""
        out = [end]
        while end > 0:
            end -= len(self.last[end])
            out.append(end)
        return out

    def _commit(self, first: int) -> None:
        """Gives out the pieces before the last boundary that all paths open from ``first`` on lead through."""
        shared: set[int] | None = None
        for end in range(first, len(self.last)):
            if self.last[end] is not None:
                path = set(self._path(end))
                shared = path if shared is None else shared & path
        if shared:
            self._give(max(shared))

    def _give(self, end: int) -> None:
        if end <= 0:
            return
        at = self._path(end)[::-1]
        for a, b in zip(at, at[1:]):
            self.done += self.p.ids_of(self.text[a:b])
        self.text = self.text[end:]
        self.last = self.last[end:]
        self.lefts = self.lefts[end:]

    def finish(self) -> list[int]:
        self._give(len(self.last) - 1)
        out, self.done = self.done, []
        return out


def _parts(p: Pieces, word: str) -> list[str]:
    """Parts of a word that no piece runs over: no piece holds two characters that are no joint."""
    joints, start, out = p.joints, 0, []
    if joints.issuperset(map(add, word, word[1:])):
        return [word]
    for k in range(1, len(word)):
        if word[k - 1 : k + 1] not in joints:
            out.append(word[start:k])
            start = k
    return [*out, word[start:]]


def _found(p: Pieces, words: Iterable[str]) -> dict[str, bytes]:
    """Ids of words that are not looked up, each word searched from the boundaries it shares with the one before."""
    out: dict[str, bytes] = {}
    last: list[str | None] = [""]
    lefts, before = [0], ""
    ids_of = p.ids.get
    for word in sorted(words):
        if len(word) > p.longest:
            stream = Stream(p)
            out[word] = array("i", stream.push(word) + stream.finish()).tobytes()
            continue
        shared = 0
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        del last[shared + 1 :], lefts[shared + 1 :]
        p.extend(word, last, lefts)
        before = word
        n, ids = len(word), []
        while n:
            piece = last[n]
            i = ids_of(piece)
            ids += p.ids_of(piece)[::-1] if i is None else (i,)
            n -= len(piece)
        ids.reverse()
        out[word] = array("i", ids).tobytes()
    return out


def _new_words(p: Pieces, words: set[str]) -> dict[str, bytes]:
    """Ids of words, looked up or searched; they are kept."""
    out: dict[str, bytes] = {}
    new = []
    for word in words:
        ids = p.word(word)
        if ids is None:
            new.append(word)
        else:
            out[word] = ids
    rest = []
    if new:
        for word, ids in zip(new, p.search.found(new)):
            if ids is None:
                rest.append(word)
            else:
                out[word] = ids
                p.keep(word, ids)
    return out | _by_parts(p, rest) if rest else out


def _by_parts(p: Pieces, words: list[str]) -> dict[str, bytes]:
    """Ids of words, their parts looked up or found one by one; they are kept."""
    out: dict[str, bytes] = {}
    parts = {word: _parts(p, word) for word in words}
    known: dict[str, bytes] = {}
    missing = set()
    for part in {part for several in parts.values() for part in several}:
        ids = p.word(part)
        if ids is None:
            missing.add(part)
        else:
            known[part] = ids
    known |= _found(p, missing)
    for word, several in parts.items():
        out[word] = known[several[0]] if len(several) == 1 else b"".join(map(known.__getitem__, several))
        for part in several:
            if part in missing:
                p.keep(part, known[part])
                missing.discard(part)
        p.keep(word, out[word])
    return out


def _slices(text: str) -> Iterator[str]:
    """Parts of a text that end before white space, which no piece runs over."""
    start = 0
    while start < len(text):
        end = min(len(text), start + SLICE_CHARS)
        while end < len(text) and not (text[end] == SPACE and text[end - 1] != SPACE):
            end += 1
        yield text[start:end]
        start = end


def encode(p: Pieces, text: str | None) -> np.ndarray:
    """Ids of a whole text, without begin or end."""
    return encode_all(p, [text])[0]


def encode_all(p: Pieces, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of whole texts, without begin or end; the new words of several texts are found together."""
    found: list[list[bytes]] = [[] for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    chars = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for part in _slices(SPACE + text.replace(" ", SPACE)):
            waiting.append((i, _WORD.findall(part)))
            chars += len(part)
            if chars >= SLICE_CHARS:
                _look_up(p, waiting, found)
                waiting, chars = [], 0
    _look_up(p, waiting, found)
    return [np.frombuffer(b"".join(ids), np.int32) for ids in found]


def _look_up(p: Pieces, waiting: list[tuple[int, list[str]]], found: list[list[bytes]]) -> None:
    """Adds the ids of the words of each text to what is found of it."""
    known = p.known.get
    ids_of = [list(map(known, words)) for _, words in waiting]
    new = {w for (_, words), ids in zip(waiting, ids_of) if None in ids for w, x in zip(words, ids) if x is None}
    new_ids = _new_words(p, new) if new else {}
    for (i, words), ids in zip(waiting, ids_of):
        if None in ids:
            ids = [new_ids[w] if x is None else x for w, x in zip(words, ids)]
        found[i] += ids


def decode(p: Pieces, ids) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD, and the first space is the one that encoding added."""
    joined = b"".join(map(p.decoded.__getitem__, ids))
    text = joined.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _pieces(model: bytes, known_words: int = KNOWN_WORDS) -> Pieces:
    hold("sentencepiece", _loaded.clear)
    key = md5(model).digest()
    if key not in _loaded:
        _loaded[key] = Pieces(model)
    _loaded[key].room = known_words
    return _loaded[key]


def _encode(batches: Iterator[pa.RecordBatch], model: Broadcast, known_words: int) -> Iterator[pa.RecordBatch]:
    p = _pieces(model.value, known_words)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            ids = encode_all(p, part.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, flat)], ["id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    p = _pieces(model.value)
    for batch in batches:
        texts = [None if ids.as_py() is None else decode(p, ids.as_py()) for ids in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])


def _model(df: DataFrame, path: str) -> Broadcast:
    """The file's bytes, read by the driver and sent to the executors once."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", known_words: int = KNOWN_WORDS
) -> DataFrame:
    """(id_col, ids) of every row. A null or empty text has no ids; repeated rows are repeated, others ignored.

    A worker keeps the ids of up to twice ``known_words`` words; fewer take less memory and more time.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    encode_rows = partial(_encode, model=_model(docs, model_path), known_words=known_words)
    found = map_arrow(rows, encode_rows, f"id {kind}, ids array<int>")
    return found.withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row of ids; null stays null."""
    some = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = some.schema["id"].dataType.simpleString()
    found = map_arrow(some, partial(_decode, model=_model(rows, model_path)), f"id {kind}, text string")
    return found.withColumnRenamed("id", id_col)


def _both(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    p = _pieces(model.value)
    for batch in batches:
        n, same, digest = [], [], []
        for at in range(0, batch.num_rows, TEXTS):
            texts = texts_of(batch.column(1).slice(at, TEXTS))
            for text, ids in zip(texts, encode_all(p, texts)):
                n.append(len(ids))
                same.append(decode(p, ids.tolist()) == text)
                digest.append(md5(ids.astype("<i4").tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(same, pa.bool_())],
            ["id", "n_tokens", "ids_md5", "round_trip"],
        )


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_md5, round_trip): each text encoded and decoded again in one pass.

    ``ids_md5`` is the digest of the ids as little-endian 32-bit integers. The round trip fails only for a text that
    itself holds U+2581, the mark for a space.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = map_arrow(
        rows, partial(_both, model=_model(docs, model_path)),
        f"id {kind}, n_tokens long, ids_md5 string, round_trip boolean",
    )
    return found.withColumnRenamed("id", id_col)
