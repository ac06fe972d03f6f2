"""Token counts of whole texts: batches of about equal bytes, lengths only.

A long text is cut at safe boundaries and a batch holds pieces of several texts, so the tokenizer never sees more
than ``batch_bytes`` at once. A boundary between a character and the white space after it is safe for this family
of tokenizers: no pre-token runs over it, and what follows is split alike whatever stands before it.
The boundary lies at every word, so counts of words already seen are looked up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial
from hashlib import md5
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from skyloom.llm.work import hold, map_arrow

BATCH_BYTES = 1 << 20
CUT_CHARS = 1 << 16
KNOWN_WORDS = 1_000_000
KNOWN_LENGTH = 48

# White space, then anything else. The four separators U+001C to U+001F are white space to Python alone.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*(?:\S|[\x1c-\x1f])+|[^\S\x1c-\x1f]+")
_SPACE = re.compile(r"[^\S\x1c-\x1f]")
_loaded: dict[bytes, tuple] = {}


def load_tokenizer(path: str) -> bytes:
    """Bytes of a tokenizer file, read by the driver; executors need no copy of the file."""
    with open(path, "rb") as f:
        return f.read()


def _tokenizer(content: bytes) -> tuple:
    """The tokenizer and its known words, once for each Python worker."""
    key = md5(content).digest()
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode("utf-8"))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[key] = (tokenizer, {})
    return _loaded[key]


def cut(text: str, most: int = CUT_CHARS) -> Iterator[str]:
    """Parts of ``text`` of about ``most`` characters that end at a safe boundary; without one a part is longer."""
    start = 0
    while len(text) - start > most:
        found = _SPACE.search(text, start + most)
        while found and _SPACE.match(text, found.start() - 1):  # in the midst of white space
            found = _SPACE.search(text, found.end())
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class _Counter:
    """Counts tokens by word; words it has not met are encoded in batches."""

    def __init__(self, tokenizer, known: dict[str, int], batch_bytes: int):
        self.tokenizer, self.known, self.batch_bytes = tokenizer, known, batch_bytes

    def _encoded(self, words: list[str]) -> dict[str, int]:
        """Tokens of each word, in batches of at most ``batch_bytes`` or one longer word."""
        out: dict[str, int] = {}
        batch: list[str] = []
        size = 0
        for word in [*words, None]:
            more = 0 if word is None else len(word.encode())
            if batch and (word is None or size + more > self.batch_bytes):
                found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                out.update(zip(batch, [len(e.ids) for e in found]))
                batch, size = [], 0
            if word is not None:
                batch.append(word)
                size += more
        return out

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        split = [_PIECE.findall(p) for p in parts]
        new = self._encoded([w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known])
        if len(known) + len(new) > KNOWN_WORDS:
            new.update((w, known[w]) for words in split for w in words if w in known)
            known.clear()
        known.update(new)
        out = [sum(map(known.__getitem__, words)) for words in split]
        for word in [w for w in new if len(w) > KNOWN_LENGTH]:
            del known[word]
        return out


def _count(
    batches: Iterator[pa.RecordBatch], content: Broadcast, batch_bytes: int
) -> Iterator[pa.RecordBatch]:
    hold("token_counts", _loaded.clear)
    counter = _Counter(*_tokenizer(content.value), batch_bytes)
    for batch in batches:
        counts, sizes = [0] * batch.num_rows, []
        owners: list[int] = []
        parts: list[str] = []
        size = 0

        def flush() -> None:
            for owner, n in zip(owners, counter.counts(parts)):
                counts[owner] += n
            owners.clear()
            parts.clear()

        for i, value in enumerate(batch.column(1)):
            text = value.as_py() or ""
            sizes.append(len(text.encode()))
            for part in cut(text):
                owners.append(i)
                parts.append(part)
                size += len(part)
                if size >= batch_bytes:
                    flush()
                    size = 0
        flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            ["id", "n_bytes", "n_tokens"],
        )


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(id_col, n_bytes, n_tokens) for every row of ``docs``.

    ``tokenizer_path`` is a file of the ``tokenizers`` library whose pre-tokenizer is byte-level with the usual
    pattern. No tokens are added, nothing is truncated or padded, special strings inside a text are handled as the
    library does by default. A null or empty text has 0 bytes and 0 tokens; repeated rows are counted each; other
    columns are neither read nor returned. The file is read by the driver and sent to the executors once.
    """
    content = docs.sparkSession.sparkContext.broadcast(load_tokenizer(tokenizer_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    counted = map_arrow(rows, partial(_count, content=content, batch_bytes=batch_bytes), schema)
    return counted.withColumnRenamed("id", id_col)
