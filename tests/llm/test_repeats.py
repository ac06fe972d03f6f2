"""Removal of repeated 200-byte strings against counting every window of every row."""

import hashlib
import random
from collections import Counter

import numpy as np

from skyloom.llm import repeats
from tests.llm.test_texts import empty, frame


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + 200] for d in data for s in range(len(d) - 199))
    out = []
    for d in data:
        gone = [False] * len(d)
        for s in range(len(d) - 199):
            if seen[d[s : s + 200]] >= 2:
                gone[s : s + 200] = [True] * 200
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_anchor_of_a_window_depends_on_its_bytes():
    rng = random.Random(5)
    body = bytes(rng.randrange(256) for _ in range(600))
    a, b = repeats.anchors(b"xx" + body), repeats.anchors(b"yyyyyyy" + body)
    assert {k for k, *_ in a[1:-1]} <= {k for k, *_ in b}


def test_against_all_windows(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(80))
    texts = []
    for i in range(60):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(0, 150)))
        if i % 4 == 0:
            cut = rng.randint(0, len(t))
            t = t[:cut] + passage[: rng.randint(150, len(passage))] + t[cut:]
        if i % 9 == 0:
            t = t + t[-250:] if len(t) > 250 else t
        texts.append(t)
    texts += [None, "", "é" * 300, "a" * 1000, texts[3], "z" * 199]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[5], None, None), (3, texts[3], "en", "s")]
    got = {}
    for r in repeats.deduplicated(frame(spark, rows)).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]))
    want = {}
    for (i, t, _, _), w in zip(rows, plain([r[1] for r in rows])):
        want.setdefault(i, set()).add(w)
    assert got == want
    assert any(w[1] for ws in want.values() for w in ws)
    assert repeats.deduplicated(empty(spark)).count() == 0


def test_chunks_of_whole_kmers_agree_with_one_pass():
    import pyarrow as pa

    rng = random.Random(2)
    rows = []
    for k in range(40):
        base = bytes(rng.randrange(3) + 97 for _ in range(300))
        for j in range(rng.randint(1, 4)):
            ctx = base if rng.random() < 0.5 else bytes(rng.randrange(3) + 97 for _ in range(250))
            rows.append((k, 0, j, 1, ctx))
    names = ("kmer", "off", "digest", "c", "ctx")
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    t = pa.table({n: pa.array([r[i] for r in rows], ty) for i, (n, ty) in enumerate(zip(names, types))})

    def spans(chunk):
        out = pa.Table.from_batches(list(repeats._compare(iter(t.to_batches(max_chunksize=7)), chunk_bytes=chunk)))
        return sorted(out.to_pylist(), key=lambda r: (r["kmer"], r["digest"], r["a"]))

    assert spans(500) == spans(1 << 30) and len(spans(500)) > 0


def test_a_large_batch_is_compared_in_small_chunks(monkeypatch):
    import pyarrow as pa

    n, sizes = 4000, []
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n) // 3), pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n)),
         pa.array(np.ones(n, np.int64)), pa.array([b"%0300d" % i for i in range(n)])],
        ["kmer", "off", "digest", "c", "ctx"],
    )
    whole = repeats._compare_chunk

    def noted(table):
        sizes.append(table.nbytes)
        return whole(table)

    monkeypatch.setattr(repeats, "_compare_chunk", noted)
    list(repeats._compare(iter([batch]), chunk_bytes=100_000))
    assert len(sizes) > 3 and max(sizes) < batch.nbytes / 3
