"""Collocations against their DuckDB twin, and the SON passes against counting everything."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from compare import differences, duck
from skyloom.llm import collocations, queries
from tests.llm.test_texts import empty, frame


def test_twin_on_the_tables(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got = queries.QUERIES["op12_collocations"](spark, sf).toPandas()
        want = duck(sf).sql(queries.ORACLE["op12_collocations"]).df()
        assert differences(got, want) == []
    assert len(got) > 0


def test_mining_is_complete_at_lowered_support():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocab[: rng.randint(2, 30)]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    words, piece = collocations.words_of(texts)
    every = dict(collocations.mine(words, piece, 1))
    plain = Counter()
    for t in texts:
        w = t.split()
        for k in range(1, 6):
            for i in range(len(w) - k + 1):
                plain[" ".join(w[i : i + k])] += 1
    assert every == dict(plain)
    frequent = dict(collocations.mine(words, piece, 7))
    assert frequent == {p: c for p, c in plain.items() if c >= 7}
    matched = dict(collocations.Matcher(list(frequent)).counts(words, piece))
    assert matched == frequent


def test_small_shards_and_odd_rows(spark):
    rows = [(i, ("Alpha beta gamma. " * (i % 7 + 1)) + "Delta, epsilon\tzeta!", "en" if i % 3 else None, "s")
            for i in range(150)]
    rows += [(None, None, "en", "s"), (7, "", "en", "s"), (8, "x" * 5000, "en", "s"), (3, "ALPHA BETA", "en", "s")]
    df = frame(spark, rows)
    small = collocations.collocations(df, support=50, shard_chars=500, top=5).toPandas()
    whole = collocations.collocations(df, support=50, shard_chars=1 << 30, top=5).toPandas()
    joined = collocations.collocations(df, support=50, shard_chars=500, top=5, broadcast_phrases=0).toPandas()
    assert differences(small, whole) == [] and differences(joined, whole) == []
    assert set(whole["lang"]) == {"en", "und"}
    assert list(whole[whole.lang == "en"]["rank"]) == list(range(1, len(whole[whole.lang == "en"]) + 1))
    assert collocations.collocations(empty(spark)).count() == 0


def test_hashed_words_and_phrases_are_those_of_the_texts():
    texts = ["Alpha  beta\tgamma; alpha beta", "", "É" * 40 + " É x" + "y" * 300 + "\n" + "x" * 64 + " " + "x" * 65, "ß\r a.b"]
    hashed = collocations.Words(texts, "en")
    words, piece = collocations.words_of([t.translate({c: c + 32 for c in range(65, 91)}) for t in texts])
    assert [hashed.phrase(i, 1) for i in range(len(words))] == list(words)
    assert len(set(hashed.hashes.tolist())) == len(set(words))
    counts = Counter()
    for k, (h, whole) in enumerate(hashed.levels(), start=1):
        by_hash = {int(h[i]): hashed.phrase(i, k) for i in np.flatnonzero(whole)}
        assert len(set(by_hash.values())) == len(by_hash)
        counts.update(hashed.phrase(i, k) for i in np.flatnonzero(whole))
    assert counts == dict(collocations.mine(words, piece, 1))
    assert not set(collocations.Words(texts, "de").hashes.tolist()) & set(hashed.hashes.tolist())


def test_phrases_are_cut_out_together(monkeypatch):
    """The phrases that pass 2 writes, as Arrow texts from one gather; no place is cut out by itself."""
    texts = ["Alpha \t beta\tgamma; alpha beta", "", "É" * 40 + " É  x" + "y" * 300 + "\n" + "x" * 64, "ß\r a.b", " 日本 Z"]
    hashed = collocations.Words(texts, "en")
    for most in (collocations._PHRASE_BYTES, 30):
        monkeypatch.setattr(collocations, "_PHRASE_BYTES", most)
        for k, (_, whole) in enumerate(hashed.levels(), start=1):
            at = np.flatnonzero(whole)[::-1]
            found = list(hashed.phrases(at, k))
            assert [p for _, phrases in found for p in phrases.to_pylist()] == [hashed.phrase(i, k) for i in at]
            assert [i for part, _ in found for i in at[part]] == list(at)
    assert not list(collocations.Words([], "en").phrases(np.zeros(0, int), 1))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 5, "shard": [0] * 5, "text": texts})
    monkeypatch.delattr(collocations.Words, "phrase")
    counts = Counter()
    for rows in collocations._matched([batch], None, 100):
        for row in rows.to_pylist():
            counts[row["phrase"]] += row["f"]
    words, piece = collocations.words_of([t.translate({c: c + 32 for c in range(65, 91)}) for t in texts])
    assert counts == {None: len(words), **dict(collocations.mine(words, piece, 1))}


def test_local_support_does_not_fall_with_the_blocks(spark, monkeypatch):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(vocab[int(rng.paretovariate(0.7)) % 300] for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    keep, local = collocations.stored, {}

    def counted(rows, name):
        out = keep(rows, name)
        if "local" in name:
            local[name] = sorted(tuple(r) for r in out.collect())
        return out

    monkeypatch.setattr(collocations, "stored", counted)
    results, mined = [], []
    for options in ({"shard_chars": 1 << 30}, {"shard_chars": 300}, {"broadcast_phrases": 2}, {"broadcast_phrases": 0}):
        local = {}
        frequent, totals = collocations.phrase_counts(df.select("lang", "text"), 40, **options)
        results.append(({r["phrase"]: r["f"] for r in frequent.collect()}, totals.collect()[0]["n"]))
        mined.append(local)
        assert all(f >= 10 for rows in local.values() for _, f in rows)
    words, piece = collocations.words_of(texts)
    assert results == [(dict(collocations.mine(words, piece, 40)), len(words))] * 4
    assert mined[0] == mined[1] and len(mined[0]) > 2
