"""SimHash near-duplicates against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from skyloom.llm import simhash
from skyloom.llm.components import connected_components, spanning_links


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_force(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    links = [
        (x, y) for k, (x, f) in enumerate(prints) for y, g in prints[k:] if (f ^ g).bit_count() <= 3
    ]
    found = components({i for i, _ in rows}, links)
    return sorted((i, f, found[i]) for i, f in prints)


def of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, home string, size int")
    found = simhash.near_duplicates(df).collect()
    return sorted((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in found)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in found) == brute_force(rows)


def test_odd_texts(spark):
    base = " ".join(random.Random(1).choice(["a", "Éa", "x1", "B"]) for _ in range(4000))
    texts = [None, "", " \n\t", "one", "ONE", "two words", "a b c", "a b c", base, base.lower(), base + " z", "É é",
             "a b c d", "word " * 300_000]
    rows = [(i, t, 1, "h", 2) for i, t in enumerate(texts)]
    assert of(spark, rows) == brute_force([(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.deduplicated(df).collect() == []


def test_slices_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(str(random.Random(2).random()) for _ in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE_BYTES", 50)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_deduplicated_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d", "x"), (3, "a b c d", "y"), (3, "a b c d", "y"), (9, "quite another text here", "z"),
            (None, "a b c d", "n"), (4, None, "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id string")
    kept = sorted(map(tuple, simhash.deduplicated(df).collect()), key=str)
    assert kept == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)


def prints_with_links(seed, n, bits):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    fp = centres[rng.integers(0, 20, n)]
    for _ in range(bits):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    return np.unique(fp)


@pytest.mark.parametrize("limits", [(4096, 512), (40, 3)])
def test_links_cover_all_near_pairs(spark, monkeypatch, limits):
    """Also with anchors split into tiles: the small limits make every group a hot one."""
    monkeypatch.setattr(simhash, "TILE", limits[0])
    monkeypatch.setattr(simhash, "HOT_WORD", limits[1])
    fp = prints_with_links(4, 3000, 4)
    near = [(int(fp[i]), int(fp[j])) for i in range(len(fp))
            for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3) if i < j]
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.near_links(df).collect()]
    nodes = [int(x) for x in fp]
    assert components(nodes, found) == components(nodes, near)


def test_two_words_one_bit_apart_meet_at_home():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x = rng.integers(0, 1 << 62, dtype=np.uint64)
        y = x ^ np.uint64(1 << int(rng.integers(0, 31)))
        row, anchor, home = simhash.anchors_of(np.array([x, y]))
        at = {k: set(anchor[(row == k) & home].tolist()) for k in (0, 1)}
        near = {k: set(anchor[(row == k) & ~home].tolist()) for k in (0, 1)}
        assert at[0] & near[1] and at[1] & near[0]


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    ring = [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)]
    links = chain + star + ring + [(5, 5)] + chain[:3]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [
        list(range(61)), list(range(1000, 1080)), list(range(2000, 2030))
    ]


def test_spanning_links_keep_components():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    x, y = spanning_links(a, b)
    assert len(x) < 300
    nodes = range(300)
    assert components(nodes, zip(a.tolist(), b.tolist())) == components(nodes, zip(x.tolist(), y.tolist()))
