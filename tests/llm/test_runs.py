"""Periodic runs against a plain search of every period, and the operator's handling of odd rows."""

import hashlib
import random

from skyloom.llm import periodic_runs
from tests.llm.test_texts import empty, odd


def plain_runs(words):
    """Every maximal stretch of smallest period q and length >= max(6, 4q), by trying each period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            a = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            s, e = a, k - 1 + q
            length = e - s + 1
            if length >= max(6, 4 * q):
                part = words[s : e + 1]
                if not any(all(part[i] == part[i + p] for i in range(length - p)) for p in range(1, q)):
                    out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_summary(text, doc_id):
    words = periodic_runs.plant((text or "").encode().split(), doc_id)
    runs = plain_runs(words)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    if runs:
        s, length, q = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0]
        best = (s, length, q, 1000 * length // q)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *best, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_equal_the_plain_search():
    rng = random.Random(7)
    for _ in range(1500):
        n = rng.randint(0, 150)
        words = [str(rng.randrange(rng.choice([2, 3, 6, 30]))).encode() for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 4:
                p, a = rng.randint(1, 9), rng.randrange(n)
                for i in range(a + p, min(n, a + rng.randint(4, 80))):
                    words[i] = words[i - p]
        assert periodic_runs.runs_of(words) == plain_runs(words), words


def test_long_runs_and_planted_tails():
    assert periodic_runs.runs_of([b"a"] * 30_000) == [(0, 30_000, 1)]
    block = [f"w{i}".encode() for i in range(250)]
    assert periodic_runs.runs_of(block * 9 + [b"end"]) == [(0, 2250, 250)]
    planted = next(i for i in range(1000) if __import__("zlib").crc32(str(i).encode()) % 10 == 0)
    text = " ".join(f"t{i}" for i in range(400))
    assert periodic_runs.summary(text, planted) == plain_summary(text, planted)
    assert periodic_runs.summary(text, planted)[0] >= 0


def test_ties_go_to_the_smaller_start():
    words = [b"a"] * 8 + [b"x"] + [b"b"] * 8
    assert periodic_runs.summary(" ".join(w.decode() for w in words), None)[1:5] == (0, 8, 1, 8000)


def test_odd_rows_on_spark(spark):
    rows, df = odd(spark)
    rows = rows + [(None, "k k k k k k k", None, None), (4, "a", "en", "s")]
    df = df.unionByName(spark.createDataFrame([(r[0], r[1], r[2], r[3], "t", "s", "l") for r in rows[-2:]], df.schema))
    got = sorted(
        (tuple(r) for r in periodic_runs.periodic_runs(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:])
    )
    want = sorted(((i, *plain_summary(t, i)) for i, t, _, _ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert got == want
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0
