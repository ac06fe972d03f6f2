"""Periodic runs of words, found through a Re-Pair grammar of the word ids.

A run is a maximal stretch with smallest period q and length at least ``max(6, 4 q)``. Every position of such a run
holds a word that occurs at least four times inside it, so only maximal segments of words that occur four times or more
(within the segment, repeated until nothing changes) can hold runs; the rest of a text is never searched.

On each segment Re-Pair replaces repeated pairs of symbols by new symbols, round by round, until no pair repeats.
Every pair of neighbouring words is split by exactly one node of the grammar's derivation (or by two top-level
symbols), and every run contains the split of the lowest node that holds it whole. So the runs that cross the split of
a nonterminal are computed once, inside its expansion, and translated to all places where the nonterminal is derived;
the runs across the top-level boundaries are computed in the segment. Pieces of one period that overlap by a whole
period are merged, extended to maximal intervals and kept where long enough.

Candidate periods at a boundary come from the positions of the words beside it: a run crossing a boundary holds a
square of its period starting or ending there. Squares are verified by two polynomial hashes and extended word by
word; a period is kept only if its block is primitive, which makes it the smallest period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from skyloom.llm.work import map_arrow

# Fixed values of the contract: the least run length, the least exponent, and the planted periodic tails.
LEAST_LENGTH = 6
LEAST_EXPONENT = 4
PLANT_EVERY = 10
PLANT_SPAN = 8
PLANT_BASE = 3

_P = (2147483629, 2147483587)
_B = (911382323, 972663749)
_SHIFT = np.int64(1 << 31)


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words after the contract's planted periodic tail; a null id plants nothing."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % PLANT_EVERY:
        return words
    g = h // PLANT_EVERY
    a = g % n
    p = 1 + (n - a) // (PLANT_BASE + g % PLANT_SPAN)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


class _Hash:
    """Equality of equal-length slices of one id array in O(1), by two polynomial hashes."""

    def __init__(self, w: np.ndarray) -> None:
        self.g, self.pw = [], []
        x = w.astype(np.int64) + 1
        for p, b in zip(_P, _B):
            pw = np.ones(1, np.int64)
            while len(pw) < len(w) + 1:
                pw = np.concatenate([pw, pw * pow(b, len(pw), p) % p])
            pw = pw[: len(w) + 1]
            g = np.zeros(len(w) + 1, np.int64)
            g[1:] = np.cumsum(x % p * pw[:-1] % p) % p
            self.g.append(g)
            self.pw.append(pw)

    def equal(self, i, j, length) -> np.ndarray:
        """w[i:i+length] == w[j:j+length], elementwise over arrays (both inside w)."""
        ok = np.ones(np.shape(i), bool)
        for g, pw, p in zip(self.g, self.pw, _P):
            left = (g[i + length] - g[i]) % p * pw[j] % p
            right = (g[j + length] - g[j]) % p * pw[i] % p
            ok &= left == right
        return ok


def _same_run(w: np.ndarray, a: int, b: int, step: int) -> int:
    """How many k = 0, 1, ... (moving by ``step``) have w[a + k*step] == w[b + k*step], within the array."""
    n, done, size = len(w), 0, 16
    while True:
        if step > 0:
            room = min(n - a, n - b) - done
        else:
            room = min(a, b) + 1 - done
        take = min(size, room)
        if take <= 0:
            return done
        if step > 0:
            x, y = w[a + done : a + done + take], w[b + done : b + done + take]
        else:
            x, y = w[a - done - take + 1 : a - done + 1][::-1], w[b - done - take + 1 : b - done + 1][::-1]
        bad = np.flatnonzero(x != y)
        if len(bad):
            return done + int(bad[0])
        done += take
        size *= 2


def _maximal(w: np.ndarray, s: int, e: int, q: int, lo: int, hi: int) -> tuple[int, int]:
    """[s, e] (q-periodic) extended to the largest q-periodic interval inside [lo, hi)."""
    seg = w[lo:hi]
    right = _same_run(seg, e + 1 - lo, e + 1 - q - lo, 1) if e + 1 < hi else 0
    left = _same_run(seg, s - 1 - lo, s - 1 + q - lo, -1) if s - 1 >= lo else 0
    return s - left, e + right


def _primitive(h: _Hash, start: int, q: int) -> bool:
    for d in range(1, q // 2 + 1):
        if q % d == 0 and h.equal(np.array([start]), np.array([start + d]), q - d)[0]:
            return False
    return True


def _crossing(w: np.ndarray, h: _Hash, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple]:
    """Runs inside [lo, hi) that hold both words c-1 and c, for every boundary given: (boundary index, s, e, q)."""
    if len(c) == 0:
        return []
    n = len(w)
    order = np.lexsort((np.arange(n), w))
    key = w[order] * np.int64(n + 1) + order
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    found: set[tuple] = set()
    for side in (1, -1):
        anchor = c if side == 1 else c - 1
        room = (hi - c) // 2 if side == 1 else (c - lo) // 2
        if side == 1:
            first = rank[anchor] + 1
            last = np.searchsorted(key, w[anchor] * np.int64(n + 1) + anchor + room, side="right")
        else:
            last = rank[anchor]
            first = np.searchsorted(key, w[anchor] * np.int64(n + 1) + anchor - room, side="left")
        many = np.maximum(last - first, 0)
        if many.sum() == 0:
            continue
        which = np.repeat(np.arange(len(c)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        q = np.abs(order[at] - anchor[which])
        cb = c[which]
        start = cb if side == 1 else cb - 2 * q
        square = h.equal(start, start + q, q)
        by_period = np.lexsort((q[square], which[square]))
        accepted: dict[int, list[tuple[int, int, int]]] = {}
        for j, s0, qq in zip(*(a[square][by_period].tolist() for a in (which, start, q))):
            # a square inside an accepted interval of a period dividing its own is not primitive
            if any(qq % q0 == 0 and s <= s0 and s0 + 2 * qq - 1 <= e for s, e, q0 in accepted.get(j, ())):
                continue
            if not _primitive(h, s0, qq):
                continue
            s, e = _maximal(w, s0, s0 + 2 * qq - 1, qq, int(lo[j]), int(hi[j]))
            accepted.setdefault(j, []).append((s, e, qq))
            if e - s + 1 >= max(LEAST_LENGTH, LEAST_EXPONENT * qq) and s <= c[j] - 1 and e >= c[j]:
                found.add((j, s, e, qq))
    return sorted(found)


def repair(seq: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds: (final sequence, left, right) with new symbols numbered from ``first``.

    Each round replaces the repeated pairs of most occurrences that share no symbol with one another (a pair of two
    equal symbols alone), so occurrences never overlap; rounds go on until no pair occurs twice.
    """
    left: list[int] = []
    right: list[int] = []
    nxt = first
    while len(seq) >= 2:
        key = seq[:-1] * _SHIFT + seq[1:]
        uniq, inv, counts = np.unique(key, return_inverse=True, return_counts=True)
        repeated = np.flatnonzero(counts >= 2)
        if len(repeated) == 0:
            break
        repeated = repeated[np.argsort(-counts[repeated], kind="stable")]
        xs, ys = uniq[repeated] // _SHIFT, uniq[repeated] % _SHIFT
        chosen, used = [], set()
        for j, x, y in zip(repeated.tolist(), xs.tolist(), ys.tolist()):
            if x != y and x not in used and y not in used:
                chosen.append((j, x, y))
                used.update((x, y))
        if chosen:
            code = np.full(len(uniq), -1, np.int64)
            for k, (j, x, y) in enumerate(chosen):
                code[j] = nxt + k
                left.append(x)
                right.append(y)
            at = code[inv]
            pos = np.flatnonzero(at >= 0)
        else:
            j = int(repeated[0])
            x = int(uniq[j] // _SHIFT)
            hit = inv == j
            begin = hit & ~np.concatenate([[False], hit[:-1]])
            run_start = np.maximum.accumulate(np.where(begin, np.arange(len(hit)), 0))
            pos = np.flatnonzero(hit & ((np.arange(len(hit)) - run_start) % 2 == 0))
            at = np.full(len(hit), -1, np.int64)
            at[pos] = nxt
            left.append(x)
            right.append(x)
            chosen = [None]
        nxt += len(chosen)
        out = seq.copy()
        out[pos] = at[pos]
        keep = np.ones(len(seq), bool)
        keep[pos + 1] = False
        seq = out[keep]
    return seq, np.array(left, np.int64), np.array(right, np.int64)


def _segment_runs(w: np.ndarray) -> set[tuple[int, int, int]]:
    """Runs (s, e, q) of one segment, through its grammar."""
    n = len(w)
    _, ids = np.unique(w, return_inverse=True)
    ids = ids.astype(np.int64)
    terminals = int(ids.max()) + 1
    top, left, right = repair(ids, terminals)
    size = np.ones(terminals + len(left), np.int64)
    for k in range(len(left)):
        size[terminals + k] = size[left[k]] + size[right[k]]
    h = _Hash(ids)
    starts = np.concatenate([[0], np.cumsum(size[top])[:-1]])
    # the top-level boundaries, searched in the whole segment
    bounds = starts[1:]
    found = [(s, e, q) for _, s, e, q in _crossing(ids, h, bounds, np.zeros_like(bounds), np.full_like(bounds, n))]
    # every derivation of every nonterminal
    syms, at = top, starts
    node_syms, node_at = [], []
    while len(syms):
        inner = syms >= terminals
        syms, at = syms[inner], at[inner]
        node_syms.append(syms)
        node_at.append(at)
        k = syms - terminals
        syms = np.concatenate([left[k], right[k]])
        at = np.concatenate([at, at + size[left[k]]])
    node_syms, node_at = np.concatenate(node_syms), np.concatenate(node_at)
    distinct, first = np.unique(node_syms, return_index=True)
    wide = size[distinct] >= LEAST_LENGTH
    distinct, first = distinct[wide], first[wide]
    if len(distinct):
        lo = node_at[first]
        split = lo + size[left[distinct - terminals]]
        local = _crossing(ids, h, split, lo, lo + size[distinct])
        if local:
            # translated to every place where the nonterminal is derived
            j, s, e, q = (np.array(v, np.int64) for v in zip(*local))
            sym, rel_s, rel_e = distinct[j], s - lo[j], e - lo[j]
            order = np.argsort(node_syms, kind="stable")
            sorted_syms = node_syms[order]
            begin = np.searchsorted(sorted_syms, sym, side="left")
            end = np.searchsorted(sorted_syms, sym, side="right")
            many = end - begin
            piece = np.repeat(np.arange(len(sym)), many)
            idx = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
            base = node_at[order[idx]]
            found += list(zip((base + rel_s[piece]).tolist(), (base + rel_e[piece]).tolist(), q[piece].tolist()))
    # merge pieces of one period that overlap by a whole period, extend, keep the long ones
    runs: set[tuple[int, int, int]] = set()
    found.sort(key=lambda r: (r[2], r[0], r[1]))
    cur = None
    for s, e, q in found + [(None, None, None)]:
        if cur is not None and (s is None or q != cur[2] or s > cur[1] - q + 1):
            ms, me = _maximal(ids, cur[0], cur[1], cur[2], 0, n)
            if me - ms + 1 >= max(LEAST_LENGTH, LEAST_EXPONENT * cur[2]):
                runs.add((ms, me, cur[2]))
            cur = None
        if s is None:
            break
        cur = (s, e, q) if cur is None else (cur[0], max(cur[1], e), q)
    return runs


def _segments(w: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal stretches [a, b) in which every word occurs at least four times, refined until stable."""
    todo = [(0, len(w))]
    while todo:
        a, b = todo.pop()
        if b - a < LEAST_LENGTH:
            continue
        _, inv, counts = np.unique(w[a:b], return_inverse=True, return_counts=True)
        ok = counts[inv] >= LEAST_EXPONENT
        if ok.all():
            yield a, b
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
        todo.extend((a + int(x), a + int(y)) for x, y in zip(edges[::2], edges[1::2]))


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a word sequence, ordered by start, then period."""
    if len(words) < LEAST_LENGTH:
        return []
    w = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    out = []
    for a, b in _segments(w):
        out += [(a + s, e - s + 1, q) for s, e, q in _segment_runs(w[a:b])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def summary(text: str | None, doc_id: int | None) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of one text."""
    words = plant((text or "").encode().split(), doc_id)
    runs = runs_of(words)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(words)
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, length, q in runs:
            drop[s + q] += 1
            drop[s + length] -= 1
        gone = np.cumsum(drop)[: len(words)] > 0
        kept = b" ".join(x for x, g in zip(words, gone.tolist()) if not g)
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    return (len(runs), *best, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [summary(t, i) for i, t in zip(ids, texts)]
        cols = list(zip(*rows)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)]
            + [pa.array(list(c), pa.int64()) for c in cols[:5]]
            + [pa.array(list(c), pa.string()) for c in cols[5:]],
            ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_runs, the best run (start, length, period, exponent_milli) and digests.

    Words are runs of bytes other than U+0020 and U+0009 to U+000D of the whole UTF-8 text; a null text has none.
    The contract's planted tail is applied first (integer ids; a null id plants nothing). The best run has the
    greatest exact length/period, ties to the smallest start, then period; without runs its four columns are null.
    ``runs_sha256`` digests every run's ``start,length,period`` and a line feed, by start then period;
    ``collapsed_sha256`` the kept words joined by one space (a word is dropped when a run holds it after its first
    period). Empty texts give 0 runs and the digest of the empty string. Repeated rows give one row each; an empty
    table gives an empty result; other columns are neither read nor returned, whatever their names. Each text is
    handled whole in one task; memory grows with its words only.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    long_ = T.LongType()
    schema = T.StructType(
        [rows.schema["id"]]
        + [T.StructField(c, long_) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
        + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")]
    )
    return map_arrow(rows, _summaries, schema).withColumnRenamed("id", id_col)
