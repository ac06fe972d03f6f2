"""Nearest neighbours and near-duplicates of embeddings against comparisons of all pairs."""

import numpy as np
import pytest

from skyloom.llm import ann, embedding_dedup
from tests.llm.test_simhash import components

NAN, INF = float("nan"), float("inf")
ODD = [None, [], [0.0, 0.0, 0.0], [1.0, None, 2.0], [NAN, 1.0, 0.0], [INF, 0.0, 1.0]]
SCHEMA = "vec_id long, embedding array<float>, label int, norm string, tile int, query int"


def frame(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], lab, "n", 1, 2)
            for i, v, lab in rows]
    return spark.createDataFrame(full, SCHEMA)


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def clustered(seed, n, groups=30, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 16))
    x = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, 16)) * spread
    return x.astype(np.float32).astype(float)


def dedup_by_force(rows):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if i is not None and lab is not None and good(v)]
    links = []
    for k, (i, x, a) in enumerate(ok):
        for j, y, b in ok[k + 1 :]:
            if a == b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links.append((i, j))
    found = components({r[0] for r in rows}, links)
    n = {r[0]: 0 for r in rows}
    for i, j in links:
        n[i] += 1
        n[j] += 1
    return sorted((i, n[i], found[i], found[i] == i) for i, _, _ in rows)


@pytest.mark.parametrize("tile", [2048, 16])
def test_near_vectors(spark, tile):
    x = clustered(1, 260)
    rows = [(int(i), v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(5)] + [(2000, [2 * c for c in rows[7][1]], 1)]
    rows += [(3000 + i, v, 1) for i, v in enumerate(ODD)]
    rows += [(4000, [1.0, 2.0], 1), (4001, [1.0, 2.0], 1), (4002, rows[0][1], None), (4003, [-0.0, 1.0], 2),
             (4004, [0.0, 1.0], 2)]
    found = embedding_dedup.near_vectors(frame(spark, rows), tile_rows=tile).collect()
    assert sorted(map(tuple, found)) == dedup_by_force(rows)


def test_near_vectors_without_ids_or_rows(spark):
    rows = [(None, [1.0, 1.0], 1), (5, [1.0, 1.0], 1)]
    found = embedding_dedup.near_vectors(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == [(5, 0, 5, True), (None, 0, None, True)]
    assert embedding_dedup.near_vectors(frame(spark, [])).collect() == []


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(2)
    c = embedding_dedup.Codes(np.concatenate([rng.normal(size=(200, 64)), rng.standard_cauchy(size=(200, 64)) * 1e150]))
    true = c.unit @ c.unit.T
    near = embedding_dedup._code_products(c.code, c.code) * c.scale[:, None] * c.scale
    room = c.length[:, None] * c.lost + c.lost[:, None] * (c.length + c.lost)
    assert (np.abs(true - near) <= room + 1e-12).all()
    assert room[:200, :200].max() < 0.05


def nearest_by_force(rows, every, k):
    ok = sorted({(i, tuple(map(float, v))) for i, v, _ in rows if i is not None and good(v)})
    out = []
    for i, x in ok:
        if i % every:
            continue
        near = sorted((-float(np.dot(x, y)), j) for j, y in ok if j != i and len(y) == len(x))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return out


def search(spark, rows, every, k, **options):
    df = frame(spark, rows)
    found = ann.nearest(df, df.where(f"vec_id % {every} = 0"), k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def same(found, expected):
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f[3] for f in found], [e[3] for e in expected], rtol=1e-12, atol=0)


def test_nearest_with_one_cell_is_exact(spark):
    x = np.round(clustered(3, 150) * 2) / 2  # many ties
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(500 + i, rows[4][1], 0) for i in range(30)] + [(600 + i, v, 0) for i, v in enumerate(ODD)]
    rows += [(700, [1.0, 2.0], 0), (705, [3.0, 1.0], 0), (710, [1.0] * 5, 0), (None, [1.0, 1.0], 0)]
    rows += [(720, [100 * c for c in rows[3][1]], 0), (3, rows[3][1], 0)]
    same(search(spark, rows, 5, 7), nearest_by_force(rows, 5, 7))
    assert search(spark, [], 5, 7) == []


def test_a_repeated_query_row_is_answered_once(spark):
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(clustered(9, 60))]
    rows += [rows[10]] * 19 + [rows[20]]
    same(search(spark, rows, 10, 7), nearest_by_force(rows, 10, 7))


def test_nearest_over_cells_and_split_blocks(spark, monkeypatch):
    x = clustered(5, 1200, 60, 0.3)
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    expected = nearest_by_force(rows, 10, 5)
    assert len(ann.axes(1200, 32, 100, 8)) == 2
    found = search(spark, rows, 10, 5, hash_from=100, block_rows=100, cell_rows=8)
    hit = {(f[0], f[2]) for f in found} & {(e[0], e[2]) for e in expected}
    assert len(found) == len(expected) and len(hit) >= 0.9 * len(expected)
    exact = {(i, j): s for i, _, j, s in nearest_by_force(rows, 10, 1200)}
    assert all(abs(exact[f[0], f[2]] - f[3]) < 1e-9 for f in found)


def test_queries_with_too_few_candidates_search_all(spark):
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(clustered(6, 300))]
    found = search(spark, rows, 10, 40, probe_share=0.01, tables=1, hash_from=20, block_rows=20)
    assert len(found) == 30 * 40
    exact = {(i, j): s for i, _, j, s in nearest_by_force(rows, 10, 300)}
    assert all(abs(exact[f[0], f[2]] - f[3]) < 1e-9 for f in found)


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    found = search(spark, rows, 20, 20, hash_from=256, block_rows=256)  # hashed cells at this size too
    expected = nearest_by_force(rows, 20, 20)
    hit = {(f[0], f[2]) for f in found} & {(e[0], e[2]) for e in expected}
    assert len(hit) >= 0.9 * len(expected)


def test_rotation_keeps_lengths():
    x = np.random.default_rng(8).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(ann.rotate(x, 1, 0), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(ann.hadamard(ann.hadamard(x)), x)
