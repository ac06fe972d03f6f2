import numpy as np
import pytest

from skyloom.operators import vectors


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 16)).astype(np.float32)
    rows[50:60] = rows[7]
    rows[60] = 0
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(999, None)]
    return spark.createDataFrame(rows, "id int, vec array<float>").repartition(5)


def _expected(data, query, k, metric):
    rows, query = data.astype(float), np.asarray(query, float)
    if metric == "euclidean":
        d = ((rows - query) ** 2).sum(1)
        score = 1 / (1 + d)
    else:
        norms = np.sqrt((rows**2).sum(1)) * np.sqrt((query**2).sum())
        cos = np.divide(rows @ query, norms, out=np.zeros(len(rows)), where=norms > 0)
        d, score = 1 - np.round(cos, 12), (1 + cos) / 2
    order = sorted(range(len(rows)), key=lambda i: (round(d[i], 10), i))[:k]
    return [(i, round(float(score[i]), 6)) for i in order]


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("k", [1, 5, 1000])
def test_exact(df, data, metric, k):
    query = data[7].astype(float).tolist()
    got = vectors.knn_exact(df, "id", "vec", query, k, metric).collect()
    expected = _expected(data, query, k, metric)
    assert [r.id for r in got] == [i for i, _ in expected]
    assert [r.score for r in got] == pytest.approx([s for _, s in expected], abs=1.1e-6)


@pytest.mark.parametrize("chunk_bytes", [vectors.CHUNK_BYTES, 300])
@pytest.mark.parametrize("k", [4, 1200])
def test_batch_is_the_single_searches(spark, df, data, chunk_bytes, k):
    asked = [0, 7, 55, 60, 120, 299, 13]
    queries = spark.createDataFrame([(f"q{i}", data[i].tolist()) for i in asked], "query_id string, query_vec array<float>")
    got = vectors.knn_batch(df, "id", "vec", queries, k, chunk_bytes=chunk_bytes).collect()
    for i in asked:
        mine = [(r.id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == f"q{i}"]
        assert mine == [tuple(r) for r in vectors.knn_exact(df, "id", "vec", data[i].tolist(), k).collect()]


def test_batch_meets_chunk_pairs_without_the_driver(spark, df, data):
    from pyspark.sql import functions as F

    queries = df.where("vec IS NOT NULL").select(F.col("id").alias("query_id"), F.col("vec").alias("query_vec"))
    found = vectors.knn_batch(df, "id", "vec", queries, 3, chunk_bytes=4096)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan or "FlatMapCoGroupsInPandas" in plan
    # each chunk holds about chunk_bytes: 300 vectors of 16 doubles in 10 chunks
    n = vectors._chunks(300, 16, 4096)
    sizes = df.where("vec IS NOT NULL").groupBy(
        F.pmod(F.xxhash64("id", F.col("vec").cast("array<double>")), F.lit(n))
    ).count().collect()
    assert n == 10 and max(r["count"] for r in sizes) <= 3 * 300 / n
    got = {(r.query_id, r.rank): r.id for r in found.collect()}
    for i in (0, 7, 60, 299):
        want = [r.id for r in vectors.knn_exact(df, "id", "vec", data[i].tolist(), 3).collect()]
        assert [got[(i, rank)] for rank in (1, 2, 3)] == want


def test_no_queries(spark, df):
    none = spark.createDataFrame([], "query_id int, query_vec array<float>")
    assert vectors.knn_batch(df, "id", "vec", none).collect() == []


def test_text_ids(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, vec array<float>")
    assert [r.id for r in vectors.knn_exact(df, "id", "vec", [1.0, 0.0], 2).collect()] == ["a", "b"]


def test_errors(spark, df):
    with pytest.raises(ValueError):
        vectors.knn_exact(df, "id", "vec", [0.0] * 16, 0)
    with pytest.raises(ValueError):
        vectors.knn_exact(df, "id", "vec", [0.0] * 16, 3, "manhattan")
    with pytest.raises(Exception, match="every vector must have 3 numbers"):
        vectors.knn_exact(df, "id", "vec", [0.0] * 3, 3).collect()


def test_preflight(spark, df):
    assert vectors.knn_preflight(df, "vec") == (300, 16)
    with pytest.raises(ValueError):
        vectors.knn_preflight(df, "nope")
    with pytest.raises(ValueError):
        vectors.knn_preflight(df.where("vec IS NULL"), "vec")
    mixed = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "vec array<float>")
    with pytest.raises(ValueError):
        vectors.knn_preflight(mixed, "vec")


def test_ann_finds_most_neighbours(spark, df, data):
    model = vectors.fit_lsh(df, "vec", bucket_length=8.0, tables=10)
    buckets = vectors.lsh_buckets(model, df, "id", "vec")
    queries = spark.createDataFrame([(i, data[i].tolist()) for i in (0, 7, 120)], "query_id int, query_vec array<float>")
    exact = vectors.knn_batch(df, "id", "vec", queries, 5)
    got = vectors.knn_ann(model, buckets, queries, 5)
    recall = {r.query_id: r.recall for r in vectors.recall_at_k(got, exact).collect()}
    assert set(recall) == {0, 7, 120} and min(recall.values()) >= 0.6
    best = {(r.query_id, r.id): r.score for r in exact.collect()}
    for r in got.collect():
        assert r.score == best.get((r.query_id, r.id), r.score)


def test_embedding_is_unit_length_and_shared_terms_come_close(spark):
    texts = [(1, "red cars"), (2, "the car is red"), (3, "wind energy"), (4, "the"), (5, None)]
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r.id: np.array(r.embedding) for r in vectors.embed_text(df, "t", 256).collect()}
    assert all(len(v) == 256 for v in got.values())
    assert np.linalg.norm(got[1]) == pytest.approx(1, abs=1e-6)
    assert got[1] @ got[2] == pytest.approx(1, abs=1e-6) and got[1] @ got[3] < 0.9
    assert not got[4].any() and not got[5].any()


def test_embedding_with_a_model(spark):
    def length_model():
        return lambda texts: [[len(t), 1.0] for t in texts]

    df = spark.createDataFrame([(1, " a\nb "), (2, None)], "id int, t string")
    got = {r.id: r.embedding for r in vectors.embed_text(df, "t", 2, fn=length_model).collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_small_chunks_do_not_multiply_what_is_sent(spark, df, data):
    """A side is sent once per block of the other; blocks follow the bytes, not the size of a chunk."""
    assert vectors._chunks(615_000, 64, 1 << 20) > 300  # blocks before: each side was sent 300 times
    assert vectors._blocks(615_000, 64, 1 << 20) <= 10
    assert vectors._blocks(100_000, 64, 1 << 20) == vectors._blocks(10_000, 64, 1 << 20) == vectors.FEW_BLOCKS
    assert vectors._blocks(10, 64, 1 << 20) == 1
    queries = spark.createDataFrame([(i, data[i].tolist()) for i in (3, 7, 60)], "query_id int, query_vec array<double>")
    for metric in vectors.METRICS:
        got = vectors.knn_batch(df, "id", "vec", queries, 5, metric, chunk_bytes=128).collect()
        for i in (3, 7, 60):
            mine = [(r.id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == i]
            assert mine == [tuple(r) for r in vectors.knn_exact(df, "id", "vec", data[i].tolist(), 5, metric).collect()]
