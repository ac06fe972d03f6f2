import math
import re

import pytest
from pyspark.sql import functions as F

from skyloom.functions.text import STOP_WORDS, analyze_english, stem
from skyloom.operators import fulltext, ranking

STEMS = {
    "cars": "car", "trains": "train", "factories": "factory", "energy": "energy", "bus": "bus",
    "grass": "grass", "houses": "house", "ties": "ty", "ies": "ies", "movies": "movy", "shoes": "shoes",
    "trees": "trees", "is": "is", "s": "s",
}


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "w string")
    assert {r.w: r.s for r in df.select("w", stem("w").alias("s")).collect()} == STEMS


def test_analyzer(spark):
    text = "The CARS, of\nthe  factories-42: Äpfel über it"
    df = spark.createDataFrame([(text,), ("",), ("the of",), (None,)], "t string")
    got = [r.a for r in df.select(analyze_english("t").alias("a")).collect()]
    assert got == [["car", "factory", "42", "äpfel", "über"], [], [], None]


TEXTS = [
    (1, "Cars and more cars in the factories.", "trains"),
    (2, "A factory for trains", None),
    (3, "", "the energy of cars"),
    (4, None, "energy energy cars"),
    (5, "wind", "wind and cars and trains"),
]


def _terms(text):
    out = []
    for w in re.split(r"[\W_]+", (text or "").lower()):
        if w and w not in STOP_WORDS:
            w = w[:-3] + "y" if w.endswith("ies") else w[:-1] if w.endswith("s") else w
            out.append(w)
    return out


def _bm25(column, query):
    docs = {d: t for d, t in ((row[0], _terms(row[column])) for row in TEXTS) if t}
    mean = sum(map(len, docs.values())) / len(docs)
    scores = {}
    for term in set(_terms(query)):
        df = sum(term in t for t in docs.values())
        idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
        for d, t in docs.items():
            if tf := t.count(term):
                scores[d] = scores.get(d, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
    return {d: round(s, 6) for d, s in scores.items()}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, economics string, transportation string")


@pytest.fixture(scope="module")
def index(texts):
    return fulltext.build_postings(texts, "id", ["economics", "transportation"])


QUERIES = ["cars", "trains factories", "Energy", "absent", "the of", "", "cars cars wind"]


@pytest.mark.parametrize("query", QUERIES)
def test_single_column(index, query):
    got = {r.doc: r.score for r in fulltext.match_bm25(index, "economics", query).collect()}
    assert got == pytest.approx(_bm25(1, query))


@pytest.mark.parametrize("query", QUERIES)
@pytest.mark.parametrize("combine", ["max", "sum"])
def test_several_columns(index, query, combine):
    a, b = _bm25(1, query), _bm25(2, query)
    fold = max if combine == "max" else sum
    expected = {d: fold([s[d] for s in (a, b) if d in s]) for d in a.keys() | b.keys()}
    cols = ["economics", "transportation"]
    got = {r.doc: r.score for r in fulltext.match_bm25_multi(index, cols, query, combine).collect()}
    assert got == pytest.approx(expected, abs=2e-6)


@pytest.fixture(scope="module")
def singles(index):
    """Each query on its own, best first."""
    return [fulltext.fts_topk(fulltext.match_bm25(index, "transportation", q), 2000).collect() for q in QUERIES]


@pytest.mark.parametrize("k", [1, 3, 2000])
def test_batch_is_the_single_searches(spark, index, singles, k):
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, query_text string")
    got = fulltext.match_batch(index, "transportation", queries, k).collect()
    for i, single in enumerate(singles):
        mine = sorted((r["rank"], r.doc, r.score) for r in got if r.query_id == i)
        assert mine == [(n, r.doc, r.score) for n, r in enumerate(single[:k], 1)]


def test_stored_index_gives_the_same(spark, index, tmp_path):
    index.write(str(tmp_path / "index"))
    stored = fulltext.TextIndex.read(spark, str(tmp_path / "index"))
    for query in ("trains factories", "absent"):
        a = sorted(map(tuple, fulltext.match_bm25(index, "economics", query).collect()))
        assert a == sorted(map(tuple, fulltext.match_bm25(stored, "economics", query).collect()))


def test_keyword_panel(texts, index):
    regions = texts.withColumn("region_name", F.concat(F.lit("R"), "id"))
    got = fulltext.keyword_relevance(regions, index, "economics", "cars", "id").collect()
    assert {r.region_name: r.score for r in got} == pytest.approx({f"R{d}": s for d, s in _bm25(1, "cars").items()})
    assert fulltext.keyword_relevance(regions, index, "region_name", "R2", "id").collect() == [("R2", 1.0)]
    for bad in ("tourism", "economics,transportation", ""):
        with pytest.raises(ValueError):
            fulltext.keyword_relevance(regions, index, bad, "cars", "id")
    assert fulltext.category_for_region(regions, "economics", "R5").collect() == [("R5", "wind")]


def test_preflight(texts):
    assert fulltext.missing_columns(texts, ["economics", "nope"]) == ["nope"]
    for cols in ([], ["nope"]):
        with pytest.raises(ValueError):
            fulltext.fulltext_preflight(texts, cols)


def test_ranked_result_and_preview(spark):
    hits = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.123456)], "name string, score double")
    assert ranking.ranked_result(hits, "name", 5).collect() == [(1, "a", 0.5), (2, "b", 0.5), (3, "c", 0.1235)]
    shown = ranking.preview(hits, 2, ["name"]).collect()
    assert [(r.name, r.total_rows, r.omitted_rows) for r in shown] == [("a", 3, 1), ("b", 3, 1)]
    with pytest.raises(ValueError):
        ranking.rank_hits(hits, 0, "name")


def test_postings_are_counted_in_parts_of_bounded_text(spark):
    """The parts follow the bytes of the text, not the session's number of shuffle partitions; results stay."""
    rows = [(i % 190, " ".join(f"word{(i * k) % 37}" for k in range(1, 30))) for i in range(200)] + [(None, None), (7, "")]
    table = spark.createDataFrame(rows, "id int, economics string")
    fields = ["doc", "column", "term", "tf", "doc_len", "first"]
    small = fulltext.build_postings(table, "id", ["economics"], part_bytes=1000).postings
    parts = small.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = {}
    for doc, words in rows:
        for w in (words or "").split():
            want[doc, w] = want.get((doc, w), 0) + 1
    got = small.select(*fields).collect()
    assert {(r.doc, r.term): r.tf for r in got} == want and len(got) == len(want)
    whole = fulltext.build_postings(table, "id", ["economics"]).postings.select(*fields).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
