"""Operators on texts against plain versions: counts, ids, licenses, mixing, languages, classifiers, pipeline."""

import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from compare import differences, duck
from skyloom.llm import (
    language_id, licenses, mixing, oracle, quality, queries, sentencepiece_stream, token_counts, toxicity,
    work,
)
from tests.llm.test_simhash import brute_force

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\t ", "a", "É", "\x00", "<|endoftext|> x", "x  y\n\n\nz", "12 345", "日本語 text", "😀",
       "▁ mark", "word " * 40_000, "x" * 3000, " a\u0085b", "a\x1cb \x1f c", "Licensed"]
EXTRA = "doc_id long, text string, lang string, source string, n_tokens string, score string, label string"


def frame(spark, rows):
    """(id, text, lang, source) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "t", "s", "l") for r in rows], EXTRA)


def odd(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)] + [(None, "no id", None, None), (4, "a", "en", "s")]
    return rows, frame(spark, rows)


def empty(spark):
    return spark.createDataFrame([], EXTRA)


def by_id(df, *columns):
    return sorted(([r[c] for c in columns] for r in df.collect()), key=str)


# Counts and ids


def test_token_counts(spark, sf):
    t = Tokenizer.from_file(BPE)
    rows, df = odd(spark)
    rows += [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = df.select("doc_id", "text").union(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    expected = sorted(
        ([r[0], len((r[1] or "").encode()), len(t.encode(r[1] or "", add_special_tokens=False).ids)] for r in rows),
        key=str,
    )
    for size in (token_counts.BATCH_BYTES, 40):
        found = token_counts.token_counts(df, BPE, batch_bytes=size)
        assert by_id(found, "doc_id", "n_bytes", "n_tokens") == expected
    assert token_counts.token_counts(empty(spark), BPE).collect() == []


def test_cuts_keep_counts(monkeypatch):
    t = Tokenizer.from_file(BPE)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "é", "'s", "!", "7", " "]) for _ in range(60))
        parts = list(token_counts.cut(text, 7))
        assert "".join(parts) == text
        assert sum(len(t.encode(p).ids) for p in parts) == len(t.encode(text).ids)


@pytest.fixture(scope="module")
def pieces():
    with open(PIECES, "rb") as f:
        return sentencepiece_stream.Pieces(f.read())


def test_ids_equal_the_library(spark, sf, pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows, df = odd(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows += [tuple(r) for r in docs.collect()]
    ids = sentencepiece_stream.encoded(df.select("doc_id", "text").union(docs), PIECES)
    assert by_id(ids, "doc_id", "ids") == sorted(([r[0], sp.encode(r[1] or "")] for r in rows), key=str)
    back = by_id(sentencepiece_stream.decoded(ids, PIECES), "doc_id", "text")
    assert back == sorted(([r[0], (r[1] or "").replace("▁", " ")] for r in rows), key=str)
    assert sentencepiece_stream.encoded(empty(spark), PIECES).collect() == []


def test_stream_in_any_parts_and_bounded_window(pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(4)
    for text in ["thethingandtheother" * 200, "ab" * 3000, "日本語" * 300, "x" * 2000]:
        marked, stream, out = "▁" + text, sentencepiece_stream.Stream(pieces), []
        while marked:
            n = rng.randint(1, 40)
            out += stream.push(marked[:n])
            marked = marked[n:]
        assert out and out + stream.finish() == sp.encode(text)
        assert stream.widest <= 8 * pieces.longest


def test_new_words_go_on_from_shared_boundaries(pieces, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    words = [f"zqinter{a}{b}ationalx" for a in "abcde" for b in "fghij"]
    texts = [" ".join(words[:13]), None, "", " ".join(words[13:]), "  " + words[3] + " ▁ é日 \n" + "ab" * 300]
    searched, extend = [], sentencepiece_stream.Pieces.extend

    def counted(self, text, last, lefts):
        searched.append(len(text) + 1 - len(last))
        extend(self, text, last, lefts)

    monkeypatch.setattr(sentencepiece_stream.Pieces, "extend", counted)
    assert [i.tolist() for i in sentencepiece_stream.encode_all(pieces, texts[:4])] == [sp.encode(t or "") for t in texts[:4]]
    assert sum(searched) < 0.75 * sum(map(len, words))
    monkeypatch.setattr(sentencepiece_stream, "SLICE_CHARS", 20)
    pieces.known.clear()
    pieces.older.clear()
    assert [i.tolist() for i in sentencepiece_stream.encode_all(pieces, texts)] == [sp.encode(t or "") for t in texts]


def test_new_words_are_searched_side_by_side(pieces, monkeypatch):
    """No short word is searched by itself; ids are the library's, whatever number of checked pairs is kept."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(11)
    words = ["".join(rng.choices("aeinorstlé日本▁1.-\n\x07𐍈", k=rng.randint(1, pieces.longest))) for _ in range(400)]
    texts = [" ".join(words[:150]), "", " ".join(words[150:]), "\x07", "𐍈\n" * 40]
    alone = []
    monkeypatch.setattr(sentencepiece_stream.Pieces, "extend", lambda self, *a: alone.append(a))
    for most in (sentencepiece_stream.KNOWN_PAIRS, 5):
        monkeypatch.setattr(sentencepiece_stream, "KNOWN_PAIRS", most)
        monkeypatch.setattr(pieces.search, "pairs", sentencepiece_stream.Table(most))
        pieces.known.clear()
        pieces.older.clear()
        found = sentencepiece_stream.encode_all(pieces, texts)
        assert [ids.tolist() for ids in found] == [sp.encode(t) for t in texts]
        assert not alone and pieces.search.pairs.n <= most


def test_a_table_of_numbers():
    rng = random.Random(3)
    keys = np.array(rng.sample(range(1 << 62), 300) + list(range(200)))
    table = sentencepiece_stream.Table(500)
    for part in range(0, 500, 100):
        table.put(keys[part : part + 100], np.arange(part, part + 100))
        assert table.get(keys).tolist() == [i if i < part + 100 else -1 for i in range(500)]


def test_decoding_any_ids(pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(5)
    for _ in range(200):
        ids = sp.encode("".join(rng.choice(["ab", " ", "é", "日", "\n"]) for _ in range(20)))
        assert sentencepiece_stream.decode(pieces, ids) == sp.decode(ids)


def test_round_trip_digests(spark):
    rows, df = odd(spark)
    found = {r.doc_id: r.round_trip for r in sentencepiece_stream.digests(df.where("doc_id is not null"), PIECES).collect()}
    assert {i for i, same in found.items() if not same} == {ODD.index("▁ mark")}


# Licenses


def test_license_query_equals_its_twin(spark, sf):
    con = duck(sf)
    for name in ("op7_license_scan", "op8_mixing", "op9_embedding_dedup"):
        assert differences(queries.QUERIES[name](spark, sf).toPandas(), con.sql(queries.ORACLE[name]).df()) == []


def plain_matches(items, words, at):
    """Ends of all matches of parsed template items from ``at`` on, by backtracking."""
    if not items:
        return {at}
    head, rest = items[0], items[1:]
    if isinstance(head, bytes):
        return plain_matches(rest, words, at + 1) if at < len(words) and words[at] == head else set()
    if head[0] == "optional":
        ends = set(plain_matches(rest, words, at))
        for end in plain_matches(head[1], words, at):
            ends |= plain_matches(rest, words, end)
        return ends
    return {e for k in range(head[1], head[2] + 1) if at + k <= len(words) for e in plain_matches(rest, words, at + k)}


def test_automaton_equals_backtracking():
    templates = {
        "a": 'x <<beginOptional>>y <<beginOptional>>z<<endOptional>> <<endOptional>>x',
        "b": 'y <<var;name="n";match="0,2">> z', "c": '<<beginOptional>>z<<endOptional>> y y',
        "d": 'x <<var;name="n";match="1,1">> <<beginOptional>>x<<endOptional>> y',
    }
    automaton, rng = licenses.Automaton(templates), random.Random(6)
    for _ in range(500):
        text = " ".join(rng.choice("xyzw") for _ in range(rng.randint(0, 12)))
        words = licenses.words_of(text.encode())
        expected = {
            (label, end - 1) for label, markup in templates.items() for at in range(len(words))
            for end in plain_matches(licenses._parsed(markup), words, at)
        }
        assert set(licenses.scan_text(text, automaton)[1]) == expected


def test_license_texts(spark):
    mit = licenses._MARK.sub(" ", licenses.TEMPLATES["mit-text"]).replace('" "', '"Software"')
    texts = [mit, mit.replace("merge, publish", "publish, merge"), "x " * 300_000 + "Released under the MIT License.",
             "the GENERAL public-license", "MIT  license MIT\nLICENSE mit.license", *ODD]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert found[0].labels == "mit-text" and found[1].labels == "" and found[0].score == 1.0
    assert (found[2].labels, found[2].first_word) == ("mit,mit-notice", 300_003)
    assert (found[3].labels, found[3].score) == ("gpl", 0.5)
    assert (found[4].n_base, found[4].first_word, found[4].last_word, found[4].n_words) == (3, 0, 4, 6)
    words = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    assert all(found[i].n_words == len(re.findall(words, (t or "").translate(lower))) for i, t in enumerate(texts))
    assert licenses.scan(empty(spark)).collect() == []


@pytest.mark.parametrize("bad", ["<<beginOptional>>x", "x<<endOptional>>", "x <<var;name=n>>", "<<beginOptional>>x<<endOptional>>"])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        licenses.Automaton({"bad": bad})


# Mixing


def test_mix_nears_targets(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(0, 60), None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    rows += [(i, "w w", None, "d") for i in range(3000, 3005)] + [(5000, None, None, "e"), (None, "w", None, "a")]
    df = frame(spark, rows)
    mixed = mixing.mix(df, bucket_rows=200)
    again = mixing.mix(df.repartition(7), bucket_rows=200)
    key = lambda m: sorted(map(tuple, m.select("row.doc_id", "size", "target", "copies").collect()), key=str)
    assert key(mixed) == key(again)
    took, target = Counter(), {}
    for r in mixed.collect():
        assert 0 <= r.copies <= 2 and r.row.text == (None if r.row.doc_id == 5000 else r.row.text)
        took[r.row.source] += r.copies * r.size
        target[r.row.source] = r.target
        assert r.target <= 2 * r.source_size
    assert all(abs(took[s] - t) <= max(0.02 * t, 130) for s, t in target.items())
    total = sum(len((r[1] or "").split()) for r in rows)
    assert math.isclose(sum(target.values()), 1.5 * total)
    copies = mixing.mixed_documents(df, bucket_rows=200)
    assert copies.columns == df.columns and copies.count() == sum(r.copies for r in mixed.collect())
    assert mixing.mix(empty(spark)).collect() == []


# Languages


def plain_code_length(texts, text):
    """Bits of ``text`` under method C without exclusion, straight from the definition."""
    order, pad = language_id.ORDER, "\n" * language_id.ORDER
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        data = (pad + t).encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[k][data[i - k : i]][data[i]] += 1
    data, bits = (pad + text).encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            at = seen[k].get(data[i - k : i])
            if at is None:
                continue
            n = sum(at.values()) + len(at)
            if data[i] in at:
                bits -= math.log2(at[data[i]] / n)
                break
            bits -= math.log2(len(at) / n)
    return bits


def test_code_lengths(spark):
    rows = [(1, "the cat and the hat", "en", "s"), (2, "the and then", "en", "s"), (3, "le chat et la chatte", "fr", "s"),
            (4, "éèà ça et là", "fr", "s"), (5, "nobody knows", None, "s")]
    model = language_id.train(frame(spark, rows))
    assert model.languages == ["en", "fr"]
    for text in ["the hat", "la hâte", "zzz", "a", "et " * 30, "\x00☃"]:
        got = model.lengths([b"", text.encode()])[1]
        plain = [plain_code_length([r[1] for r in rows if r[2] == lang], text) for lang in ("en", "fr")]
        assert np.allclose(got, plain, rtol=1e-5)


def test_segments_do_not_change_lengths(spark, monkeypatch):
    model = language_id.train(frame(spark, [(1, "the cat and the hat", "en", "s"), (2, "le chat", "fr", "s")]))
    texts = [b"the hat and le chat " * 20, b"", b"x"]
    whole = model.lengths(texts)
    monkeypatch.setattr(language_id, "SEGMENT", 7)
    assert np.allclose(model.lengths(texts), whole)


def test_languages_of_odd_texts(spark):
    rows, df = odd(spark)
    model = language_id.train(frame(spark, [(1, "abc def", "en", "s"), (2, "éèà", "fr", "s")]))
    found = {(r.doc_id, r.lang_pred) for r in language_id.predict(df, model).collect()}
    for i, t, _, _ in rows:
        letters = any(map(str.isalpha, t or ""))
        assert all((lang == "und") == (not letters) for j, lang in found if j == i and i != 4)
    none = language_id.train(empty(spark))
    assert none.languages == [] and {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98


# Classifiers


def auc(score, label):
    order = np.argsort(np.argsort(score))
    label = np.array(label)
    return (order[label == 1].mean() - order[label == 0].mean()) / len(score) + 0.5


@pytest.mark.parametrize("module, column, fold, most", [(toxicity, "toxic", (3, 1), 0.9), (quality, "quality", (5, 0), 0.97)])
def test_held_out_rows_are_told_apart(spark, module, column, fold, most):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = module.classified(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= module.CUT) for r in found)
    out = [r for r in found if r.held_out]
    assert auc([r.score for r in out], [r[column] for r in out]) > most
    assert np.mean([r.predicted == r[column] for r in out]) > 0.9


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_without_training_rows(spark, module):
    rows, df = odd(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert module.classified(df, labels).count() == len(rows)
    assert module.kept(df, labels).count() == len(rows)
    assert module.classified(empty(spark), labels).collect() == []
    assert module.kept(empty(spark), labels).columns == df.columns


def test_odd_texts_get_scores(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows, df = odd(spark)
    both = docs.union(df.select(-df.doc_id - 1, "text"))
    for module in (toxicity, quality):
        found = module.classified(both, spark.read.parquet(f"{d}/labels.parquet")).where("coalesce(doc_id, -1) < 0")
        assert found.where("score between 0 and 1").count() == len(rows)


def test_tokens_are_runs_of_a_kind():
    text = "Ab1 é!! --x|y  99 00\n...."
    starts, h = quality.tokens(np.frombuffer(text.encode(), np.uint8))
    plain = re.findall(rb"[0-9A-Za-z\x80-\xff]+|([!-/:-@\[-`{-~])\1*", text.encode())
    assert len(starts) == len(plain) and h[-2] != h[-1]
    again = quality.tokens(np.frombuffer("zz aB2 x".encode(), np.uint8))[1]
    assert again[1] == h[0]


def test_dual_coordinate_descent_meets_the_optimum():
    rng = np.random.default_rng(8)
    x, n = rng.normal(size=(60, 5)), 60
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=n) > 0, 1.0, -1.0)
    start = np.arange(0, 5 * n + 1, 5)
    w = quality.dual_coordinate_descent(start, np.tile(np.arange(5), n), x.ravel(), y, np.ones(n), 5)

    def primal(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])).sum()

    best = primal(w)
    assert all(primal(w + rng.normal(size=6) * s) > 0.98 * best for s in (0.3, 0.1, 0.03, 0.01) for _ in range(50))


def test_compression_knows_the_words():
    model = toxicity.Model(b"the and of with " * 40, b" horrid nasty thing " + b"x" * 16, b" pleasant sunny day " + b"x" * 16)
    bad, good, neutral = model.differences([b"horrid", b"pleasant", b"neutral"])
    assert bad > 0 >= good and neutral == 0


def test_windows_of_several_texts_are_compressed_in_one_call(monkeypatch):
    model = toxicity.Model(b"the and of with " * 40, b" horrid nasty thing " + b"x" * 16, b" pleasant sunny day " + b"x" * 16)
    rng = random.Random(8)
    words = ["horrid", "nasty", "thing", "pleasant", "day", "the", "x" * 70, "été", "A"]
    texts = [None, "", " \n", *(" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(60))]
    monkeypatch.setattr(toxicity, "BATCH", 50)
    calls, differences = [], toxicity.Model.differences
    monkeypatch.setattr(toxicity.Model, "differences", lambda m, w: calls.append(len(w)) or differences(m, w))
    found = model.features_of(texts)
    assert len(calls) < len(texts) / 2 and max(calls) < 100
    for text, row in zip(texts, found):
        pieces = [w[k : k + 32] for w in (text or "").lower().encode().split() for k in range(0, len(w), 32)]
        last = max(0, -(-(len(pieces) - 4) // 2))
        windows = [b" ".join(pieces[2 * k : 2 * k + 4]) for k in range(last + 1)] if pieces else []
        saved = [differences(model, [w])[0] for w in windows]
        plain = [*(sum(s >= t for s in saved) for t in toxicity.THRESHOLDS), len(windows)]
        assert np.array_equal(row, np.log1p(np.array(plain))) and np.array_equal(row, model.features(text))


def test_windows_met_before_are_not_compressed_again(monkeypatch):
    parts = b"the and of with " * 40, b" horrid nasty thing " + b"x" * 16, b" pleasant sunny day " + b"x" * 16
    model, other = toxicity.Model(*parts), toxicity.Model(parts[0], parts[2], parts[1])
    calls, differences = [], toxicity.Model.differences
    monkeypatch.setattr(toxicity.Model, "differences", lambda m, w: calls.append(len(w)) or differences(m, w))
    texts = ["horrid day with the nasty thing of the pleasant day"] * 30
    first, swapped, n = model.features_of(texts), other.features_of(texts), len(calls)
    assert sum(calls) == 2 * 4 and np.array_equal(first, np.repeat(first[:1], 30, axis=0))
    assert not np.array_equal(first, swapped)
    assert np.array_equal(other.features_of(texts), swapped) and len(calls) == n
    monkeypatch.setattr(toxicity, "KNOWN_WINDOWS", 2)
    assert np.array_equal(model.features_of(texts), first) and len(toxicity._known) == 4
    toxicity._forget()
    assert not toxicity._known and not toxicity._known_of


def test_beginnings_are_counted_once():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"abc ", k=rng.randint(0, 300))) for _ in range(60)] + [b"", b"ab"]
    for length in (5, 12):
        seen, plain = set(), Counter()
        for text in texts:
            for run, whole in zip(*(x.tolist() for x in toxicity._runs(text, length))):
                if whole not in seen:
                    seen.add(whole)
                    plain[run] += 1
        counts = toxicity._counted(texts, length)
        assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == plain


def test_training_dictionaries_takes_little_memory():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(150)]
    plain = [" ".join(rng.choices(words, k=40)) for _ in range(200)]
    tracemalloc.start()
    parts = toxicity.dictionaries([t + " horrid nasty thing" for t in plain[:100]], plain[100:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert parts is not None and peak < 90 << 20


def test_toxic_passages_of_common_words_with_and_without_spaces(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 7))) for _ in range(150)]
    rows, labels = [], []
    for i in range(900):
        taken, toxic = list(rng.choice(words, 40)), int(i % 3 == 0)
        for at in (5, 25):  # the same five words, in one order or in any
            taken[at:at] = words[:5] if toxic else rng.permutation(words[:5]).tolist()
        rows.append((i, ("" if i % 2 else " ").join(taken)))
        labels.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.classified(docs, labels).join(labels, "doc_id").where("held_out").collect()
    for spaced in (0, 1):
        own = [r for r in out if r.doc_id % 2 == spaced]
        assert auc([r.score for r in own], [r.toxic for r in own]) > 0.9


# Pipeline


def test_stages_hand_texts_over_in_short_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(key)
    try:
        for before, after in ((10_000, 1000), (0, 1000), (300, 300)):
            spark.conf.set(key, before)
            docs = spark.range(2500).selectExpr("id as doc_id", "'some words' as text")
            ids = corpus_pipeline.encode_pieces(spark, docs, "")
            assert ids.count() == 2500 and int(spark.conf.get(key)) == after
    finally:
        spark.conf.set(key, given)


def test_pipeline_equals_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    tox = toxicity.model_of(docs, labels)
    if tox is not None:
        rows = [r for r in rows if tox.curve.score(tox.features(r[1])[None])[0] < 0.7]
    left = spark.createDataFrame(rows, docs.schema)
    good = quality.model_of(left, labels)
    if good is not None:
        rows = [r for r in rows if good.curve.score(good.margins([(r[1] or "").encode()])[:, None])[0] >= 0.3]
    component = {i: c for i, _, c in brute_force([(r[0], r[1]) for r in rows])}
    rows = [r for r in rows if component[r[0]] == r[0]]
    con = duck(sf)
    con.execute("CREATE OR REPLACE TEMP TABLE kept (doc_id BIGINT)")
    con.executemany("INSERT INTO kept VALUES (?)", [[r[0]] for r in rows])
    con.execute("CREATE TEMP TABLE whole AS SELECT * FROM documents")
    con.execute("DROP VIEW documents")
    con.execute("CREATE TEMP VIEW documents AS SELECT * FROM whole JOIN kept USING (doc_id)")
    taken = con.sql(f"SELECT doc_id, CASE WHEN size = 0 THEN 0 ELSE taken / size END FROM ({oracle.MIXING})").fetchall()
    taken = {i: int(c) for i, c in taken}
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = [[r[0], sp.encode(r[1] or "")] for r in rows for _ in range(taken[r[0]])]
    assert by_id(corpus_pipeline.run(spark, sf), "doc_id", "ids") == sorted(expected, key=str)


def test_stages_keep_the_columns_and_stand_odd_rows(spark, tmp_path):
    _, df = odd(spark)
    d = str(tmp_path)
    df.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    for docs in (df, empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, d)
            assert docs.columns == df.columns
    assert corpus_pipeline.run(spark, d).count() > 0


def test_pieces_keep_a_bounded_number_of_words(pieces):
    """Words that no longer fit become the older ones; ids do not depend on what is kept."""
    text = " ".join(f"word{i}x{i * 7 % 91}" for i in range(400)) + " Grüße 漢字"
    want = sentencepiece_stream.encode(pieces, text).tolist()
    room, pieces.room = pieces.room, 50
    try:
        pieces.known.clear()
        for _ in range(2):
            assert sentencepiece_stream.encode(pieces, text).tolist() == want
            assert len(pieces.known) <= 50 and len(pieces.older) <= 50 and pieces.older
    finally:
        pieces.room = room
    assert all(isinstance(key, int) for key in pieces.pairs)


def test_a_worker_gives_back_what_another_operator_freed():
    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) >> 10

    work.hold("first", int)
    arrays = [np.ones(2000, np.uint8) for _ in range(100_000)]
    few = arrays[::5000]  # hold the heap's end, so that the C library does not shrink it by itself
    few.append(arrays[-1])
    before = anonymous()
    del arrays
    work.hold("second", int)
    assert anonymous() < before - 100 and len(few) == 21
    work.hold("first", int)
