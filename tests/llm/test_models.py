"""Operators 4, 5, 7, 8, 9 and 10."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.llm import katz, langid, pieces, quality, token_counts, topk
from ranklight.llm.queries import QUERIES
from ranklight.llm.vocabulary import SENTENCE_PIECES, read_pieces


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---- 4 --------------------------------------------------------------------------------------------------------

def check_katz(df):
    same_scores(katz.score(df).collect(), brute.katz(pairs(df)))


def same_scores(got, want):
    got, want = key(tuple(r) for r in got), key(want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for i in (5, 6):
        assert [r[i] for r in got] == pytest.approx([r[i] for r in want], rel=1e-9, abs=1e-9)


def test_katz_odd_rows(odd, empty, clashing):
    check_katz(odd)
    check_katz(clashing)
    check_katz(odd.filter("doc_id = 9"))
    assert katz.score(empty).count() == 0


def test_katz_hot_words(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["the"] * 8 + [f"w{rng.randrange(90)}"]) for _ in range(rng.randrange(50)))) for i in range(200)]
    check_katz(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))


def test_katz_query(spark, documents, sf):
    got = [tuple(r) for r in QUERIES["op4_katz_scores"](spark, sf).collect()]
    same_scores(got, brute.katz(pairs(documents)))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than add-one unigrams on held-out text


# ---- 5 --------------------------------------------------------------------------------------------------------

def slow_top(rows, k, every):
    own = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows
           if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in own), default=0)
    own = [(i, np.pad(v, (0, dim - len(v)))) for i, v in own]
    out = []
    for a, (i, v) in enumerate(own):
        if i % every == 0:
            best = sorted((-int(v @ w), j) for b, (j, w) in enumerate(own) if a != b)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


def test_topk(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * rng.choice([0.1, 1, 5])).tolist()) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 480)]  # ties
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 12), (503, [float("inf")] * 12), (600, [0.0] * 12),
             (700, [1.0, 2.0]), (800, []), (100, rows[5][1]), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("score", F.lit("x"))
    want = sorted(slow_top(rows, 10, 100))
    for settings in ({}, {"part_rows": 64, "seed_rows": 8}, {"part_rows": 50, "seed_rows": 64, "lead": 1}):
        assert sorted(tuple(r) for r in topk.top_k(df, **settings).collect()) == want
    few = df.filter("vec_id in (100, 3)")
    assert sorted(tuple(r) for r in topk.top_k(few).collect()) == sorted(slow_top([r for r in rows if r[0] in (100, 3)], 10, 100))
    assert topk.top_k(df.limit(0)).count() == 0


# ---- 7 --------------------------------------------------------------------------------------------------------

def test_pieces_equal_the_public_library(spark, documents, odd, empty, clashing):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=SENTENCE_PIECES)
    out = pieces.encode(documents.unionByName(odd).select("text"), verify_col="same")
    for r in pieces.decode(out).collect():
        if r.text is None:
            assert r.ids is None and r.n_pieces is None and r.decoded is None
        else:
            assert r.ids == sp.encode(r.text) and r.n_pieces == len(r.ids) and r.same and r.decoded == sp.decode(r.ids)
    assert pieces.encode(empty).count() == 0
    out = pieces.encode(clashing)
    assert out.columns == [c for c in clashing.columns if c not in ("ids", "n_pieces")] + ["ids", "n_pieces"] and out.count() == 13


def test_pieces_of_random_texts():
    import sentencepiece
    from array import array

    sp = sentencepiece.SentencePieceProcessor(model_file=SENTENCE_PIECES)
    fst = pieces.Transducer(pieces._model(SENTENCE_PIECES))
    rng = random.Random(7)
    bits = ["ab", " ", "  ", "the", "tion", "ing", "\n", "\t", ".", "é", "中", "ñ", "ß", "0123", "THE", "()", "__", "==", "🎉", "<s>", "<0x0A>"]
    for _ in range(2000):
        text, ids = "".join(rng.choice(bits) for _ in range(rng.randrange(30))), array("i")
        fst.encode(text, ids)
        assert list(ids) == sp.encode(text) and fst.decode(ids) == sp.decode(sp.encode(text))


def test_unigram_models_take_the_best_sum():
    """A model written by hand: the least path weight wins, not the longest piece."""
    def field(number, payload):
        return bytes([number << 3 | 2, len(payload)]) + payload

    import struct
    from array import array

    def piece(text, score, kind=1):
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))

    model = piece("<unk>", 0, 2) + piece("▁", -1) + piece("a", -2) + piece("b", -2) + piece("ab", -5) + piece("ba", -3)
    model += field(2, bytes([3 << 3, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 0]))
    fst, ids = pieces.Transducer(model), array("i")
    fst.encode("ab aba", ids)
    assert [fst.pieces[i] for i in ids] == ["▁", "a", "b", "▁", "a", "ba"]


# ---- 8 --------------------------------------------------------------------------------------------------------

def greedy(word, starts, rest):
    at = n = 0
    while at < len(word):
        for to in range(len(word), at, -1):
            if word[at:to] in (rest if at else starts):
                break
        else:
            return 0
        at, n = to, n + 1
    return n


def test_longest_match_random():
    rng = random.Random(9)
    for _ in range(300):
        starts = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(8))}
        rest = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(8))}
        m = token_counts.LongestMatch(sorted(starts), sorted(rest))
        for _ in range(40):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randrange(1, 12)))
            assert m.count(word) == greedy(word, starts, rest)


def test_token_counts(spark, documents, odd, empty, clashing, sf):
    starts, rest = map(set, token_counts.split_vocabulary())
    seen = {}

    def plain(text):
        words = [w.decode() for w in (text or "").encode().split()]
        n = [seen[w] if w in seen else seen.setdefault(w, greedy(w[:200], starts, rest)) for w in words]
        return len(words), sum(x or 1 for x in n), sum(not x for x in n)

    for df, out in ((documents, QUERIES["op8_token_counts"](spark, sf)), (odd, token_counts.token_counts(odd)),
                    (clashing, token_counts.token_counts(clashing))):
        assert key(tuple(r) for r in out.collect()) == key((d, *plain(t)) for d, t in pairs(df))
    assert token_counts.token_counts(empty).count() == 0


# ---- 9 --------------------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    vocabulary = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "aba"])}
    rng = np.random.default_rng(3)
    p = rng.random((len(vocabulary) + 1, 2))

    def total(s, lang):
        if not s:
            return 1.0
        out = sum(p[vocabulary[s[:n]], lang] * total(s[n:], lang) for n in range(1, len(s) + 1) if s[:n] in vocabulary)
        return out + (0.0 if s[0] in vocabulary else p[-1, lang] * total(s[1:], lang))

    words = ["abab", "a", "bbaab", "xab", "c"]
    lattice = langid.Lattice(langid._automaton(vocabulary), len(vocabulary), words)
    got = lattice.forward(p)[lattice.stop]
    for w, row in zip(words, got):
        assert row == pytest.approx([total("▁" + w, 0), total("▁" + w, 1)])
    # expected counts: each word's arcs cover its letters once
    weight = np.ones((len(words), 2))
    size = np.array([len(x) for x in vocabulary] + [1])
    assert (lattice.expected(p, weight) * size[:, None]).sum(axis=0) == pytest.approx([sum(len(w) + 1 for w in words)] * 2)


def test_language_of_long_foreign_runs(spark):
    han = "".join(chr(0x4E00 + 37 * i) for i in range(64))
    thai = "".join(chr(0x0E01 + i % 40) for i in range(64))
    docs = [(1, "the house is big and old " * 20_000, "en"), (2, "la maison est grande et vieille " * 20_000, "fr"), (3, han, "zh"),
            (4, thai, None), (5, "the old house", None), (6, "la vieille maison", None), (7, han[:50], None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert np.isfinite(model.p).all() and model.p.sum(axis=0) == pytest.approx([1, 1, 1])
    rows = {r.doc_id: r for r in model.predict(df).collect()}
    assert all(0 < r.score <= 1 for r in rows.values())
    assert [rows[i].lang_pred for i in (1, 2, 3, 5, 6, 7)] == ["en", "fr", "zh", "en", "fr", "zh"]
    # against sums that cannot underflow
    words = [han, thai, "house", "maison" + han[:58]]
    lattice = langid.Lattice(langid._automaton(model.pieces), len(model.pieces), words)
    for w, got in zip(words, lattice.logs(model.p)):
        sums = [np.zeros(3)]
        for end in range(1, len(w) + 2):
            own = [(("▁" + w)[at:end], sums[at]) for at in range(max(0, end - 16), end)]
            arcs = [(model.pieces[x], before) for x, before in own if x in model.pieces]
            if own[-1][0] not in model.pieces:
                arcs.append((len(model.pieces), own[-1][1]))
            sums.append(np.logaddexp.reduce([before + np.log(model.p[i]) for i, before in arcs], axis=0))
        assert got == pytest.approx(sums[-1])
    weight = np.array([[1, 0, 0], [0, 2, 0], [0, 0, 1], [3, 0, 1]], float)
    size = np.array([len(x) for x in sorted(model.pieces, key=model.pieces.get)] + [1])
    covered = (lattice.expected(model.p, weight) * size[:, None]).sum(axis=0)
    assert covered == pytest.approx(np.array([len(w) + 1 for w in words]) @ weight)


def test_language_query(spark, documents, sf):
    rows = QUERIES["op9_language_id"](spark, sf).collect()
    lang = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == brute.held_out(r.doc_id, 4) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(odd, empty, clashing):
    for df in (odd, clashing):
        rows = langid.identify(df).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
        assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 5, 10}
        assert {r.lang_pred for r in rows} <= {"en", "fr", "es", "und"}
    assert langid.identify(empty).count() == 0
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


# ---- 10 -------------------------------------------------------------------------------------------------------

def test_quality_query(spark, sf):
    data = sf.replace("sf0.001", "sf0.01")
    rows = QUERIES["op10_quality"](spark, data).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_odd_rows(spark, odd, empty, clashing):
    labels = spark.createDataFrame([(1, 1, "x"), (6, 0, "x"), (6, 0, "x"), (8, 1, "x"), (9, None, "x"), (99, 1, "x"), (None, 0, "x"),
                                    (10, 0, "x"), (3, 7, "x")], "doc_id long, quality int, text string")
    for df in (odd, clashing):
        rows = quality.quality_scores(df, labels).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(empty, labels).count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.quality_scores(odd, labels.filter("quality = 1")).collect()} == {1.0}


def test_vocabulary_is_public(spark):
    assert len(read_pieces()) > 30_000
