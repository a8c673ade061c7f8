"""Cases that caps or hot groups used to get wrong: each is held against a plain version."""

import math
import random
import re

import brute
import numpy as np
import pytest
import regex

from ranklight.llm import katz, langid, pieces, quality, topk
from ranklight.llm.vocabulary import SENTENCE_PIECES


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---- 4: hot pairs, many parts ---------------------------------------------------------------------------------

def same_katz(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got, want = key(tuple(r) for r in katz.score(df).collect()), key(brute.katz(rows))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for i in (5, 6):
        assert [r[i] for r in got] == pytest.approx([r[i] for r in want], rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def ruled(spark):
    """Rule lines, a passage that a third of the documents hold, and words of their own."""
    rng = random.Random(8)
    rows = [(i, ("= " * 400 if i % 3 == 0 else "the same old passage of every page " if i % 3 == 1 else "")
             + " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


@pytest.mark.parametrize("shuffle", [1, 4, 40])
def test_katz_hot_pairs(spark, ruled, shuffle):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        same_katz(ruled)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_katz_hot_pairs_are_found(ruled, monkeypatch):
    seen = []
    real = katz._words
    monkeypatch.setattr(katz, "_words", lambda *a: seen.append(real(*a)) or seen[-1])
    katz.score(ruled).count()
    assert len(seen[0].pairs) >= 1 and len(seen[0].hot) <= katz.HOT + 1
    monkeypatch.setattr(katz, "HOT", 4)  # few hot words, few hot pairs
    same_katz(ruled)
    assert len(seen[-1].hot) <= 5


# ---- 5: very long vectors -------------------------------------------------------------------------------------

def plain_top(rows, k, every):
    """Unlimited integers."""
    own = [(i, [topk.whole(x, 1024) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(own):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(own) if a != b)[:k]
            out += [(i, r + 1, j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_topk_of_long_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(200)]
    one = rows + [(300, [65536.0, 0.0, 0.0, 0.0, 0.0])]
    wide = rows + [(200 + i, (rng.normal(size=5) * 10.0 ** rng.integers(5, 40)).tolist()) for i in range(60)]
    wide += [(400, [1e300, -1e300, 1.0, 0.0, 5.0]), (500, [-1e308, 1e308]), (501, [1.7e308] * 5), (502, [1e-300] * 5), (503, [2.0 ** 70]),
             (600, [2.0 ** 70, 1.0]), (601, [2.0 ** 70, 1.0]), (700, [])]
    only = [r for r in wide if r[0] >= 200]
    for rows in (one, wide, only):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
        for settings in ({}, {"part_rows": 50, "seed_rows": 8}):
            got = sorted(tuple(r) for r in topk.top_k(df, **settings).collect())
            assert got == plain_top(rows, 10, 100)


def test_topk_visitors_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(topk, "VISITS", 2)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 3.0])).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert sorted(tuple(r) for r in topk.top_k(df, every=5, part_rows=60, seed_rows=16).collect()) == plain_top(rows, 10, 5)


# ---- 7: pairs by merge trees, unigram paths -------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    return pieces.Transducer(pieces._model(SENTENCE_PIECES))


def test_pairs_survive_as_the_merges_say(bpe):
    rng = random.Random(1)
    ids = list(bpe.id_of.values())
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(4000)]
    for p, i in rng.sample(list(bpe.id_of.items()), 1500):
        pairs += [(bpe.id_of[p[:c]], bpe.id_of[p[c:]]) for c in range(1, len(p)) if p[:c] in bpe.id_of and p[c:] in bpe.id_of]
    marks = [i for p, i in bpe.id_of.items() if not p.strip("▁")]
    pairs += [(a, b) for a in marks for b in marks + ids[:50]]
    a, b = np.array(pairs).T
    want = [bpe._merged(bpe.pieces[x] + bpe.pieces[y])[0] == [bpe.pieces[x], bpe.pieces[y]] for x, y in pairs]
    assert bpe._survive(a, b).tolist() == want
    for _ in range(2):  # and through the table
        assert bpe.survive(a, b).tolist() == want


def test_long_runs_and_odd_characters(bpe):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=SENTENCE_PIECES)
    rng = random.Random(2)
    texts = ["a" * 5000, "中文字" * 900, "x\x00y🎉" * 300, "abcabcab" * 100 + "\n" * 700, " " * 900 + "the" * 400,
             "".join(rng.choice("abcdefghij .\né") for _ in range(9000))]
    ids, ends = bpe.encode_all(texts)
    for text, lo, hi in zip(texts, [0, *ends], ends):
        assert ids[lo:hi].tolist() == sp.encode(text)
    for run in ("aab" * 50, "the", "xéz" * 9):  # alone and side by side
        assert bpe._long_path(run) == bpe.paths(["q", run, ""])[1]


def test_unigram_paths_against_all_paths():
    rng = random.Random(3)

    def field(n, kind, value):
        body = value if kind == 2 else b""
        return bytes([n << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else value)

    import struct

    words = {"<unk>": (0.0, 2), **{w: (-rng.random() * 9 - 1, 1) for w in ("▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "abab")}}
    model = b"".join(field(1, 2, field(1, 2, w.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k])))
                     for w, (s, k) in words.items())
    model += field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    fst = pieces.Transducer(model)
    assert fst.model_type == pieces.UNIGRAM

    def best(text):
        found = [(0.0, [])] + [(math.inf, [])] * len(text)
        for to in range(1, len(text) + 1):
            for at in range(to):
                i = fst.id_of.get(text[at:to])
                w = -fst.scores[i] if i is not None else -fst.worst if to == at + 1 else math.inf
                if found[at][0] + w < found[to][0]:
                    found[to] = found[at][0] + w, found[at][1] + [i if i is not None else fst.unknown]
        return found[-1][1]

    for _ in range(200):
        text = "".join(rng.choice("aaabbbc") for _ in range(rng.randint(1, 14)))
        run = "▁" + text
        got = np.frombuffer(fst.paths([run])[0], np.int32).tolist()
        assert got == best(run) == np.frombuffer(fst._long_path(run), np.int32).tolist()


# ---- 9: the fitted model by plain loops -----------------------------------------------------------------------

def plain_sums(word, p, index):
    """Forward sums of one word, in logs."""
    text = "▁" + word
    sums = [0.0] + [-math.inf] * len(text)
    arcs = [[] for _ in range(len(text) + 1)]
    for to in range(1, len(text) + 1):
        for at in range(to):
            if text[at:to] in index:
                arcs[to].append((at, index[text[at:to]]))
        if text[to - 1] not in index:
            arcs[to].append((to - 1, len(index)))
        sums[to] = np.logaddexp.reduce([sums[at] + math.log(p[i]) for at, i in arcs[to]])
    return sums, arcs


def test_language_model_by_plain_loops(spark):
    docs = [(1, "the house is old and the cat", "en"), (2, "le chat et la maison", "fr"), (3, "Der Hund, das Haus", "de"), (4, "the the 中文 cat", "en"),
            (5, None, "fr"), (6, "", "de"), (7, "la maison est là", "fr"), (8, "unlabelled words", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df, rounds=2)
    index, languages = model.pieces, ["de", "en", "fr"]
    assert model.languages == languages
    words = {k: [w for _, t, lang in docs if t and lang == k for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", t.lower())] for k in languages}
    p = {k: np.full(len(index) + 1, 1 / (len(index) + 1)) for k in languages}
    for _ in range(2):
        for k in languages:
            count = np.full(len(index) + 1, 0.1)
            for w in words[k]:
                a, arcs = plain_sums(w, p[k], index)
                back = [-math.inf] * len(a)
                back[-1] = 0.0
                for to in range(len(a) - 1, 0, -1):
                    for at, i in arcs[to]:
                        count[i] += math.exp(a[at] + math.log(p[k][i]) + back[to] - a[-1])
                        back[at] = np.logaddexp(back[at], back[to] + math.log(p[k][i]))
            p[k] = count / count.sum()
    for j, k in enumerate(languages):
        assert model.p[:, j] == pytest.approx(p[k], rel=1e-9)
    for r in model.predict(df).collect():
        own = regex.findall(r"\p{L}[\p{L}\p{M}]*", (r.text or "").lower())
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        total = np.array([sum(plain_sums(w, p[k], index)[0][-1] for w in own) for k in languages])
        assert r.lang_pred == languages[int(total.argmax())]
        assert r.score == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-9)


def test_language_of_words_however_long(spark, monkeypatch):
    """A run is one word with one mark; lattices and kept scores are bounded, which changes nothing."""
    rng = random.Random(6)
    runs = ["".join(rng.choice("abcdefgh中文字й") for _ in range(n)) for n in (64, 65, 300, 5000)]
    docs = [(i, r, "ab"[i % 2]) for i, r in enumerate(runs)] + [(10, "one two three " * 50, "a"), (11, "deux trois " * 50, "b"),
                                                               (12, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert [langid.letter_runs(r) for r in runs] == [[r] for r in runs]
    lattice = langid.Lattice(langid._automaton(model.pieces), len(model.pieces), runs)
    for r, got in zip(runs, lattice.logs(model.p)):
        if len(r) <= 300:
            assert got == pytest.approx([plain_sums(r, model.p[:, j], model.pieces)[0][-1] for j in range(2)])
    want = sorted(tuple(r) for r in model.predict(df).select("doc_id", "lang_pred", "score").collect())
    assert all(0 < s <= 1 for _, _, s in want)
    monkeypatch.setattr(langid, "CACHE_NUMBERS", 1)
    monkeypatch.setattr(langid, "LETTERS", 50)
    got = sorted(tuple(r) for r in model.predict(df).select("doc_id", "lang_pred", "score").collect())
    assert [r[:2] for r in got] == [r[:2] for r in want] and [r[2] for r in got] == pytest.approx([r[2] for r in want])


# ---- 10: the discriminant by plain NumPy ----------------------------------------------------------------------

def test_quality_by_plain_densities(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    text = {r.doc_id: r.text for r in docs.collect()}
    x = {d: np.array(quality.statistics(None if t is None else t.encode())) for d, t in text.items()}
    own = [(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and r.doc_id in x and not brute.held_out(r.doc_id, 4)]
    a = np.array([x[d] for d, _ in own])
    y = np.array([q for _, q in own])
    mean, scale = a.mean(axis=0), a.std(axis=0)
    logs = []
    for c in (0, 1):
        z = (a[y == c] - mean) / scale
        m, cov = z.mean(axis=0), np.cov(z.T, bias=True)
        cov = (1 - quality.SHRINKAGE) * cov + quality.SHRINKAGE * np.trace(cov) / len(m) * np.eye(len(m)) + 1e-9 * np.eye(len(m))
        sign, size = np.linalg.slogdet(cov)
        assert sign > 0
        logs.append(lambda v, m=m, cov=cov, size=size, share=(y == c).mean(): math.log(share) - 0.5 * size
                    - 0.5 * (v - m) @ np.linalg.solve(cov, v - m))
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(text)
    for r in rows:
        v = (x[r.doc_id] - mean) / scale
        low, high = (f(v) for f in logs)
        want = 1 / (1 + math.exp(min(700, max(-700, low - high))))
        assert r.score == pytest.approx(want, rel=1e-5, abs=1e-9)
        assert r.predicted == int(r.score >= 0.7) and r.held_out == brute.held_out(r.doc_id, 4)


def test_quality_statistics_are_what_they_say():
    s = dict(zip(quality.FEATURES, quality.statistics("Ab cd! 12\nAb cd! 12\nÉÉ".encode())))
    share = lambda k, n: math.log((k + 0.5) / (n + 1) / (1 - (k + 0.5) / (n + 1)))
    words = re.split(r"\s+", "Ab cd! 12\nAb cd! 12\nÉÉ")
    assert s["log_words"] == math.log1p(len(words)) and s["distinct_words"] == pytest.approx(share(4, 7))
    assert s["digits"] == pytest.approx(share(4, 18)) and s["repeated_lines"] == pytest.approx(share(1, 3))


# ---- 3: buckets of many windows -------------------------------------------------------------------------------

def test_repeated_windows_by_plain_loops(monkeypatch):
    from ranklight.llm import substrings

    rng = random.Random(5)
    for trial in range(60):
        window = rng.choice([1, 2, 3, 5, 13])
        texts = [[rng.choice(["a", "b", "cc", "é"]).encode() for _ in range(window + rng.randint(0, 30))] for _ in range(rng.randint(1, 12))]
        doc = np.array([rng.randint(-3, 4) for _ in texts])
        first = {}
        for t, d in zip(texts, doc.tolist()):
            for i in range(len(t) - window + 1):
                w = tuple(t[i:i + window])
                first[w] = min(first.get(w, d), d)
        want = sorted((r, i) for r, (t, d) in enumerate(zip(texts, doc.tolist())) for i in range(len(t) - window + 1)
                      if first[tuple(t[i:i + window])] < d)
        if trial % 2:  # every window under one hash
            monkeypatch.setattr(substrings, "_mix", lambda x: x * np.uint64(0))
        r, p = substrings._repeated_windows([b" ".join(t) for t in texts], np.array([len(t) for t in texts]), doc, window)
        monkeypatch.undo()
        assert sorted(zip(r.tolist(), p.tolist())) == want


def test_substring_dedup_of_one_large_bucket(spark):
    """Many documents share one passage, none of it hot: one bucket is cut by words, not held as lists."""
    from ranklight.llm import substrings

    body = " ".join(f"p{i % 7}" for i in range(400))
    rows = [(i, f"own{i} {body} end{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.dedup(df, hot_rows=10 ** 9).collect()}
    brute_rows = {d: (n, gone) for d, n, gone, _, _ in brute.cut_words(rows)}
    assert got == brute_rows


# ---- 2: large shards, hubs ------------------------------------------------------------------------------------

def test_inner_masks_cover_all_close_pairs():
    from ranklight.llm import simhash

    rng = random.Random(9)
    for mask in simhash.shard_masks(10 ** 6, 3)[:6]:
        inner = simhash.inner_masks(mask, 3)
        assert all(m & mask == mask for m in inner) and len(inner) == 4
        free = [i for i in range(64) if not mask >> i & 1]
        for _ in range(200):
            x = rng.getrandbits(64)
            y = x
            for i in rng.sample(free, rng.randint(0, 3)):
                y ^= 1 << i
            assert any(x & m == y & m for m in inner)


@pytest.mark.parametrize("hub_links", [1, 500])
def test_components_with_hubs(spark, monkeypatch, hub_links):
    from ranklight.llm import components as comp

    monkeypatch.setattr(comp, "HUB_LINKS", hub_links)
    monkeypatch.setattr(comp, "HUBS", 10 ** 6)
    rng = random.Random(3)
    edges = [(0, i) for i in range(1, 300)] + [(1000, i) for i in range(1001, 1100)] + [(2000 + i, 2001 + i) for i in range(40)]
    edges += [(rng.randint(3000, 3100), rng.randint(3000, 3100)) for _ in range(60)]
    rng.shuffle(edges)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b and top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node: r.label for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root}


def test_a_broken_import_is_not_swallowed(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.delitem(sys.modules, "ranklight.llm.queries", raising=False)
    monkeypatch.setitem(sys.modules, "ranklight.llm.katz", None)
    import ranklight.llm as package

    monkeypatch.delattr(package, "katz", raising=False)
    monkeypatch.delattr(package, "queries", raising=False)
    with pytest.raises(ImportError):
        entry.queries()
