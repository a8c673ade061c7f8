"""Operators 1, 2, 3 and 6."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from ranklight.llm import decontaminate, simhash, substrings, suffixes
from ranklight.llm.queries import QUERIES


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---- 2 --------------------------------------------------------------------------------------------------------

def check_simhash(df, **settings):
    docs = pairs(df)
    prints = [brute.fingerprint(t) for _, t in docs]
    want = [(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, brute.components([d for d, _ in docs], prints))]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, **settings).collect()]
    assert key(got) == key(want)


def test_simhash_odd_rows(odd, empty, clashing):
    check_simhash(odd)
    check_simhash(clashing)
    assert simhash.near_duplicates(empty).count() == 0
    stay = [(r.doc_id, r.text) for r in simhash.representatives(odd).select("doc_id", "text").collect()]
    assert len(stay) == len(set(stay)) and (1, odd.first().text) in stay and (2, odd.first().text) not in stay
    assert simhash.representatives(clashing).columns == clashing.columns


def test_simhash_query(spark, documents, sf):
    docs = pairs(documents)
    prints = [brute.fingerprint(t) for _, t in docs]
    want = [(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, brute.components([d for d, _ in docs], prints))]
    assert key(tuple(r) for r in QUERIES["op2_simhash_dedup"](spark, sf).collect()) == key(want)


def test_links_of_dense_and_split_shards(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    own = {base}
    for _ in range(300):  # a chain of near values, far beyond one radius, and noise
        own.add(base := base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    own |= {rng.getrandbits(64) for _ in range(300)}
    own = sorted(own)
    fps = spark.createDataFrame([(simhash._signed(x),) for x in own], "fp long")
    want = brute.components(list(range(len(own))), own)
    for rows in (2048, 40):  # 40: shards are cut into parts
        from ranklight.llm.components import components

        label = {r.node: r.label for r in components(simhash.links(fps, 3, rows)).collect()}
        got = [label.get(simhash._signed(x), simhash._signed(x)) for x in own]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_shard_masks_cover_all_close_pairs():
    rng = random.Random(1)
    for count in (10, 10**8, 10**11):
        masks = simhash.shard_masks(count, 3)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 3):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


# ---- 3 --------------------------------------------------------------------------------------------------------

def check_words(df, **settings):
    want = [r[:4] for r in brute.cut_words(pairs(df))]
    out = substrings.dedup(df, **settings)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()]
    assert key(got) == key(want)
    return out


def test_word_dedup_odd_rows(odd, empty, clashing):
    check_words(odd)
    check_words(odd, hot_rows=0)  # every slot over its share takes the hot path
    out = check_words(clashing)
    assert out.columns == [c for c in clashing.columns if c not in ("n_words", "n_removed", "kept_sha256", "kept_text")] + [
        "n_words", "n_removed", "kept_sha256", "kept_text"]
    assert substrings.dedup(empty).count() == 0
    texts = {(r.doc_id, r.text): r.kept_text for r in check_words(odd).collect()}
    assert texts[4, None] is None and texts[1, odd.first().text] == odd.first().text


def test_word_dedup_hot_passage(spark):
    rng = random.Random(3)
    words = [f"t{i}" for i in range(50)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(20))) + " " + (passage if i % 3 == 0 else "") + " "
             + " ".join(["same"] * rng.randrange(60)) + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(40))))
            for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check_words(df)
    check_words(df, hot_rows=2)
    check_words(df, hot_rows=0, part_rows=50)


def test_word_dedup_query(spark, documents, sf):
    want = [r[:4] for r in brute.cut_words(pairs(documents))]
    assert key(tuple(r) for r in QUERIES["op3_substring_dedup"](spark, sf).collect()) == key(want)


# ---- 6 --------------------------------------------------------------------------------------------------------

def check_bytes(df, length=200, **settings):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffixes.dedup(df, length=length, **settings).collect()]
    assert key(got) == key(brute.cut_bytes(pairs(df), length))


def test_byte_dedup_odd_rows(spark, odd, empty, clashing):
    small = odd.withColumn("text", F.substring("text", 1, 3000))
    check_bytes(small)
    check_bytes(small, length=40, gram=12)
    check_bytes(clashing.withColumn("text", F.substring("text", 1, 3000)))
    assert suffixes.dedup(empty).count() == 0
    whole = {r.doc_id: r for r in suffixes.dedup(odd.filter("doc_id = 6")).collect()}[6]
    assert whole.n_bytes == odd.filter("doc_id = 6").first().n_chars and whole.n_removed > 0  # the words repeat inside it


def test_byte_dedup_hot_and_periodic(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdé ") for _ in range(400))
    docs = [(i, "".join(rng.choice("xyz é") for _ in range(rng.randrange(300))) + (passage if i % 3 == 0 else "")
             + "ab" * rng.randrange(200) + "z" * rng.randrange(300)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    check_bytes(df)
    check_bytes(df, shard=1000)


def test_byte_dedup_splits_a_hot_minimiser(spark, monkeypatch):
    rng = random.Random(5)
    letters = "abcdefghij "
    passage = "".join(rng.choice(letters) for _ in range(500))
    edges = ["".join(rng.choice(letters) for _ in range(60)) for _ in range(8)]  # some neighbours are shared as well
    docs = [(i, "".join(rng.choice(letters) for _ in range(150)) + rng.choice(edges)[rng.randrange(60):] + passage
             + rng.choice(edges)[:rng.randrange(60)] + "".join(rng.choice(letters) for _ in range(150))) for i in range(400)]
    docs += [docs[0], (None, docs[1][1]), (7000, docs[2][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    repeated = suffixes.repeated

    def bounded(texts, known, length):
        assert sum(map(len, texts)) < 20_000  # all holders' edges would be 80,000 bytes and more
        return repeated(texts, known, length)

    monkeypatch.setattr(suffixes, "repeated", bounded)
    monkeypatch.setattr(suffixes, "HOT_RUNS", 50, raising=False)
    check_bytes(df, shard=10_000)
    monkeypatch.setattr(suffixes, "HOT_CHUNK", 700, raising=False)
    monkeypatch.setattr(suffixes, "HOT_RUNS", 0, raising=False)
    monkeypatch.setattr(suffixes, "HOT_PART", 5000, raising=False)
    check_bytes(df, shard=10_000)


def test_byte_dedup_query(spark, documents, sf):
    assert key(tuple(r) for r in QUERIES["op6_suffix_dedup"](spark, sf).collect()) == key(brute.cut_bytes(pairs(documents)))


def test_long_text_is_cut_into_segments(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abc") for _ in range(4000))
    text = text + "-" + text[1000:1700] + "+"
    powers = suffixes._powers(1000 + 64)
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    r = suffixes.runs([text.encode()], 64, 20, powers)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(r["at"], r["n"])])
    assert sorted(covered.tolist()) == list(range(len(text) - 63))  # each string in one run


def test_suffix_arrays():
    rng = random.Random(0)
    for _ in range(150):
        s = "".join(rng.choice(rng.choice(["ab", "a", "abc", "abcdefgh"])) for _ in range(rng.randrange(1, 60))) * rng.randrange(1, 4)
        t = np.append(np.frombuffer(s.encode(), np.uint8), np.uint8(0))
        b, order = t.tobytes(), suffixes.suffix_array(t)
        assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        left, shared = suffixes.common_prefixes(t, order)
        for i, j in zip(order[1:].tolist(), order[:-1].tolist()):
            n = 0
            while i + n < len(b) and j + n < len(b) and b[i + n] == b[j + n]:
                n += 1
            assert left[i] == j and shared[i] == n


# ---- 1 --------------------------------------------------------------------------------------------------------

def test_decontamination(spark, odd, empty, clashing):
    body = odd.first().text
    items = spark.createDataFrame([
        (1, body), (1, body), (2, body + " and a tail that no document has at all"), (3, "niño 中文"), (4, None), (5, ""),
        (6, "Fourteen, FIFTEEN; sixteen"), (None, body)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.containment, 4) for r in decontaminate.contaminated(odd, items).collect()}
    holders = {1, 2, 6, 7, 9, None}
    assert {d for d, i in got if i == 1} == holders == {d for d, i in got if i == 6} == {d for d, i in got if i is None}
    assert {d for d, i in got if i == 3} == {8} and not {i for _, i in got} & {2, 4, 5}
    slow = {(r.doc_id, r.item_id): round(r.containment, 4) for r in decontaminate.contaminated(odd, items, broadcast_rows=0).collect()}
    assert slow == got
    clean = decontaminate.clean(clashing, items)
    assert clean.columns == clashing.columns
    assert {r.doc_id for r in clean.collect()} == {3, 4, 5, 9, 10}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0
    assert decontaminate.clean(odd, items.limit(0)).count() == odd.count()


def test_containment_threshold_has_no_misses(spark):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))) for i in range(40)]
    docs = []
    for d in range(200):
        w = items[d % 40][1].split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "changed"
        docs.append((d, " ".join(rng.choice(words) for _ in range(300)) + " " + " ".join(w)))

    def grams(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    want = {(d, i) for d, t in docs for i, x in items if len(grams(t) & grams(x)) >= round(0.8 * len(grams(x)), 9)}
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and 40 < len(want) < 200
