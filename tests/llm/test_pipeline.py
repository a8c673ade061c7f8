import brute
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from ranklight.llm.queries import ORACLE, QUERIES


def plain_stages(docs, lang_rejects, items):
    """docs: {id: text}; the five stages one after the other."""
    kept = {d: t for d, t in docs.items() if d not in lang_rejects}
    ids = sorted(kept)
    first = brute.components(ids, [brute.fingerprint(kept[d]) for d in ids])
    kept = {d: kept[d] for d, c in zip(ids, first) if d == c}
    out = {}
    for d, _, gone, _, words in brute.cut_words(sorted(kept.items())):
        out[d] = b" ".join(words).decode() if gone else kept[d]

    def grams(t):
        import regex

        w = regex.findall(r"[\p{L}\p{N}]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    wanted = [grams(t) for t in items]
    return {d: t for d, t in out.items() if not any(g and len(g & grams(t)) >= 0.8 * len(g) for g in wanted)}


def test_pipeline_against_plain_stages(spark, sf, documents):
    import sentencepiece

    from ranklight.llm.vocabulary import SENTENCE_PIECES

    sp = sentencepiece.SentencePieceProcessor(model_file=SENTENCE_PIECES)
    docs = {r.doc_id: r.text for r in documents.collect()}
    pred = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf).collect()}
    rejects = {d for d, r in pred.items() if r.lang_pred == "und" or r.score < 0.5}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain_stages(docs, rejects, items)
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*documents.columns, "ids", "n_pieces", "round_trip"]
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.ids == sp.encode(r.text) and r.round_trip and r.n_chars == len(r.text) for r in rows)


def test_stages_on_odd_rows(spark, sf, odd, empty, clashing):
    for docs in (odd, empty, clashing):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            if i < 4:
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
            extra = [c for c in docs.columns[5:] if i < 4 or c not in ("ids", "n_pieces", "round_trip")]
            assert all(r[c] == "extra" for r in out.collect() for c in extra)  # every value comes back as it was
    text = odd.first().text
    cut = corpus_pipeline.substring_dedup(spark, odd.filter("doc_id <= 2").withColumn("text", F.concat("text", F.lit("\n  tail"))), sf)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in cut.collect())[0] == (1, text + "\n  tail", 10)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = con.execute(ORACLE[name])
    names = [c[0] for c in got.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(got.fetchall())
