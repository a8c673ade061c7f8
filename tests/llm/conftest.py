import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf(spark):
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    body = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    long = " ".join(f"w{i % 7919}" for i in range(60_000)) + " " + body
    rows = [(1, body, "en", "a", 10), (2, body, "en", "a", 10), (2, body, "en", "a", 10), (3, "", "en", None, 0),
            (4, None, None, "b", None), (5, " \t\n ", "fr", "b", 3), (6, long, "en", "b", len(long)), (None, body, "en", "b", 5),
            (7, body.upper(), None, None, None), (8, "él niño 中文 🎉 ▁ x\x00y", "es", "c", 1), (9, "a", "en", "c", 1),
            (9, "another text under the same id " + body, "en", "c", 1), (10, "?!... 123", "en", "c", 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns called like everything an operator might add."""
    from pyspark.sql import functions as F

    names = ("mark fp part blob key at n t c0 spans w h d m item ids n_pieces round_trip score lang_pred held_out kept_text "
             "n_words n_removed kept_sha256 fingerprint component_id first row x label decoded _gone_id _gone_mark gone_id gone_mark "
             "_near_none _near_id _near_mark near_none near_id near_mark _lang_pred _lang_score lang_score").split()
    return odd.withColumns({c: F.lit("extra") for c in names})
