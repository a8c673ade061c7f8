from pyspark.sql import functions as F

from ranklight.functions.text import default_stopwords, tokens


def _tokens(spark, text, stopwords=()):
    df = spark.createDataFrame([(0, text)], "doc_id bigint, text string")
    return [r.term for r in tokens(df, stopwords=stopwords).collect()]


def test_g7_tokeniser(spark):
    text = "It's the U.S. no-one and/or 12:30, rock-n-roll don't café sun. sun"
    assert _tokens(spark, text) == ["it", "the", "do", "café", "sun", "sun"]


def test_stop_words_removed_before_anything_else(spark):
    assert _tokens(spark, "The sun and THE sea", stopwords=None) == ["sun", "sea"]


def test_punctuation_and_clitics(spark):
    assert _tokens(spark, "Wait...what--now? (yes) we'll go; \"quoted\" «guillemets»") == \
        ["wait", "what", "now", "yes", "we", "go", "quoted", "guillemets"]


def test_empty_and_null_text(spark):
    df = spark.createDataFrame([(0, ""), (1, None), (2, "   ")], "doc_id bigint, text string")
    assert tokens(df).count() == 0


def test_default_stop_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert set(default_stopwords("english")) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_one_word_contractions(spark):
    words = "cannot gimme gonna gotta lemme wanna canoe".split()
    df = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    got = {}
    for r in tokens(df, stopwords=()).collect():
        got.setdefault(words[r.doc_id], []).append(r.term)
    assert got == {"cannot": ["can", "not"], "gimme": ["gim", "me"], "gonna": ["gon", "na"], "gotta": ["got", "ta"],
                   "lemme": ["lem", "me"], "wanna": ["wan", "na"], "canoe": ["canoe"]}
