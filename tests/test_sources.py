import csv
import random

import pytest
from pyspark.sql import functions as F

from ranklight.sources import files


def test_list_media_by_suffix(spark, tmp_path):
    for name in ("1 - a - b.m4a", "2 - c - d.txt", "3 - e - f.m4a"):
        (tmp_path / name).write_bytes(b"x" * 10)
    got = sorted(r.name for r in files.list_media(spark, str(tmp_path), ".m4a").collect())
    assert got == ["1 - a - b.m4a", "3 - e - f.m4a"]


def test_corpus_csv_multiline_quotes(spark, tmp_path):
    rows = [(0, 'line one\nline "two", with comma'), (1, "plain")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    files.write_corpus_csv(df, str(tmp_path / "c"))
    back = files.read_corpus_csv(spark, str(tmp_path / "c"), "doc_id bigint, text string")
    assert sorted(map(tuple, back.collect())) == rows


def test_stoplist_file_normalised(spark, tmp_path):
    (tmp_path / "s.txt").write_text("The  \nI\n\nand\nthe\n", encoding="utf-8")
    got = sorted(r.word for r in files.read_stoplist(spark, str(tmp_path / "s.txt")).collect())
    assert got == ["and", "i", "the"]


def test_suffix_predicate_ignores_query_and_fragment(spark):
    df = spark.createDataFrame([("a/b.html?x=1",), ("a/b.htm",), ("a/c.html#top",)], "url string")
    assert df.filter(files.has_suffix("url", ".html")).count() == 2


@pytest.mark.parametrize("limit", ["97", "64", "211", "1000", "100000"])
def test_split_csv_equals_the_multiline_reader(spark, tmp_path, limit):
    """Quotes, doubled quotes, commas, blank lines and line feeds on range borders; a record longer than several ranges."""
    rng = random.Random(int(limit))
    alphabet = ["a", "b ", '"', '""', ",", "\n", "\n\n", '",\n"', "é", "x" * 20]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))), rng.choice(["plain", "", 'say "hi"', "\n"])) for i in range(120)]
    rows += [(500, "long " * 300 + '\n"' * 100, "end"), (501, "last", "")]
    path = tmp_path / "one"
    path.mkdir()
    with open(path / "a.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator=rng.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL if limit == "64" else csv.QUOTE_NONNUMERIC)
        out.writerow(["id", "text", "more"])
        out.writerows(rows[:70])
    with open(path / "b.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC)
        out.writerow(["id", "text", "more"])
        out.writerows(rows[70:])
    schema = "id bigint, text string, more string"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    try:
        df = files.read_corpus_csv_split(spark, str(path), schema)
        got = sorted(tuple(r) for r in df.collect())
        ranges = spark.read.text(str(path)).select("_metadata.file_block_start").distinct().count()
        if limit in ("64", "97"):
            assert ranges > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(tuple(r) for r in files.read_corpus_csv(spark, str(path), schema).collect())
    assert len(got) == len(rows)


def test_split_csv_of_an_empty_corpus(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,text\n")
    assert files.read_corpus_csv_split(spark, str(tmp_path / "e.csv"), "id bigint, text string").count() == 0


def test_large_csv_files_are_bounded(spark, tmp_path):
    """A table beyond ``file_bytes`` is written by several tasks, a smaller one as one file; both are read whole."""
    rows = [(i, f'text {i}\n"{"x" * 500}"' if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(8)
    for limit, least, most in ((1 << 20, 1, 1), (60_000, 3, 4)):
        path = tmp_path / str(limit)
        files.write_corpus_csv(df, str(path), limit)
        assert least <= len(list(path.glob("*.csv"))) <= most
        assert sorted(map(tuple, files.read_corpus_csv_split(spark, str(path), "id bigint, text string").collect())) == rows
