"""File sources and sinks.

* S1/S2 — a corpus CSV with a header whose quoted fields span lines; a declared schema (no
  inference pass).  ``read_corpus_csv`` leaves it to Spark's multi-line reader, for which one file is one task.
  ``read_corpus_csv_split`` reads one large file in many tasks: every task takes a byte range of lines and counts its
  quotes; the sums of all earlier ranges tell whether a range starts inside a quoted field (an odd number of quotes so far);
  then each range cuts its own records, and the two pieces of a record at a border are put together.
* S6 — wide feature CSV: one column per coordinate plus ``filename``; loaded back into
  ``array<double>``.  Parquet with an array column is the native form.
* S7 — media listing by suffix with the ``binaryFile`` source (content column pruned away).
* S8 — stop list file: one word per line, right-trimmed, lower-cased.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.operators.sizing import bounded


def read_corpus_csv(spark: SparkSession, path: str, schema: str = "artist string, song string, link string, text string",
                    mode: str = "FAILFAST") -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", mode).csv(path))


FILE_BYTES = 512 << 20  # of a file that many tasks read: some ranges of the default 128 MB
MAX_RANGES = 1_000_000  # byte ranges whose states are broadcast
PIECES = "file string, start bigint, at int, kind string, text string"


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines ``file, start, odd, value`` of byte ranges, in order, as records and, at the borders of a range, pieces of records.

    ``head``: the end of a record that began in an earlier range; ``tail``: the beginning of one that goes on in the next.
    A task holds one record."""
    held: list[str] = []
    key, inside, head, first = None, False, False, True
    out: list[tuple] = []

    def piece(kind: str, at: int) -> None:
        if held:
            text = "\n".join(held)
            if kind != "record" or text.strip("\r"):  # blank lines are no records
                out.append((*key, at, kind, text))
            held.clear()

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["file", "start", "at", "kind", "text"])

    for b in batches:
        quotes = pc.count_substring(b.column(3), '"').to_pylist()
        for file, start, odd, value, n in zip(*(c.to_pylist() for c in b.columns), quotes):
            if (file, start) != key:
                piece("head" if head else "tail", 2)
                key, inside, head, first = (file, start), odd, odd, True
            held.append(value)
            inside ^= bool(n & 1)
            if not inside:
                piece("head" if head else "header" if first and start == 0 else "record", 0 if head else 1)
                head = first = False
        if len(out) >= 10_000 or out and sum(len(o[4]) for o in out[-100:]) > 1 << 20:
            yield batch()
    piece("head" if head else "tail", 2)
    yield batch()


def read_corpus_csv_split(spark: SparkSession, path: str, schema: str = "artist string, song string, link string, text string",
                          mode: str = "FAILFAST") -> DataFrame:
    """The rows of :func:`read_corpus_csv`, with one large file read by many tasks.

    Ranges follow ``spark.sql.files.maxPartitionBytes``.  Quotes must be written as CSV has it: only around whole fields, doubled
    inside them; line ends are LF or CR LF; the first record of each file is its header, which fits one range."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    n = F.length("value") - F.length(F.translate("value", '"', ""))
    ranges = lines.groupBy("file", "start").agg((F.sum(n) % 2).alias("odd"))  # one row for each range
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = ranges.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    ordered = lines.withColumn("line", F.monotonically_increasing_id())
    if bounded(states, MAX_RANGES):
        ordered = ordered.join(F.broadcast(states), ["file", "start"])  # lines stay in order
    else:
        ordered = ordered.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "line")
    pieces = ordered.select("file", "start", "odd", "value").mapInArrow(_cut_records, PIECES)
    borders = pieces.filter(F.col("kind").isin("head", "tail"))
    run = Window.partitionBy("file").orderBy("start", "at")
    borders = borders.withColumn("record", F.sum((F.col("kind") == "tail").cast("int")).over(run))
    joined = borders.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "at", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    records = pieces.filter("kind = 'record'").select("text").unionAll(joined.select(text.alias("text")))
    parsed = F.from_csv(F.regexp_replace("text", "\r$", ""), schema, {"escape": '"', "mode": mode})
    return records.select(parsed.alias("row")).select("row.*")


def write_corpus_csv(df: DataFrame, path: str, file_bytes: int | None = None) -> None:
    """``file_bytes``: rows are gathered in as few files as hold about that many bytes of text each; a file is written by one
    task, so no task reads more than its share however large the table is.  Without it, each partition is a file."""
    if file_bytes:
        size = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
        total = df.agg(F.sum(sum(size, F.lit(0)).cast("long"))).first()[0] or 0
        df = df.coalesce(max(1, math.ceil(total / file_bytes)))
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def save_features(df: DataFrame, vec_col: str, name_col: str, path: str, dim: int) -> None:
    """``0 … d-1`` columns and ``filename``."""
    cols = [F.element_at(vec_col, i + 1).cast("double").alias(str(i)) for i in range(dim)]
    df.select(*cols, F.col(name_col).alias("filename")).write.mode("overwrite").option("header", True).csv(path)


def load_features(spark: SparkSession, path: str, dim: int, vec_col: str = "features") -> DataFrame:
    """S6 + P3: ``(filename, features array<double>)`` (the name column dropped from the vector)."""
    schema = ", ".join([f"`{i}` double" for i in range(dim)] + ["filename string"])
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return df.select("filename", F.array(*[F.col(f"`{i}`") for i in range(dim)]).alias(vec_col))


def list_media(spark: SparkSession, folder: str, suffix: str = ".m4a") -> DataFrame:
    """``(path, name, length)`` of files ending in ``suffix`` (contents are not read)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def has_suffix(col, suffix: str):
    """S7 as a predicate on a path/url column (query string and fragment ignored)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.endswith(F.regexp_replace(c, r"[?#].*$", ""), F.lit(suffix))


def read_stoplist(spark: SparkSession, path: str) -> DataFrame:
    """``(word)`` — right-trimmed and lower-cased, blank lines dropped, duplicates removed."""
    w = spark.read.text(path).select(F.lower(F.rtrim("value")).alias("word"))
    return w.filter(F.length("word") > 0).distinct()
