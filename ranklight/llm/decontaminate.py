"""Benchmark decontamination: MinHash containment search, in DataFrame operations only.

An item is a short text, a document a long one, so their Jaccard similarity says little; containment does: the
share of the item's distinct five-word shingles that the document holds.  Items are partitioned by
size, and the partition sets how much of the item's MinHash order is looked up: an item of n shingles that a
document contains to the share t misses at most n - ceil(t n) of them, so one of its
n - ceil(t n) + 1 shingles with the smallest hashes is in every such document.  No hit can be
missed.  Candidates are then verified by the shingles themselves, as text.

Words are runs of letters and digits, lower-cased.  An item of fewer than five words is one shingle of all
its words; an item without a word matches nothing.  Null text counts as empty.  Rows that repeat are
judged by themselves; repeated results are returned once.  A null id is returned as it is.  Without documents or items there
is no hit.  Extra columns of either table are not read by ``contaminated``; ``clean`` returns all columns of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import unused
from ranklight.sources.scratch import materialize

WORDS = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 1_000_000  # sketch or candidate rows of at most 40 bytes each


def words(text: Column) -> Column:
    runs = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(runs, lambda w: w != "")


def _grams(w: str, size: int, as_text: bool) -> Column:
    """All ``size``-word shingles of the array column ``w``, as text or as hashes."""
    def one(i):
        part = [F.get(F.col(w), i + k) for k in range(size)]
        return F.concat_ws(" ", *part) if as_text else F.xxhash64(*part)

    last = F.size(w) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one))


def _all_grams(w: str, sizes: list[int], as_text: bool) -> Column:
    kind = "array<string>" if as_text else "array<long>"
    return F.concat(*[F.coalesce(_grams(w, n, as_text), F.array().cast(kind)) for n in sizes])


def item_shingles(items: DataFrame, id_col: str, text_col: str, containment: float, size: int) -> DataFrame:
    """``item, item_id, size, shingles, n, depth``: ``depth`` is the size partition's lookup depth."""
    w = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("size", F.least(F.size("w"), F.lit(size)))
    text = F.coalesce(*[F.when(F.col("size") == n, _grams("w", n, True)) for n in range(1, size + 1)])
    out = w.select("item_id", "size", F.array_distinct(text).alias("shingles"))
    n = F.size("shingles")
    return out.select(F.xxhash64("item_id", "shingles").alias("item"), "item_id", "size", "shingles", n.alias("n"),
                      (n - F.ceil(F.round(n * F.lit(containment), 9)) + 1).cast("int").alias("depth"))


def sketches(items: DataFrame, sizes: list[int]) -> DataFrame:
    """``h, item``: the ``depth`` smallest shingle hashes of every item (bottom-k MinHash)."""
    def hashed(n: int) -> Column:
        return F.transform("shingles", lambda s: F.xxhash64(*[F.get(F.split(s, " "), F.lit(k)) for k in range(n)]))

    h = F.coalesce(*[F.when(F.col("size") == n, hashed(n)) for n in sizes])
    return items.select("item", F.explode(F.slice(F.array_sort(F.array_distinct(h)), F.lit(1), F.col("depth"))).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", containment: float = CONTAINMENT,
                 size: int = WORDS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` for every document and item at or over
    ``containment``."""
    found = _hits(docs, items, id_col, text_col, item_id_col, item_text_col, containment, size, broadcast_rows)
    return found.drop("mark").distinct()


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", containment: float = CONTAINMENT, size: int = WORDS,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, whatever their names."""
    found = _hits(docs, items, id_col, text_col, item_id_col, item_text_col, containment, size, broadcast_rows)
    gone = materialize(found.select("doc_id", "mark").distinct(), "decontaminate-gone")
    gone_id, gone_mark = unused(docs, "gone_id", "gone_mark")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("mark").alias(gone_mark))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.join(_side(gone, broadcast_rows), F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.xxhash64(text) == F.col(gone_mark)),
                     "left_anti")


def _side(df: DataFrame, broadcast_rows: int) -> DataFrame:
    """Broadcast behind a count of the (written) table."""
    return F.broadcast(df) if df.count() <= broadcast_rows else df


def _hits(docs, items, id_col, text_col, item_id_col, item_text_col, containment, size, broadcast_rows) -> DataFrame:
    """Verified hits with the hash of the document's text as ``mark``.  The sketch table and the candidates are broadcast only when their counted rows stay under
    ``broadcast_rows``; beyond that both joins shuffle."""
    held = materialize(item_shingles(items, item_id_col, item_text_col, containment, size), "decontaminate-items")
    sizes = sorted(r[0] for r in held.select("size").distinct().collect()) or [size]  # at most ``size`` numbers
    sketch = materialize(sketches(held, sizes), "decontaminate-sketch")

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    hashed = rows.select("doc_id", "mark", words(F.col("text")).alias("w")).select(
        "doc_id", "mark", F.explode(_all_grams("w", sizes, False)).alias("h"))
    found = materialize(hashed.join(_side(sketch, broadcast_rows), "h").select("doc_id", "mark", "item").distinct(),
                        "decontaminate-candidates")
    found = found.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "item")
    near = rows.join(_side(found, broadcast_rows), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))
    near = near.select("doc_id", "mark", "item", words(F.col("text")).alias("w")).select(
        "doc_id", "mark", "item", _all_grams("w", sizes, True).alias("own"))
    shared = F.size(F.array_intersect("shingles", "own"))
    return (near.join(held, "item")
            .select("doc_id", "mark", "item_id", F.col("n").alias("n_shingles"), shared.alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
            .filter(F.round("containment", 9) >= containment))


#: DuckDB twin of ``contaminated(documents, benchmark)``.
ORACLE = r"""
WITH items AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
grams AS (SELECT item_id, least(len(w), 5) AS k,
          list_distinct([array_to_string(w[i:i + least(len(w), 5) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 5) + 2)]) AS g
          FROM items WHERE len(w) > 0),
flat AS (SELECT DISTINCT item_id, len(g) AS n_shingles, unnest(g) AS s FROM grams),
docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
own AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS s
        FROM docs, (SELECT DISTINCT k FROM grams))
SELECT doc_id, item_id, n_shingles::INTEGER AS n_shingles, count(*)::INTEGER AS n_shared, count(*) / n_shingles::DOUBLE AS containment
FROM own JOIN flat USING (s) GROUP BY doc_id, item_id, n_shingles HAVING round(count(*) / n_shingles::DOUBLE, 9) >= 0.8
"""
