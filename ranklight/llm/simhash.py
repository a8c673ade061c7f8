"""SimHash near-duplicate detection through BK-trees.

1. Every text becomes one 64-bit fingerprint (Arrow batches, one row out per document).
2. The distinct fingerprints are dealt into shards: any two fingerprints at ``radius`` or fewer bits
   agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so each fingerprint joins one shard
   per choice of that many blocks, and every close pair meets in some shard.  More blocks mean smaller
   shards; the number follows the count of fingerprints.
3. In a shard a BK-tree is grown: a child hangs on its parent under the integer Hamming distance between
   the two, and a probe at distance d follows only the edges d - radius .. d + radius.  Links become
   the edges of a spanning forest of the shard, never all pairs.
4. A shard over ``shard_rows`` is dealt again by the bits that its mask leaves out, cut into ``radius + 1`` blocks of which a
   close pair shares one: ``radius + 1`` rows for each of its rows, however large it is.  What is still too large then (only
   fingerprints that crowd into a few bits) is cut into parts; each pair of parts meets in a task of its own, so the tree
   of one part is probed by the rows of the other and no task sees the whole shard.
5. Components of the links, then the smallest document id of each.

Fingerprints are never collected on the driver.  Shard trees travel to their probes by shuffle, not as
broadcast variables, because their size grows with the corpus.

Null text counts as empty.  Rows with the same id or the same text are ordinary rows; a null id never
becomes a component id unless the whole component has none.  An empty table gives no row.  Columns besides id and text are
not read by ``near_duplicates`` and pass through ``representatives``, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import id_and_text, shuffle_partitions, slices, text_bytes, tidied, unused
from ranklight.llm.components import components
from ranklight.sources.scratch import materialize

SHARD_ROWS = 2048
SEED = 42
WORD = (1 << 64) - 1


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one UTF-8 text; 0 for a text without words."""
    import xxhash

    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:i + n] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, mark, fp`` for every row; ``mark`` is the hash of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = pa.array([fingerprint(t, shingle) for t in text_bytes(b, 2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], ["doc_id", "mark", "fp"])

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(tidied(run), "doc_id long, mark long, fp long")


def shard_masks(count: int, radius: int) -> list[int]:
    """Bit masks whose masked values name the shards; enough blocks for about 64 rows in a shard."""
    blocks = radius + 1
    while blocks < 2 * radius and count > 64 * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(parts, blocks - radius)]


def inner_masks(mask: int, radius: int) -> list[int]:
    """The mask with each of ``radius + 1`` blocks of the bits that it leaves out."""
    left = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(left) * i // (radius + 1) for i in range(radius + 2)]
    return [mask | sum(1 << i for i in left[lo:hi]) for lo, hi in itertools.pairwise(cuts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class BKTree:
    """Burkhard-Keller tree over 64-bit integers, signed or not, under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, x: int, radius: int) -> list[int]:
        """Indices of all values at ``radius`` or fewer bits from ``x``."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = ((self.values[at] ^ x) & WORD).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.children[at]
            if len(kids) <= 2 * radius + 1:
                todo += [c for e, c in kids.items() if d - radius <= e <= d + radius]
            else:
                todo += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found

    def add(self, x: int) -> None:
        self.values.append(x)
        self.children.append({})
        at, new = 0, len(self.values) - 1
        while at != new:
            at = self.children[at].setdefault(((self.values[at] ^ x) & WORD).bit_count(), new)


def shard_links(values: list[int], parts: list[int], i: int, j: int, radius: int) -> list[tuple[int, int]]:
    """Spanning links of one shard: all values (i == j) or those between the parts i and j."""
    tree, root, links = BKTree(), {}, []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for x in values:
        root[x] = x
    own = values if i == j else [x for x, p in zip(values, parts) if p == i]
    others = [] if i == j else [x for x, p in zip(values, parts) if p == j]
    for x in own:
        if i == j:
            for at in tree.near(x, radius):
                a, b = top(tree.values[at]), top(x)
                if a != b:
                    root[b] = a
                    links.append((tree.values[at], x))
        tree.add(x)
    for x in others:
        for at in tree.near(x, radius):
            a, b = top(tree.values[at]), top(x)
            if a != b:
                root[b] = a
                links.append((tree.values[at], x))
    return links


def links(fps: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``a, b``: links between distinct fingerprints whose closure is that of all pairs at ``radius``."""
    spark = fps.sparkSession
    distinct = materialize(fps.select("fp").distinct(), "simhash-distinct")
    masks = shard_masks(distinct.count(), radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                            .alias("t", "v"))

    def crowded(df: DataFrame) -> DataFrame:
        return df.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows)

    large = materialize(crowded(keyed).select("t", "v"), "simhash-large")
    inner = F.array(*[F.array(*[F.lit(_signed(x)) for x in inner_masks(m, radius)]) for m in masks])
    again = keyed.join(large, ["t", "v"], "left_semi").select("fp", "t", F.posexplode(F.transform(
        F.element_at(inner, F.col("t") + 1), lambda m: F.col("fp").bitwiseAND(m))).alias("j", "w"))
    again = again.select("fp", (len(masks) + F.col("t") * (radius + 1) + F.col("j")).alias("t"), F.col("w").alias("v"))
    keyed = keyed.join(large, ["t", "v"], "left_anti").select("fp", "t", "v").unionAll(again)
    big = crowded(keyed).select("t", "v", F.ceil(2 * F.col("n") / shard_rows).cast("int").alias("cuts"))
    keyed = keyed.join(big, ["t", "v"], "left")
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("cuts")).cast("int")
    keyed = keyed.withColumn("part", F.coalesce(part, F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("cuts") - 1, F.lit(0)))).alias("o")
    met = keyed.select("t", "v", "fp", "part", other).select(
        "t", "v", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def grown():
            if len(rows) < 2:
                return []
            return shard_links([r[1] for r in rows], [r[0] for r in rows], key[2], key[3], radius)

        def out(found):
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        found: list[tuple[int, int]] = []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for t, v, i, j, p, fp in zip(*cols):
                if (t, v, i, j) != key:
                    found += grown()
                    key, rows = (t, v, i, j), []
                rows.append((p, fp))
            yield out(found)
            found = []
        yield out(found + grown())

    n = shuffle_partitions(spark)
    return (met.repartition(n, "t", "v", "i", "j").sortWithinPartitions("t", "v", "i", "j")
            .mapInArrow(tidied(run), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id, mark, first`` for every row of ``docs``.

    ``fingerprint``: 16 lowercase hex digits.  ``component_id``: the smallest id reachable over links of
    at most ``radius`` differing bits, its own included.  ``first``: whether the row is its component's
    representative (the smallest id, then the smallest ``mark``, the hash of the text)."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    label = components(links(fps, radius, shard_rows)).select(F.col("node").alias("fp"), "label")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")  # rows without an id come last
    least = (fps.groupBy("fp").agg(F.min(row).alias("least")).join(label, "fp", "left")
             .withColumn("label", F.coalesce("label", "fp")))
    whole = least.groupBy("label").agg(F.min("least").alias("least"))
    of_fp = least.drop("least").join(whole, "label").select("fp", "least")
    return fps.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
        "mark", (row == F.col("least")).alias("first"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, with all their columns, whatever their
    names."""
    near = near_duplicates(docs, id_col, text_col, **settings).filter("first")
    names = unused(docs, "near_none", "near_id", "near_mark")

    def key(of_id, mark):  # a null id is an id of its own
        return dict(zip(names, (of_id.isNull(), F.coalesce(of_id, F.lit(0)), mark)))

    near = near.select(*[v.alias(k) for k, v in key(F.col("doc_id"), F.col("mark")).items()]).distinct()
    own = docs.withColumns(key(F.col(id_col).cast("long"), F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0))))
    # rows with the same id and the same text: one stays (the join has already dealt them out by these columns)
    return own.join(near, list(near.columns), "left_semi").dropDuplicates(near.columns).select(*docs.columns)
