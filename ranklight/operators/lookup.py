"""Posting lookup by directory (A4, F19): one block read and a binary search for each (term, document) pair.

The documents of a term stand in ascending order in blocks of ``block_size`` at most; a directory has the first and the last
document of each block and, over ``FAN`` blocks, of each group.  A pair of a term with several blocks finds its group and in it its
block (the last that begins at or before it), where it searches the sorted array by halving.  Blocks are cut from a
range-partitioned sort, so a term that a third of the corpus holds is spread over many tasks; their numbers are corrected by one
row for each term and partition that such a term spans.

Postings move once, into the blocks, and blocks and pairs once more, to each other: a pair knows its block before it moves, from the
directory of the terms that have more than one, which is broadcast (one entry for some ``block_size`` postings).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ranklight.operators.sizing import MAX_BROADCAST_ROWS, bounded
from ranklight.sources.scratch import materialize

BLOCK_SIZE = 4096
FAN = 256


@dataclass
class PostingDirectory:
    blocks: DataFrame      # term, block, doc_ids, tfs
    directory: DataFrame   # term, part, block, first, last
    groups: DataFrame      # term, part, first, last


def build(postings: DataFrame, block_size: int = BLOCK_SIZE, fan: int = FAN) -> PostingDirectory:
    """From ``term, doc_id, tf`` (one row for each pair).  A null document id is no posting that a pair could find."""
    spark = postings.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = postings.select("term", "doc_id", "tf").filter(F.col("doc_id").isNotNull())
    placed = placed.repartitionByRange(n, "term", "doc_id").sortWithinPartitions("term", "doc_id").withColumn("pid", F.spark_partition_id())
    kind = {f.name: f.dataType.simpleString() for f in placed.schema}
    cut = placed.mapInArrow(_cut(block_size), f"term string, pid int, own bigint, first {kind['doc_id']}, last {kind['doc_id']}, "
                                              f"doc_ids array<{kind['doc_id']}>, tfs array<{kind['tf']}>")
    cut = materialize(cut, "posting-blocks")
    spans = cut.groupBy("term", "pid").agg(F.count("own").alias("n"))
    before = Window.partitionBy("term").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    later = materialize(spans.withColumn("before", F.sum("n").over(before)).filter("before > 0").select("term", "pid", "before"), "posting-spans")
    placed = cut.join(F.broadcast(later), ["term", "pid"], "left").withColumn("block", F.col("own") + F.coalesce("before", F.lit(0)))
    directory = placed.select("term", F.floor(F.col("block") / fan).alias("part"), "block", "first", "last")
    groups = directory.groupBy("term", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return PostingDirectory(placed.select("term", "block", "doc_ids", "tfs"), directory, groups)


def _cut(block_size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted postings as blocks, numbered within their term and partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, at, number = None, None, 0  # postings of the last term, whose next block is ``number``
        for b in batches:
            t = pa.Table.from_batches([rest, b] if rest else [b]).combine_chunks()
            rest = None
            if t.num_rows:
                out, rest, at, number = blocks(t.to_batches()[0], at, number, False)
                if out:
                    yield out
        if rest:
            yield blocks(rest, at, number, True)[0]

    def blocks(b: pa.RecordBatch, at, number: int, end: bool):
        term = b.column("term")
        code = pc.rank(term, sort_keys="ascending", tiebreaker="dense").to_numpy() if b.num_rows else np.zeros(0)
        heads = np.r_[0, np.flatnonzero(np.diff(code)) + 1]
        sizes = np.diff(np.r_[heads, len(code)])
        starts = np.concatenate([np.arange(h, h + s, block_size) for h, s in zip(heads, sizes)]) if (sizes > block_size).any() else heads
        run_of = np.searchsorted(heads, starts, "right") - 1
        own = np.arange(len(starts)) - np.searchsorted(run_of, run_of)
        if term[0].as_py() == at:
            own[run_of == 0] += number
        ends, rest = np.r_[starts[1:], len(code)], None
        at, number = term[len(term) - 1].as_py(), int(own[-1])
        if not end:  # the last block may go on in the next batch
            rest = b.slice(int(starts[-1]))
            starts, ends, own = starts[:-1], ends[:-1], own[:-1]
        if not len(starts):
            return None, rest, at, number
        used = b.slice(0, int(ends[-1]))
        offsets = pa.array(np.r_[starts, ends[-1]].astype(np.int32))
        ids, first, last = used.column("doc_id"), pa.array(starts), pa.array(ends - 1)
        made = [used.column("term").take(first), used.column("pid").take(first), pa.array(own.astype(np.int64)), ids.take(first), ids.take(last),
                pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, used.column("tf"))]
        return pa.RecordBatch.from_arrays(made, ["term", "pid", "own", "first", "last", "doc_ids", "tfs"]), rest, at, number

    return run


def lookup(index: PostingDirectory, pairs: DataFrame, block_size: int = BLOCK_SIZE, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``pairs`` (columns ``term, doc_id``; others pass through) with ``tf``, NULL where the document does not hold the term."""
    at = _placed(index, materialize(pairs, "posting-lookup"), max_broadcast_rows)
    # the pairs of a block meet it in groups of twice ``block_size``, about: a block's arrays are joined once for a group, not for each pair
    groups = F.ceil(F.count(F.lit(1)) / (2 * block_size)).cast("int")
    many = materialize(at.groupBy("term", "_block").agg(groups.alias("_groups")).filter("_groups > 1"), "posting-groups")
    many = F.broadcast(many) if bounded(many, max_broadcast_rows) else many
    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("_groups", F.lit(1))).cast("int")
    asked = at.join(many, ["term", "_block"], "left").select("term", "_block", own.alias("_own"), F.struct(*pairs.columns).alias("p"))
    asked = asked.groupBy("term", "_block", "_own").agg(F.collect_list("p").alias("p"))
    copies = F.sequence(F.lit(0), F.coalesce("_groups", F.lit(1)) - 1)
    blocks = index.blocks.withColumnRenamed("block", "_block").join(many, ["term", "_block"], "left").select(
        "term", "_block", F.explode(copies).alias("_own"), "doc_ids", "tfs")
    read = asked.join(blocks, ["term", "_block", "_own"], "left").select("p", "doc_ids", "tfs")
    schema = StructType([*pairs.schema.fields, StructField("tf", read.schema["tfs"].dataType.elementType)])
    return read.mapInArrow(_search(pairs.columns.index("doc_id")), schema)


def _placed(index: PostingDirectory, pairs: DataFrame, max_broadcast_rows: int) -> DataFrame:
    """``pairs`` with the ``_block`` of their term in which they would stand; 0 where no block holds their place, and for a
    term of one block, whose pairs need no directory."""
    several = index.directory.filter("block > 0").select("term").distinct()
    blocks = materialize(index.directory.join(several, "term", "left_semi"), "posting-directory")
    groups = blocks.groupBy("term", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    small = bounded(blocks, max_broadcast_rows)

    def within(rows: DataFrame, of: DataFrame, on: list[str], found: str) -> DataFrame:
        of = of.select(*[F.col(c).alias(f"_at_{c}") for c in of.columns])
        met = (F.col("doc_id") >= F.col("_at_first")) & (F.col("doc_id") <= F.col("_at_last"))
        for a, b in zip(on, ("_at_term", "_at_part")):
            met &= F.col(a) == F.col(b)
        return rows.join(F.broadcast(of) if small else of, met, "left").select(*rows.columns, F.col(f"_at_{found}").alias(f"_{found}"))

    at = within(within(pairs, groups, ["term"], "part"), blocks, ["term", "_part"], "block")
    return at.select(*pairs.columns, F.coalesce("_block", F.lit(0)).cast("long").alias("_block"))


def _search(key: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Binary search of the asked documents (field ``key`` of the pairs) of each row in its block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, ids, tfs = b.columns
            asked, ends = p.flatten(), np.r_[0, np.cumsum(pc.list_value_length(p).to_numpy(zero_copy_only=False))]
            fields = asked.flatten()
            held = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]
            known = fields[key].is_valid().to_numpy(zero_copy_only=False)
            docs = (fields[key].fill_null(0) if pa.types.is_integer(fields[key].type) else fields[key]).to_numpy(zero_copy_only=False)
            blocks, values = (x.flatten() for x in (ids, tfs))
            blocks = blocks.to_numpy(zero_copy_only=False)
            place = np.full(len(docs), -1)
            for a, z, lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), held[:-1].tolist(), held[1:].tolist()):
                if hi > lo:
                    own = docs[a:z] if known[a:z].all() else docs[a:z][known[a:z]]
                    at = np.minimum(blocks[lo:hi].searchsorted(own), hi - lo - 1) + lo
                    place[a:z][known[a:z]] = np.where(blocks[at] == own, at, -1)
            tf = values.take(pa.array(place, mask=place < 0))
            yield pa.RecordBatch.from_arrays([*fields, tf], names=[*(f.name for f in asked.type), "tf"])

    return run
