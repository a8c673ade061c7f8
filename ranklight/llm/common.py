"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tidied(run: Callable) -> Callable:
    """A map over Arrow batches that gives its freed memory back to the system when its partition is done: Python
    workers live on between tasks, and several of them share an executor's memory."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        release_memory()

    return tidy


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


class Shared:
    """A broadcast of an object of this package.  It travels with its class, so executors need no installed copy."""

    def __init__(self, spark: SparkSession, value: object):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self) -> object:
        return pickle.loads(self.sent.value)


def crc_mod(id_col: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``, the rule that assigns documents to folds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(batch: pa.RecordBatch, i: int) -> list:
    """Column ``i`` of UTF-8 strings as Python bytes (None for null)."""
    return batch.column(i).cast(pa.binary()).to_pylist()


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows: bounds what a task holds as Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut where the text column reaches about ``limit`` bytes (one row at least)."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield b.slice(at, to - at)
            at = to
        del b
        release_memory()


def pack(columns: dict[str, pa.Array], level: int = 3) -> bytes:
    """Columns as one compressed blob: many small rows travel through a shuffle as one."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    codec = pa.Codec("zstd", compression_level=level)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]).combine_chunks()


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """Blobs of rows ``(part, blob)`` that arrive sorted by part, one list for each part."""
    part, blobs = None, []
    for b in batches:
        for p, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if p != part and blobs:
                yield blobs
                blobs = []
            part = p
            blobs.append(blob)
    if blobs:
        yield blobs


def merge_spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the half-open intervals of each document: ``doc, start, stop`` of the maximal runs."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    if not len(doc):
        return doc, start, stop
    new = np.concatenate(([True], doc[1:] != doc[:-1]))
    run = np.cumsum(new)  # a running maximum of the ends that starts anew in each document
    far = np.maximum.accumulate(stop + run * (1 << 40)) - run * (1 << 40)
    head = new.copy()
    head[1:] |= start[1:] > far[:-1]
    first = np.flatnonzero(head)
    return doc[first], start[first], far[np.concatenate((first[1:], [len(doc)])) - 1]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has a column called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def passing(docs: DataFrame, text_col: str, new: list[str]) -> tuple[DataFrame, list[str], str]:
    """``docs`` for a map over Arrow batches that returns its columns and then the columns ``new``.

    Columns get positional names with the text, as a string, last, so no name can clash.  An input column that is called like a
    new one is left out: the new one takes its name.  Also returns the kept names and their schema."""
    taken = {c.lower() for c in new}
    fields = [f for f in docs.schema.fields if f.name.lower() not in taken]
    own = docs.select(*[docs[f"`{f.name}`"].alias(f"c{i}") for i, f in enumerate(fields)],
                      docs[f"`{text_col}`"].cast("string").alias("t"))
    return own, [f.name for f in fields], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)


def packed_by_part(part: np.ndarray, columns: dict[str, pa.Array]) -> tuple[list[int], list[bytes]]:
    """One blob for each value of ``part``."""
    order = np.argsort(part, kind="stable")
    columns = {k: v.take(pa.array(order)) for k, v in columns.items()}
    own, heads = np.unique(part[order], return_index=True)
    return own.tolist(), [pack({k: v.slice(lo, hi - lo) for k, v in columns.items()})
                          for lo, hi in zip(heads, np.append(heads[1:], len(order)))]


def _row_key(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (b.column(0).is_null().to_numpy(zero_copy_only=False), b.column(0).fill_null(0).to_numpy(), b.column(1).to_numpy())


def map_with_spans(rows: DataFrame, spans: DataFrame, text_at: int, fn: Callable, schema: str) -> DataFrame:
    """``fn(batch, found)`` over the rows ``doc_id, mark, ...``; ``found`` has for each row the matching rows of
    ``spans`` (``doc_id, mark``, then whole numbers) as a matrix, or None.

    Both sides travel packed, compressed by map batch and part, because the rows carry whole texts.  Of a part, a task
    holds the spans and some 8 MB of rows."""
    n = shuffle_partitions(rows.sparkSession)
    parts = 4 * n

    def send(kind: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in byte_slices(batches, text_at, 16 << 20) if kind else batches:
                if b.num_rows:
                    _, ids, marks = _row_key(b)
                    part = (marks ^ (ids * 0x9E3779B9)) % parts
                    own, blobs = packed_by_part(part, dict(zip(b.schema.names, b.columns)))
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([kind] * len(own), pa.int32()),
                                                      pa.array(blobs, pa.binary())], ["part", "kind", "blob"])
        return run

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(found: dict, tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            for own in pa.concat_tables(tables).combine_chunks().to_batches():
                null, ids, marks = _row_key(own)
                yield fn(own, [found.get(k) for k in zip(null.tolist(), ids.tolist(), marks.tolist())])

        at, held, found, rows = None, [], {}, []
        for b in batches:
            for part, kind, blob in zip(*(c.to_pylist() for c in b.columns)):
                if part != at or sum(t.nbytes for t in rows) > 8 << 20:
                    if rows:
                        yield from flush(found, rows)
                    rows = []
                if part != at:
                    at, held, found = part, [], {}
                if kind == 0:
                    held.append(blob)
                    continue
                if held:
                    found, held = _found(held), []
                rows.append(unpack([blob]))
        if rows:
            yield from flush(found, rows)

    sent = spans.mapInArrow(tidied(send(0)), "part long, kind int, blob binary").unionAll(
        rows.mapInArrow(tidied(send(1)), "part long, kind int, blob binary"))
    return sent.repartition(n, "part").sortWithinPartitions("part", "kind").mapInArrow(tidied(apply), schema)


def _found(blobs: list[bytes]) -> dict[tuple, np.ndarray]:
    if not blobs:
        return {}
    b = unpack(blobs).to_batches()[0]
    null, ids, marks = _row_key(b)
    order = np.lexsort((marks, ids, null))
    null, ids, marks = null[order], ids[order], marks[order]
    values = np.stack([c.to_numpy() for c in b.columns[2:]], 1)[order]
    new = np.ones(len(order), bool)
    new[1:] = (null[1:] != null[:-1]) | (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    heads = np.flatnonzero(new)
    keys = zip(null[heads].tolist(), ids[heads].tolist(), marks[heads].tolist())
    return dict(zip(keys, np.split(values, heads[1:])))
