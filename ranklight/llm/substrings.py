"""Substring dedup over word windows through super-k-mers.

A window is ``window`` consecutive words of one document.  Its minimiser is the smallest hash among its
``gram``-word sequences.  Equal windows have equal minimisers, so a bucket (one minimiser) holds all
occurrences of each of its windows.  Consecutive windows with the same minimiser (a super-k-mer) travel to
their bucket as one packed string.  There the words become numbers and the windows are sorted by a hash of them; equal
neighbours are repeats, found by comparing the words themselves (where two different windows share a hash, the windows of
those buckets are sorted by exact names instead).  A task handles ``BUCKET_WORDS`` words of buckets at a time, one bucket at least.

* Super-k-mers bound for the same part (a range of buckets) are packed into one compressed row for each
  map batch, so the shuffle carries few rows.
* A count over all documents finds hot slots (slices of the minimiser space with far more than their share: a passage that a third
  of the documents contain).  There are at most ``4 * parts`` of them, so their list is small.  Their
  windows travel alone, under the whole window as key: an aggregate with map-side combine finds the first
  document and a join brings it back, whose skewed partitions AQE splits.
* Covered words come back as intervals for each document and are joined with the text once.

Null text counts as empty.  A document with a null id keeps all its words and removes none elsewhere.
Rows that repeat an id are judged by themselves; equal ids are not smaller than one another.  An empty table gives no row.
Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import by_part, byte_slices, map_with_spans, merge_spans, packed_by_part, passing, \
    shuffle_partitions, text_bytes, tidied, unpack
from ranklight.sources.scratch import materialize

WINDOW = 13
GRAM = 3
SLOTS = 1 << 16
HOT_ROWS = 500  # a slot below this many super-k-mers is never hot
LONGEST = 64    # windows in one super-k-mer
PART_ROWS = 200_000  # super-k-mers in a part, on average
BUCKET_WORDS = 1 << 19

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_ODD[0])
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (len(x) - width + 1 of them)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


class Superkmers:
    """Super-k-mers of a batch of documents, as arrays over all of its words."""

    def __init__(self, texts: list[bytes | None], window: int, gram: int):
        import xxhash

        self.words: list[bytes] = []
        size = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = (t or b"").split()
            size[i] = len(own)
            self.words += own
        n = len(self.words)
        doc_end = np.repeat(np.cumsum(size), size)
        doc = np.repeat(np.arange(len(texts)), size)
        self.doc_start = np.cumsum(size) - size
        valid = np.arange(n) + window <= doc_end
        at = np.flatnonzero(valid)
        if not len(at):
            self.first = self.count = self.doc = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        h = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, n)
        g = h[:n - gram + 1].copy()
        for i in range(1, gram):
            g = _mix(g) + h[i:n - gram + 1 + i]
        low = _sliding_min(_mix(g), window - gram + 1)[at]
        new = np.concatenate(([True], (low[1:] != low[:-1]) | (doc[at[1:]] != doc[at[:-1]])))
        run = np.flatnonzero(new)
        inside = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        heads = np.flatnonzero(inside % LONGEST == 0)  # a long run is cut into several
        self.first = at[heads]  # word index of the first window
        self.count = np.diff(np.append(heads, len(at)))  # windows
        self.doc = doc[self.first]
        self.key = low[heads]

    def slot(self) -> np.ndarray:
        return (self.key >> np.uint64(40)).astype(np.int64) % SLOTS

    def position(self) -> np.ndarray:
        return self.first - self.doc_start[self.doc]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, mark, text``: the mark tells apart rows that share an id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _mark(text).alias("mark"), text.alias("text"))


def _mark(text: Column) -> Column:
    """32 bits of the text's hash (it travels with every super-k-mer)."""
    return F.shiftright(F.xxhash64(text), 32)


def _slot_counts(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for b in byte_slices(batches, 0, 1 << 19):
            total += np.bincount(Superkmers(text_bytes(b, 0), window, gram).slot(), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    return rows.filter("doc_id is not null").select("text").mapInArrow(tidied(run), "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n"))


def _packed(rows: DataFrame, window: int, gram: int, parts: int, hot: frozenset[int]) -> DataFrame:
    """``part, blob`` for every map batch and part; super-k-mers of hot slots are left out."""
    hot_slots = np.array(sorted(hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 2, 4 << 20):  # packed together; the words as objects only of an eighth at a time
            held: list[dict] = []
            parts_of: list[np.ndarray] = []
            for x in byte_slices(iter([b]), 2, 1 << 19):
                s = Superkmers(text_bytes(x, 2), window, gram)
                use = np.flatnonzero(~np.isin(s.slot(), hot_slots))
                join, words = b" ".join, s.words
                text = pa.array([join(words[i:i + k]) for i, k in zip(s.first[use].tolist(), (s.count[use] + window - 1).tolist())],
                                pa.binary())
                ids, marks = (x.column(i).take(pa.array(s.doc[use])) for i in (0, 1))
                # any 32 bits of the minimiser will do: windows are compared as text
                held.append({"key": pa.array((s.key[use] >> np.uint64(20)).astype(np.uint32)), "doc_id": ids, "mark": marks.cast(pa.int32()),
                             "at": pa.array(s.position()[use].astype(np.int32)), "n": pa.array(s.count[use].astype(np.int32)), "text": text})
                parts_of.append((s.key[use] % np.uint64(parts)).astype(np.int64))
                del s, words, text
            if held:
                columns = {k: pa.concat_arrays([c[k] for c in held]) for k in held[0]}
                del held
                own, blobs = packed_by_part(np.concatenate(parts_of), columns)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"])

    return rows.filter("doc_id is not null").mapInArrow(tidied(run), "part long, blob binary")


def _bucket_spans(blobs: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Intervals of repeated windows in one part: ``doc_id, mark, start, stop``."""
    t = unpack(blobs)
    key, doc, at = (t.column(c).to_numpy() for c in ("key", "doc_id", "at"))
    mark = t.column("mark").to_numpy().astype(np.int64)
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    low, high = np.minimum.reduceat(doc[order], heads), np.maximum.reduceat(doc[order], heads)
    tails = np.append(heads[1:], len(order))
    text = t.column("text").combine_chunks()
    size = t.column("n").to_numpy() + window - 1  # words
    who, pos = [], []
    shared = np.flatnonzero(low < high)  # buckets that more than one document shares
    words = np.add.reduceat(size[order], heads)[shared] if len(shared) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(shared):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(words[lo:]), BUCKET_WORDS, side="right")))
        rows = np.concatenate([order[heads[g]:tails[g]] for g in shared[lo:hi]])
        r, p = _repeated_windows(text.take(pa.array(rows)).to_pylist(), size[rows], doc[rows], window)
        who.append(rows[r])
        pos.append(at[rows[r]] + p)
        lo = hi
    who = np.concatenate(who) if who else np.zeros(0, np.int64)
    pos = np.concatenate(pos).astype(np.int64) if len(who) else np.zeros(0, np.int64)
    if not len(who):
        return (np.zeros(0, np.int64),) * 4
    owner, own = np.unique(np.stack((doc[who], mark[who]), 1), axis=0, return_inverse=True)
    i, start, stop = merge_spans(own.reshape(-1), pos, pos + window)
    return owner[i, 0], owner[i, 1], start, stop


def _names(ids: np.ndarray, window: int) -> np.ndarray:
    """A number for the window at every position, equal exactly for equal windows: names of 1, 2, 4, ... words are put
    together as the binary digits of ``window`` say."""
    n = len(ids) - window + 1
    power, name, done, out = 1, ids.copy(), 0, np.zeros(n, np.int64)
    while done < window:
        if window & power:
            out = np.unique(out * (len(ids) + 1) + name[done:done + n], return_inverse=True)[1]
            done += power
        if done < window:
            name = np.unique(name[:-power] * (len(ids) + 1) + name[power:], return_inverse=True)[1]
            power *= 2
    return out


def _repeated_windows(texts: list[bytes], size: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a smaller document of the buckets has too, as the index of their super-k-mer and the place in it."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for t in texts for w in t.split(b" ")), np.int64, int(size.sum()))
    many = size - window + 1
    row = np.repeat(np.arange(len(size)), many)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = np.repeat(np.cumsum(size) - size, many) + inside
    mixed = _mix(ids.astype(np.uint64) + np.uint64(1))
    h = np.zeros(len(ids) - window + 1, np.uint64)
    for i in range(window):
        h = h * np.uint64(_ODD[1]) + mixed[i:i + len(h)]
    name, owner = h[start], doc[row]
    order = np.lexsort((owner, name))
    same = name[order][1:] == name[order][:-1]
    before, after = start[order][:-1][same], start[order][1:][same]
    if any((ids[before + i] != ids[after + i]).any() for i in range(window)):  # different windows under one hash
        name = _names(ids, window)[start]
        order = np.lexsort((owner, name))
        same = name[order][1:] == name[order][:-1]
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.repeat(owner[order][heads], np.diff(np.append(heads, len(order))))
    again = order[owner[order] > least]
    return row[again], inside[again]


def _hot_spans(rows: DataFrame, window: int, gram: int, hot: frozenset[int]) -> DataFrame:
    """Intervals of repeated windows in hot slots.  Inside a map batch, all but the first document of a window are known to
    repeat it; one row for each window and batch goes on to find out whether an earlier batch has it."""
    hot_slots = np.array(sorted(hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 2, 1 << 19):
            s = Superkmers(text_bytes(b, 2), window, gram)
            use = np.flatnonzero(np.isin(s.slot(), hot_slots))
            many = s.count[use]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            first = (np.repeat(s.first[use], many) + inside).tolist()
            where = np.repeat(s.position()[use], many) + inside
            words, join, seen = s.words, b" ".join, {}
            index = np.fromiter((seen.setdefault(join(words[i:i + window]), len(seen)) for i in first), np.int64, len(first))
            doc = np.repeat(s.doc[use], many)
            ids = b.column(0).take(pa.array(doc)).to_numpy()
            low = np.full(len(seen), np.iinfo(np.int64).max)
            np.minimum.at(low, index, ids)
            known = ids > low[index]
            text = pa.array(list(seen), pa.binary()).take(pa.array(index, mask=known))  # null: nothing left to find out
            yield pa.RecordBatch.from_arrays([text, pa.array(ids), b.column(1).take(pa.array(doc)), pa.array(where)],
                                             ["w", "doc_id", "mark", "start"])

    seen = materialize(rows.filter("doc_id is not null").mapInArrow(tidied(run), "w binary, doc_id long, mark long, start long"),
                       "substring-hot")
    open_ = seen.filter("w is not null")
    first = open_.groupBy("w").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    again = materialize(open_.join(first.select("w", "low"), "w").filter("doc_id > low").select("doc_id", "mark", "start"),
                        "substring-hot-repeats")
    return (seen.filter("w is null").select("doc_id", "mark", "start").unionAll(again)
            .select("doc_id", "mark", "start", (F.col("start") + window).alias("stop")))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, hot_rows: int = HOT_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """``doc_id, mark, start, stop``: word intervals covered by windows that also start in a document with
    a smaller id.  Intervals of a document may overlap.  ``mark`` is a hash of the row's text."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    slots = materialize(_slot_counts(rows, window, gram), "substring-slots")
    total = slots.agg(F.sum("n")).first()[0] or 0
    parts = max(4 * shuffle_partitions(spark), -(-total // part_rows))
    limit = max(hot_rows, total // (4 * parts))
    hot = frozenset(r[0] for r in slots.filter(F.col("n") > limit).select("slot").collect())  # 4 * parts at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in by_part(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _bucket_spans(blobs, window)],
                                             ["doc_id", "mark", "start", "stop"])

    spans = (_packed(rows, window, gram, parts, hot).repartition(shuffle_partitions(spark), "part")
             .sortWithinPartitions("part").mapInArrow(tidied(run), "doc_id long, mark long, start long, stop long"))
    return spans.unionAll(_hot_spans(rows, window, gram, hot)) if hot else spans


CUT_COLUMNS = ("n_words", "n_removed", "kept_sha256", "kept_text")


def cut_words(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              new: tuple[str, ...] = CUT_COLUMNS) -> DataFrame:
    """All columns of ``docs``, then ``n_words, n_removed, kept_sha256, kept_text`` under the names ``new`` (which
    replace columns of the same names).

    ``kept_text``: the kept words joined by one space; the text as it was if no word goes; null for null."""
    own, names, schema = passing(docs, text_col, list(new))
    text_at = next((i for i, c in enumerate(names) if c.lower() == text_col.lower()), None)
    t = F.col("t") if text_at is None else F.col(f"c{text_at}").cast("string")
    id_at = next(f"c{i}" for i, c in enumerate(names) if c.lower() == id_col.lower())
    rows = own.select(F.col(id_at).cast("long").alias("doc_id"), _mark(F.coalesce(t, F.lit(""))).alias("mark"),
                      *own.columns[:-1], *(["t"] if text_at is None else []))  # the text travels once
    at = 2 + (len(names) if text_at is None else text_at)

    def cut(b: pa.RecordBatch, found: list[np.ndarray | None]) -> pa.RecordBatch:
        out: list[tuple] = []
        for raw, spans in zip(b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist(), found):
            words = (raw or b"").split()
            kept = words
            if spans is not None:
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, spans[:, 0], 1)
                np.add.at(gone, spans[:, 1], -1)
                kept = [w for w, c in zip(words, np.cumsum(gone).tolist()) if not c]
            joined = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(),
                        joined.decode() if len(kept) < len(words) else raw.decode() if raw is not None else None))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        added = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays([*b.columns[2:2 + len(names)], *added], [*names, *new])

    kinds = ("long", "long", "string", "string")
    return map_with_spans(rows, spans, at, cut, schema + ", ".join(f"`{n}` {kind}" for n, kind in zip(new, kinds)))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          new: tuple[str, ...] = CUT_COLUMNS, **settings) -> DataFrame:
    """``cut_words`` over ``repeated_spans``."""
    return cut_words(docs, repeated_spans(docs, id_col, text_col, window, **settings), id_col, text_col, new)
