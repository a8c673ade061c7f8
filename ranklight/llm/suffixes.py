"""Exact substring dedup over bytes through suffix arrays of content-addressed shards.

A string is ``length`` consecutive bytes of one text.  A byte goes if some string that covers it starts anywhere
else as well (in the same text or in another).

1. The minimiser of a string is the leftmost smallest hash among its ``gram``-byte substrings, so equal strings have
   equal minimisers.  Consecutive strings with one minimiser form a run.  Runs whose minimiser occurs once in the
   corpus cannot hold a repeat; they stop here, as hashes, before any text moves.
2. The texts of the other runs travel to the shard of their minimiser.  Equal runs are merged in the map task
   first: of a passage that a third of the documents hold, each task sends one copy.
3. Runs of one minimiser that are all equal are settled by that. The other runs of a shard are joined into one byte string, and its suffix array is built by induced sorting: suffixes are
   classified, leftmost smaller (LMS) substrings are sorted and named, the names are ordered recursively
   (repeatedly renamed in pairs until all differ), and the order of all suffixes is induced from them in
   linear passes over the first bytes.
4. Permuted common prefixes: only irreducible values are compared, the others follow from their left
   neighbour.  A string repeats exactly if its suffix shares ``length`` bytes with a neighbour in the array.
5. A minimiser with over ``HOT_RUNS`` runs is hot: at the edges of a passage that many documents hold, each document has its
   own bytes in the run, so the runs all differ.  Their strings are dealt out by themselves, under a 128-bit BLAKE2 digest of
   all their bytes; equal ones are merged in the map task first.  So a suffix array has ``shard`` bytes or the
   runs of one minimiser that is not hot, and the holders of one string are one row for each map batch.
6. The covered intervals come back for each document and are joined with the text once.

Null text counts as empty.  Rows that repeat an id and text count as separate places.  A null id is an id
like any other.  An empty table gives no row.  Columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import by_part, byte_slices, map_with_spans, merge_spans, packed_by_part, \
    shuffle_partitions, text_bytes, tidied, unpack
from ranklight.sources.scratch import materialize

LENGTH = 200
GRAM = 64
CHUNK = 2 << 20       # bytes of text in one map batch (a longer text is a batch of its own, cut into segments)
SHARD = 4 << 20       # bytes in one suffix array, unless one minimiser has more
LONGEST = 400         # strings in one run
HOT_RUNS = 4000       # a minimiser with more runs is hot (about 1.3 MB of text)
HOT_KEYS = 1 << 20    # no more hot minimisers than this (8 MB in each task); beyond, the limit on runs rises
HOT_CHUNK = 500_000   # strings of hot runs that a task holds at once
HOT_PART = 1_000_000  # strings of hot runs in a part, before equal ones are merged
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 22) - 1


# ---- minimiser runs -------------------------------------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _segment_runs(data: np.ndarray, valid: np.ndarray, doc: np.ndarray, length: int, gram: int, powers):
    """Runs of one segment: first string, number of strings, minimiser hash."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * powers[1][:n - gram + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    low = (h & ~np.uint64(_MASK)) | np.arange(len(h), dtype=np.uint64)
    width, done = length - gram + 1, 1
    while done < width:
        step = min(done, width - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    place = (low & np.uint64(_MASK)).astype(np.int64)
    at = np.flatnonzero(valid[:len(place)])
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    p = place[at]
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]])))
    head = np.flatnonzero(new)
    inside = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    head = np.flatnonzero(inside % LONGEST == 0)
    return at[head], np.diff(np.append(head, len(at))), h[p[head]]


def runs(texts: list[bytes], length: int, gram: int, powers) -> dict[str, np.ndarray]:
    """``doc, at, n, key`` of all minimiser runs (``at``: byte offset in the document, ``n``: strings)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    doc = np.repeat(np.arange(len(texts)), size)
    valid = np.arange(len(data)) + length <= np.repeat(end, size)
    found = []
    for a in range(0, len(data), CHUNK):
        to = min(len(data), a + CHUNK + length - 1)
        if to - a < length:
            break
        ok = valid[a:to].copy()
        ok[CHUNK:] = False  # these strings belong to the next segment
        first, n, key = _segment_runs(data[a:to], ok, doc[a:to], length, gram, powers)
        found.append((first + a, n, key))
    first, n, key = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    own = doc[first] if len(first) else first
    return {"doc": own, "at": first - (end - size)[own] if len(first) else first, "n": n, "key": key.astype(np.uint64)}


def _blobs(part: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    own, blobs = packed_by_part(part, columns)
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _shared_runs(rows: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """``doc_id, mark, at, n, key`` of the runs whose minimiser occurs more than once."""
    def out(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        powers = _powers(CHUNK + length)
        for b in byte_slices(b, 2, CHUNK):
            r = runs(text_bytes(b, 2), length, gram, powers)
            _, index, count = np.unique(r["key"], return_inverse=True, return_counts=True)
            many = count[index] > 1  # known to repeat; only one of them travels to tell the others
            part = (r["key"] % np.uint64(parts)).astype(np.int64)
            first = np.zeros(len(index), bool)
            first[np.unique(index, return_index=True)[1]] = True
            spread = np.where(many, np.arange(len(part)) % parts, part)
            ids, marks = (b.column(i).take(pa.array(r["doc"])) for i in (0, 1))
            for use, kind, to in ((np.flatnonzero(many), 2, spread), (np.flatnonzero(~many), 0, part),
                                  (np.flatnonzero(many & first), 1, part)):
                if len(use):
                    take = pa.array(use)
                    yield _blobs(to[use], {"key": pa.array(r["key"][use]), "doc_id": ids.take(take), "mark": marks.take(take),
                                           "at": pa.array(r["at"][use]), "n": pa.array(r["n"][use].astype(np.int32)),
                                           "kind": pa.array(np.full(len(use), kind, np.int8))})

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in by_part(batches):
            t = unpack(blobs)
            kind = t.column("kind").to_numpy()
            key = t.column("key").to_numpy()
            vote = np.flatnonzero(kind < 2)
            _, index, count = np.unique(key[vote], return_inverse=True, return_counts=True)
            told = np.zeros(len(count), bool)
            told[index[kind[vote] == 1]] = True
            keep = np.concatenate((np.flatnonzero(kind == 2), vote[(kind[vote] == 0) & ((count > 1) | told)[index]]))
            t = t.take(pa.array(keep)).combine_chunks()
            for b in t.select(["doc_id", "mark", "at", "n", "key"]).to_batches():
                yield pa.RecordBatch.from_arrays([*b.columns[:4], b.column(4).cast(pa.uint64()).view(pa.int64())],
                                                 ["doc_id", "mark", "at", "n", "key"])

    n = shuffle_partitions(rows.sparkSession)
    return (rows.mapInArrow(tidied(out), "part long, blob binary").repartition(n, "part").sortWithinPartitions("part")
            .mapInArrow(tidied(back), "doc_id long, mark long, at long, n int, key long"))


# ---- suffix array ---------------------------------------------------------------------------------------------

def _deal(at: np.ndarray, by: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append ``at`` to the lists of its first bytes ``by``, in order."""
    if len(at):
        order = np.argsort(by, kind="stable")
        cuts = np.cumsum(np.bincount(by, minlength=256))
        at, start = at[order], 0
        for c in np.unique(by):
            into[c].append(at[start:cuts[c]])
            start = cuts[c]


def _join(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.int64)


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Order of all suffixes induced from an order of the LMS positions; bucket by bucket, in whole rounds."""
    n = len(t)
    seeds: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(lms, t[lms], seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]

    def before(at: np.ndarray, wanted: bool) -> np.ndarray:
        at = at[at > 0] - 1
        return at[smaller[at] == wanted]

    for c in range(256):  # larger-type suffixes, first bytes ascending
        done, now = [], _join(larger[c])
        while len(now):
            done.append(now)
            p = before(now, False)
            same = t[p] == c
            _deal(p[~same], t[p[~same]], larger)
            now = p[same]
        larger[c] = done
        p = before(_join(seeds[c]), False)
        _deal(p, t[p], larger)
    low: list[list[np.ndarray]] = [[] for _ in range(256)]
    low[0] = [np.array([n - 1])]
    for c in range(255, -1, -1):  # smaller-type suffixes, descending, each list from its right end
        done, now = [], _join(low[c])
        while len(now):
            done.append(now)
            p = before(now, True)
            same = t[p] == c
            _deal(p[~same], t[p[~same]], low)
            now = p[same]
        low[c] = done
        p = before(_join(larger[c])[::-1], True)
        _deal(p, t[p], low)
    return np.concatenate([x for c in range(256) for x in (_join(larger[c]), _join(low[c])[::-1])])


def _order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a name string: names are renamed in pairs until all differ."""
    rank, reach = names.astype(np.int64), 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-reach or None] = rank[reach:] + 1 if reach < len(rank) else 0
        pair = rank * (len(rank) + 2) + after
        order = np.argsort(pair, kind="stable")
        new = np.concatenate(([0], np.cumsum(pair[order][1:] != pair[order][:-1])))
        rank[order] = new
        reach *= 2
        if new[-1] == len(rank) - 1:
            return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of bytes that end with a single 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    step = t[1:].astype(np.int16) - t[:-1]
    nearest = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]  # the next place where the byte changes
    smaller = np.append(step[nearest] > 0, True)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induce(t, smaller, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    number = np.zeros(n, np.int64)  # where an LMS position stands in the text
    number[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], n - 1)
    a, b = order[:-1], order[1:]
    size_a, size_b = (ends[number[x]] - x for x in (a, b))
    equal = size_a == size_b
    active, off = np.flatnonzero(equal), 0
    while len(active):  # compare neighbours byte by byte, dropping pairs that differ or end
        differ = t[a[active] + off] != t[b[active] + off]
        equal[active[differ]] = False
        active = active[~differ & (size_a[active] > off)]
        off += 1
    name = np.concatenate(([0], np.cumsum(~equal)))
    names = np.zeros(len(lms), np.int64)
    names[number[order]] = name
    if name[-1] < len(lms) - 1:
        order = lms[_order_names(names)]
    return _induce(t, smaller, order)


def common_prefixes(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position, its left neighbour in the suffix array and their common prefix length."""
    n = len(t)
    left = np.full(n, -1, np.int64)
    left[order[1:]] = order[:-1]
    at = np.arange(n)
    follows = np.zeros(n, bool)  # its value is that of the position before, less one
    ok = (at > 0) & (left > 0)
    follows[ok] = t[at[ok] - 1] == t[left[ok] - 1]
    own = np.flatnonzero(~follows & (left >= 0))
    padded = np.concatenate((t, np.zeros(16, np.uint8)))
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
    value, active, off = np.zeros(n, np.int64), own, 0
    while len(active):
        i, j = active + off, left[active] + off
        x = words[np.minimum(i, n)] ^ words[np.minimum(j, n)]
        differ = x != 0
        tail = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
        value[active[differ]] = off + tail[differ]
        active = active[~differ]
        off += 8
    source = np.maximum.accumulate(np.where(~follows, at, 0))
    return left, np.where(left >= 0, value[source] - (at - source), 0)


def repeated(texts: list[bytes], known: np.ndarray, length: int) -> list[np.ndarray]:
    """For each of the distinct ``texts``, which of its strings also start elsewhere; ``known`` texts stand
    for several equal ones."""
    t = np.frombuffer(b"\x01".join(texts) + b"\x01", np.uint8).copy()
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size + 1) - size - 1
    rest = np.repeat(start + size, size + 1) - np.arange(len(t))  # bytes left of the own text
    text_byte = rest > 0
    t[text_byte] += 2  # UTF-8 has no byte over 0xF4; 1 separates, 0 ends
    t = np.append(t, np.uint8(0))
    left, shared = common_prefixes(t, suffix_array(t))
    hit = np.flatnonzero((np.minimum(shared[:-1], rest) >= length) & text_byte)
    flag = np.zeros(len(t), bool)
    flag[hit] = True
    flag[left[hit]] = True
    return [np.ones(n - length + 1, bool) if k else flag[s:s + n - length + 1] for s, n, k in zip(start, size, known)]


# ---- shards ---------------------------------------------------------------------------------------------------

def _hot_keys(shared: DataFrame, limit: int) -> tuple[np.ndarray, int]:
    """The minimisers with more than ``limit`` runs, ascending (``HOT_KEYS`` at most), and the strings of those runs."""
    limit = max(limit, shared.count() // HOT_KEYS)
    hot = shared.groupBy("key").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("n")).filter(F.col("runs") > limit).toPandas()
    return np.sort(hot["key"].to_numpy(np.int64)), int(hot["n"].sum())


def _equal_digests(digest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first row of each distinct digest (two words a row), each row's digest number, and the rows of each digest."""
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    ranked = digest[order]
    new = np.concatenate(([True], (ranked[1:] != ranked[:-1]).any(axis=1)))
    index = np.empty(len(order), np.int64)
    index[order] = np.cumsum(new) - 1
    return order[new], index, np.bincount(index)


def _hot_strings(texts: list[bytes], many: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Strings of distinct runs, about ``HOT_CHUNK`` at a time: the run, the place in it, the digest, whether to send it (one of
    several equal ones), and whether it is known to repeat.  ``many`` runs occur more than once themselves."""
    n = np.fromiter((len(x) - length + 1 for x in texts), np.int64, len(texts))
    for own in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // HOT_CHUNK)) + 1):
        run = np.repeat(own, n[own])
        off = np.arange(len(run)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        digest = np.frombuffer(b"".join(hashlib.blake2b(texts[r][i:i + length], digest_size=16).digest()
                                        for r, i in zip(run.tolist(), off.tolist())), np.int64).reshape(-1, 2)
        first, index, count = _equal_digests(digest)
        told = count > 1
        told[index[many[run]]] = True
        send = np.zeros(len(run), bool)
        send[first] = True
        yield run, off, digest, send, told[index]


def _hot_spans(t: pa.Table, length: int) -> pa.RecordBatch:
    """Intervals of the strings of one part whose digest comes from several map batches."""
    _, index, count = _equal_digests(np.stack([t.column(c).to_numpy() for c in ("d0", "d1")], 1))
    told = t.column("told").to_numpy() > 0
    hit = np.flatnonzero(~told & (count > 1)[index])
    take, at = pa.array(hit), t.column("at").to_numpy()[hit]
    return pa.RecordBatch.from_arrays([t.column(c).combine_chunks().take(take) for c in ("doc_id", "mark")]
                                      + [pa.array(at), pa.array(at + length)], ["doc_id", "mark", "start", "stop"])


def _run_texts(rows: DataFrame, shared: DataFrame, length: int, parts: int, hot: np.ndarray, hot_parts: int) -> DataFrame:
    """``part, blob, strings`` with the texts of the runs and the digests of ``hot`` runs' strings; intervals of strings
    that repeat inside a map batch are known at once and travel as blobs of negative parts."""
    hot_keys = rows.sparkSession.sparkContext.broadcast(hot)

    def out(b: pa.RecordBatch, found: list[np.ndarray | None]) -> pa.RecordBatch:
        texts, own, of = text_bytes(b, 2), [], []
        for d, r in enumerate(found):
            if r is not None:  # a repeated row (same id and text) lists its runs once for each copy
                of.append(np.full(len(r), d))
                own.append(r)
        if not own:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] + [pa.array([], pa.binary())] * 2, names)
        doc, (at, n, key) = np.concatenate(of), np.concatenate(own).T
        own = [texts[d][s:s + k + length - 1] for d, s, k in zip(doc.tolist(), at.tolist(), n.tolist())]
        seen: dict[bytes, int] = {}
        index = np.fromiter((seen.setdefault(x, len(seen)) for x in own), np.int64, len(own))
        count = np.bincount(index, minlength=len(seen))
        send = np.unique(index, return_index=True)[1]
        ids, marks = (b.column(i).take(pa.array(doc)) for i in (0, 1))
        is_hot = np.isin(key[send], hot_keys.value)
        hot_runs, send = send[is_hot], send[~is_hot]
        k = pa.array(send)
        part = (np.ascontiguousarray(key).view(np.uint64)[send] % np.uint64(parts)).astype(np.int64)
        blobs = dict(zip(*packed_by_part(part, {
            "key": pa.array(key[send]), "doc_id": ids.take(k), "mark": marks.take(k), "at": pa.array(at[send]),
            "many": pa.array(count[index[send]] > 1), "text": pa.array([own[i] for i in send], pa.binary())})))
        sent, after = [], 0

        def known(who: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
            nonlocal after
            if len(who):
                k, part = pa.array(who), after + np.arange(len(who)) // 50_000
                after = int(part[-1]) + 1
                sent.extend((p, blob, None) for p, blob in zip(*packed_by_part(-1 - part, {
                    "doc_id": ids.take(k), "mark": marks.take(k), "start": pa.array(start), "stop": pa.array(stop)})))

        sure = np.flatnonzero(count[index] > 1)
        known(sure, at[sure], at[sure] + n[sure] + length - 1)
        many = count[index[hot_runs]] > 1
        for run, off, digest, first, told in _hot_strings([own[i] for i in hot_runs], many, length) if len(hot_runs) else ():
            use = np.flatnonzero(first)
            who, said = hot_runs[run[use]], told[use]
            k = pa.array(who, mask=said)  # where a string repeats is known: only its digest travels
            part = (digest[use, 0].view(np.uint64) % np.uint64(hot_parts)).astype(np.int64)
            sent.extend((p, blobs.pop(p, None), strings) for p, strings in zip(*packed_by_part(part, {
                "d0": pa.array(digest[use, 0]), "d1": pa.array(digest[use, 1]), "told": pa.array(said.astype(np.int8)),
                "doc_id": ids.take(k), "mark": marks.take(k), "at": pa.array(np.where(said, 0, at[who] + off[use]))})))
            use = np.flatnonzero(told & ~many[run])  # the others are sure as whole runs
            who, start = hot_runs[run[use]], at[hot_runs[run[use]]] + off[use]
            known(*merge_spans(who, start, start + length))
        sent.extend((p, blob, None) for p, blob in blobs.items())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*sent), (pa.int64(), pa.binary(), pa.binary()))],
                                          names)

    names = ["part", "blob", "strings"]
    runs = shared.select("doc_id", "mark", "at", F.col("n").cast("long"), "key")
    return map_with_spans(rows, runs, 2, out, "part long, blob binary, strings binary")


def _shard_spans(blobs: list[bytes], length: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Intervals of repeated strings in one part.

    Equal strings share their minimiser, so only runs of one minimiser have to be compared, and a minimiser
    whose runs are all equal needs no comparison.  The others go into suffix arrays of about ``shard`` bytes, whole
    minimisers each."""
    t = unpack(blobs)
    t = t.take(pa.array(np.argsort(t.column("key").to_numpy(), kind="stable"))).combine_chunks()
    key, at, many = (t.column(c).to_numpy() for c in ("key", "at", "many"))
    size = pc.binary_length(t.column("text")).to_numpy().astype(np.int64)
    seen: dict[bytes, int] = {}
    index = np.fromiter((seen.setdefault(x, len(seen)) for x in t.column("text").to_pylist()), np.int64, len(key))
    known = np.bincount(index, weights=1.0 + many, minlength=len(seen)) > 1  # the run itself occurs again
    first = np.unique(index, return_index=True)[1]
    texts, of_key = list(seen), key[first]  # ascending by key, as their rows are
    head = np.flatnonzero(np.concatenate(([True], of_key[1:] != of_key[:-1])))
    tail = np.append(head[1:], len(texts))
    lone = np.repeat(tail - head == 1, tail - head)
    whole = np.flatnonzero((lone & known)[index])

    def spans(who: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        take = pa.array(who)
        return pa.RecordBatch.from_arrays([t.column("doc_id").chunk(0).take(take), t.column("mark").chunk(0).take(take),
                                           pa.array(start), pa.array(stop)], ["doc_id", "mark", "start", "stop"])

    if len(whole):
        yield spans(whole, at[whole], at[whole] + size[whole])
    rows = np.argsort(index, kind="stable")  # rows of each distinct run
    row_head = np.searchsorted(index[rows], np.arange(len(texts) + 1))
    head, tail = head[tail - head > 1], tail[tail - head > 1]
    total = np.cumsum([sum(map(len, texts[i:j])) for i, j in zip(head, tail)])
    lo = 0
    while lo < len(head):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + shard, side="right")))
        own = np.concatenate([np.arange(i, j) for i, j in zip(head[lo:hi], tail[lo:hi])])
        lo = hi
        who, start = [], []
        for i, f in zip(own.tolist(), repeated([texts[i] for i in own], known[own], length)):
            hits = np.flatnonzero(f)
            for r in rows[row_head[i]:row_head[i + 1]].tolist() if len(hits) else ():
                who.append(np.full(len(hits), r))
                start.append(hits + at[r])
        if who:
            who, start = np.concatenate(who), np.concatenate(start)
            yield spans(*merge_spans(who, start, start + length))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, shard: int = SHARD, hot_runs: int | None = None) -> DataFrame:
    """``doc_id, mark, start, stop``: byte intervals covered by strings that start elsewhere as well."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    n = shuffle_partitions(spark)
    parts = 4 * n
    shared = materialize(_shared_runs(rows, length, gram, parts), "suffix-runs")
    hot, strings = _hot_keys(shared, HOT_RUNS if hot_runs is None else hot_runs)
    hot_parts = min(parts, 1 + strings // HOT_PART)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parted():
            for b in batches:
                negative = np.flatnonzero(b.column(0).to_numpy() < 0)
                for blob in b.column(1).take(pa.array(negative)).to_pylist():
                    ready.extend(unpack([blob]).select(["doc_id", "mark", "start", "stop"]).to_batches())
                b = b.take(pa.array(np.flatnonzero(b.column(0).to_numpy() >= 0)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays(b.columns[1:], ["runs", "strings"])],
                                                 ["part", "blob"])

        ready: list[pa.RecordBatch] = []
        for blobs in by_part(parted()):
            yield from ready
            ready.clear()
            if strings := [x["strings"] for x in blobs if x["strings"] is not None]:
                yield _hot_spans(unpack(strings), length)
            if texts := [x["runs"] for x in blobs if x["runs"] is not None]:
                yield from _shard_spans(texts, length, shard)
        yield from ready

    return (_run_texts(rows, shared, length, parts, hot, hot_parts).repartition(n, "part").sortWithinPartitions("part")
            .mapInArrow(tidied(back), "doc_id long, mark long, start long, stop long"))


def cut_bytes(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, and ``kept`` (the remaining bytes: a cut
    may split a character) if ``with_text``."""
    def cut(b: pa.RecordBatch, found: list[np.ndarray | None]) -> pa.RecordBatch:
        out = []
        for raw, s in zip(text_bytes(b, 2), found):
            kept, n = raw, 0
            if s is not None:
                _, start, stop = merge_spans(np.zeros(len(s), np.int64), s[:, 0], s[:, 1])
                edges = [0, *np.stack((start, stop), 1).ravel().tolist(), len(raw)]
                kept, n = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2])), len(start)
            out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_text
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)

    return map_with_spans(_rows(docs, id_col, text_col), spans, 2, cut,
                          "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          with_text: bool = True, **settings) -> DataFrame:
    """``cut_bytes`` over ``repeated_spans``."""
    return cut_bytes(docs, repeated_spans(docs, id_col, text_col, length, **settings), id_col, text_col, with_text)
