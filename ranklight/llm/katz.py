"""Katz back-off language model: Good-Turing discounted bigram and unigram counts.

    P(w | h) = d(c(h, w)) c(h, w) / c(h)    if c(h, w) > 0
             = a(h) P(w)                    otherwise
    P(w)     = d(c(w)) c(w) / N             if c(w) > 0, else the mass that discounting leaves

``d(r)`` is Katz's Good-Turing discount for r <= ``CUT`` (1 above, and 1 where the count of counts gives no value
in (0, 1]).  ``a(h)`` is normalised exactly: the mass left by the discounts of h over the mass that the
unigrams give to words unseen after h.  A context whose counts leave no mass keeps c(h) / (c(h) + 1) for
its seen words.  A context without counts backs off with weight 1.  All unknown words are one event.

How it runs:

1. Unigram counts: each map batch sends its distinct words with their counts to the part of the word.
2. Bigrams: each map batch sends its distinct (word, context) pairs, their training counts and the documents in which they stand
   to the part of the word.  There the pair counts and the word's own count meet; the result is a table
   whose rows are keyed by the part of the context.
3. At the context's part everything that its back-off weight needs is at hand.  Scores go back to the documents as partial sums.

Counts are over all training documents, scores over all documents, whole texts.  Pairs travel as (pair, document,
occurrences).  Words and contexts whose count passes a quarter of a part are hot (at most ``HOT`` of them, however many parts
there are): their pairs are spread over all parts, and each task sends one vector of their totals, which are added in groups and
broadcast.  A pair that is as frequent itself does not travel: its occurrences stay with the documents, each task sends its
counts in the same vector, and its scores are added where the documents' sums meet.  Such pairs are found in the unigram
pass: one that is twice as frequent as a hot pair needs to be in all must be frequent enough in batches that hold half of it.  Pairs are
keyed by 64-bit word hashes; the most frequent words travel as short numbers instead (a fixed-size table that changes no result).

Null text counts as empty: one token, the end.  Repeated rows count and are scored as rows of their own.  A row
with a null id is in training.  An empty table gives no row.  Columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import Shared, by_part, byte_slices, crc_mod, shuffle_partitions, text_bytes, tidied
from ranklight.sources.scratch import materialize

CUT = 5
FREQUENT = 1 << 16
HOT = 4096
END, START = b"", np.uint64(1 << 62)
_RARE = np.uint64(1 << 63)
PACKED = "part long, kind int, blob binary"


def squeeze(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one blob: each compressed byte plane by byte plane."""
    out, codec = {}, pa.Codec("zstd", compression_level=5)
    for name, a in arrays.items():
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        out[name] = a.dtype.str, len(a), codec.compress(planes, asbytes=True) if len(a) else b""
    return pickle.dumps(out)


def expand(blob: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, (kind, n, data) in pickle.loads(blob).items():
        size = np.dtype(kind).itemsize
        raw = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
        out[name] = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()
    return out


def _stack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    own = [expand(b) for b in blobs]
    return {k: np.concatenate([x[k] for x in own]) for k in own[0]}


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that are written by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token, of the token before it, and the index of its document."""
    import xxhash

    end = xxhash.xxh64_intdigest(END)
    own = [np.fromiter(chain(map(xxhash.xxh64_intdigest, (t or b"").lower().split()), (end,)), np.uint64) for t in texts]
    size = np.fromiter(map(len, own), np.int64, len(own))
    last = np.cumsum(size) - 1
    token = np.concatenate(own) if own else np.zeros(0, np.uint64)
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[last - size + 1] = START
    return token, before, np.repeat(np.arange(len(own)), size)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the first one first) and the heads of the equal groups in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _mix(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    x = (w ^ (h * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class GoodTuring:
    """Discounts from counts of counts ``n[1..CUT + 1]`` (``n[0]`` is not used)."""

    def __init__(self, n: np.ndarray):
        self.d = np.ones(CUT + 1)
        if n[1] > 0:
            rest = (CUT + 1) * n[CUT + 1] / n[1]
            for r in range(1, CUT + 1):
                if n[r] > 0 and rest < 1:
                    d = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
                    self.d[r] = d if 0 < d <= 1 else 1.0

    def discounted(self, count: np.ndarray) -> np.ndarray:
        return count * np.where(count <= CUT, self.d[np.minimum(count, CUT)], 1.0)


def _histogram(count: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(count, CUT + 2), minlength=CUT + 3)[:CUT + 2]


def _shuffled(packed: DataFrame, parts: int) -> DataFrame:
    """A task gets about four parts, one after the other: it holds a quarter of what it reads."""
    return packed.select("part", "blob").repartition(max(1, parts // 4), "part").sortWithinPartitions("part")


def _by_part(part: np.ndarray, arrays: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Arrays (already sorted by part) cut at the parts."""
    own, heads = np.unique(part, return_index=True)
    for p, lo, hi in zip(own.tolist(), heads, np.append(heads[1:], len(part))):
        yield p, {k: v[lo:hi] for k, v in arrays.items()}


def _packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
                                      ["part", "kind", "blob"])


# ---- counts ---------------------------------------------------------------------------------------------------

def _unigrams(rows: DataFrame, parts: int) -> DataFrame:
    """Table ``tokens, types, counts, top, pairs``: totals and most frequent words of each part, and the pairs that batches
    found frequent.  (The counts of all words meet again with their pairs.)"""
    most = max(4 * FREQUENT // parts, min(4 * parts, HOT))
    shares = 2 * min(4 * parts, HOT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 0):
            token, before, _ = _tokens(text_bytes(b, 0))
            word, at, n = np.unique(token, return_inverse=True, return_counts=True)
            part = (word % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            out = [(p, 0, squeeze(x)) for p, x in _by_part(
                part[order], {"w": word[order], "n": n[order].astype(np.int32)})]
            pairs = _frequent_pairs(word, at, n, before, 1 + len(token) // shares)
            pair_part = (_mix(pairs["w"], pairs["h"]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(pair_part, kind="stable")
            out += [(p, 1, squeeze(x)) for p, x in _by_part(pair_part[order], {k: v[order] for k, v in pairs.items()})]
            yield _packed(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def most_of(held: list[dict], by: list[str], limit: int) -> tuple[np.ndarray, list[dict]]:
            t = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
            order, heads = _groups(*(t[k] for k in by))
            c = np.add.reduceat(t["n"][order].astype(np.int64), heads) if len(order) else np.zeros(0, np.int64)
            top = np.argsort(-c, kind="stable")[:limit]
            keys = [t[k][order][heads][top].view(np.int64).tolist() for k in by]
            return c, [dict(zip([*by, "c"], row)) for row in zip(*keys, c[top].tolist())]

        for blobs in by_part(batches):
            own = [expand(b) for b in blobs]
            none = {"w": np.zeros(0, np.uint64), "n": np.zeros(0, np.int32)}
            c, top = most_of([x for x in own if "h" not in x] or [none], ["w"], most)
            _, pairs = most_of([x for x in own if "h" in x] or [none | {"h": none["w"]}], ["w", "h"], min(4 * parts, HOT))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c.sum())]), pa.array([len(c)]), pa.array([_histogram(c).tolist()], pa.list_(pa.int64())),
                 pa.array([top], pa.list_(pa.struct([("w", pa.int64()), ("c", pa.int64())]))),
                 pa.array([pairs], pa.list_(pa.struct([("w", pa.int64()), ("h", pa.int64()), ("c", pa.int64())])))],
                ["tokens", "types", "counts", "top", "pairs"])

    sent = rows.filter("train").select("text").mapInArrow(tidied(send), PACKED)
    return materialize(_shuffled(sent, parts).mapInArrow(
        tidied(add), "tokens long, types long, counts array<long>, top array<struct<w: long, c: long>>, "
                     "pairs array<struct<w: long, h: long, c: long>>"), "katz-unigrams")


def _frequent_pairs(word: np.ndarray, at: np.ndarray, n: np.ndarray, before: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """The pairs that occur at least ``least`` times in a batch, with their counts.  ``at`` numbers the distinct words of the
    tokens, ``n`` counts them."""
    some = np.flatnonzero(n >= least)  # both words of such a pair are as frequent
    index = np.full(len(word) + 1, -1)
    index[some] = np.arange(len(some))
    first = before == START
    own, last = index[at], np.empty(len(at), np.int64)
    last[1:] = own[:-1]
    last[first] = len(some)  # the start is a context as well
    key = (last * (len(some) + 1) + own)[(own >= 0) & (last >= 0)]
    count = np.bincount(key, minlength=1)
    found = np.flatnonzero(count >= least)
    h, w = found // (len(some) + 1), found % (len(some) + 1)
    return {"w": word[some][w] if len(found) else np.zeros(0, np.uint64),
            "h": np.append(word[some], START)[h] if len(found) else np.zeros(0, np.uint64), "n": count[found].astype(np.int32)}


class Words:
    """What every task knows of the unigrams: totals, discounts and the most frequent words."""

    def __init__(self, tokens: int, types: int, counts: np.ndarray, word: np.ndarray, count: np.ndarray, parts: int,
                 pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = ()):
        self.tokens, self.types, self.parts = tokens, types, parts
        self.tasks = max(1, parts // 4)  # parts of contexts and of documents
        self.turing = GoodTuring(counts)
        seen = np.arange(CUT + 1)
        left = float((counts[:CUT + 1] * seen * (1 - self.turing.d)).sum())
        self.scale = 1.0 / (tokens if left > 0 else tokens + 1)
        self.unknown = (left if left > 0 else 1.0) * self.scale
        order = np.argsort(word)
        self.word, self.count = word[order], count[order]
        least = tokens // min(4 * parts, HOT)
        self.hot_count = self.count[self.count > least]
        code = self.code(self.word[self.count > least])
        order = np.argsort(code)
        self.hot_count = np.append(self.hot_count[order], 0)
        self.hot = np.append(code[order], START)  # every document has the start context; codes of words may be greater
        order = np.argsort(self.hot)
        self.hot, self.hot_count = self.hot[order], self.hot_count[order]
        own = [(self.index(self.code(w)), self.index(self.code(h))) for w, h, c in pairs if len(c)]
        keys = np.concatenate([np.where((w >= 0) & (h >= 0), h * len(self.hot) + w, -1)[c > least] for (w, h), (_, _, c) in zip(own, pairs)]) \
            if own else np.zeros(0, np.int64)
        self.pairs = np.unique(keys[keys >= 0])  # hot pairs, as context * number of hot words + word

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.turing.discounted(count) * self.scale, self.unknown)

    def code(self, word: np.ndarray) -> np.ndarray:
        """Frequent words as small numbers, others by their hash."""
        at = np.searchsorted(self.word, word)
        known = np.zeros(len(word), bool)
        inside = at < len(self.word)
        known[inside] = self.word[at[inside]] == word[inside]
        return np.where(known, at.astype(np.uint64), np.where(word == START, START, word | _RARE))

    def index(self, code: np.ndarray) -> np.ndarray:
        """Number among the hot words (the start counts as one), or -1."""
        at = np.minimum(np.searchsorted(self.hot, code), len(self.hot) - 1)
        return np.where(self.hot[at] == code, at, -1)

    def is_hot(self, code: np.ndarray) -> np.ndarray:
        return self.index(code) >= 0

    def pair_index(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Number among the hot pairs, or -1."""
        if not len(self.pairs):
            return np.full(len(word), -1)
        w, h = self.index(word), self.index(context)
        key = np.where((w >= 0) & (h >= 0), h * len(self.hot) + w, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, -1)


def _words(unigrams: DataFrame, parts: int) -> Words:
    totals = unigrams.agg(F.sum("tokens"), F.sum("types"), *[F.sum(F.col("counts")[i]) for i in range(CUT + 2)]).first()
    top = (unigrams.select(F.explode("top").alias("t")).select("t.w", "t.c").orderBy(F.col("c").desc(), "w")
           .limit(FREQUENT).toPandas())
    pairs = (unigrams.select(F.explode("pairs").alias("t")).select("t.w", "t.h", "t.c").orderBy(F.col("c").desc(), "w", "h")
             .limit(HOT).toPandas())
    own = tuple(pairs[k].to_numpy(np.int64) for k in "whc")
    return Words(totals[0] or 0, totals[1] or 0, np.array([x or 0 for x in totals[2:]], float),
                 top["w"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), parts,
                 [(own[0].view(np.uint64), own[1].view(np.uint64), own[2])])


# ---- bigrams --------------------------------------------------------------------------------------------------

DOCUMENT, PAIRS, SUMS, TOTALS = range(4)  # kinds of packed rows
TABLE = 2 + CUT  # of a context: sum of counts, unigram mass of its words, counts of counts up to CUT


def _send_pairs(rows: DataFrame, words) -> DataFrame:
    """Distinct pairs of each map batch, to the part of the word; documents, to the part of their batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        w, task = words.load(), TaskContext.get().partitionId()
        batch = task << 20
        parts = np.uint64(w.parts)
        counts = np.zeros(len(w.pairs), np.int64)
        for b in byte_slices(batches, 2, 6 << 20):
            token, before, doc = _tokens(text_bytes(b, 2))
            word, context = w.code(token), w.code(before)
            train = b.column(1).to_numpy(zero_copy_only=False)
            number = w.pair_index(word, context)
            hot = np.flatnonzero(number >= 0)
            stays, k = np.unique(doc[hot] * max(1, len(w.pairs)) + number[hot], return_counts=True)
            stays_doc, stays_pair = np.divmod(stays, max(1, len(w.pairs)))
            counts += np.bincount(stays_pair, weights=k * train[stays_doc], minlength=len(counts)).astype(np.int64)
            if len(hot):
                rest = number < 0
                word, context, doc = word[rest], context[rest], doc[rest]
            part = (np.where(w.is_hot(word), _mix(word, context), word) % parts).astype(np.int64)
            order, heads = _groups(part, word, context)
            new = np.zeros(len(order), bool)  # within a pair the tokens are in document order
            new[heads] = True
            new[1:] |= doc[order][1:] != doc[order][:-1]
            entry = np.flatnonzero(new)
            k_entry = np.diff(np.append(entry, len(order)))
            docs = doc[order][entry]
            size = np.diff(np.append(np.searchsorted(entry, heads), len(entry)))
            pair = np.repeat(np.arange(len(heads)), size)
            n = np.bincount(pair, weights=k_entry * train[docs], minlength=len(heads)).astype(np.int32)
            ends = np.cumsum(size)
            out = []
            for p, x in _by_part(part[order][heads], {"w": word[order][heads], "h": context[order][heads], "n": n,
                                                      "m": size.astype(np.int32), "at": np.arange(len(heads))}):
                at = x.pop("at")
                own = slice(ends[at[0] - 1] if at[0] else 0, ends[at[-1]])
                out.append((p, PAIRS, squeeze(x | {"row": docs[own] + (batch << 20), "k": k_entry[own].astype(np.int32)})))
            ids = b.column(0)
            out.append((batch % w.tasks, DOCUMENT, squeeze({
                "row": np.arange(b.num_rows) + (batch << 20), "null": ids.is_null().to_numpy(zero_copy_only=False),
                "id": ids.fill_null(0).to_numpy(), "train": train, "pair_row": stays_doc + (batch << 20),
                "pair": stays_pair.astype(np.int32), "pair_k": k.astype(np.int32)})))
            batch += 1
            yield _packed(out)
        if counts.any():
            yield _packed([(task % w.tasks, TOTALS, squeeze({"v": np.concatenate((np.zeros(_size(w)), counts))}))])

    return rows.mapInArrow(tidied(run), PACKED)


def _size(w: Words) -> int:
    """Numbers a task sends besides the counts of hot pairs: counts of counts, then ``TABLE`` for each hot context."""
    return CUT + 2 + TABLE * len(w.hot)


class _Sums:
    """Sums of each document over the parts of a task."""

    def __init__(self):
        self.held: list[dict[str, np.ndarray]] = []

    def add(self, rows: np.ndarray, **values: np.ndarray) -> None:
        row, index = np.unique(rows, return_inverse=True)
        self.held.append({"row": row} | {k: np.bincount(index, weights=v, minlength=len(row)) for k, v in values.items()})

    def packed(self, parts: int) -> list[tuple[int, int, bytes]]:
        """To the part of the document's batch."""
        if not self.held:
            return []
        if len(self.held) > 1:
            whole = {k: np.concatenate([x[k] for x in self.held]) for k in self.held[0]}
            self.held = []
            self.add(whole.pop("row"), **whole)
        data = self.held.pop()
        part = (data["row"] >> 20) % parts
        order = np.argsort(part, kind="stable")
        data = {k: v[order].astype(np.int32) if k in ("tokens", "known") else v[order] for k, v in data.items()}
        return [(p, SUMS, squeeze(x)) for p, x in _by_part(part[order], data)]


def _pair_counter(words):
    """At the word's part: exact pair counts.  Rows out: pairs to their context's part, sums to the
    documents, and totals (counts of counts, and what hot contexts need)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        w = words.load()
        sums, totals = _Sums(), np.zeros(_size(w) + len(w.pairs))
        for blobs in by_part(batches):
            t = _stack(blobs)
            order, heads = _groups(t["w"], t["h"])
            c = np.add.reduceat(t["n"][order].astype(np.int64), heads)
            word, context = t["w"][order][heads], t["h"][order][heads]
            new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            own = np.repeat(np.add.reduceat(c, new), np.diff(np.append(new, len(word))))  # the word's count
            at = w.index(word)  # a hot word's pairs lie in many parts
            own = np.where(at >= 0, w.hot_count[at], own)
            p = w.probability(own)
            # rows of the documents, in the order of the pairs
            m = t["m"].astype(np.int64)
            begin = np.cumsum(m) - m
            size = m[order]
            take = np.repeat(begin[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            row, k = t["row"][take], t["k"][take]
            pair = np.repeat(np.cumsum(np.isin(np.arange(len(order)), heads)) - 1, size)
            count = np.bincount(pair, minlength=len(heads))
            sums.add(row, tokens=k, known=k * (own[pair] > 0),
                     base=k * np.log10((own[pair] + 1) / (w.tokens + w.types + 1)),
                     score=k * np.where(c[pair] > 0, 0.0, np.log10(p[pair])))
            out = []
            spread = np.where(w.is_hot(context), _mix(context, word), context) % np.uint64(w.tasks)
            far = np.argsort(spread, kind="stable")
            starts = np.cumsum(count) - count
            n = count[far]
            take = np.repeat(starts[far] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows_far, k_far = row[take], k[take]
            ends = np.cumsum(n)
            for to, x in _by_part(spread[far].astype(np.int64), {
                    "h": context[far], "c": c[far].astype(np.int32), "p": np.where(c > 0, p, 0.0)[far], "m": n.astype(np.int32),
                    "at": np.arange(len(far))}):
                at = x.pop("at")
                span = slice(ends[at[0] - 1] if at[0] else 0, ends[at[-1]])
                out.append((to, PAIRS, squeeze(x | {"row": rows_far[span], "k": k_far[span]})))
            totals[:CUT + 2] += _histogram(c)
            at = w.index(context)
            hot = (at >= 0) & (c > 0)
            _add_table(totals[CUT + 2:_size(w)].reshape(TABLE, -1), at[hot], c[hot], p[hot])
            del t, row, rows_far, k, k_far, pair, take, order
            yield _packed(out)
        yield _packed(sums.packed(w.tasks) + [(TaskContext.get().partitionId() % w.tasks, TOTALS, squeeze({"v": totals}))])

    return run


def _add_table(table: np.ndarray, at: np.ndarray, c: np.ndarray, p: np.ndarray) -> None:
    """Adds pairs with their counts and unigram probabilities to the totals of their contexts, numbered ``at``."""
    n = table.shape[1]
    table[0] += np.bincount(at, weights=c, minlength=n)
    table[1] += np.bincount(at, weights=p, minlength=n)
    for r in range(1, CUT + 1):
        table[1 + r] += np.bincount(at[c == r], minlength=n)


class Contexts:
    """Count, scale of the seen words and back-off weight of contexts."""

    def __init__(self, turing: GoodTuring, h: np.ndarray, table: np.ndarray):
        some = table[0] > 0
        self.h, table = h[some], table[:, some]
        self.sum = table[0]
        left = sum(table[1 + r] * r * (1 - turing.d[r]) for r in range(1, CUT + 1))
        none = left <= 1e-12 * self.sum
        self.sum = np.where(none, self.sum + 1, self.sum)  # seen words keep c / (c + 1), one count is left
        self.weight = np.where(none, 1.0, left) / self.sum / np.maximum(1 - table[1], 1e-300)

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a context is known, its count and its weight."""
        if not len(self.h):
            return np.zeros(len(h), bool), np.zeros(len(h)), np.ones(len(h))
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        own = self.h[at] == h
        return own, np.where(own, self.sum[at], 0.0), np.where(own, self.weight[at], 1.0)


def _score_pairs(pairs: DataFrame, shared, parts: int) -> DataFrame:
    """At the context's part: conditional probabilities, summed for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, turing, hot = shared.load()
        sums = _Sums()
        for blobs in by_part(batches):
            t = _stack(blobs)
            seen = t["c"] > 0
            own, index = np.unique(t["h"], return_inverse=True)
            table = np.zeros((TABLE, len(own)))
            _add_table(table, index[seen], t["c"][seen], t["p"][seen])
            _, total, weight = Contexts(turing, own, table).of(t["h"])
            known, hot_total, hot_weight = hot.of(t["h"])  # replaces what this part has seen of hot contexts
            total, weight = np.where(known, hot_total, total), np.where(known, hot_weight, weight)
            value = np.log10(np.where(seen, turing.discounted(t["c"].astype(np.int64)) / np.maximum(total, 1e-300), weight))
            sums.add(t["row"], score=t["k"] * np.repeat(value, t["m"]))
        yield _packed(sums.packed(max(1, parts // 4)))

    return _shuffled(pairs, parts).mapInArrow(tidied(run), PACKED)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Documents with crc32(id) mod 7 = 2 are held out, the others are counted.  ``base_score``: add-one unigrams;
    ``score``: the model's log10 probability of the text, its end included."""
    spark = docs.sparkSession
    parts = 4 * shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (~F.coalesce(crc_mod(id_col, 7) == 2, F.lit(False))).alias("train"),
                       F.col(text_col).cast("string").alias("text"))
    unigrams = _unigrams(rows, parts)
    _release(spark)
    known = _words(unigrams, parts)
    words = Shared(spark, known)
    sent = _send_pairs(rows, words)
    # documents travel on as they are; pairs are counted at their word's part
    packed = materialize(_counted(sent, words, parts), "katz-bigrams")
    _release(spark)
    turing, hot, pairs = _hot(known, _totals(packed.filter(F.col("kind") == TOTALS), _size(known) + len(known.pairs)))
    shared = Shared(spark, (parts, turing, hot))
    scored = _score_pairs(packed.filter(F.col("kind") == PAIRS), shared, parts)
    back = packed.filter(F.col("kind").isin(DOCUMENT, SUMS)).unionAll(scored)
    return _per_document(back, known.tokens, Shared(spark, pairs), parts)


def _counted(sent: DataFrame, words, parts: int) -> DataFrame:
    """``_pair_counter`` over the shuffled pairs, with the other rows of the same scan passed through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others: list[tuple[int, int, bytes]] = []

        def pairs():
            for b in batches:
                kind = b.column(1).to_numpy()
                others.extend(zip(*(b.column(i).take(pa.array(np.flatnonzero(kind != PAIRS))).to_pylist() for i in (0, 1, 2))))
                b = b.take(pa.array(np.flatnonzero(kind == PAIRS)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], ["part", "blob"])

        yield from count(pairs())
        yield _packed(others)

    count = _pair_counter(words)
    return sent.repartition(max(1, parts // 4), "part").sortWithinPartitions("part").mapInArrow(tidied(run), PACKED)


def _totals(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the vectors that the tasks have sent: in groups of tasks first, then here."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for blob in b.column(0).to_pylist():
                total += expand(blob)["v"]
        yield pa.RecordBatch.from_arrays([pa.array([squeeze({"v": total})], pa.binary())], ["blob"])

    groups = max(1, int(shuffle_partitions(rows.sparkSession) ** 0.5))
    spread = rows.select("blob", (F.col("part") % groups).alias("g")).repartition(groups, "g").select("blob")
    return sum((expand(r.blob)["v"] for r in spread.mapInArrow(tidied(add), "blob binary").collect()), np.zeros(size))


def _hot(w: Words, totals: np.ndarray) -> tuple[GoodTuring, Contexts, dict[str, np.ndarray]]:
    """Discounts, hot contexts, and what a hot pair adds to a document for each time that it stands there."""
    counts, table, c = np.split(totals, [CUT + 2, _size(w)])
    table = table.reshape(TABLE, -1)
    h, word = np.divmod(w.pairs, len(w.hot))
    p, seen = w.probability(w.hot_count[word]), c > 0
    counts = counts + _histogram(c[seen].astype(np.int64))
    _add_table(table, h[seen], c[seen].astype(np.int64), p[seen])
    turing = GoodTuring(counts)
    hot = Contexts(turing, w.hot, table)
    _, total, weight = hot.of(w.hot[h])
    value = np.where(seen, turing.discounted(c.astype(np.int64)) / np.maximum(total, 1e-300), weight * p)
    return turing, hot, {"tokens": np.ones(len(c)), "known": (w.hot_count[word] > 0).astype(float),
                         "base": np.log10((w.hot_count[word] + 1) / (w.tokens + w.types + 1)), "score": np.log10(value)}


def _per_document(packed: DataFrame, train_tokens: int, pairs: Shared, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = pairs.load()
        for blobs in by_part(batches):
            own = [expand(b) for b in blobs]
            docs = {k: np.concatenate([x[k] for x in own if "id" in x]) for k in ("row", "id", "null", "train")}
            order = np.argsort(docs["row"])
            docs = {k: v[order] for k, v in docs.items()}
            total = {k: np.zeros(len(order)) for k in ("tokens", "known", "base", "score")}
            for x in own:
                if "id" in x:
                    at = np.searchsorted(docs["row"], x["pair_row"])
                    for k in total:
                        np.add.at(total[k], at, each[k][x["pair"]] * x["pair_k"])
                    continue
                at = np.searchsorted(docs["row"], x["row"])
                for k in total:
                    if k in x:
                        np.add.at(total[k], at, x[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs["id"], mask=docs["null"].astype(bool)), pa.array(~docs["train"].astype(bool)),
                 *(pa.array(np.rint(total[k]).astype(np.int64)) for k in ("tokens", "known")),
                 pa.array(np.full(len(order), train_tokens)), pa.array(total["base"]), pa.array(total["score"])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _shuffled(packed, parts).mapInArrow(
        tidied(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
