"""SentencePiece encoding and decoding through a weighted finite-state transducer.

The model file is compiled into one transducer: the normaliser's rewriting (a blank becomes the piece mark, a mark goes in front), one
arc path for each piece, and a byte path for every character that no piece covers.  An input is composed with it
character by character (a lattice of piece arcs over its positions); the encoding is the lattice's
shortest path in the tropical semiring: weights add along a path, and every position takes the least over its arcs.

* Unigram models: an arc weighs minus the piece's score.
* BPE models: an arc weighs 0 if its piece and the one before it survive the model's merges side by side, and infinity if they do
  not.  A sequence of pieces is the BPE encoding exactly if all its pairs survive, so every position has one state of finite
  weight, and the path equals the merge procedure's result (tested against the public library).  Whether a pair survives follows
  from the merge trees of its pieces: going back in time along the right edge of the left one and the left edge of the
  right one, no two symbols that stood side by side may make a piece that merges earlier than what really followed.

No piece holds a mark after another character, so the text is composed run by run (a run starts at its
marks).  The runs of a batch that were not met lately are composed together: one pass of an automaton finds all their arcs, and all
runs advance position by position.  Very long runs are composed alone, in the same way.

Whole texts are encoded.  Null text: null ids and null count.  Empty text: no ids.  Repeated rows are rows of their own; an
empty table gives no row; extra columns pass through, and the new columns replace those of their names.  Decoding inverts the
transducer; ids outside the vocabulary raise.  The mark character itself decodes to a blank, as in every SentencePiece
model.  Models that rewrite characters, remove extra white space or have user-defined pieces are refused with an error.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ranklight.llm.common import Shared, byte_slices, passing, tidied
from ranklight.llm.vocabulary import MARK, SENTENCE_PIECES

KEPT_RUNS = 60_000
PAIR_SLOTS = 1 << 20
LETTERS = 1 << 16   # of runs that are composed together
LONG = 256          # letters of a run that is composed alone
# Piece types and model types of the public SentencePiece model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        x = shift = 0
        while True:
            c = data[at]
            at += 1
            x |= (c & 127) << shift
            shift += 7
            if c < 128:
                return x

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, struct.unpack("<f" if size == 4 else "<d", data[at:at + size])[0]
            at += size


class Transducer:
    """A compiled SentencePiece model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.model_type, self.byte_fallback, self.prefix = UNIGRAM, False, True
        trim, charsmap = True, b""
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(float(piece.get(2, 0.0)))
                self.kinds.append(int(piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                self.model_type, self.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                rules = dict(_fields(value))
                charsmap, self.prefix, trim = rules.get(2, b""), bool(rules.get(3, 1)), bool(rules.get(4, 1))
        if charsmap or trim or USER_DEFINED in self.kinds or self.model_type not in (UNIGRAM, BPE):
            raise ValueError("only identity normalisers without user-defined pieces are compiled")
        self.unknown, self.worst = self.kinds.index(UNKNOWN), min(self.scores) - 10.0  # the weight of an unknown character
        self.id_of = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        inner = {c for p in self.id_of if p.strip(MARK) for c in p[1:]}
        if MARK in inner:
            raise ValueError("a piece holds the mark after another character")
        # a line feed that no piece holds ends a run as well: more runs repeat
        self.runs = re.compile(f"\n+|{MARK}*[^{MARK}\n]+|{MARK}+" if not any("\n" in p for p in self.id_of)
                               else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                      " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
                      for p, k in zip(self.pieces, self.kinds)]

        alphabet = {c for p in self.id_of for c in p}
        self.border = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in alphabet)
        if self.model_type == BPE:
            self._merge_trees()
        self._start()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "kept", "older", "slot", "slot_value")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def _start(self) -> None:
        """What a task builds for itself: the automaton of all pieces, and tables of runs and pairs met before."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for text, i in self.id_of.items():
            self.automaton.add_word(text, i << 16 | len(text))
        if self.id_of:
            self.automaton.make_automaton()
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.slot = np.full(PAIR_SLOTS, -1)
        self.slot_value = np.zeros(PAIR_SLOTS, bool)

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The merge procedure on a short text, and its last merge."""
        s, last = list(text), None
        while len(s) > 1:
            best, at = -math.inf, -1
            for i in range(len(s) - 1):
                j = self.id_of.get(s[i] + s[i + 1])
                if j is not None and self.scores[j] > best:
                    best, at = self.scores[j], i
            if at < 0:
                break
            last = s[at], s[at + 1]
            s[at:at + 2] = [s[at] + s[at + 1]]
        return s, last

    def _merge_trees(self) -> None:
        """For every piece: its rank (0 merges first; -1: a character), its two parts, and whether its own text becomes it.  For
        every two pieces that make a third one: that one's rank."""
        size = len(self.pieces)
        self.rank = np.unique(-np.array(self.scores), return_inverse=True)[1].astype(np.int64)
        self.parts = np.full((size, 2), -1)
        self.alone = np.zeros(size, bool)
        made: dict[int, int] = {}
        for p, i in self.id_of.items():
            whole, last = self._merged(p)
            self.alone[i] = whole == [p]
            if self.alone[i] and last:
                self.parts[i] = self.id_of.get(last[0], -1), self.id_of.get(last[1], -1)
            for cut in range(1, len(p)):
                x, y = self.id_of.get(p[:cut]), self.id_of.get(p[cut:])
                if x is not None and y is not None:
                    made[x * size + y] = i
        rank = self.rank.copy()
        single = np.array([len(p) == 1 for p in self.pieces])
        self.rank[single] = -1
        self.made = np.array(sorted(made), np.int64)
        self.made_rank = rank[[made[k] for k in self.made.tolist()]] if made else np.zeros(0, np.int64)
        # pieces that do not merge after their parts (as runs of marks, all of one score): pairs with them run the merges
        self.flat = self.alone & ~single & ((self.parts < 0) | (self.rank[self.parts] >= self.rank[:, None])).any(axis=1)
        while (more := self.alone & ~single & ~self.flat & self.flat[self.parts].any(axis=1)).any():
            self.flat |= more

    def _survive(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces ``a`` and ``b`` stay two when their texts stand side by side."""
        out = self.alone[a] & self.alone[b]
        flat = self.flat[a] | self.flat[b]
        for i in np.flatnonzero(out & flat).tolist():
            pair = [self.pieces[a[i]], self.pieces[b[i]]]
            out[i] = self._merged("".join(pair))[0] == pair
        live = np.flatnonzero(out & ~flat)
        a, b = a[live], b[live]
        limit = np.full(len(live), np.iinfo(np.int64).max)  # twice the rank of the merge that followed; odd: it lay to the right
        while len(live) and len(self.made):
            key = a * len(self.pieces) + b
            at = np.minimum(np.searchsorted(self.made, key), len(self.made) - 1)
            lost = (self.made[at] == key) & (2 * self.made_rank[at] < limit)
            out[live[lost]] = False
            left = self.rank[a] > self.rank[b]  # of equal merges the left one came first
            limit = np.where(left, 2 * self.rank[a], 2 * self.rank[b] + 1)
            more = ~lost & (limit >= 0)  # both characters: no merge before
            a, b = np.where(left, self.parts[a, 1], a), np.where(left, b, self.parts[b, 0])
            live, a, b, limit = live[more], a[more], b[more], limit[more]
        return out

    def survive(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same through a table of pairs met lately; ``a`` is -1 at the start and after bytes."""
        out = self.alone[b]
        some = np.flatnonzero(a >= 0)
        key = a[some] * len(self.pieces) + b[some]
        slot = (key * 0x9E3779B1 >> 15) & (PAIR_SLOTS - 1)
        miss = np.flatnonzero(self.slot[slot] != key)
        if len(miss):
            value = self._survive(a[some][miss], b[some][miss])
            known = self.slot_value[slot]
            known[miss] = value
            self.slot[slot[miss]] = key[miss]  # of two keys for one slot the last stays, with its own value
            self.slot_value[slot[miss]] = value
            out[some] = known
        else:
            out[some] = self.slot_value[slot]
        return out

    def _fallback(self, c: str) -> list[int]:
        return [self.byte_ids[x] for x in c.encode()] if self.byte_fallback else [self.unknown]

    def paths(self, runs: list[str]) -> list[bytes]:
        """Ids, as 32-bit numbers, on the shortest path of each run."""
        big = self.border.join(runs) + self.border
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        first = np.concatenate(([0], np.cumsum(size + 1)[:-1]))  # a run has one position more than letters
        stop = first + size
        arcs = np.fromiter(chain.from_iterable(self.automaton.iter(big)), np.int64).reshape(-1, 2) if self.id_of else np.zeros((0, 2), np.int64)
        to, piece, length = arcs[:, 0] + 1, arcs[:, 1] >> 16, arcs[:, 1] & 0xFFFF
        single = np.zeros(len(big) + 1, bool)
        single[to[length == 1] - 1] = True
        single[stop] = True
        lone = np.flatnonzero(~single[:-1])  # characters that are no piece: one arc each
        to = np.concatenate((to, lone + 1))
        piece = np.concatenate((piece, np.full(len(lone), -1)))
        since = to - np.concatenate((length, np.ones(len(lone), np.int64)))
        step = to - np.repeat(first, size + 1)[to]
        order = np.lexsort((since, to, step.astype(np.min_scalar_type(int(size.max(initial=0))))))
        to, since, piece = to[order], since[order], piece[order]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(step))))
        last, came = self._relaxed(to, since, piece, cuts, first, len(big) + 1)
        at, index, found = stop.copy(), np.arange(len(runs)), []
        while len(at):  # back along the best arcs, all runs side by side
            more = at > first[index]
            at, index = at[more], index[more]
            found.append((index, at, last[at]))
            at = came[at]
        index, at, ids = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")  # positions rise from run to run
        index, at, ids = index[order], at[order], ids[order]
        ends = np.cumsum(np.bincount(index, minlength=len(runs)))
        flat = ids.astype(np.int32)
        data = flat.tobytes()
        out = [data[4 * lo:4 * hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for i in np.unique(index[ids < 0]).tolist():
            own = slice(ends[i - 1] if i else 0, ends[i])
            out[i] = array("i", chain.from_iterable([p] if p >= 0 else self._fallback(big[a - 1]) for a, p in zip(
                at[own].tolist(), flat[own].tolist()))).tobytes()
        return out

    def _relaxed(self, to, since, piece, cuts, first, nodes) -> tuple[np.ndarray, np.ndarray]:
        """For each position the last piece of its best path and where that one began."""
        last, came = np.full(nodes, -2), np.zeros(nodes, np.int64)
        last[first] = -1
        if self.model_type == BPE:
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    own, begin, end = piece[lo:hi], since[lo:hi], to[lo:hi]
                    before = last[begin]
                    fits = (before > -2) & ((own < 0) | self.survive(before, own))
                    last[end[fits]], came[end[fits]] = own[fits], begin[fits]
            return last, came
        cost = -np.append(self.scores, self.worst)  # the last one is that of piece -1
        weight = np.full(nodes, np.inf)
        weight[first] = 0.0
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                own, begin, end = piece[lo:hi], since[lo:hi], to[lo:hi]
                value = weight[begin] + cost[own]
                heads = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
                least = np.minimum.reduceat(value, heads)
                weight[end[heads]] = least
                best = np.flatnonzero(value == np.repeat(least, np.diff(np.append(heads, len(end)))))[::-1]
                last[end[best]], came[end[best]] = own[best], begin[best]  # of equal ones the longest piece, written last
        return last, came

    def _long_path(self, run: str) -> bytes:
        """The same for one run, arc by arc."""
        n = len(run)
        last, came, weight = array("q", [-2]) * (n + 1), array("q", [0]) * (n + 1), array("d", [math.inf]) * (n + 1)
        last[0], weight[0] = -1, 0.0
        known: dict[tuple[int, int], bool] = {}
        done = 0

        def lone(up_to: int) -> None:
            nonlocal done
            while done < up_to:
                done += 1
                if run[done - 1] not in self.id_of:
                    relax(done, done - 1, -1)

        def relax(to: int, since: int, piece: int) -> None:
            if self.model_type == BPE:
                pair = last[since], piece
                if pair[0] == -2:
                    return
                if piece >= 0 and pair not in known:
                    if len(known) >= KEPT_RUNS:
                        known.clear()
                    known[pair] = bool(self.survive(np.array([pair[0]]), np.array([piece]))[0])
                if piece < 0 or known[pair]:
                    last[to], came[to] = piece, since
            elif (w := weight[since] - (self.scores[piece] if piece >= 0 else self.worst)) < weight[to]:
                weight[to], last[to], came[to] = w, piece, since

        for end, value in self.automaton.iter(run):
            lone(end)
            relax(end + 1, end + 1 - (value & 0xFFFF), value >> 16)
        lone(n)
        out: list[int] = []
        while n:
            out += [last[n]] if last[n] >= 0 else self._fallback(run[n - 1])[::-1]
            n = came[n]
        return array("i", out[::-1]).tobytes()

    def encode_all(self, texts: list[str | None]) -> tuple[array, list[int]]:
        """All ids of the texts, one after the other, and where each text ends."""
        runs = [self.runs.findall((MARK + t if self.prefix else t).replace(" ", MARK)) if t else [] for t in texts]
        kept, long = self.kept, {}
        new = []
        for run in set().union(*runs).difference(kept):
            if (ids := self.older.get(run)) is not None:
                kept[run] = ids
            elif len(run) > LONG:
                long[run] = self._long_path(run)
            else:
                new.append(run)
        at = 0
        while at < len(new):
            to, letters = at, 0
            while to < len(new) and letters < LETTERS:
                letters += len(new[to])
                to += 1
            kept.update(zip(new[at:to], self.paths(new[at:to])))
            at = to
        ids, ends = array("i"), []
        for own in runs:
            ids.frombytes(b"".join([kept[r] if len(r) <= LONG else long[r] for r in own]))
            ends.append(len(ids))
        if len(kept) > KEPT_RUNS:  # runs not met again for as long are forgotten
            self.older, self.kept = kept, {}
        return ids, ends

    def encode(self, text: str, into: array) -> None:
        into.extend(self.encode_all([text])[0])

    def decode(self, ids) -> str:
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _model(path: str) -> bytes:
    with open(path, "rb") as f:  # on the driver; the tasks get the bytes
        return f.read()


def encode(docs: DataFrame, text_col: str = "text", model_path: str = SENTENCE_PIECES, ids_col: str = "ids",
           count_col: str = "n_pieces", verify_col: str | None = None) -> DataFrame:
    """All columns of ``docs``, then the ids and their count (which replace columns of the same names).
    ``verify_col``: whether the ids decode to the text again (null for null text)."""
    new = [c for c in (ids_col, count_col, verify_col) if c]
    model = Shared(docs.sparkSession, Transducer(_model(model_path)))
    rows, names, schema = passing(docs, text_col, new)
    own = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = model.load()
        for b in byte_slices(batches, own, 1 << 20):
            texts = b.column(own).to_pylist()
            ids, ends = fst.encode_all(texts)
            ends = [0, *ends]
            same = [None if t is None else fst.decode(ids[lo:hi]) == t.replace(MARK, " ")
                    for t, lo, hi in zip(texts, ends, ends[1:])] if verify_col else []
            null = pa.array([t is None for t in texts], pa.bool_())
            flat = pa.array(np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=null)
            count = pa.array(np.diff(ends), pa.int64(), mask=np.array([t is None for t in texts], bool))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:own], lists, count, *([pa.array(same, pa.bool_())] if verify_col else [])],
                names + new)

    schema += f"`{ids_col}` array<int>, `{count_col}` long" + f", `{verify_col}` boolean" * bool(verify_col)
    return rows.mapInArrow(tidied(run), schema)


def decode(rows: DataFrame, ids_col: str = "ids", model_path: str = SENTENCE_PIECES, out_col: str = "decoded") -> DataFrame:
    """All columns of ``rows``, then the decoded text (null for null ids), which replaces a column of its name."""
    rows = rows.select(*[rows[f"`{c}`"] for c in rows.columns if c.lower() != out_col.lower()])
    model = Shared(rows.sparkSession, Transducer(_model(model_path)))
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = model.load()
        for b in batches:
            text = [None if ids is None else fst.decode(ids) for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, out_col])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)
    return rows.mapInArrow(tidied(run), f"{schema}`{out_col}` string")
