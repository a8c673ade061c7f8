"""Repair of role sequences in conversations by generalised LR parsing with edits.

The role grammar (``RULES``) is compiled into an SLR(1) automaton.  A conversation is parsed over a graph-structured
stack: stack cells are shared, and after every row equal stack tops merge, the least ``(cost, audit)`` staying.  A row may be
kept (shifted as it is), reroled (shifted as another symbol) or deleted (the stack stays); symbols may be inserted before
any row and at the end.  The grammar is left-recursive, so there are only a few different stacks, whatever the length.

Why merging is exact: two audits that have consumed the same rows and cost the same cannot be prefixes of one another (one
would have more inserts), so the smaller stays smaller whatever follows.

How it runs: equal rows of a turn are counted before anything moves; rows whose role and text occur at an earlier turn are
marked by an aggregate over digests; then rows are range-partitioned and sorted by conversation and turn, so one
conversation may span many tasks.  A conversation inside one task is parsed and hashed there.  One that is cut by a task
border (or is long) is parsed from *every* stack the automaton can hold; such segments are composed in order afterwards, and
its rows, packed, stream through one SHA-256, which is serial by definition.  A task holds a few MB of rows and
the audits.

Defined cases.  Null role or text counts as one space; null ``conv_id`` is a conversation of its own; null turns come
first.  Rows of one turn are ordered by role, then text, after damage, so repeated rows are neighbours, and all but the
first are duplicates (blank rows are blank).  A row with an empty role has no initial and cannot be kept.  An
empty table gives no row.  Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import pack, tidied, unpack
from ranklight.sources.scratch import materialize

RULES = [("Chat", ""), ("Chat", "T"), ("Chat", "sT"), ("T", "TP"), ("T", "P"), ("P", "ua")]
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
BLOCK_CHARS = 2 << 20  # characters of a conversation a task holds before it packs them
FREEZE = 256           # rows after which the audits so far are set aside
WHITE = r"\x20\x09-\x0D"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string, repaired_sha256 string"


class Automaton:
    """SLR(1) tables of a grammar ``[(left, right)]`` whose symbols are single characters but for the start symbol."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        heads = {left for left, _ in rules}
        self.terminals = {c for _, right in rules for c in right if c not in heads}
        start = rules[0][0]
        first = self._first(heads)
        follow = {h: set() for h in heads}
        follow[start].add("$")
        changed = True
        while changed:
            changed = False
            for left, right in rules:
                after = set(follow[left])
                for c in reversed(right):
                    if c in heads:
                        changed |= not after <= follow[c]
                        follow[c] |= after
                        after = first[c] - {""} | (after if "" in first[c] else set())
                    else:
                        after = {c}
        states = [self._close({(r, 0) for r, (left, _) in enumerate(rules) if left == start}, heads)]
        self.goto: list[dict[str, int]] = []
        for items in states:
            step = {}
            for c in sorted({rules[r][1][at] for r, at in items if at < len(rules[r][1])}):
                to = self._close({(r, at + 1) for r, at in items if rules[r][1][at:at + 1] == c}, heads)
                if to not in states:
                    states.append(to)
                step[c] = states.index(to)
            self.goto.append(step)
        self.reduce = [{c: r for r, at in items if at == len(rules[r][1]) for c in follow[rules[r][0]]} for items in states]
        # a state that can only reduce, by one rule, does so without looking ahead
        self.always = [next(iter(set(self.reduce[i].values()))) if not self.goto[i] and len(set(self.reduce[i].values())) == 1
                       and rules[next(iter(self.reduce[i].values()))][0] != start else None for i in range(len(states))]
        self.start = start
        self._moves: dict = {}

    def _first(self, heads: set[str]) -> dict[str, set[str]]:
        first = {h: set() for h in heads}
        for _ in range(len(self.rules) + 1):
            for left, right in self.rules:
                for c in right:
                    first[left] |= first[c] - {""} if c in heads else {c}
                    if c not in heads or "" not in first[c]:
                        break
                else:
                    first[left].add("")
        return first

    def _close(self, items: set[tuple[int, int]], heads: set[str]) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, at = todo.pop()
            c = self.rules[r][1][at:at + 1]
            for k, (left, _) in enumerate(self.rules):
                if c in heads and left == c and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    def _reduced(self, cell: tuple, rule: int) -> tuple:
        left, right = self.rules[rule]
        for _ in right:
            cell = cell[1]
        return self.goto[cell[0]][left], cell

    def shift(self, cell: tuple, symbol: str) -> tuple | None:
        """The stack after ``symbol``, or None where the grammar has no place for it.  A stack is ``(state, stack below)``."""
        if (cell, symbol) not in self._moves:
            at = cell
            while at is not None and symbol not in self.goto[at[0]]:
                rule = self.reduce[at[0]].get(symbol)
                at = None if rule is None or self.rules[rule][0] == self.start else self._reduced(at, rule)
            if at is not None and symbol in self.terminals:
                at = self.goto[at[0]][symbol], at
                while (rule := self.always[at[0]]) is not None:
                    at = self._reduced(at, rule)
            else:
                at = None
            self._moves[cell, symbol] = at
        return self._moves[cell, symbol]

    def accepts(self, cell: tuple) -> bool:
        while (rule := self.reduce[cell[0]].get("$")) is not None:
            if self.rules[rule][0] == self.start:
                return True
            cell = self._reduced(cell, rule)
        return False

    def stacks(self) -> list[tuple]:
        """Every stack that can stand between two rows (finite: the rules recurse on the left only)."""
        found = [(0, None)]
        for cell in found:
            for c in sorted(self.terminals):
                if (to := self.shift(cell, c)) is not None and to not in found:
                    found.append(to)
        return found


class Repair:
    """The frontier of one parse: for each stack top the least cost and, of that cost, the least audit."""

    def __init__(self, automaton: Automaton, entry: tuple):
        self.automaton = automaton
        self.tops = {entry: (0, 0, "")}  # cost, rank of the audit set aside, audit since then
        self.aside: list = [None]        # by rank: (audit set aside before, piece)
        self.rows = 0
        self._inserts: dict = {}

    def _with_inserts(self, cell: tuple) -> list[tuple[tuple, int]]:
        """Stacks reached from ``cell`` by inserts alone, with their number."""
        if cell not in self._inserts:
            found, edge, n = {cell: 0}, [cell], 0
            while edge:
                n += 1
                edge = [to for at in edge for c in ROLES if (to := self.automaton.shift(at, c)) is not None]
                edge = [to for to in dict.fromkeys(edge) if to not in found]
                found.update(dict.fromkeys(edge, n))
            self._inserts[cell] = list(found.items())
        return self._inserts[cell]

    def _closed(self) -> dict:
        tops: dict = {}
        for cell, (cost, rank, tail) in self.tops.items():
            for to, n in self._with_inserts(cell):
                w = (cost + INSERT * n, rank, tail + "I" * n)
                if to not in tops or w < tops[to]:
                    tops[to] = w
        return tops

    def row(self, initial: str, fault: str) -> None:
        """One row: its role's initial and its fault (``b`` blank, ``d`` duplicate, ``t`` truncated or empty)."""
        if fault in ("b", "d"):
            self.deletes(1)
            return
        more = TRUNCATED if fault == "t" else 0
        tops: dict = {}
        for cell, (cost, rank, tail) in self._closed().items():
            moves = [(cell, DELETE, "D")]
            if (to := self.automaton.shift(cell, initial)) is not None:
                moves.append((to, KEEP + more, "K"))
            moves += [(to, REROLE + more, "R") for c in ROLES if (to := self.automaton.shift(cell, c)) is not None]
            for to, extra, mark in moves:
                w = (cost + extra, rank, tail + mark)
                if to not in tops or w < tops[to]:
                    tops[to] = w
        self.tops = tops
        self._count(1)

    def deletes(self, n: int) -> None:
        """``n`` rows that must go.  An insert before them is never needed: ``DI`` costs what ``ID`` costs and is smaller."""
        self.tops = {cell: (cost + DELETE * n, rank, tail + "D" * n) for cell, (cost, rank, tail) in self.tops.items()}
        self._count(n)

    def _count(self, n: int) -> None:
        self.rows += n
        if self.rows >= FREEZE:
            self.rows = 0
            order = sorted(self.tops, key=lambda c: self.tops[c][1:])
            self.aside = [(self.aside[self.tops[c][1]], self.tops[c][2]) for c in order]
            self.tops = {c: (self.tops[c][0], i, "") for i, c in enumerate(order)}

    def _audit(self, rank: int, tail: str) -> str:
        pieces, at = [tail], self.aside[rank]
        while at is not None:
            at, piece = at
            pieces.append(piece)
        return "".join(reversed(pieces))

    def exits(self) -> dict:
        """For each stack top the cost and the audit; inserts at the end are left to what follows."""
        return {cell: (cost, self._audit(rank, tail)) for cell, (cost, rank, tail) in self.tops.items()}

    def end(self) -> tuple[int, str]:
        cost, rank, tail = min(w for cell, w in self._closed().items() if self.automaton.accepts(cell))
        return cost, self._audit(rank, tail)


class Applied:
    """Applies an audit to the rows of a conversation as they come and hashes the repaired ones."""

    def __init__(self, automaton: Automaton, audit: str):
        self.automaton, self.audit, self.at, self.cell, self.first = automaton, audit, 0, (0, None), True
        self.hash = hashlib.sha256()

    def _put(self, role: str, text: str, symbol: str) -> None:
        self.cell = self.automaton.shift(self.cell, symbol)
        self.hash.update((("" if self.first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.first = False

    def _next_role(self) -> str:
        return next(c for c in ROLES if self.automaton.shift(self.cell, c) is not None)

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            c = self._next_role()
            self._put(ROLES[c], "", c)
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        """A row and its ``n - 1`` repetitions, which are all deleted."""
        self._inserted()
        if (mark := self.audit[self.at]) == "K":
            self._put(role, text, role[0])
        elif mark == "R":
            c = self._next_role()
            self._put(ROLES[c], text, c)
        self.at += 1
        if n > 1:
            self._inserted()
            self.at += n - 1

    def digest(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


class Segment:
    """A run of consecutive rows of one conversation: counts that add up, and the rows not yet packed."""

    def __init__(self) -> None:
        self.rows: list = []
        self.chars = self.blocks = 0
        self.parses: list[Repair] | None = None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.turns: list = []     # first and last turn that is not null
        self.initials: list = []  # first and last

    def add(self, turn, role: str, text: str, fault: str, n: int) -> None:
        c, initial = self.counts, role[:1]
        if self.initials:
            c["illegal"] += self.initials[1] + initial not in LEGAL
        c["illegal"] += (n - 1) * (initial + initial not in LEGAL)
        self.initials = [self.initials[0] if self.initials else initial, initial]
        if turn is not None:
            c["turns"] += not self.turns or turn != self.turns[1]
            self.turns = [self.turns[0] if self.turns else turn, turn]
        c["blank"] += n if fault == "b" else 0
        c["duplicate"] += 0 if fault == "b" else n - (fault != "d")
        c["truncated"] += fault == "t"
        self.rows.append((role, text, fault, n))
        self.chars += len(role) + len(text) + 64

    @staticmethod
    def feed(parse: Repair, rows: list) -> None:
        for role, _, fault, n in rows:
            parse.row(role[:1], fault)
            if n > 1:
                parse.deletes(n - 1)

    def flush(self, automaton: Automaton) -> bytes:
        """Parses the rows at hand from every stack and packs them."""
        if self.parses is None:
            self.parses = [Repair(automaton, cell) for cell in automaton.stacks()]
        for parse in self.parses:
            self.feed(parse, self.rows)
        blob = pack({"role": pa.array([r[0] for r in self.rows], pa.string()),
                     "text": pa.array([r[1] for r in self.rows], pa.string()),
                     "n": pa.array([r[3] for r in self.rows], pa.int64())})
        self.rows, self.chars, self.blocks = [], 0, self.blocks + 1
        return blob

    def summary(self, automaton: Automaton) -> bytes:
        stacks = automaton.stacks()
        table = [[[stacks.index(cell), cost, audit] for cell, (cost, audit) in parse.exits().items()] for parse in self.parses]
        return json.dumps({"counts": self.counts, "turns": self.turns, "initials": self.initials, "table": table}).encode()


def _counts(c: dict, turns: list) -> list[int]:
    return [turns[1] - turns[0] + 1 - c["turns"] if turns else 0] + [c[k] for k in COUNTS[1:]]


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(ddl_fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema(ddl_fields)


_RESULT = [("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("cost", pa.int64()), ("audit", pa.string()),
           ("repaired_sha256", pa.string())]


def _parsed(rules: list[tuple[str, str]]):
    """Rows sorted by conversation in; results of whole conversations, and summaries and packed rows of cut ones, out."""
    schema = pa.schema([*_RESULT, ("kind", pa.int32()), ("part", pa.int32()), ("seq", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, part = Automaton(rules), TaskContext.get().partitionId()
        blank_result = [None] * (len(_RESULT) - 1)
        out: list[list] = []
        segment, at, first, begun = Segment(), None, True, False

        def close(last: bool) -> None:
            if not (first or last or segment.blocks):
                parse = Repair(automaton, (0, None))
                segment.feed(parse, segment.rows)
                cost, audit = parse.end()
                applied = Applied(automaton, audit)
                for role, text, _, n in segment.rows:
                    applied.row(role, text, n)
                out.append([at, *_counts(segment.counts, segment.turns), cost, audit, applied.digest(), 0, part, 0, None])
                return
            pack_rows()
            out.append([at, *blank_result, 1, part, 0, segment.summary(automaton)])

        def pack_rows() -> None:
            blob = segment.flush(automaton)
            out.append([at, *blank_result, 2, part, segment.blocks, blob])

        size = 0
        for b in batches:
            for conv, turn, role, text, fault, n in zip(*(c.to_pylist() for c in b.columns)):
                if begun and conv != at:
                    close(last=False)
                    segment, first = Segment(), False
                at, begun = conv, True
                if n:  # 0: a dropped row, which only names its conversation
                    segment.add(turn, role, text, fault, n)
                    if segment.chars > BLOCK_CHARS:
                        pack_rows()
                        size += BLOCK_CHARS
                if len(out) >= 1000 or size >= 2 * BLOCK_CHARS:
                    yield _batch(out, schema)
                    out, size = [], 0
        if begun:
            close(last=True)
        if out:
            yield _batch(out, schema)

    return tidied(run)


def _composed(rules: list[tuple[str, str]]):
    """Summaries, then packed rows, of one cut conversation after the other."""
    schema = pa.schema(_RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        stacks = automaton.stacks()
        at, begun, parse, applied, counts, turns, initials, found = None, False, None, None, {}, [], [], None

        def result() -> pa.RecordBatch:
            cost, audit = found if found else parse.end()
            last = applied or Applied(automaton, audit)
            return _batch([[at, *_counts(counts, turns), cost, audit, last.digest()]], schema)

        for b in batches:
            for conv, kind, blob in zip(*(c.to_pylist() for c in b.columns)):
                if not begun or conv != at:
                    if begun:
                        yield result()
                    at, begun, applied, found, turns, initials = conv, True, None, None, [], []
                    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
                    parse = Repair(automaton, (0, None))
                if kind == 1:
                    s = json.loads(blob)
                    for k, v in s["counts"].items():
                        counts[k] += v
                    if s["turns"]:
                        counts["turns"] -= bool(turns) and turns[1] == s["turns"][0]
                        turns = [turns[0] if turns else s["turns"][0], s["turns"][1]]
                    if s["initials"]:
                        counts["illegal"] += bool(initials) and initials[1] + s["initials"][0] not in LEGAL
                        initials = s["initials"]
                    tops: dict = {}
                    for cell, (cost, rank, tail) in parse.tops.items():
                        for k, more, audit in s["table"][stacks.index(cell)]:
                            w = (cost + more, rank, tail + audit)
                            if stacks[k] not in tops or w < tops[stacks[k]]:
                                tops[stacks[k]] = w
                    parse.tops = tops
                    parse._count(FREEZE)
                    continue
                if found is None:
                    found = parse.end()
                    applied = Applied(automaton, found[1])
                for role, text, n in zip(*(c.to_pylist() for c in unpack([blob]).columns)):
                    applied.row(role, text, n)
        if begun:
            yield result()

    return tidied(run)


def damage(rows: DataFrame) -> DataFrame:
    """The test damage by ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats
    it, 4 sets the role to user.  ``n`` is the number of copies that are left."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), space).alias("role"),
                      F.coalesce(F.col("text").cast("string"), space).alias("text"),
                      (F.crc32(key.cast("binary")) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return own.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1).alias("n"))


def _fault(seen: Column) -> Column:
    text = F.col("text")
    return (F.when(~text.rlike(f"[^{WHITE}]"), "b").when(seen, "d")
            .when(~text.rlike(f"[.!?][{WHITE}]*\\z"), "t").otherwise(""))


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for each conversation of
    ``conv_id, turn, role, text``.  A column ``n`` gives the number of copies of a row; a conversation whose rows all have
    0 is empty."""
    own = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
                      (F.col("n") if "n" in rows.columns else F.lit(1)).cast("long").alias("n"))
    gone = F.col("n") == 0
    own = own.select("conv_id", *[F.when(~gone, F.col(c)).alias(c) for c in ("turn", "role", "text")], "n")
    own = own.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    own = own.withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)))
    own = materialize(own, "conversation-rows")
    # nulls first: a null turn is less than every other
    by_text = own.filter("n > 0").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.count("*").alias("k"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("at_null"))
    more = by_text.filter("k > 1").drop("k")
    marked = own.join(more, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    seen = F.coalesce(F.when(F.col("at_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least")), F.lit(False))
    marked = marked.select("conv_id", "turn", "role", "text", _fault(seen).alias("fault"), "n")
    ordered = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    parsed = materialize(ordered.mapInArrow(_parsed(RULES), RESULT + ", kind int, part int, seq int, blob binary"), "conversation-parses")
    names = [n for n, _ in _RESULT]
    cut = parsed.filter("kind > 0").repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "seq")
    return parsed.filter("kind = 0").select(names).unionAll(
        cut.select("conv_id", "kind", "blob").mapInArrow(_composed(RULES), RESULT))
