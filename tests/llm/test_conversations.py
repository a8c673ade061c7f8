"""Operator 11 against an exhaustive search over edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from ranklight.llm import conversations as C
from ranklight.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string"


def begins(word):
    """Whether some legal word starts so."""
    return any(LEGAL.fullmatch(word + rest) for rest in ("", "a", "ua"))


def edits(rows):
    """Least (cost, audit) by trying everything; more than two inserts in a row never help."""
    @lru_cache(None)
    def best(i, word, inserted):
        found = []
        if i == len(rows) and LEGAL.fullmatch(word):
            found.append((0, ""))
        options = [(5, "I", i, word + c, inserted + 1) for c in "ua"] if inserted < 2 else []
        if i < len(rows):
            initial, fault = rows[i]
            options.append((2, "D", i + 1, word, 0))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                options += [(1 + more, "R", i + 1, word + c, 0) for c in "ua"]
                options += [(more, "K", i + 1, word + initial, 0)] if initial else []
        for cost, mark, j, w, k in options:
            if begins(w) and (rest := best(j, w, k)):
                found.append((cost + rest[0], mark + rest[1]))
        return min(found, default=None)

    return best(0, "", 0)


def damaged(conv, turn, role, text):
    name = lambda x: " " if x is None else str(x)
    role, text = name(role), name(text)
    hit = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
    row = (turn, "user" if hit == 4 else role, "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text)
    return {0: [], 3: [row, row]}.get(hit, [row])


def plain(rows, hurt=damaged):
    """One result row for each conversation, from rows ``conv_id, turn, role, text``."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((x for r in rows if r[0] == conv for x in hurt(*r)), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            body = text.strip(" \t\n\v\f\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        cost, audit = edits(tuple((r[1][:1], f) for r, f in zip(own, faults)))
        lines, word, i = [], "", 0
        for mark in audit:
            role, text = (own[i][1], own[i][2]) if mark != "I" else ("", "")
            i += mark != "I"
            if mark != "D":
                if mark != "K":
                    role = next(r for r in ("user", "assistant") if begins(word + r[0]))
                word += role[0]
                lines.append(f"{role}:{text}")
        turns = [r[0] for r in own if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def test_grammar_accepts_what_the_pattern_does():
    automaton = C.Automaton(C.RULES)
    words = [""]
    for _ in range(7):
        words += [w + c for w in words for c in "sua" if len(w) < 7 and w + c not in words][:400]
    for w in set(words):
        cell = (0, None)
        for c in w:
            cell = cell and automaton.shift(cell, c)
        assert (cell is not None and automaton.accepts(cell)) == bool(LEGAL.fullmatch(w)), w
    assert len(automaton.stacks()) == 8


@pytest.mark.parametrize("freeze", [1, 256])
def test_parser_against_all_edits(monkeypatch, freeze):
    monkeypatch.setattr(C, "FREEZE", freeze)
    automaton, rng = C.Automaton(C.RULES), random.Random(5)
    for _ in range(800):
        rows = tuple((rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(rng.randint(0, 8)))
        parse = C.Repair(automaton, (0, None))
        for r in rows:
            parse.row(*r)
        assert parse.end() == edits(rows), rows


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(QUERIES["op11_conversation_repair"](spark, sf)) == plain(rows_of(df))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "well", "", "  \t", "Why? ", "él 中文 🎉.", None, "long " * 40_000 + ".", "a:b.", "x\ny."]
    rows = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(texts)) for _ in range(60)]
    return rows + rows[:10] + [(50, t, "user", "ok.") for t in range(6)] + [(9, 4, "user", "alone.")]


def test_odd_rows(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, ROWS)
    assert got(C.repair(C.damage(df))) == plain(odd_rows)
    clash = df.withColumns({c: F.lit("extra") for c in "n hit c d k least at_null fault digest audit kind part seq blob".split()})
    assert got(C.repair(C.damage(clash))) == plain(odd_rows)
    assert C.repair(C.damage(df.limit(0))).count() == 0


def test_cut_conversations(spark, odd_rows, monkeypatch):
    """Conversations over several tasks and over several blocks."""
    monkeypatch.setattr(C, "BLOCK_CHARS", 300)
    rng = random.Random(3)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "tool"]), rng.choice(["Yes.", "No", "", f"w{t}.", f"w{t}"])) for t in range(300)]
    rows += [(2, t, ("assistant", "user")[t % 2], f"w{t}.") for t in range(40)] + odd_rows
    whole = lambda conv, turn, role, text: [(turn, " " if role is None else role, " " if text is None else text)]
    assert got(C.repair(spark.createDataFrame(rows, ROWS))) == plain(rows, whole)
