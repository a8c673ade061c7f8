"""Word-piece token counts through a linear longest-match automaton.

The vocabulary is a trie with two roots: one for pieces that start a word, one for pieces that continue
it.  Every node carries a failure link and the number of pieces that are popped when the link is taken, so
greedy longest-match-first lengths come out of one pass over the characters, without backtracking and without building a piece.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the whole text, unchanged.  A word that greedy matching cannot
finish counts as one unknown token.  Null text counts as empty: no words, no tokens.  Repeated rows are rows of their own, a
null id is returned as it is, and an empty table gives no row.  Columns besides id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import byte_slices, tidied
from ranklight.llm.vocabulary import MARK, SENTENCE_PIECES, read_pieces

KEPT_WORDS = 500_000


class LongestMatch:
    """The automaton: node 0 is the start root, node 1 the continuation root."""

    def __init__(self, starts: list[str], continuations: list[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        token = [False, False]
        for root, own in ((0, starts), (1, continuations)):
            for piece in own:
                at = root
                for c in piece:
                    to = self.next[at].get(c)
                    if to is None:
                        to = self.next[at][c] = len(self.next)
                        self.next.append({})
                        token.append(False)
                    at = to
                token[at] |= at > 1
        self.fail = [-1] * len(self.next)  # -1: no link, the word is unknown
        self.popped = [0] * len(self.next)
        todo = deque((0, 1))
        while todo:
            u = todo.popleft()
            for c, v in self.next[u].items():
                todo.append(v)
                if token[v]:
                    self.fail[v], self.popped[v] = 1, 1
                else:
                    z, n = self.fail[u], self.popped[u]
                    while z >= 0 and c not in self.next[z]:
                        n += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.next[z][c], n

    def count(self, word: str) -> int:
        """Number of greedy longest-match pieces, 0 if the word cannot be matched."""
        follow, fail, popped = self.next, self.fail, self.popped
        u = n = 0
        for c in word:
            while (v := follow[u].get(c)) is None:
                n += popped[u]
                u = fail[u]
                if u < 0:
                    return 0
            u = v
        while u > 1:  # the end of the word: pop what is left
            n += popped[u]
            u = fail[u]
        return n if u == 1 else 0


def split_vocabulary(path: str = SENTENCE_PIECES) -> tuple[list[str], list[str]]:
    """Word starts (the mark taken off) and continuations of a public piece vocabulary."""
    own = [p for p in read_pieces(path) if MARK not in p[1:]]
    return [p[1:] for p in own if p[0] == MARK and len(p) > 1], [p for p in own if p[0] != MARK]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", starts: list[str] | None = None,
                 continuations: list[str] | None = None, pieces_path: str = SENTENCE_PIECES) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for every row.  The vocabulary is that of ``pieces_path``
    unless its two lists are given."""
    if starts is None or continuations is None:
        starts, continuations = split_vocabulary(pieces_path)
    vocabulary = docs.sparkSession.sparkContext.broadcast((starts, continuations))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, kept = LongestMatch(*vocabulary.value), {}
        for b in byte_slices(batches, 1):
            words, tokens, unknown = [], [], []
            for raw in b.column(1).cast(pa.binary()).to_pylist():
                own = raw.split() if raw else []
                total = lost = 0
                for w in own:
                    n = kept.get(w)
                    if n is None:
                        if len(kept) >= KEPT_WORDS:
                            kept.clear()
                        n = match.count(w.decode())
                        if len(w) <= 64:
                            kept[w] = n
                    total += n or 1
                    lost += not n
                words.append(len(own))
                tokens.append(total)
                unknown.append(lost)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(run), "doc_id long, n_words long, n_tokens long, n_unknown long")
