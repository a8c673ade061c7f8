"""Language identification by unigram piece models, summed over all segmentations.

Every language has one probability per piece of a fixed public vocabulary.  The probability of a word is
the sum over all ways to cut it into pieces (forward algorithm); that of a text is the product over its
words.  Probabilities are fitted by expectation-maximisation: expected piece counts from the forward and
backward sums of the training words, added up by Spark over partitions.  The sums of every word and language are rescaled
by powers of two along the word, so words of improbable pieces do not underflow.

Words are the runs of letters of the whole text, lower-cased, however long.  A letter outside the vocabulary is
covered by one unknown piece.  Lattices are built for ``LETTERS`` letters of distinct words at a time, and the scores of
words seen before are kept up to ``CACHE_NUMBERS`` numbers, so a task's memory depends on neither texts nor languages.

Training uses a bounded sample: about ``train_docs`` documents for each language (all, if it has fewer), chosen by a
hash of the id over the whole table.  Scoring covers every document.

Null text, or text without a letter: ``und`` with score 0.  Without any training document every
document is ``und``.  Equal scores go to the smaller language name.  A row with a null id is in training.  Repeated rows are
rows of their own, in training and in the result.  An empty table gives no row.  Extra columns pass through ``predict`` and are not
read by ``identify``; the two result columns replace columns of their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import byte_slices, crc_mod, passing, slices, tidied
from ranklight.llm.vocabulary import MARK, SENTENCE_PIECES, read_pieces
from ranklight.sources.scratch import materialize

STEP = 64  # binary digits of one rescaling
TRAIN_DOCS = 2000
ROUNDS = 3
CACHE_WORDS = 100_000
CACHE_NUMBERS = 2_000_000
LETTERS = 1 << 16


def letter_runs(text: str) -> list[str]:
    import regex  # Unicode letters in one pattern

    return regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())


def lettered(words: list[str]) -> Iterator[list[str]]:
    """Words cut into lists of about ``LETTERS`` letters (one word at least)."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    at = 0
    while at < len(words):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + LETTERS, side="right")))
        yield words[at:to]
        at = to


class Lattice:
    """All piece arcs of a batch of distinct words, and sums over their paths."""

    def __init__(self, automaton, unknown: int, words: list[str]):
        big = MARK + MARK.join(words)
        n, self.words = len(big), len(words)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        word_at = np.repeat(np.arange(len(words)), size)
        arcs = np.fromiter(chain.from_iterable(automaton.iter(big)), np.int64).reshape(-1, 2)
        end, piece, length = arcs[:, 0], arcs[:, 1] >> 8, arcs[:, 1] & 255
        single = np.zeros(n, bool)
        single[end[length == 1]] = True
        lone = np.flatnonzero(~single)  # characters that are no piece: one unknown arc each
        if len(lone):
            end = np.concatenate((end, lone))
            order = np.argsort(end, kind="stable")
            end = end[order]
            piece = np.concatenate((piece, np.full(len(lone), unknown)))[order]
            length = np.concatenate((length, np.ones(len(lone), np.int64)))[order]
        word = word_at[end]
        step = (end + 1 - first[word]).astype(np.min_scalar_type(int(size.max(initial=0))))  # letters of the word up to the arc's end
        order = np.argsort(step, kind="stable")  # within a step the arcs stay in text order
        self.piece = piece[order]
        self.to = (end + 1 + word)[order]  # every word has one node more than letters
        self.since = (end + 1 - length + word)[order]
        self.cuts = np.concatenate(([0], np.cumsum(np.bincount(step, minlength=1))))
        self.start, self.stop = first + np.arange(len(words)), first + size + np.arange(len(words))
        self.nodes = n + len(words)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Node sums over all paths from a word's start; ``p[piece, language]``."""
        a, power = self._scaled(p)
        return np.ldexp(a, power)

    def logs(self, p: np.ndarray) -> np.ndarray:
        """Log probability of every word and language."""
        a, power = self._scaled(p)
        return np.log(a[self.stop]) + power[self.stop] * np.log(2.0)

    def _scaled(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node sums as ``a * 2 ** power``.  The power of a node is that of the node before it, less ``STEP`` where that one's
        sum is below ``2 ** -STEP``: no piece is longer than its word, so an arc's sums differ by a few steps at most."""
        a = np.zeros((self.nodes, p.shape[1]))
        power = np.zeros(a.shape, np.int32)
        a[self.start] = 1.0
        rescaled = False
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            if hi > lo:
                to, since = self.to[lo:hi], self.since[lo:hi]  # ascending
                heads = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                own = to[heads]
                low = a[own - 1] < 2.0 ** -STEP
                rescaled = rescaled or low.any()
                if rescaled:
                    power[own] = power[own - 1] - STEP * low
                    arcs = np.ldexp(a[since], power[since] - power[to]) * p[self.piece[lo:hi]]
                else:
                    arcs = a[since] * p[self.piece[lo:hi]]
                a[own] = np.add.reduceat(arcs, heads, axis=0)
        return a, power

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected piece counts; ``weight[word, language]`` is how often the word was seen."""
        a, power = self._scaled(p)
        b = np.zeros_like(a)  # times 2 ** -power
        b[self.stop] = weight / a[self.stop]
        out = np.zeros_like(p)
        rescaled = power.any()
        for lo, hi in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            if hi > lo:
                to, since = self.to[lo:hi], self.since[lo:hi]
                back = b[to] * p[self.piece[lo:hi]]
                if rescaled:
                    back = np.ldexp(back, power[since] - power[to])
                np.add.at(out, self.piece[lo:hi], back * a[since])
                np.add.at(b, since, back)
        return out


def _automaton(pieces: dict[str, int]):
    """Finds all pieces in a text; its values are ``piece << 8 | length``."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for text, i in pieces.items():
        found.add_word(text, i << 8 | len(text))
    found.make_automaton()
    return found


class _Scores:
    """Log probabilities of texts, given as lists of words; those of words are kept while there is room."""

    def __init__(self, automaton, unknown: int, p: np.ndarray):
        self.automaton, self.unknown, self.p = automaton, unknown, p
        self.room = max(1024, min(CACHE_WORDS, CACHE_NUMBERS // max(1, p.shape[1])))
        self.row: dict[str, int] = {}
        self.scores = np.zeros((self.room, p.shape[1]))

    def _learn(self, words: set[str]) -> None:
        for own in lettered(sorted(words)):
            at = len(self.row)
            self.scores[at:at + len(own)] = Lattice(self.automaton, self.unknown, own).logs(self.p)
            self.row.update(zip(own, range(at, at + len(own))))

    def totals(self, runs: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(runs), self.p.shape[1]))
        held: list[tuple[int, list[str]]] = []
        new: set[str] = set()

        def add_up() -> None:
            self._learn(new)
            for i, words in held:
                out[i] += self.scores[np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))].sum(axis=0)
            held.clear()
            new.clear()

        for i, words in enumerate(runs if self.p.shape[1] else []):
            for at in range(0, len(words), self.room):
                part = words[at:at + self.room]
                fresh = set(part).difference(self.row, new)
                if len(self.row) + len(new) + len(fresh) > self.room:
                    add_up()
                    self.row.clear()
                    fresh = set(part)
                new |= fresh
                held.append((i, part))
        add_up()
        return out


class LanguageModel:
    """Per-language piece probabilities (a ``pieces x languages`` matrix, bounded by the vocabulary)."""

    def __init__(self, languages: list[str], probabilities: np.ndarray, pieces: dict[str, int]):
        self.languages, self.p, self.pieces = languages, probabilities, pieces

    def predict(self, docs: DataFrame, text_col: str = "text",
                names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
        """All columns of ``docs``, then the likeliest language and its posterior probability as ``names`` (which
        replace columns of the same names)."""
        spark = docs.sparkSession
        model = spark.sparkContext.broadcast((self.languages, self.p, self.pieces))
        data, kept, schema = passing(docs, text_col, list(names))
        b_text = len(kept)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            languages, p, pieces = model.value
            automaton, unknown = _automaton(pieces), len(pieces)
            kept_words = _Scores(automaton, unknown, p)
            for b in byte_slices(batches, b_text, 1 << 20):
                runs = [letter_runs(t) if t else [] for t in b.column(b_text).to_pylist()]
                totals = kept_words.totals(runs)
                pred, score = [], []
                for words, total in zip(runs, totals):
                    if not words or not languages:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    best = int(total.argmax())
                    pred.append(languages[best])
                    score.append(float(1.0 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    [*kept, *names])

        return data.mapInArrow(tidied(run), f"{schema}`{names[0]}` string, `{names[1]}` double")


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, word, n`` over all letter runs (counted in each task before the shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1):
            seen: Counter = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    seen.update((lang, w) for w in letter_runs(text))
            langs, words = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()),
                                              pa.array(seen.values(), pa.int64())], ["lang", "word", "n"])

    rows = docs.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(
        tidied(run), "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, pieces_path: str = SENTENCE_PIECES) -> LanguageModel:
    """Fit on the rows of ``docs`` with a language.  ``train_docs`` bounds the documents for each language,
    ``rounds`` the EM steps.  The driver holds one probability for each piece and language."""
    spark = docs.sparkSession
    pieces = read_pieces(pieces_path)
    docs = docs.filter(F.col(lang_col).isNotNull())
    count = {r[0]: r[1] for r in docs.groupBy(lang_col).agg(F.count(F.lit(1))).collect()}
    languages = sorted(count)
    if not languages:
        return LanguageModel([], np.zeros((len(pieces) + 1, 0)), pieces)
    at = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(9)), F.lit(1 << 30))
    share: Column = F.lit(0.0)
    for lang, n in count.items():
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, train_docs / n))).otherwise(share)
    words = materialize(word_counts(docs.filter(at < share * (1 << 30)), text_col, lang_col), "langid-words")
    p = np.full((len(pieces) + 1, len(languages)), 1.0 / (len(pieces) + 1))
    column = {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((p, pieces, column))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, pieces, column = model.value
            automaton, total = _automaton(pieces), np.zeros_like(p)
            for b in slices(batches, 10_000):
                lang, word, n = (c.to_pylist() for c in b.columns)
                seen: dict[str, list[tuple[int, int]]] = {}
                for k, w, c in zip(lang, word, n):
                    seen.setdefault(w, []).append((column[k], c))
                for own in lettered(sorted(seen)):
                    weight = np.zeros((len(own), p.shape[1]))
                    for i, w in enumerate(own):
                        for k, c in seen[w]:
                            weight[i, k] += c
                    total += Lattice(automaton, len(pieces), own).expected(p, weight)
            i, j = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             ["piece", "lang", "n"])

        got = words.mapInArrow(tidied(run), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n")).toPandas()
        counts = np.full_like(p, 0.1)
        counts[got.iloc[:, 0], got.iloc[:, 1]] += got.iloc[:, 2]
        p = counts / counts.sum(axis=0)
        model.unpersist()
    return LanguageModel(languages, p, pieces)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.filter(crc_mod(id_col, 4) != 2)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **settings) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; learns from the rows that are not held out."""
    model = fit(training_rows(docs, id_col), id_col, text_col, lang_col, **settings)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False)).alias("held_out"))
    return model.predict(rows, "text").drop("text")
