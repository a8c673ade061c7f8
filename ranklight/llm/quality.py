"""Quality scores by a regularised quadratic discriminant over document statistics.

Each text gives a fixed vector of transformed statistics.  Each class gets a Gaussian: its mean, and its
covariance shrunk towards a multiple of the identity.  The score is the posterior probability of class 1 from the
difference of the two log densities (Mahalanobis distances through cached Cholesky factors) and the
class shares.  Spark adds up counts, sums and cross products over all labelled rows; the driver sees only
these ``d * d`` numbers for each class.

Null text counts as empty; its statistics are defined.  Labels other than 0 and 1 are ignored; a document with several
labels counts once for each.  With one class only, every score is that class's share;
without labels every score is 0.5.  Repeated rows are rows of their own, in training and in the result; a row with a null id
is scored and has no label; an empty table gives no row.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import Shared, byte_slices, crc_mod, tidied
from ranklight.sources.scratch import materialize

THRESHOLD = 0.7
SHRINKAGE = 0.05
FEATURES = ("log_bytes", "log_words", "word_length", "long_words", "distinct_words", "commonest_word", "upper", "digits",
            "symbols", "sentence_marks", "other_marks", "non_ascii", "log_lines", "repeated_lines", "line_words",
            "marked_words", "words_of_marks", "shouted_words", "stop_gap", "entropy")
_UPPER, _LOWER, _DIGIT = (slice(65, 91), slice(97, 123), slice(48, 58))


def _share(x: float, n: float) -> float:
    """A share in [0, 1] spread by a smoothed logit."""
    p = (x + 0.5) / (n + 1.0)
    return math.log(p / (1.0 - p)) if p < 1.0 else 7.0


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of one UTF-8 text (``FEATURES``)."""
    from collections import Counter

    text = text or b""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    words = text.split()
    k = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    freq = Counter(words)
    line_freq = Counter(lines)
    black = max(1, n - int(count[9:14].sum()) - int(count[32]))
    alpha_ascii = int(count[_UPPER].sum() + count[_LOWER].sum())
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    sentence = int(count[46] + count[44] + count[33] + count[63])
    symbols = int(count[35] + count[36] + count[37] + count[38] + count[42] + count[124] + count[60] + count[62] + count[61]
                  + count[94] + count[126] + count[123] + count[125] + count[92])
    endings = Counter(w[-1] for w in words)
    ended = k - sum(c for e, c in endings.items() if 97 <= e < 123 or 65 <= e < 91 or e >= 128)
    bare = sum(c for w, c in freq.items() if not any(65 <= x < 91 or 97 <= x < 123 or x >= 128 for x in w[:4]))
    shouted = sum(c for w, c in freq.items() if len(w) > 1 and w.upper() == w and w.lower() != w)
    p = count[count > 0] / max(1, n)
    top = freq.most_common(1)[0][1] if freq else 0
    short = sum(c for w, c in freq.items() if len(w) <= 3)
    return [math.log1p(n), math.log1p(k), math.log1p(black / max(1, k)), _share(sum(c for w, c in freq.items() if len(w) > 12), k),
            _share(len(freq), k), _share(top, k), _share(int(count[_UPPER].sum()), max(1, alpha_ascii)),
            _share(int(count[_DIGIT].sum()), black), _share(symbols, black), _share(sentence, black),
            _share(marks - sentence, black), _share(int(count[128:].sum()), black), math.log1p(len(lines)),
            _share(len(lines) - len(line_freq), len(lines)), math.log1p(k / max(1, len(lines))), _share(ended, k), _share(bare, k),
            _share(shouted, k), _share(short, k), float(-(p * np.log(p)).sum()) if n else 0.0]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 1):
            x = np.array([statistics(t) for t in b.column(1).cast(pa.binary()).to_pylist()]).reshape(b.num_rows, -1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(run), "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Discriminant:
    """Class shares, means and Cholesky factors (``d * d`` numbers for each class)."""

    def __init__(self, moments: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float):
        total = sum(n for n, _, _ in moments.values())
        self.constant = 0.5 if not total else None
        if total and len(moments) < 2:
            self.constant = float(next(iter(moments)))
        if self.constant is not None:
            return
        mean = sum(s for _, s, _ in moments.values()) / total
        spread = sum(np.diag(q) for _, _, q in moments.values()) / total - mean ** 2
        self.mean, self.scale = mean, np.sqrt(np.maximum(spread, 1e-12))
        self.classes = []
        for c in (0, 1):
            n, s, q = moments[c]
            m = (s / n - mean) / self.scale
            cov = (q / n - np.outer(s / n, s / n)) / np.outer(self.scale, self.scale)
            d = len(m)
            cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-6) * np.eye(d) + 1e-9 * np.eye(d)
            root = np.linalg.cholesky(cov)
            self.classes.append((math.log(n / total) - np.log(np.diag(root)).sum(), m, np.linalg.inv(root)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.mean) / self.scale
        low, high = (k - 0.5 * (((z - m) @ inv.T) ** 2).sum(axis=1) for k, m, inv in self.classes)
        return 1.0 / (1.0 + np.exp(np.clip(low - high, -700.0, 700.0)))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From rows ``x, label``: moments are summed by Spark, all rows count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(FEATURES)
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x, y = _matrix(b.column(0)), b.column(1).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(total[c, i])], ["c", "i", "v"])

    sums = labelled.mapInArrow(tidied(run), "c int, i int, v double").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()
    d = len(FEATURES)
    flat: dict[int, np.ndarray] = {}
    for c, i, v in sums:
        flat.setdefault(c, np.zeros(1 + d + d * d))[i] = v
    return Discriminant({c: (round(f[0]), f[1:1 + d], f[1 + d:].reshape(d, d)) for c, f in flat.items()}, shrinkage)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD, shrinkage: float = SHRINKAGE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.  Learns from the labels of rows that are
    not held out."""
    x = materialize(document_statistics(docs, id_col, text_col), "quality-statistics")
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    y = y.filter(F.col("label").isin(0, 1) & (crc_mod("doc_id", 4) != 2))
    fitted = Shared(x.sparkSession, fit(x.join(y, "doc_id").select("x", "label"), shrinkage))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.load()
        for b in batches:
            score = model.scores(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return x.select("doc_id", held, "x").mapInArrow(tidied(run), "doc_id long, held_out boolean, score double, predicted int")
