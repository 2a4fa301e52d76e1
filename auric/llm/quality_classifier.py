"""Quality scores by a regularised quadratic discriminant.

Each text is described by statistics of its characters, words and lines,
transformed to be nearer to normal.  Both classes get a mean and a covariance
from sums over all labelled rows (each task sends its count, sum and sum of
outer products); a class covariance is shrunk towards the pooled one and
towards its diagonal.  A score is the logistic of the difference of the two
log-densities, each a Mahalanobis distance by the inverse of a Cholesky factor that is
computed once and shipped with the scan, over a temperature.

Defined cases: null and empty texts have all counts 0 and get the score of
such a text; labels other than 0 and 1, null labels, labels of unknown
documents, and documents with a null id teach nothing; several labels for one
id each count; without labels of both classes every score is the share of
label 1 (0.5 if there are none); repeated rows and ids each give a row; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.langid import held_out
from auric.llm.quality_rules import SYMBOLS, _per_text, repeated_words
from auric.llm.textbatch import SPACE, prefix_hash, runs, saved, span_hash, words

THRESHOLD = 0.7
#: Weight of the pooled covariance in a class's, and of the diagonal in the result.
TO_POOLED, TO_DIAGONAL = 0.2, 0.1
#: Added to the diagonal, as features are of the order of 1.
RIDGE = 1e-3
#: Densities of correlated features are too sure of themselves.
TEMPERATURE = 4.0

NAMES = ("log_words", "log_word_chars", "word_spread", "log_line_words", "symbols", "upper", "capital_words", "digits",
         "exclamations", "stops", "commas", "other_marks", "bars", "distinct_words", "repeated", "short_words",
         "long_words", "marked_words", "alphabet", "space")
SIZE = len(NAMES)

_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = _IS_LETTER[128:] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True


def _one(byte: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(byte.encode())] = True
    return flags


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """A row of transformed statistics for every text."""
    for a, b, data, offsets in runs(column):
        n = b - a
        start, end, text = words(data, offsets)
        count = np.bincount(text, minlength=n).astype(np.float64)
        per_word = 1.0 / np.maximum(count, 1)
        length = np.diff(offsets).astype(np.float64)
        per_byte = 1.0 / np.maximum(length, 1)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
        chars = (lead[end] - lead[start]).astype(np.float64)
        mean = np.bincount(text, weights=chars, minlength=n) * per_word
        spread = np.sqrt(np.maximum(np.bincount(text, weights=chars * chars, minlength=n) * per_word - mean * mean, 0))
        lines = _per_text(data == 10, offsets) + 1.0
        letters = _per_text(_IS_LETTER[data], offsets)
        per_letter = 1.0 / np.maximum(letters, 1)
        h = span_hash(prefix_hash(data), start, end)
        order = np.lexsort((h, text))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
        distinct = np.bincount(text[order][new], minlength=n)

        def share(flags: np.ndarray, per: np.ndarray) -> np.ndarray:
            return np.sqrt(_per_text(flags[data], offsets) * per)  # noqa: B023

        def of_words(flags: np.ndarray) -> np.ndarray:
            return np.sqrt(np.bincount(text[flags], minlength=n) * per_word)  # noqa: B023

        first, last = data[start], data[end - 1]
        kinds = np.zeros(n)
        for i in range(n):
            kinds[i] = np.count_nonzero(np.bincount(data[offsets[i]:offsets[i + 1]], minlength=256))
        marks = ~_IS_LETTER & ~_IS_DIGIT & ~SPACE & ~SYMBOLS & ~_one("!.,")
        yield np.stack([
            np.log1p(count), np.log1p(mean), np.log1p(spread), np.log1p(count / lines), share(SYMBOLS, per_word),
            share(_IS_UPPER, per_letter), of_words(_IS_UPPER[first]), share(_IS_DIGIT, per_byte), share(_one("!"), per_word),
            share(_one("."), per_word), share(_one(","), per_word), share(marks, per_word), share(_one("|"), per_word),
            distinct * per_word, np.sqrt(repeated_words(h, text, n, 5) * per_word), of_words(chars <= 2),
            of_words(chars >= 12), of_words(~_IS_LETTER[last] & (last != 44) & (last != 46)), np.log1p(kinds),
            share(SPACE, per_byte)], axis=1)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every text as packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r.tobytes() for x in features(b.column(1)) for r in x]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["doc_id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, SIZE)


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of each class over all rows (x, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for b in batches:
            x, y = _matrix(b.column(0)), np.asarray(b.column(1))
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        cell = np.tile(np.arange(total.shape[1]), 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], total.shape[1])), pa.array(cell), pa.array(total.ravel())],
                                         names=["label", "cell", "v"])

    rows = (labelled.select("x", "label").mapInArrow(run, "label long, cell long, v double")
            .groupBy("label", "cell").agg(F.sum("v").alias("v")).collect())  # 2 x (1 + SIZE + SIZE^2) numbers
    out = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for r in rows:
        out[r["label"], r["cell"]] = r["v"]
    return {k: (out[k, 0], out[k, 1:1 + SIZE], out[k, 1 + SIZE:].reshape(SIZE, SIZE)) for k in (0, 1)}


@dataclass
class Model:
    prior: float
    means: list[np.ndarray]
    whiten: list[np.ndarray]  # inverse Cholesky factors
    log_dets: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        log_p = []
        for mean, inverse, log_det in zip(self.means, self.whiten, self.log_dets, strict=True):
            z = (x - mean) @ inverse.T
            log_p.append(-0.5 * ((z * z).sum(axis=1) + log_det))
        odds = (log_p[1] - log_p[0]) / TEMPERATURE + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    n0, n1 = sums[0][0], sums[1][0]
    if not n0 or not n1:
        return Model(n1 / (n0 + n1) if n0 + n1 else 0.5, [], [], [])
    means = [sums[k][1] / sums[k][0] for k in (0, 1)]
    own = [sums[k][2] / sums[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (n0 * own[0] + n1 * own[1]) / (n0 + n1)
    whiten, log_dets = [], []
    for k in (0, 1):
        cov = (1 - TO_POOLED) * own[k] + TO_POOLED * pooled
        cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(SIZE)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Model(n1 / (n0 + n1), means, whiten, log_dets)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    rows = saved(described(docs, id_col, text_col))
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).where("label in (0, 1)")
    learn = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2)).join(known, "doc_id")
    model = fit(moments(learn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(F.col("doc_id").alias(id_col), held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
