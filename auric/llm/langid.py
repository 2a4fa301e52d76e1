"""Language identification of whole texts.

A sparse multinomial logistic regression on TF-IDF weighted character
n-grams.  Letters are lower-cased, everything else is a word edge; the 1- to
3-grams that do not span an edge are hashed into `FEATURES` cells.  A text's
features are its grams' relative frequencies times their inverse document
frequency, which is counted over all learning documents.  The regression is
trained by follow-the-regularised-leader with an L1 and an L2 penalty on a
sample of at most about `MAX_SAMPLE` documents, drawn evenly from the
languages by a hash of the id, and its scores are calibrated by one
temperature on a part of the sample that training doesn't see.

Training is one task over the bounded sample; the model has FEATURES numbers
for each language and is broadcast to the scan that predicts.

Defined cases: null texts and texts without a letter are `und` with score 0,
as is every text when there is nothing to learn from; a document with a null
id is never learned from and never held out; ties between languages go to
the first by code point; repeated rows and ids each give a row; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
FEATURES = 1 << 15
ORDERS = (1, 2, 3)
#: Bound on the documents that the regression is trained on.
MAX_SAMPLE = 8000
EPOCHS = 4
#: Step size, its offset, and the penalties of follow-the-regularised-leader.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05
#: One sampled document in so many is kept for calibration.
CALIBRATION = 5
#: Relative frequencies are small; this brings features near 1.
SCALE = 20.0
RUN_CHARS = 1 << 19

_CACHE: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _CACHE:
        _CACHE["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _CACHE["letters"]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every n-gram of the texts and the number of its text, in the order of the texts for each n."""
    low = [t.lower() + "\n" for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    text = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one edge after each run of letters
    codes, text, letter = codes[keep], text[keep], letter[keep]
    codes = np.where(letter, codes, 0).astype(np.uint64)
    cells, owner = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        ok = np.ones(size, dtype=bool)
        for k in range(1, n - 1):
            ok &= letter[k:k + size]
        ok &= letter[:size] if n == 1 else True
        if n > 1:  # an edge before the word belongs to the text that follows it
            ok &= letter[:size] | letter[n - 1:n - 1 + size]
        h = np.full(size, n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = (h ^ codes[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        cells.append((h[ok] & np.uint64(FEATURES - 1)).astype(np.int32))
        owner.append(text[n - 1:n - 1 + size][ok])
    if not cells:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(cells), np.concatenate(owner)


def _text_runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    first, size, run = 0, 0, []
    for i, t in enumerate(texts):
        if run and size + len(t or "") > RUN_CHARS:
            yield first, run
            first, size, run = i, 0, []
        run.append(t or "")
        size += len(t or "")
    if run:
        yield first, run


def held_out(doc_id: Column, modulus: int = 3, remainder: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def document_frequency(learn: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each cell, over all learning rows (cell -1: all documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(FEATURES, np.int64), 0
        for b in batches:
            for _, texts in _text_runs(b.column(0).to_pylist()):
                cell, owner = grams(texts)
                order = np.argsort(owner, kind="stable")
                cell, ends = cell[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))
                for a, z in zip(ends[:-1], ends[1:], strict=True):
                    flags = np.zeros(FEATURES, bool)
                    flags[cell[a:z]] = True
                    seen += flags
                total += len(texts)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))],
                                         names=["cell", "n"])

    rows = (learn.select("text").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most FEATURES + 1 rows
    df, total = np.zeros(FEATURES, np.int64), 0
    for r in rows:
        if r["cell"] < 0:
            total = r["n"]
        else:
            df[r["cell"]] = r["n"]
    return df, total


def inverse_frequency(df: np.ndarray, total: int) -> np.ndarray:
    return (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)


def bounded_sample(learn: DataFrame, bound: int = MAX_SAMPLE) -> DataFrame:
    """An even draw from the languages: each gives the share of its documents
    whose hash is small enough that about bound / languages remain."""
    counts = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    shares = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], bound / len(counts) / r["n"])])
    place = F.pmod(F.xxhash64(F.lit("langid"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return learn.where(place < shares[F.col("lang")]).select(
        "lang", "text", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATION)).alias("part"))


def _sparse(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell, _ = grams([text])
    count = np.bincount(cell, minlength=FEATURES)
    at = np.flatnonzero(count)
    x = (count[at] / max(len(cell), 1)).astype(np.float32) * idf[at] * SCALE
    return np.append(at, FEATURES).astype(np.int32), np.append(x, 1.0).astype(np.float32)


def train(labels: list[int], rows: list[tuple[np.ndarray, np.ndarray]], classes: int) -> np.ndarray:
    """Weights (FEATURES + 1 by classes) by per-coordinate follow-the-regularised-leader."""
    z = np.zeros((FEATURES + 1, classes), np.float64)
    n = np.zeros_like(z)

    def weights(at) -> np.ndarray:
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= L1, 0.0,
                        -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            g = np.outer(x, p)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss (golden section on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    a, b, r = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # cells by languages, with idf, scale and temperature inside
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return langs, scores
        for first, run in _text_runs(texts):
            cell, owner = grams(run)
            total = np.bincount(owner, minlength=len(run))
            s = np.stack([np.bincount(owner, weights=self.weights[cell, k], minlength=len(run))
                          for k in range(len(self.langs))], axis=1)
            s = s / np.maximum(total, 1)[:, None] + self.bias
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            for i in np.flatnonzero(total):
                langs[first + i] = self.langs[best[i]]
                scores[first + i] = float(p[i, best[i]])
        return langs, scores


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from rows with a language and a text whose id is not held out."""
    learn = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
               & ~held_out(F.col("doc_id")))
    df, total = document_frequency(learn)
    if not total:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0))
    idf = inverse_frequency(df, total)

    def learn_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "text"], ignore_index=True)
        langs = sorted(rows["lang"].unique())
        y = rows["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy()
        x = [_sparse(t, idf) for t in rows["text"]]
        kept = (rows["part"] == 0).to_numpy()
        if kept.all():
            kept[:] = False
        w = train([int(y[i]) for i in np.flatnonzero(~kept)], [x[i] for i in np.flatnonzero(~kept)], len(langs))
        s = np.array([x[i][1] @ w[x[i][0]] for i in np.flatnonzero(kept)]).reshape(-1, len(langs))
        w = w / temperature(s, y[kept])
        w[:-1] *= (idf * SCALE)[:, None]
        return pd.DataFrame({"lang": langs, "weights": [w[:, k].astype(np.float32).tobytes() for k in range(len(langs))]})

    # one task: the sample is bounded by MAX_SAMPLE
    model = (bounded_sample(learn).withColumn("one", F.lit(0)).groupBy("one").applyInPandas(learn_all, "lang string, weights binary")
             .collect())
    model.sort(key=lambda r: r["lang"])
    w = np.array([np.frombuffer(r["weights"], np.float32) for r in model]).reshape(len(model), FEATURES + 1).T
    return Model([r["lang"] for r in model], np.ascontiguousarray(w[:-1]), w[-1].astype(np.float64))


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns named in `keep` (all, by default) with lang_pred and score."""
    # FEATURES numbers a language, as plain lists and arrays: a broadcast names classes
    # by their module, which executors without the repository couldn't import.
    shared = docs.sparkSession.sparkContext.broadcast((list(model.langs), model.weights, model.bias))
    columns = list(docs.columns if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for b in batches:
            langs, scores = known.predict(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(i + 1) for i in range(len(columns))] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[f"c{i}" for i in range(len(columns))] + ["lang_pred", "score"])

    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    schema = ", ".join([f"c{i} {k}" for i, k in enumerate(kinds)] + ["lang_pred string", "score double"])
    out = docs.select(docs[text_col].alias("t"), *[docs[c].alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, schema)
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(columns)})
