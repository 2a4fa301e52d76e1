r"""Quality rules with cross-document line frequency.

One pass over the texts gives each document's own figures and, for every
distinct normalised line (letters in lower case, digits as 0, white space as
one space), its hash and its words.  Over the whole corpus the distinct
documents of a host that hold a line are counted; copies of one text count
once.  Lines above the limit of their host are removed, and a document from
which too much went is rejected as depleted.

Counting is by (host, line, text) and then by (host, line), so a line that
stands in every document is summed map-side and never gathered.  The table of
frequent lines is joined back to the documents' lines by an ordinary join,
whose skewed partitions Spark may split.

Defined cases: null and empty texts have no words and fail the base rule; a
null host is a host of its own; repeated rows and ids each give a row; ties
don't matter (limits are strict); empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.textbatch import gram_hash, prefix_hash, runs, saved, span_hash, text_key, words

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A line in more distinct documents of a host than this is boilerplate, however large the host.
MAX_LINE_DOCUMENTS = 20
#: A document is depleted if fewer words than MIN_WORDS or than this share of
#: its words remain.
MIN_REMAINING = 0.2

# The contract's symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

_ZERO_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")

FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(word_hash: np.ndarray, word_text: np.ndarray, n_texts: int, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in it."""
    n = len(word_hash)
    if n < window:
        return np.zeros(n_texts, np.int64)
    key = gram_hash(word_hash, window)
    inside = word_text[:len(key)] == word_text[window - 1:]
    at = np.flatnonzero(inside)
    key, text = key[at], word_text[at]
    order = np.lexsort((key, text))
    same = (key[order][1:] == key[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + window, -1)
    return np.bincount(word_text[np.cumsum(cover[:n]) > 0], minlength=n_texts)


def line_figures(text: bytes) -> tuple[int, list[int], list[int]]:
    """Lines equal to an earlier one; hash and words of each distinct normalised line."""
    seen: set[bytes] = set()
    repeats = 0
    lines: dict[int, int] = {}
    for line in text.split(b"\n"):
        tokens = line.split()  # bytes split at the contract's white space
        if not tokens:
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        # Numbers count as equal where words with letters tell the line; tables of numbers differ.
        lettered = [_LETTER.search(t) is not None for t in tokens]
        if 2 * sum(lettered) >= len(tokens) > sum(lettered):
            tokens = [t if word else t.translate(_ZERO_DIGITS) for t, word in zip(tokens, lettered, strict=True)]
        normal = b" ".join(tokens).lower()
        h = xxhash.xxh3_64_intdigest(normal)
        h = h - (1 << 64) if h >= 1 << 63 else h
        lines[h] = lines.get(h, 0) + len(tokens)
    return repeats, list(lines), list(lines.values())


def figures(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray], list]]:
    for a, b, data, offsets in runs(column):
        start, end, text = words(data, offsets)
        n = b - a
        lead = (data & 0xC0) != 0x80
        chars = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
        word_chars = np.bincount(text, weights=chars[end] - chars[start], minlength=n).astype(np.int64)
        hashes = span_hash(prefix_hash(data), start, end)
        raw = data.tobytes()
        lines = [line_figures(raw[offsets[i]:offsets[i + 1]]) for i in range(n)]
        yield a, b, [np.bincount(text, minlength=n), word_chars, _per_text(SYMBOLS[data], offsets),
                     np.array([x[0] for x in lines], np.int64), repeated_words(hashes, text, n)], lines


def document_figures(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, host, _text, the contract's figures, lines: array of (hash, words))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, columns, lines in figures(b.column(3)):
                size = pa.array(np.concatenate([[0], np.cumsum([len(x[1]) for x in lines])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(a, z - a) for i in range(3)] + [pa.array(c.astype(np.int64)) for c in columns]
                    + [pa.ListArray.from_arrays(size, pa.array([h for x in lines for h in x[1]], pa.int64())),
                       pa.ListArray.from_arrays(size, pa.array([w for x in lines for w in x[2]], pa.int64()))],
                    names=["doc_id", "host", "_text", *[f.split()[0] for f in FIGURES.split(", ")], "line", "line_words"])

    kind = {c: docs.schema[c].dataType.simpleString() for c in (id_col, host_col)}
    return docs.select(docs[id_col].alias("doc_id"), docs[host_col].alias("host"),
                       text_key(docs[text_col]).alias("_text"), docs[text_col].alias("text")).mapInArrow(
        run, f"doc_id {kind[id_col]}, host {kind[host_col]}, _text long, {FIGURES}, line array<long>, line_words array<long>")


def frequent_lines(lines: DataFrame, most: int = MAX_LINE_DOCUMENTS) -> DataFrame:
    """(host_key, line) above the limit, from (host_key, _text, line)."""
    return (lines.groupBy("host_key", "line", "_text").agg(F.lit(1).alias("one"))
            .groupBy("host_key", "line").agg(F.count("one").alias("n")).where(F.col("n") > most).select("host_key", "line"))


def judge(docs: DataFrame, most: int = MAX_LINE_DOCUMENTS,
          id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: the figures, base_failed, n_removed_words and kept."""
    own = saved(document_figures(docs, id_col, host_col, text_col)
                .withColumn("host_key", F.xxhash64("host", F.col("host").isNull()))
                .withColumn("row", F.xxhash64("doc_id", "host", "_text")))
    lines = own.select("host_key", "_text", "row", F.explode(F.arrays_zip("line", "line_words")).alias("l")).select(
        "host_key", "_text", "row", F.col("l.line").alias("line"), F.col("l.line_words").alias("line_words"))
    frequent = saved(frequent_lines(lines.select("host_key", "line", "_text"), most))
    # repeated rows have one key; their lines are joined once for all of them
    removed = (lines.select("host_key", "line", "row", "line_words").join(frequent, ["host_key", "line"])
               .groupBy("row", "line").agg(F.max("line_words").alias("line_words"))
               .groupBy("row").agg(F.sum("line_words").alias("n_removed_words")))
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < MIN_WORDS) | (left < MIN_REMAINING * F.col("n_words")))
    return (own.drop("line", "line_words").join(removed, "row", "left")
            .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
            .select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"), "n_removed_words"))
