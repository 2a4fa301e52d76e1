"""Token counts of whole texts with a public tokenizer, lengths only.

Each task encodes its rows in Arrow batches.  Texts are cut into pieces of
bounded size at safe boundaries and the pieces are gathered into batches of
about equal bytes, so neither one long text nor a run of long ones decides
how much memory or time a call takes.

A boundary is safe where a single space stands between two characters that
are not white space, provided that no entry of the vocabulary holds a word
mark behind another character: then no merge crosses the space, and the mark
that the tokenizer puts before each piece takes the place of the space.  A
vocabulary without that property is never split.

Null and empty texts have no tokens.  Rows are independent: repeated rows and
repeated ids each give a row, and other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

#: Pieces are at least this long (they end at the next safe boundary).
PIECE_CHARS = 1 << 10
#: Text that one call of the tokenizer gets.
BATCH_CHARS = 1 << 19

_MARK = "▁"
_SAFE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_LOADED: dict[str, tuple] = {}


def _load(path: str):
    if path not in _LOADED:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any(_MARK in model.id_to_piece(i).lstrip(_MARK) for i in range(model.get_piece_size()))
        joined = model.encode("a b", out_type=str)
        _LOADED[path] = model, not inner and sum(t.startswith(_MARK) for t in joined) == 2
    return _LOADED[path]


def pieces(text: str, least: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at the first safe boundary after every `least` characters."""
    at = 0
    while len(text) - at > least:
        cut = _SAFE.search(text, at + least)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def lengths(texts: list[str | None], path: str) -> list[int]:
    """Number of tokens of every text."""
    model, split = _load(path)
    out = [0] * len(texts)
    batch: list[str] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        for i, ids in zip(owner, model.encode(batch, num_threads=1), strict=True):
            out[i] += len(ids)

    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in pieces(text) if split else (text,):
            batch.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= BATCH_CHARS:
                flush()
                batch, owner, size = [], [], 0
    if batch:
        flush()
    return out


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; a narrow map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            n_tokens = lengths(texts, model_path)
            n_bytes = [len(t.encode("utf-8")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
