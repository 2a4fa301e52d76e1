"""Alignment of two tokenizers over the same texts.

Two public tokenizers cut the bytes of " " + text: A is byte-level BPE (a
tokenizers file, whose ranks and pattern tiktoken applies), B is BPE with byte fallback (a sentencepiece model, which
puts the space there itself).  Places where a token of A and a token of B both
end cut the text into *groups*; tokens of A and B *link* where their bytes
overlap.  Every stretch between two neighbouring ends (of A or B) belongs to
one token of each, so the links of a text are those stretches: n_a + n_b -
n_groups of them.

Texts are encoded once, in chunks.  A text of more than CHUNK characters is
dealt as byte ranges to different tasks, each tokenizer's range being cut at
the first place that is safe for it: for A between a visible character and
white space or between a letter and punctuation, where its pattern always
ends; for B between two characters that stand next to each other in no entry
of its vocabulary.  So a range's tokens are those of the whole text, but A's and
B's tokens of a range may begin and end at different bytes.

A range yields a *fragment*: an open prefix (tokens up to the first common
end), closed groups, and an open suffix (tokens behind the last common end).
Fragments of neighbouring ranges compose by joining the suffix with the next
prefix, which may close more groups; composing is associative, and fragments
of a long text are composed in rounds of FAN.  Only the open ends travel:
closed groups stay behind as *parts*, told by the byte at which they start.

The number of documents that hold a pair of ids linked is summed from distinct
pairs of each text.  The most frequent pairs (HOT at most, all with at least
some power of two of documents) are looked up where the tokens lie; all others
are joined with the table of pairs.

Defined cases: null and empty texts, and texts that B doesn't give back byte
by byte (with its space mark in them, say), have no tokens and no links and
count nowhere; rows with equal texts or ids are documents of their own; null
ids stay null; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.textbatch import written

#: Characters of a chunk; text that the tokenizers get at a time.
CHUNK, BATCH_CHARS = 1 << 16, 1 << 18
#: Fragments composed at a time.
FAN = 64
#: Pairs that are looked up in the tasks at most.
HOT = 1 << 20
#: Distinct pairs that a task holds before it hands their numbers on.
FLUSH = 1 << 21

#: Where A may be cut: its pattern never goes on over these.
_SAFE_A = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-zぁ-ゖ一-龥])(?=[.,;:!?、。，！？])")
_MARK = "▁"
_GUARD = "\n"


# --- the tokenizers -------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for
    themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def narrow(size: int):
    return np.uint16 if size <= 1 << 16 else np.uint32


class TokenizerA:
    """Byte-level BPE whose ids are in the order of its merges, so that joining
    the pair of least id first is its rule."""

    #: The pattern of byte-level BPE (fixed value).
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError(f"{path}: not a plain byte-level BPE with its pattern")
        vocab, letters = model["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if [vocab[x + y] for x, y in merges] != list(range(len(letters), len(letters) + len(merges))):
            raise ValueError(f"{path}: ids are not in the order of merges")
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.size = max(vocab.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in ranks.items():
            self.bytes[i] = token
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.model = tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return self.model.encode_to_numpy(text, disallowed_special=())

    @staticmethod
    def cut(text: str, at: int) -> int:
        found = _SAFE_A.search(text, at)
        return found.start() if found else len(text)


class TokenizerB:
    def __init__(self, path: str):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) or m.is_unknown(i)
                      else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        normal = [p.replace(_MARK, " ") for i, p in enumerate(pieces) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        self.inside = {p[i:i + 2] for p in normal for i in range(len(p) - 1)}
        lead = m.encode("")  # no tokens, and one space mark before any text
        self.lead = len(m.encode(_GUARD))
        self.guarded = (not any(_GUARD in p for p in normal)
                        and m.encode(_GUARD + "a") == m.encode(_GUARD) + m.encode(_GUARD + "a")[self.lead:])
        self.splits = not lead and m.encode(" ", out_type=str) == [_MARK * 2]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with the space it adds, or go on from a safe cut."""
        given = [t[1:] if len(t) > 1 and t[0] == " " else _GUARD + t if t and t != " " else t for t in texts]
        out = self.model.encode(given, num_threads=1) if given else []
        for k, t in enumerate(texts):
            if t == " ":  # the mark alone, which the model gives to no text
                out[k] = self.model.encode(_GUARD)[:1]
            elif t and t[0] != " ":
                out[k] = out[k][self.lead:]
        return out

    def cut(self, text: str, at: int) -> int:
        if not self.splits:
            return len(text)
        for i in range(max(at, 1), len(text)):
            pair = text[i - 1:i + 1].replace(_MARK, " ")
            if pair not in self.inside and (pair[1] == " " or self.guarded):
                return i
        return len(text)


_LOADED: dict[tuple, object] = {}


def loaded(kind: type, path: str):
    """The tokenizer of a file, read once by each worker."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


# --- encoding -------------------------------------------------------------

_CHUNK_ROW = "doc_row long, doc_id {}, no int, chunks int, at long, slice string, a0 int, a1 int, b0 int, b1 int"
_CODED_ROW = "doc_row long, doc_id {}, no int, chunks int, ok boolean, a_at long, b_at long, a binary, b binary"


def _ranges(text: str, chunk: int, a: TokenizerA, b: TokenizerB) -> list[tuple]:
    """Byte ranges of a text: (byte at which the slice begins, slice, and the
    ranges of A and B in it)."""
    cuts_a, cuts_b = [0], [0]
    for nominal in range(chunk, len(text), chunk):
        cuts_a.append(a.cut(text, max(nominal, cuts_a[-1])))
        cuts_b.append(b.cut(text, max(nominal, cuts_b[-1])))
    cuts_a.append(len(text))
    cuts_b.append(len(text))
    out, at, last = [], 0, 0
    for k in range(len(cuts_a) - 1):
        first, end = min(cuts_a[k], cuts_b[k]), max(cuts_a[k + 1], cuts_b[k + 1])
        at += len(text[last:first].encode())
        last = first
        if cuts_a[k] < cuts_a[k + 1] or cuts_b[k] < cuts_b[k + 1]:
            out.append((at, text[first:end], *(x - first for x in (cuts_a[k], cuts_a[k + 1], cuts_b[k], cuts_b[k + 1]))))
    return out


def cut_long(docs: DataFrame, kind: str, chunk: int, path_a: str, path_b: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = loaded(TokenizerA, path_a), loaded(TokenizerB, path_b)
        for batch in batches:
            for k, text in enumerate(batch.column(2).to_pylist()):
                rows = _ranges(text, chunk, a, b)
                n = len(rows)
                same = pa.array([k] * n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(same), batch.column(1).take(same), pa.array(range(n), pa.int32()),
                     pa.array([n] * n, pa.int32()),
                     *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.string()] + [pa.int32()] * 4, strict=True))],
                    names=["doc_row", "doc_id", "no", "chunks", "at", "slice", "a0", "a1", "b0", "b1"])

    return docs.mapInArrow(run, _CHUNK_ROW.format(kind))


def encode(chunks: DataFrame, kind: str, path_a: str, path_b: str) -> DataFrame:
    """The tokens of every chunk (packed ids), the bytes at which they begin,
    and whether both give the chunk's bytes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = loaded(TokenizerA, path_a), loaded(TokenizerB, path_b)
        type_a, type_b = narrow(a.size), narrow(b.size)
        for batch in batches:
            slices = batch.column(5).to_pylist()
            a0, a1, b0, b1, at = (batch.column(c).to_pylist() for c in (6, 7, 8, 9, 4))
            first = 0
            while first < len(slices):
                last, size = first, 0
                while last < len(slices) and (last == first or size + len(slices[last]) <= BATCH_CHARS):
                    size += len(slices[last])
                    last += 1
                own = range(first, last)
                text_a = [slices[k][a0[k]:a1[k]] for k in own]
                text_b = [slices[k][b0[k]:b1[k]] for k in own]
                ids_a, ids_b = [a.encode(t) for t in text_a], b.encode(text_b)
                ok = [int(a.width[x].sum()) == len(s.encode()) and b"".join(map(b.bytes.__getitem__, y)) == t.encode()
                      for x, y, s, t in zip(ids_a, ids_b, text_a, text_b, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, last - first) for c in range(4)), pa.array(ok, pa.bool_()),
                     pa.array([at[k] + len(slices[k][:a0[k]].encode()) for k in own], pa.int64()),
                     pa.array([at[k] + len(slices[k][:b0[k]].encode()) for k in own], pa.int64()),
                     pa.array([x.astype(type_a).tobytes() for x in ids_a], pa.binary()),
                     pa.array([np.array(y, type_b).tobytes() for y in ids_b], pa.binary())],
                    names=["doc_row", "doc_id", "no", "chunks", "ok", "a_at", "b_at", "a", "b"])
                first = last

    return chunks.mapInArrow(run, _CODED_ROW.format(kind))


def encoded(docs: DataFrame, path_a: str, path_b: str, chunk: int) -> DataFrame:
    """The encoded chunks of every row of (doc_id, text), written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("doc_row"), "doc_id",
                       F.concat(F.lit(" "), F.nullif("text", F.lit(""))).alias("text"))
    size = F.length("text")
    whole = size.cast("int")
    zero, one = F.lit(0), F.lit(1)
    short = rows.where(F.coalesce(size, zero) <= chunk).select(
        "doc_row", "doc_id", zero.alias("no"), one.alias("chunks"), zero.cast("long").alias("at"),
        F.coalesce("text", F.lit("")).alias("slice"), zero.alias("a0"), F.coalesce(whole, zero).alias("a1"),
        zero.alias("b0"), F.coalesce(whole, zero).alias("b1"))
    long = cut_long(rows.where(size > chunk), kind, chunk, path_a, path_b).repartition("doc_row", "no")
    return written(encode(short, kind, path_a, path_b).unionByName(encode(long, kind, path_a, path_b)))


# --- fragments ------------------------------------------------------------

class Open:
    """Tokens of A and B of a stretch, from the bytes where they begin."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_at: int, b_at: int):
        self.a, self.b, self.a_at, self.b_at = a, b, a_at, b_at

    def __add__(self, other: Open) -> Open:
        return Open(np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]), self.a_at, self.b_at)


class Fragment:
    """Open prefix, and behind a first common end (`cut`) the open suffix; the
    groups between were handed on as a part."""

    def __init__(self, prefix: Open, suffix: Open | None):
        self.prefix, self.suffix = prefix, suffix

    @property
    def cut(self) -> bool:
        return self.suffix is not None


def scan(o: Open, width_a: np.ndarray, width_b: np.ndarray) -> tuple[Fragment, Open | None]:
    """The fragment of a stretch, and its closed groups (none: None)."""
    ends_a, ends_b = o.a_at + np.cumsum(width_a[o.a]), o.b_at + np.cumsum(width_b[o.b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if o.a_at == o.b_at:
        common = np.concatenate([[o.a_at], common])
    if not len(common):
        return Fragment(o, None), None
    first, last = int(common[0]), int(common[-1])
    ia, ib = np.searchsorted(ends_a, [first, last], "right"), np.searchsorted(ends_b, [first, last], "right")
    part = Open(o.a[ia[0]:ia[1]], o.b[ib[0]:ib[1]], first, first) if last > first else None
    return Fragment(Open(o.a[:ia[0]], o.b[:ib[0]], o.a_at, o.b_at), Open(o.a[ia[1]:], o.b[ib[1]:], last, last)), part


def compose(x: Fragment, y: Fragment, width_a: np.ndarray, width_b: np.ndarray) -> tuple[Fragment, Open | None]:
    """The fragment of two neighbouring stretches, and the groups closed between them."""
    middle, part = scan((x.suffix if x.cut else x.prefix) + y.prefix, width_a, width_b)
    prefix = x.prefix if x.cut else middle.prefix
    return Fragment(prefix, y.suffix if y.cut else middle.suffix), part


_FRAGMENT = "doc_row long, no int, part boolean, a_at long, b_at long, a binary, b binary, end long, end_a binary, end_b binary"


class Codec:
    """Fragments and parts as rows, ids packed; ships the widths of all tokens
    with a stage, so that only encoding loads the tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        a, b = TokenizerA(path_a), TokenizerB(path_b)
        self.size_b = b.size
        self.widths, self.types = (a.width, b.width), (narrow(a.size), narrow(b.size))

    def pack(self, o: Open) -> tuple[bytes, bytes]:
        return o.a.astype(self.types[0]).tobytes(), o.b.astype(self.types[1]).tobytes()

    def open(self, a: bytes, b: bytes, a_at: int, b_at: int) -> Open:
        return Open(np.frombuffer(a, self.types[0]), np.frombuffer(b, self.types[1]), a_at, b_at)

    def part(self, row: int, no: int, o: Open) -> tuple:
        return (row, no, True, o.a_at, o.b_at, *self.pack(o), None, None, None)

    def fragment(self, row: int, no: int, f: Fragment) -> tuple:
        ends = (f.suffix.a_at, *self.pack(f.suffix)) if f.cut else (None, None, None)
        return (row, no, False, f.prefix.a_at, f.prefix.b_at, *self.pack(f.prefix), *ends)

    def read(self, row: dict) -> Fragment:
        return Fragment(self.open(row["a"], row["b"], row["a_at"], row["b_at"]),
                        None if row["end"] is None else self.open(row["end_a"], row["end_b"], row["end"], row["end"]))

    @staticmethod
    def rows(rows: list[tuple]) -> pa.Table:
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        names = [f.split()[0] for f in _FRAGMENT.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def parts_of_long(coded: DataFrame, codec: Codec, fan: int) -> DataFrame:
    """(doc_row, at, a, b): closed groups of the texts of several chunks; a
    text's parts in the order of `at` are all its tokens."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                f, part = scan(codec.open(r["a"], r["b"], r["a_at"], r["b_at"]), *codec.widths)
                if part:
                    rows.append(codec.part(r["doc_row"], r["no"], part))
                rows.append(codec.fragment(r["doc_row"], r["no"], f))
            if rows:
                yield from codec.rows(rows).to_batches()

    def up(key: tuple, table: pa.Table) -> pa.Table:
        row, no = key[0].as_py(), key[1].as_py()
        rows, total = [], None
        for r in sorted(table.to_pylist(), key=lambda r: r["no"]):
            if total is None:
                total = codec.read(r)
                continue
            total, part = compose(total, codec.read(r), *codec.widths)
            if part:
                rows.append(codec.part(row, no, part))
        return codec.rows([*rows, codec.fragment(row, no, total)])

    level = written(coded.select("doc_row", "no", "a_at", "b_at", "a", "b").mapInArrow(first, _FRAGMENT))
    parts = level.where("part")
    left = coded.agg(F.max("chunks")).first()[0] or 0
    while left > 1:
        level = written(level.where("not part").withColumn("up", F.floor(F.col("no") / fan).cast("int"))
                        .groupBy("doc_row", "up").applyInArrow(up, _FRAGMENT))
        parts = parts.unionByName(level.where("part"))
        left = -(-left // fan)
    # Both tokenizers end where the text ends, so nothing is open any more.
    return parts.select("doc_row", F.col("a_at").alias("at"), "a", "b")


# --- links ----------------------------------------------------------------

class Aligned:
    """Groups and links of several stretches laid end to end, each beginning
    and ending where A and B both do."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], width_a: np.ndarray, width_b: np.ndarray):
        self.rows = len(a)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(a + none).astype(np.int64), np.concatenate(b + none).astype(np.int64)
        ends_a, ends_b = np.cumsum(width_a[self.a]), np.cumsum(width_b[self.b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        mark_a, mark_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        mark_a[ends_a] = True
        mark_b[ends_b] = True
        ends = np.flatnonzero(mark_a | mark_b)  # one link ends at each
        in_a, in_b = mark_a[ends], mark_b[ends]
        self.link_a = np.cumsum(in_a) - in_a
        self.link_b = np.cumsum(in_b) - in_b
        both = in_a & in_b
        group = np.cumsum(both) - both
        self.group_a, self.group_b = group[in_a], group[in_b]
        stop_a = np.cumsum(self.n_a)
        row_a = np.repeat(np.arange(self.rows), self.n_a)
        self.link_row = row_a[self.link_a] if len(ends) else np.zeros(0, np.int64)
        self.n_links = np.bincount(self.link_row, minlength=self.rows)
        self.n_groups = self.n_a + self.n_b - self.n_links
        self.stop_a = stop_a

    def keys(self, size_b: int) -> np.ndarray:
        """The id pair of every link as one number."""
        return self.a[self.link_a] * size_b + self.b[self.link_b]

    def groups(self) -> list[bytes]:
        """Of each stretch, its groups as `a1,a2|b1;a3|b2,b3`."""
        n_a, n_b = len(self.a), len(self.b)
        if not n_a:
            return [b""] * self.rows
        total = int(self.group_a[-1]) + 1
        per_a, per_b = np.bincount(self.group_a, minlength=total), np.bincount(self.group_b, minlength=total)
        before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        to_a = np.arange(n_a) + before_b[self.group_a]
        to_b = np.arange(n_b) + (before_a + per_a)[self.group_b]
        last_a = np.diff(self.group_a, append=-1) != 0
        last_b = np.diff(self.group_b, append=-1) != 0
        ids, sign = np.empty(n_a + n_b, np.int64), np.empty(n_a + n_b, np.int64)
        ids[to_a], ids[to_b] = self.a, self.b
        sign[to_a], sign[to_b] = last_a, 2 * last_b
        words = _decimal(int(ids.max()) + 1)
        text = [words[s][i] for i, s in zip(ids.tolist(), sign.tolist(), strict=True)]
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(text[x:y])[:-1] for x, y in zip([0, *stops[:-1]], stops, strict=True)]


_DECIMAL: list[list[bytes]] = [[], [], []]


def _decimal(size: int) -> list[list[bytes]]:
    """Decimal ids followed by a comma, a bar, a semicolon."""
    for known, sign in zip(_DECIMAL, b",|;", strict=True):
        known.extend(b"%d%c" % (i, sign) for i in range(len(known), size))
    return _DECIMAL


def _batches(batch: pa.RecordBatch, codec: Codec, size: int = 1 << 18) -> Iterator[tuple[int, int, Aligned]]:
    """Rows with columns a and b in runs of bounded size: (first row, end row, aligned)."""
    a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
    first = 0
    while first < len(a):
        last, n = first, 0
        while last < len(a) and (last == first or n + len(a[last]) <= size):
            n += len(a[last])
            last += 1
        yield first, last, Aligned([np.frombuffer(x, codec.types[0]) for x in a[first:last]],
                                   [np.frombuffer(x, codec.types[1]) for x in b[first:last]], *codec.widths)
        first = last


def _distinct(aligned: Aligned, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and number of links of the distinct pairs of each row."""
    both, n = np.unique((aligned.link_row << 40) | aligned.keys(size_b), return_counts=True)
    return both >> 40, both & ((1 << 40) - 1), n


def counted_pairs(texts: DataFrame, codec: Codec) -> DataFrame:
    """(pair, n): how many rows of (a, b) hold a pair, summed by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            both, to = np.unique(np.concatenate([keys, new]), return_inverse=True)
            return both, np.bincount(to, np.concatenate([counts, n])).astype(np.int64)

        for batch in batches:
            for _, _, aligned in _batches(batch, codec):
                held.append(_distinct(aligned, codec.size_b)[1])
                size += len(held[-1])
                if size > FLUSH:
                    keys, counts = fold()
                    held, size = [], 0
                    if len(keys) > FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])
                        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = fold()
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    return texts.select("a", "b").mapInArrow(run, "pair long, n long")


def pairs_of_parts(parts: DataFrame, codec: Codec) -> DataFrame:
    """(doc_row, pair, links) of every text that came in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, aligned in _batches(batch, codec):
                row, pair, n = _distinct(aligned, codec.size_b)
                yield pa.RecordBatch.from_arrays([batch.column("doc_row").slice(first, last - first).take(pa.array(row)),
                                                  pa.array(pair), pa.array(n)], names=["doc_row", "pair", "links"])

    return (parts.select("doc_row", "a", "b").mapInArrow(run, "doc_row long, pair long, links long")
            .groupBy("doc_row", "pair").agg(F.sum("links").alias("links")))


def pair_table(counts: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no other
    pair of its id of A has more."""
    id_a = F.floor(F.col("pair") / size_b)
    most = counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("most"))
    return (counts.withColumn("id_a", id_a).join(most, "id_a")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def frequent_pairs(table: DataFrame, limit: int = HOT) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with a power of two of documents at least, so that there are
    `limit` at most: (that power, pairs sorted, counts, best)."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = dict(table.groupBy(level.alias("level")).count().collect())  # 64 rows at most
    least = max(sizes, default=0) + 1
    total = 0
    while least > 0 and total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    rows = table.where(F.col("n") >= F.lit(1 << least)).toArrow().sort_by("pair")
    pair, n, best = (rows.column(c).to_numpy() for c in ("pair", "n", "best"))
    return 1 << least, np.array(pair, np.int64), np.array(n, np.int64), np.array(best, bool)


_DIGEST = ("doc_row long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, rare array<struct<pair: bigint, links: bigint>>")


def _digested(texts: DataFrame, kind: str, codec: Codec, frequent) -> DataFrame:
    """The figures of texts that came whole; links of rarer pairs are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, bests = frequent.value
        listed = pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())]))
        for batch in batches:
            for first, last, al in _batches(batch, codec):
                keys, m = al.keys(codec.size_b), last - first
                at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                at, row = at[known], al.link_row[known]
                total, best = np.zeros(m, np.int64), np.bincount(row[bests[at]], minlength=m)
                np.add.at(total, row, counts[at])
                other, links = np.unique((al.link_row[~known] << 40) | keys[~known], return_counts=True)
                stops = np.searchsorted(other >> 40, np.arange(m + 1))
                rare = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(other & ((1 << 40) - 1)), pa.array(links.astype(np.int64))], names=["pair", "links"]))
                digest = [sha256(g).hexdigest() if g else "" for g in al.groups()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_row").slice(first, m), batch.column("doc_id").slice(first, m),
                     *(pa.array(x.astype(np.int64)) for x in (al.n_a, al.n_b, al.n_groups, al.n_links, best, total)),
                     pa.array(digest, pa.string()), rare.cast(listed)],
                    names=[f.split()[0] for f in _DIGEST.split(", ")[:9]] + ["rare"])

    return texts.select("doc_row", "doc_id", "a", "b").mapInArrow(run, _DIGEST.format(kind))


def written_groups(parts: DataFrame, codec: Codec) -> DataFrame:
    """(doc_row, at, n_a, n_b, n_groups, n_links, groups) of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, al in _batches(batch, codec):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_row").slice(first, last - first), batch.column("at").slice(first, last - first),
                     *(pa.array(x.astype(np.int64)) for x in (al.n_a, al.n_b, al.n_groups, al.n_links)),
                     pa.array([g.decode() for g in al.groups()], pa.string())],
                    names=["doc_row", "at", "n_a", "n_b", "n_groups", "n_links", "groups"])

    return parts.mapInArrow(run, "doc_row long, at long, n_a long, n_b long, n_groups long, n_links long, groups string")


# --- the operator ---------------------------------------------------------

class Alignment:
    """Both tokenizers over (doc_id, text): tokens, groups and linked pairs."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN):
        self.codec = Codec(path_a, path_b)
        self.kind = docs.schema["doc_id"].dataType.simpleString()
        coded = encoded(docs, path_a, path_b, chunk)
        none = F.lit(b"")
        #: Texts of one chunk, with no tokens where a tokenizer didn't give them back.
        self.short = coded.where("chunks = 1").select(
            "doc_row", "doc_id", F.when(F.col("ok"), F.col("a")).otherwise(none).alias("a"),
            F.when(F.col("ok"), F.col("b")).otherwise(none).alias("b"))
        long = coded.where("chunks > 1")
        self.long = long.groupBy("doc_row").agg(F.min("ok").alias("ok"), F.first("doc_id").alias("doc_id"))
        #: Closed groups of longer texts, those given back whole.
        self.parts = written(parts_of_long(long, self.codec, fan).join(self.long.where("ok").select("doc_row"), "doc_row"))

    def groups(self) -> DataFrame:
        """(doc_id, at, n_a, n_b, n_groups, n_links, groups): the aligned groups,
        long texts in several parts that begin at byte `at` of the spaced text."""
        whole = self.short.withColumn("at", F.lit(0).cast("long"))
        parts = self.parts.join(self.long.select("doc_row", "doc_id"), "doc_row").select(*whole.columns)
        rows = whole.unionByName(parts)
        ids = rows.select("doc_row", "doc_id").distinct()
        return written_groups(rows.drop("doc_id"), self.codec).join(ids, "doc_row").drop("doc_row")

    def pairs(self) -> tuple[DataFrame, DataFrame]:
        """(pair, n, best) of the corpus, and (doc_row, pair, links) of the long texts."""
        long = written(pairs_of_parts(self.parts, self.codec))
        counts = (counted_pairs(self.short, self.codec)
                  .unionByName(long.groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
                  .groupBy("pair").agg(F.sum("n").alias("n")))
        return written(pair_table(written(counts), self.codec.size_b)), long

    def digest(self, hot: int = HOT) -> DataFrame:
        """The contract's row of every document."""
        table, long = self.pairs()
        spark = table.sparkSession
        _, pair, n, best = frequent_pairs(table, hot)
        frequent = spark.sparkContext.broadcast((pair, n, best))
        whole = written(_digested(self.short, self.kind, self.codec, frequent))
        links = (whole.select("doc_row", F.explode("rare").alias("r")).select("doc_row", "r.pair", "r.links")
                 .unionByName(long))
        sums = (links.join(table, "pair").groupBy("doc_row")
                .agg(F.sum(F.col("links") * F.col("n")).alias("more"),
                     F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best")))
        parts = written_groups(self.parts, self.codec).groupBy("doc_row").agg(
            *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "groups"))), lambda p: p["groups"]), ";"),
                   256).alias("groups_sha256"))
        zero = F.lit(0).cast("long")
        late = self.long.join(parts, "doc_row", "left").select(
            "doc_row", "doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
            zero.alias("n_best"), zero.alias("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
        return (whole.drop("rare").unionByName(late).join(sums, "doc_row", "left")
                .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
                        (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256"))


def align(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK, fan: int = FAN,
          id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """Align the tokens of tokenizers A and B over every row."""
    return Alignment(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), path_a, path_b, chunk, fan)
