"""Runs of words: stretches of a text that repeat with a period, and texts without the repeats.

A *run* is a stretch of consecutive words with a smallest period q (words q
apart are the same) that no neighbouring word extends; it is at least two
periods and LEAST words long.  All runs of every text are found:

1. Only words in windows of LEAST / 2 words that stand twice in the text can
   be in a run (a run's words match q further on at least that often in
   succession), so stretches of such windows are taken out, end to end with
   separators, and everything else is left alone.
2. Grouping, the first phase of Baier's suffix sorter, over the stretches:
   groups of suffixes are taken from the greatest down, and the suffix before
   each member (the nearest to its left in a smaller group) moves to a new
   group above its own, with the member's context behind its own.  When all is
   done a group's context is the longest Lyndon word its members begin with,
   so the Lyndon array is read off the groups.  It is done once with the words
   in one order and once in the reversed order.
3. Every run has such a Lyndon word as a root in one of the orders.  Each word
   of both arrays is extended to both sides by longest common extensions,
   looked up in ranks of blocks of 1, 2, 4 ... words (exact, no hashes), and
   kept if it comes to two periods.

Every row is worked on where it lies: no shuffle, and memory grows with the
longest single text only.

Defined cases: null and empty texts and texts of white space have no words, no
runs and an empty text; repeated rows and ids each give a row; a null id stays
null; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.textbatch import RUN_BYTES, gram_hash, mix64

#: Words that a run has at least.
LEAST = 12

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


# --- Lyndon arrays --------------------------------------------------------

def lyndon(text: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place of `text`.

    Smaller numbers are smaller letters; 0 is a separator that no word
    crosses, and the first letter has to be one.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    heads = np.flatnonzero(np.diff(text[order], prepend=-1))
    counts = np.diff(np.append(heads, n))
    first = np.empty(n, np.int64)
    first[order] = np.repeat(heads, counts)
    sizes = np.zeros(n, np.int64)
    sizes[heads] = counts
    # A group is named by its first place in `place`, so names compare as groups do.
    group, place, size = first.tolist(), order.tolist(), sizes.tolist()
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    where = inverse.tolist()
    context = [1] * n
    before = [0] * n
    floor = size[0]  # places of separators
    top = n - 1
    while top >= floor:
        low = group[place[top]]
        step = context[low]
        hits: dict[int, int] = {}
        for i in sorted(place[low:top + 1]) if low < top else (place[top],):
            j = i - 1
            while group[j] >= low:
                j = before[j]
            before[i] = j
            if j < i - 1:  # what lies between is in greater groups for good
                before[i - 1] = j
            if group[j] >= floor:
                hits[j] = hits.get(j, 0) + 1
        top = low - 1
        if not hits:
            continue
        most = max(hits.values())
        for times in range(most, 0, -1) if most > 1 else (1,):
            moved: dict[int, list[int]] = {}
            for j, k in hits.items():
                if k != times:
                    continue
                own = group[j]
                size[own] -= 1
                last = own + size[own]
                other, at = place[last], where[j]
                place[at], place[last] = other, j
                where[other], where[j] = at, last
                moved.setdefault(own, []).append(j)
            for own, members in moved.items():
                new = own + size[own]
                context[new] = context[own] + times * step
                size[new] = len(members)
                for j in members:
                    group[j] = new
    return np.array(context, np.int64)[np.array(group, np.int64)]


# --- common extensions ----------------------------------------------------

def block_ranks(text: np.ndarray, longest: int) -> list[np.ndarray]:
    """Of every power of two, numbers that tell blocks of so many letters apart."""
    ranks = [text]
    width = 1
    while 2 * width <= longest:
        last = ranks[-1]
        m = len(text) - 2 * width + 1
        if m <= 1:
            break
        pair = last[:m] * np.int64(len(text) + 1) + last[width:width + m]
        values, rank = np.unique(pair, return_inverse=True)
        if len(values) == m:  # no longer block stands twice
            break
        ranks.append(rank.astype(np.int64))
        width *= 2
    return ranks


def extension(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """How many letters agree from i and j on (i < j), or before them."""
    n = len(ranks[0])
    out = np.zeros(len(i), np.int64)
    # Blocks of the greatest width may follow each other several times, the others once.
    for k in range(len(ranks) - 1, -1, -1):
        width, rank = 1 << k, ranks[k]
        open_ = np.arange(len(i))
        while len(open_):
            if back:
                a, b = i[open_] - out[open_] - width, j[open_] - out[open_] - width
                fits = a >= 0
            else:
                a, b = i[open_] + out[open_], j[open_] + out[open_]
                fits = b + width <= n
            open_, a, b = open_[fits], a[fits], b[fits]
            open_ = open_[rank[a] == rank[b]]
            out[open_] += width
            if k < len(ranks) - 1:
                break
    return out


# --- runs -----------------------------------------------------------------

def stretches(words: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of a batch that can hold runs."""
    width = max(least // 2, 1)
    grams = gram_hash(mix64(words.astype(np.uint64) + np.uint64(1)), width)
    inside = np.flatnonzero(owner[:len(grams)] == owner[width - 1:]) if len(grams) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = mix64(grams[inside] + mix64(owner[inside].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = inside[twice]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    covered = np.cumsum(cover[:-1]) > 0
    new = np.ones(len(words), bool)
    new[1:] = owner[1:] != owner[:-1]
    held = covered.copy()
    held[1:] &= covered[:-1] & ~new[1:]
    held[:1] = False
    start = np.flatnonzero(covered & ~held)
    after = np.append(held[1:], False)
    return start, np.flatnonzero(covered & ~after) + 1


def find_runs(words: np.ndarray, owner: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (first word, length, period) of the runs in a batch of texts, sorted
    by first word and period: `words` are numbers, `owner` the text of each."""
    start, end = stretches(words, owner, least)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    counts = end - start
    slot = np.cumsum(counts + 1) - counts  # a separator before each stretch
    n = int(counts.sum()) + len(start) + 1
    to = np.repeat(slot - start, counts) + np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    origin = np.full(n, -1, np.int64)
    origin[to] = np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    real = origin >= 0
    letters, rank = np.unique(words[origin[real]], return_inverse=True)
    text = np.zeros(n, np.int64)
    text[real] = rank + 1
    flipped = np.where(real, len(letters) + 1 - text, 0)
    apart = text.copy()
    apart[~real] = len(letters) + 1 + np.arange(n - int(real.sum()))  # separators differ from each other
    apart = np.unique(apart, return_inverse=True)[1].astype(np.int64)
    ranks = block_ranks(apart, int(counts.max()))

    places = np.flatnonzero(real)
    root = np.concatenate([places, places])
    period = np.concatenate([lyndon(text)[places], lyndon(flipped)[places]])
    key = np.unique(root * n + period)
    root, period = key // n, key % n
    fits = root + period < n
    root, period = root[fits], period[fits]
    right = extension(ranks, root, root + period, back=False)
    left = extension(ranks, root, root + period, back=True)
    length = left + period + right
    good = (length >= 2 * period) & (length >= least)
    found = np.stack([origin[(root - left)[good]], length[good], period[good]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    new = np.ones(len(found), bool)  # a run has roots in both orders, and one for each period
    new[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 2] != found[:-1, 2])
    return found[new]


def _cut(texts: list[str | None], least: int) -> Iterator[tuple[int, list, str]]:
    """Of each text: number of words, runs, text without repeats."""
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    number: dict[bytes, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    firsts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(split)), sizes)
    runs = find_runs(words, owner, least)
    text_of = owner[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    bounds = np.searchsorted(text_of, np.arange(len(split) + 1))
    for k, ws in enumerate(split):
        own = runs[bounds[k]:bounds[k + 1]]
        if len(own):
            first = own[:, 0] - firsts[k]
            gone = np.zeros(len(ws) + 1, np.int64)
            np.add.at(gone, first + own[:, 2], 1)
            np.add.at(gone, first + own[:, 1], -1)
            keep = np.cumsum(gone[:-1]) <= 0
            ws_kept = [w for w, kept in zip(ws, keep.tolist(), strict=True) if kept]
            rows = [{"start": s, "length": n, "period": p}
                    for s, n, p in zip(first.tolist(), own[:, 1].tolist(), own[:, 2].tolist(), strict=True)]
        else:
            ws_kept, rows = ws, []
        yield len(ws), rows, b" ".join(ws_kept).decode("utf-8", "surrogatepass")


def collapse_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: the runs by start, then
    period, and the words that no run holds after its first period, joined by
    one space."""
    kind = docs.schema[id_col].dataType
    item = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            a = 0
            while a < len(texts):  # bounded work: about RUN_BYTES of text, one text at least
                z, size = a, 0
                while z < len(texts) and (z == a or size + len(texts[z] or "") <= RUN_BYTES):
                    size += len(texts[z] or "")
                    z += 1
                n_words, rows, kept = zip(*_cut(texts[a:z], least), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array(n_words, pa.int64()), pa.array(rows, item), pa.array(kept, pa.string())],
                    names=["id", "n_words", "runs", "collapsed"])
                a = z

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {kind.simpleString()}, n_words long, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", id_col)


# --- the contract's texts and digests -------------------------------------

def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's periodic tails: of one id in ten by
    crc32, the words from a on repeat the first p of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("_chosen"), g.alias("_g"),
                         F.when(h % 10 == 0, words).alias("_words"))
    n = F.size("_words").cast("long")
    a = F.pmod(F.col("_g"), n)
    cut = chosen.withColumn("_a", F.when(n > 0, a)).withColumn(
        "_p", F.when(n > 0, 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(
        "_words", (F.when(i >= F.col("_a"), F.col("_a") + (i - F.col("_a")) % F.col("_p")).otherwise(i) + 1).cast("int")))
    return cut.select("doc_id", F.when(F.col("_chosen") & (n > 0), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the rows of collapse_runs()."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line: Column = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return (found.withColumn("_best", best)
            .select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
                    (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
                    (-F.col("_best.period")).alias("period"),
                    F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
