"""SimHash near duplicates: documents whose 64-bit fingerprints differ in few bits.

A document's features are its shingles of three words (A-Z lowered, repeats
counted, joined by a space; with fewer words, the whole sequence), each hashed
by XXH64 with seed 42.  A bit of the fingerprint is 1 if more than half of the
hashes have it.  Documents link when their fingerprints differ in RADIUS bits
at most.

1. Rows with one fingerprint are one *node* with its number of copies.
2. The bits are dealt in BLOCKS equal blocks.  Two fingerprints that link
   differ in RADIUS blocks at most, so they agree in all the others: for each
   choice of BLOCKS - RADIUS blocks the nodes are grouped by those bits.
3. Groups are cut into *tiles* by population count, and by a hash where one
   population count fills several tiles.  Tiles are compared exactly, by
   exclusive-or and bit counts in numpy, each with itself and with those whose
   population counts are within RADIUS; pairs of tiles further apart are left
   out, since their fingerprints differ in as many bits at least.  A pair that
   agrees in several choices counts in the first alone.
4. Of a pair of tiles travel a spanning forest of its links (at most one row a
   node) and each node's number of links, so a group of very many near copies
   is spread over tasks by pairs of tiles and its links are never listed.
   Components of the forests are found by contraction.

Choosing blocks keeps the work in proportion to the input (a choice fixes
BLOCKS - RADIUS of the blocks, 32 bits); inside a group the comparison is
exact and whole.

Defined cases: null and empty texts and texts of white space have fingerprint
zero and link like any other; repeated rows and ids are separate rows; a
component is named by the smallest id of its rows, null if all are null; other
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.llm.jaccard_join import components
from auric.llm.textbatch import LOWER, runs, words, written

SHINGLE = 3
SEED = 42
#: Bits in which two fingerprints that link differ at most.
RADIUS = 2
#: Blocks of bits; a choice of BLOCKS - RADIUS of them groups the nodes.
BLOCKS = 4
#: Nodes of a tile.  A pair of tiles is compared in strips of so many nodes.
TILE, STRIP = 2048, 256


# --- fingerprints ---------------------------------------------------------

def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a run's texts, and the text of each."""
    data = LOWER[data]
    start, end, text = words(data, offsets)
    # The words laid out again with one space between them: a shingle is a slice.
    size = end - start
    to = np.cumsum(size + 1) - size - 1
    flat = np.full(int((size + 1).sum()), 32, np.uint8)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(to, size) + at] = data[np.repeat(start, size) + at]
    first = np.flatnonzero(text[:-(SHINGLE - 1)] == text[SHINGLE - 1:]) if len(text) >= SHINGLE else np.zeros(0, np.int64)
    last = first + SHINGLE - 1
    count = np.bincount(text, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        head = np.searchsorted(text, short)
        first = np.concatenate([first, head])
        last = np.concatenate([last, head + count[short] - 1])
    whole, digest = flat.tobytes(), xxhash.xxh64_intdigest
    out = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(to[first].tolist(), (to[last] + size[last]).tolist(), strict=True)),
                      np.uint64, len(first))
    owner = text[first]
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


def fingerprints(data: np.ndarray, offsets: np.ndarray, strip: int = 1 << 16) -> np.ndarray:
    """Fingerprint of every text of a run."""
    n = len(offsets) - 1
    hashes, owner = shingle_hashes(data, offsets)
    ones = np.zeros((n, 64), np.int64)
    for a in range(0, len(hashes), strip):
        bits = np.unpackbits(hashes[a:a + strip].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[a:a + strip]
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    most = 2 * ones > np.bincount(owner, minlength=n)[:, None]
    return np.packbits(most, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, data, offsets in runs(b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(fingerprints(data, offsets).view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


# --- tiles ----------------------------------------------------------------

def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Of each choice of blocks, the bits in which linked fingerprints agree."""
    width = 64 // blocks
    block = [((1 << width) - 1) << (width * i) for i in range(blocks)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def tile_pairs(nodes: DataFrame, tile: int) -> DataFrame:
    """(pair, side, choice, fp, copies): the nodes of every pair of tiles that
    has to be compared; side is null where a tile meets itself."""
    masks = block_masks()
    keyed = nodes.select(
        "fp", "copies", F.bit_count("fp").alias("ones"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                            for i, m in enumerate(masks)])).alias("g")).select("fp", "copies", "ones", "g.*")
    counts = keyed.groupBy("choice", "key", "ones").agg(F.count(F.lit(1)).alias("n"))
    # A group's population counts (at most 65) in order, with the number of tiles of each.
    groups = (counts.groupBy("choice", "key")
              .agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("ones", "n"))).alias("levels"))
              .where("total > 1"))
    small = F.col("total") <= tile
    cut = lambda level: F.ceil(level["n"] / F.lit(tile)).cast("int")
    tiles = F.flatten(F.transform("levels", lambda v: F.transform(
        F.sequence(F.lit(0), cut(v) - 1), lambda i: F.struct(v["ones"].alias("ones"), i.alias("part")))))
    near = lambda a: F.filter("tiles", lambda b: (b >= a) & (b["ones"] - a["ones"] <= RADIUS))
    pairs = F.flatten(F.transform("tiles", lambda a: F.transform(near(a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    single = (groups.where(small).select("choice", "key").join(keyed, ["choice", "key"])
              .select(F.xxhash64("choice", "key").alias("pair"), F.lit(None).cast("int").alias("side"), "choice", "key", "fp", "copies"))
    # Large groups: each tile once for every tile that it meets.
    large = (groups.where(~small).select("choice", "key", tiles.alias("tiles")).select("choice", "key", F.explode(pairs).alias("p"))
             .select("choice", "key", "p.a", "p.b", F.xxhash64("choice", "key", "p.a", "p.b").alias("pair")))
    met = large.select("choice", "key", "pair", F.explode(F.when(F.col("a") == F.col("b"), F.array(
        F.struct(F.col("a").alias("t"), F.lit(None).cast("int").alias("side")))).otherwise(F.array(
            F.struct(F.col("a").alias("t"), F.lit(0).alias("side")), F.struct(F.col("b").alias("t"), F.lit(1).alias("side"))))).alias("m"))
    met = met.select("choice", "key", "pair", "m.side", "m.t.ones", "m.t.part")
    parts = F.transform("levels", lambda v: F.struct(v["ones"].alias("ones"), cut(v).alias("parts")))
    placed = (groups.where(~small).select("choice", "key", F.explode(parts).alias("l")).select("choice", "key", "l.*")
              .join(keyed, ["choice", "key", "ones"])
              .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")))
    return single.unionByName(placed.join(met, ["choice", "key", "ones", "part"])
                              .select("pair", "side", "choice", "key", "fp", "copies"))


def first_choice(difference: np.ndarray, choice: np.ndarray | int) -> np.ndarray:
    """Whether no earlier choice of blocks groups the pairs with these differing bits."""
    out = np.ones(len(difference), bool)
    for i, m in enumerate(block_masks()):
        out &= ((difference & np.uint64(m)) != 0) | (i >= choice)
    return out


def within(x: np.ndarray, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many small tiles that lie end to end; `choice` holds the
    tile's number in the upper bits, so that it changes from tile to tile."""
    ends = np.append(np.flatnonzero(np.diff(choice)) + 1, len(x))
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(x))  # rows of the tile from here on
    a, b = [], []
    alive = np.flatnonzero(left > 1)
    step = 1
    while len(alive):
        d = x[alive] ^ x[alive + step]
        hit = np.bitwise_count(d) <= RADIUS
        hit[hit] = first_choice(d[hit], choice[alive[hit]] & 255)
        a.append(alive[hit])
        b.append(alive[hit] + step)
        step += 1
        alive = alive[left[alive] > step]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def between(x: np.ndarray, y: np.ndarray, choice: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two tiles, by strips."""
    for a in range(0, len(x), STRIP):
        d = x[a:a + STRIP, None] ^ y[None, :]
        i, j = np.nonzero(np.bitwise_count(d) <= RADIUS)
        ok = first_choice(d[i, j], choice)
        yield i[ok] + a, j[ok]


class Forest:
    """Spanning forest and weighted degrees of the links among n nodes."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.degree = np.zeros(n, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray, copies: np.ndarray) -> None:
        if not len(a):
            return
        np.add.at(self.degree, a, copies[b])
        np.add.at(self.degree, b, copies[a])
        root = self.root
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            while (root[root] != root).any():
                root = root[root]
            self.root = root
            if np.array_equal(root[a], root[b]):
                return


def compare_tiles(pairs: DataFrame, partitions: int) -> DataFrame:
    """(a, b, n): node a links with n rows of other nodes, and b is the node of
    its tree's root; a row a node and pair of tiles in which it has links."""

    def compared(side: np.ndarray, choice: np.ndarray, x: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        forest = Forest(len(x))
        if (side >= 0).any():  # two tiles
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for a, b in between(x[left], x[right], int(choice[0] & 255)):
                forest.add(left[a], right[b], copies)
        else:
            forest.add(*within(x, choice), copies)
        linked = np.flatnonzero(forest.degree)
        v = x.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(v[linked]), pa.array(v[forest.root[linked]]), pa.array(forest.degree[linked])],
                                          names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by pair: whole pairs are worked on, small ones together."""
        held: list[tuple[np.ndarray, ...]] = []

        def work(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            pair, side, choice, fp, copies = rows
            number = np.cumsum(np.diff(pair, prepend=pair[:1]) != 0)
            two = side >= 0
            alone = ~two
            if alone.any():
                yield compared(side[alone], choice[alone] + (number[alone] << 8), fp[alone], copies[alone])
            for k in np.unique(number[two]):
                own = number == k
                yield compared(side[own], choice[own], fp[own], copies[own])

        for b in batches:
            side = b.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            cols = (b.column(0).to_numpy(), side, b.column(2).to_numpy().astype(np.int64),
                    b.column(3).to_numpy().view(np.uint64), b.column(4).to_numpy())
            held.append(cols)
            if cols[0][0] == cols[0][-1] and held[0][0][0] == cols[0][0]:
                continue  # one pair so far
            rows = tuple(np.concatenate([h[i] for h in held]) for i in range(5))
            cut = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1
            yield from work(tuple(r[:cut] for r in rows))
            held = [tuple(r[cut:] for r in rows)]
        if held:
            yield from work(tuple(np.concatenate([h[i] for h in held]) for i in range(5)))

    return (pairs.repartition(partitions, "pair").sortWithinPartitions("pair", "choice", "key", "side")
            .select("pair", "side", "choice", "fp", "copies").mapInArrow(run, "a long, b long, n long"))


# --- the operator ---------------------------------------------------------

def hex_of(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def similar_fingerprints(docs: DataFrame, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, fingerprint, component_id, n_links) of every row: n_links is the
    number of other rows within RADIUS bits."""
    rows = written(fingerprinted(docs, id_col, text_col))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = written(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")))
    links = written(compare_tiles(tile_pairs(nodes, tile), partitions))
    comps = components(links.select("a", "b"))
    degree = links.groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("n"))
    named = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = (named.join(least, "comp").join(degree, "fp", "left")
             .select("fp", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    out = rows.join(known, "fp").select(
        "doc_id", "fp", hex_of("fp").alias("fingerprint"), "component_id", "n_links")
    return out.withColumnRenamed("doc_id", id_col)
