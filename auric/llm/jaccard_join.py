r"""N-gram Jaccard join: which documents share at least 80 % of their word 5-grams.

A document's set holds its distinct 5-word shingles (64-bit hashes); with
fewer words, the whole sequence is its one shingle.  Documents with equal
sets are one *node*.  Two nodes link when 100 * |A and B| >= 80 * |A or B|.

1. In any common order, two sets that link share at least 1 + e shingles
   among the first n - ceil(0.8 n) + 1 + e of each, where e is a tenth of the
   smaller size.  The order puts shingles that are frequent in a sample of the
   texts last (a bounded list that decides only how fast this is, never the
   result) and the others by hash.  Nodes that share such a shingle form a
   *group* (groups with the same members are one), and nodes that share too
   few of theirs with any others are left out.
2. Rounds of contraction: each member of a group is compared with one seeded
   centre of it, and what links is joined to one component.  This takes a
   comparison per node and round, also in a group of very many near copies.
3. Groups whose members are still in several components are *open*.  Nodes
   that share too few shingles in open groups are left out, and each node
   leaves its weakest groups as long as no link can be lost.  In small groups
   the pairs that share enough are compared; larger ones are gathered into
   blocks, and each block is searched with a *signature tree*: its nodes hold the bitmaps of their sets combined
   by OR and their range of sizes, and a dual traversal leaves out pairs of
   nodes whose largest possible overlap is too small for their sizes or whose
   members are in one component already.  What is too large for a block is
   cut into chunks, and every pair of chunks is searched.

So every pair that may link is compared or already connected, and components
are exact.

4. Every two nodes of a component meet once more in a signature tree, which
now leaves out pairs by size and overlap only, and each adds up the copies of
those that it links with.  With the copies of its own node that is a
document's number of links.  This takes the square of a component's nodes in
comparisons, dealt out by pairs of chunks, but a row a node and chunk.

Texts travel once, to the documents of groups; links, components
and sets stay distributed.

Defined cases: null and empty texts and texts of white space have no shingles
and link with nothing; rows with equal texts are in one component; repeated
ids are separate rows, and a component is named by the smallest id of any of
its rows; a null id gets no component of its own but that of its set, if
another row names it, else null; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.textbatch import LOWER, gram_hash, mix64, prefix_hash, runs, saved, shuffles_dropped, span_hash, text_key, words, written

SHINGLE = 5
#: One shingle in so many is added to a prefix.
EXTRA = 10
#: Percent of the union that two sets share at least.
PERCENT = 80
#: One text in so many is looked at for frequent shingles; a shingle is
#: frequent from so many texts of the sample on; so many are listed at most.
SAMPLE, FREQUENT, MAX_FREQUENT = 16, 4, 1 << 17
#: Rounds of contraction after the first, for groups with more members than SMALL;
#: the pairs of groups that are open after them and no larger are listed.
ROUNDS, SMALL = 3, 8
#: Passes that leave out nodes with too few shingles in groups that are open.
PASSES = 2
#: Members of a chunk of a large group, and sets of a leaf of the tree.
CHUNK, LEAF = 4000, 32
#: Sets and shingles of a chunk of a large component whose links are counted.
COUNT_CHUNK, COUNT_SHINGLES = 1000, 1 << 19
#: Prefix shingles that a task deals to the buckets at a time.
FLUSH_ROWS = 1 << 19
BUCKETS_PER_PARTITION = 8


# --- sets -----------------------------------------------------------------

def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a run's texts and their text numbers, sorted by both."""
    n_texts = len(offsets) - 1
    data = LOWER[data]
    start, end, text = words(data, offsets)
    word = span_hash(prefix_hash(data), start, end)
    grams = gram_hash(word, SHINGLE)
    inside = text[:len(grams)] == text[SHINGLE - 1:] if len(grams) else np.zeros(0, bool)
    grams, owner = grams[inside], text[:len(inside)][inside]
    count = np.bincount(text, minlength=n_texts)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        first = np.searchsorted(text, short)
        whole = [gram_hash(word[f:f + count[t]], int(count[t]))[0] ^ np.uint64(count[t]) for f, t in zip(first, short, strict=True)]
        grams = np.concatenate([grams, np.array(whole, np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], owner[new]


def node_keys(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set (the sets end to end)."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(grams ^ np.uint64(0x5851F42D4C957F2D)))])
        ends = np.cumsum(sizes)
        return mix64(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.minimum(n + (-(PERCENT * n)) // 100 + 1 + n // EXTRA, n)


def least_shared(n: Column) -> Column:
    """Prefix shingles that a set of a link shares at least: one and the extra
    ones of a partner of the least size."""
    return 1 + F.floor(F.floor(PERCENT * n / 100) / EXTRA)


def _described(frequent: np.ndarray, weight: np.ndarray, column: pa.Array) -> Iterator[tuple]:
    """Of each run: first row, end row, set sizes, node keys, and of every prefix shingle its hash, text and whether it is frequent."""
    for a, b, data, offsets in runs(column):
        grams, owner = shingles(data, offsets)
        sizes = np.bincount(owner, minlength=b - a)
        keys = node_keys(grams, sizes)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            often = np.where(frequent[at] == grams, weight[at], 0)
        else:
            often = np.zeros(len(grams), np.int64)
        order = np.lexsort((grams, often, owner))
        place = np.arange(len(grams)) - (np.cumsum(sizes) - sizes)[owner]
        chosen = order[place < prefix_length(sizes)[owner]]
        yield a, b, sizes, keys, grams[chosen], owner[chosen], often[chosen] > 0


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many sampled distinct texts with their counts: at most MAX_FREQUENT, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offsets in runs(b.column(0)):
                g, n = np.unique(shingles(data, offsets)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["g", "n"])

    with shuffles_dropped(docs.sparkSession):
        sample = docs.where((F.pmod("_text", F.lit(SAMPLE)) == 0) & F.col("text").isNotNull()).dropDuplicates(["_text"])
        rows = (sample.select("text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "g").limit(MAX_FREQUENT).toPandas())
    g = rows["g"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(g)
    return g[order], rows["n"].to_numpy(np.int64)[order]


def document_nodes(docs: DataFrame, frequent) -> DataFrame:
    """(doc_id, _text, n_shingles, node, frequent): the set of every document,
    and the frequent shingles of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, sizes, keys, grams, owner, often in _described(*frequent.value, b.column(2)):
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[often], minlength=z - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array(sizes.astype(np.int64)),
                     pa.array(keys, mask=sizes == 0),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[often].view(np.int64)))],
                    names=["doc_id", "_text", "n_shingles", "node", "frequent"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_text", "text").mapInArrow(
        run, f"doc_id {kind}, _text long, n_shingles long, node long, frequent array<long>")


# --- groups ---------------------------------------------------------------

def rare_groups(docs: DataFrame, frequent, partitions: int) -> DataFrame:
    """(group, node, shared): nodes that share rare prefix shingles, and how
    many the group stands for.

    Each task packs (40 bits of the shingle, node) by hash bucket, so a bucket
    travels as a few binary rows; the bucket's task sorts it and keeps the
    groups of two nodes and more, once for each list of members.
    """
    buckets = partitions * BUCKETS_PER_PARTITION

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            g, k = (np.concatenate([h[i] for h in held]) for i in range(2))
            to = (g >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(to, kind="stable")
            g, k, to = g[order], k[order], to[order]
            cut = np.flatnonzero(np.diff(to, prepend=to[:1] + np.uint64(1)))
            parts = (g.astype(np.uint32), (g >> np.uint64(32)).astype(np.uint8), k)
            return pa.RecordBatch.from_arrays(
                [pa.array(to[cut].astype(np.int32))]
                + [pa.array([x[i:j].tobytes() for i, j in zip(cut, [*cut[1:], len(to)], strict=True)], pa.binary()) for x in parts],
                names=["bucket", "low", "high", "node"])

        for b in batches:
            for a, z, sizes, keys, grams, owner, often in _described(*frequent.value, b.column(0)):
                new = np.zeros(z - a, bool)  # copies within a task are sent once
                for i in np.flatnonzero(sizes):
                    if (key := int(keys[i])) not in seen:
                        seen.add(key)
                        new[i] = True
                rare = ~often & new[owner]
                if rare.any():
                    held.append((grams[rare], keys[owner[rare]]))
                    size += int(rare.sum())
                if size > FLUSH_ROWS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: dict[int, list] = {}
        for b in batches:
            for bucket, *columns in zip(*(c.to_pylist() for c in b.columns), strict=True):
                packed.setdefault(bucket, []).append(columns)
        for bucket in list(packed):
            rows = packed.pop(bucket)
            g = np.concatenate([np.frombuffer(r[0], np.uint32) for r in rows]).astype(np.uint64)
            g |= np.concatenate([np.frombuffer(r[1], np.uint8) for r in rows]).astype(np.uint64) << np.uint64(32)
            k = np.concatenate([np.frombuffer(r[2], np.int64) for r in rows])
            order = np.lexsort((k, g))
            g, k = g[order], k[order]
            new = np.ones(len(g), bool)  # copies of a set in other tasks
            new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
            g, k = g[new], k[new]
            first = np.flatnonzero(np.diff(g, prepend=g[:1] + np.uint64(1)))
            count = np.diff(np.append(first, len(g)))
            with np.errstate(over="ignore"):
                members = np.add.reduceat(mix64(k.view(np.uint64)), first)
            name = mix64(members + count.astype(np.uint64)).view(np.int64)
            many = np.flatnonzero(count > 1)
            if not len(many):
                continue
            name, once, shared = np.unique(name[many], return_index=True, return_counts=True)
            first, count = first[many[once]], count[many[once]]
            row = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name, count)), pa.array(k[row]), pa.array(np.repeat(shared, count))],
                                             names=["group", "node", "shared"])

    return (docs.select("text").mapInArrow(pack, "bucket int, low binary, high binary, node binary")
            .repartition(partitions, "bucket").mapInArrow(group, "group long, node long, shared long")
            .groupBy("group", "node").agg(F.sum("shared").alias("shared")))


def frequent_groups(nodes: DataFrame) -> DataFrame:
    """(group, node, shared): nodes that share a frequent prefix shingle."""
    return nodes.select(F.explode("frequent").alias("group"), "node", F.lit(1).cast("long").alias("shared"))


def promising(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """The groups' nodes that share enough, with their size class: sizes that
    may link are at most two classes apart (a class spans less than 1.25 ** 0.5)."""
    enough = (groups.groupBy("node").agg(F.sum("shared").alias("shared")).join(nodes.select("node", "n_shingles"), "node")
              .where(F.col("shared") >= least_shared(F.col("n_shingles")))
              .select("node", F.floor(F.log("n_shingles") / F.log(F.lit(1.118))).cast("int").alias("size")))
    kept = groups.join(enough, "node")
    several = kept.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return kept.join(several, "group")


# --- links and components -------------------------------------------------

def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted) link."""
    if min(len(a), len(b)) * 100 < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                  for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(sets.withColumnsRenamed({"node": "a", "set": "x"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "set": "y"}), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b): the smallest node that
    can be reached.  Each round hooks nodes to their smallest neighbour,
    follows the hooks to their roots, and contracts the edges to roots, which
    leaves at most half of the nodes."""
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = written(edges.where("a <> b").select(*ordered).distinct())
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp"))
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up")))
        moved = True
        while moved:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = written(up.join(above, "up").select("node", "top", (F.col("up") != F.col("top")).alias("moved")))
            up = jumped.select("node", F.col("top").alias("up"))
            moved = jumped.where("moved").limit(1).count() > 0
        to = up.select(F.col("node").alias("comp"), "up")
        labels = written(labels.join(to, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))
        of = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}"))  # noqa: E731, B023
        edges = written(edges.join(of("a"), "a").join(of("b"), "b").where("up_a <> up_b")
                      .select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).select(*ordered).distinct())
    return labels


def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, comp) after new links (a, b) between nodes."""
    of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    change = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return written(comps.join(change, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))


def centre_pairs(groups: DataFrame, seed: int) -> DataFrame:
    """One pair (a, b) for each node that is in a group with nodes of other
    components: with the group's seeded centre, among sizes that may link."""
    band = F.floor((F.col("size") + 2 * seed) / 4)
    rank = F.xxhash64("node", F.lit(seed))
    placed = groups.withColumn("band", band)
    centres = (placed.groupBy("group", "band")
               .agg(F.min_by(F.struct("node", "comp", "size"), rank).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
               .where("lo <> hi").select("group", "band", "c"))
    return (placed.join(centres, ["group", "band"]).where("comp <> c.comp and abs(size - c.size) <= 2")
            .groupBy(F.col("node").alias("a")).agg(F.min_by("c.node", F.xxhash64("c.node", F.lit(seed))).alias("b")))


# --- signature trees ------------------------------------------------------

class Block:
    """The sets of a block, with their elements numbered from 0, and the
    components that are known or found within it."""

    def __init__(self, sets: list[np.ndarray], comps: list[int]):
        self.sizes = np.array([len(x) for x in sets])
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        universe, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.flags = np.zeros(len(universe), bool)
        bits = 1 << int(np.ceil(np.log2(4 * max(self.sizes.max(), 16))))
        self.bit = (universe >> np.uint64(7)).astype(np.int64) & (min(bits, 1 << 15) - 1)
        self.bits = min(bits, 1 << 15)
        self.parent = {c: c for c in comps}
        self.comps = comps

    def root(self, i: int) -> int:
        c = self.comps[i]
        while self.parent[c] != c:
            self.parent[c] = self.parent[self.parent[c]]
            c = self.parent[c]
        return c

    def elements(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i]:self.ends[i + 1]]

    def count(self, left: list[int], right: list[int], copies: np.ndarray, links: np.ndarray) -> None:
        """Adds the copies of every linking set of two leaves to each other's links."""
        elements = np.concatenate([self.elements(j) for j in right])
        n = self.sizes[right]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        right_rows = np.array(right)
        for i in left:
            own = self.elements(i)
            self.flags[own] = True
            both = np.add.reduceat(self.flags[elements], starts, dtype=np.int64)
            self.flags[own] = False
            found = right_rows[100 * both >= PERCENT * (len(own) + n - both)]
            if left is right:
                links[i] += copies[found].sum() - copies[i]  # not with itself; the others' turn comes
            else:
                links[i] += copies[found].sum()
                links[found] += copies[i]

    def tree(self, rows: list[int]) -> dict:
        """A binary tree over the sets in order of size.  Its nodes hold the OR
        of their sets' bitmaps, the range of sizes, and the most elements of
        one set that share a bit with another."""
        level = []
        rows = [rows[i] for i in np.argsort(self.sizes[rows], kind="stable")]
        for at in range(0, len(rows), LEAF):
            part, bits, spare = rows[at:at + LEAF], np.zeros(self.bits // 8, np.uint8), 0
            for r in part:
                flags = np.zeros(self.bits, bool)
                flags[self.bit[self.elements(r)]] = True
                bits |= np.packbits(flags)
                spare = max(spare, int(self.sizes[r]) - int(flags.sum()))
            level.append({"rows": part, "bits": bits, "lo": int(self.sizes[part].min()), "hi": int(self.sizes[part].max()),
                          "spare": spare, "parts": ()})
        while len(level) > 1:
            odd = level[len(level) - len(level) % 2:]
            level = [{"rows": x["rows"] + y["rows"], "bits": x["bits"] | y["bits"], "lo": min(x["lo"], y["lo"]),
                      "hi": max(x["hi"], y["hi"]), "spare": max(x["spare"], y["spare"]), "parts": (x, y)}
                     for x, y in zip(level[::2], level[1::2], strict=False)] + odd
        return level[0]

    def compare(self, left: list[int], right: list[int]) -> Iterator[tuple[int, int]]:
        """Links between two leaves that join components."""
        elements = np.concatenate([self.elements(j) for j in right])
        starts = np.concatenate([[0], np.cumsum(self.sizes[right])[:-1]])
        n = self.sizes[right]
        for i in left:
            own = self.elements(i)
            self.flags[own] = True
            both = np.add.reduceat(self.flags[elements], starts, dtype=np.int64)
            self.flags[own] = False
            for q in np.flatnonzero(100 * both >= PERCENT * (len(own) + n - both)):
                a, b = self.root(i), self.root(right[q])
                if a != b:
                    self.parent[a] = b
                    yield i, right[q]


def _may_link(x: dict, y: dict) -> bool:
    """Whether some sets of two nodes can overlap enough for their sizes."""
    if x["hi"] * 100 < PERCENT * y["lo"] or y["hi"] * 100 < PERCENT * x["lo"]:
        return False
    most = int(np.bitwise_count(x["bits"] & y["bits"]).sum()) + min(x["spare"], y["spare"])
    return most * (100 + PERCENT) >= PERCENT * (x["lo"] + y["lo"])


def leaf_pairs(block: Block, left: list[int], right: list[int] | None = None, done=None) -> Iterator[tuple[list[int], list[int]]]:
    """The pairs of leaves (across two chunks, if given) that may hold links;
    done(rows, rows) tells which pairs of nodes need no look any more."""
    tree = block.tree(left)
    stack = [(tree, tree if right is None else block.tree(right))]
    while stack:
        x, y = stack.pop()
        if done and done(x["rows"], y["rows"]):
            continue
        if x is not y and not _may_link(x, y):
            continue
        if x is y and x["parts"]:
            a, b = x["parts"]
            stack += [(a, b), (b, b), (a, a)]  # within the parts first
        elif x["parts"] and (not y["parts"] or len(x["rows"]) >= len(y["rows"])):
            stack += [(p, y) for p in x["parts"]]
        elif y["parts"]:
            stack += [(x, p) for p in y["parts"]]
        else:
            yield x["rows"], y["rows"]


def tree_links(sets: list[np.ndarray], comps: list[int], left: list[int] | None = None, right: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join all components of a block (across two chunks, if given) that links join."""
    block = Block(sets, comps)
    one = lambda x, y: len({block.root(i) for i in x} | {block.root(i) for i in y}) == 1
    chunks = (left, right) if left and right else (list(range(len(sets))),)
    return [pair for x, y in leaf_pairs(block, *chunks, done=one) for pair in block.compare(x, y)]


def tree_counts(sets: list[np.ndarray], copies: np.ndarray, left: list[int], right: list[int] | None = None) -> np.ndarray:
    """Of each set, the copies of the others that it links with (only across two chunks, if given)."""
    block, links = Block(sets, list(range(len(sets)))), np.zeros(len(sets), np.int64)
    for x, y in leaf_pairs(block, left, right):
        block.count(x, y, copies, links)
    return links


def block_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) within each block of (block, side, node, comp, set); a
    block of two chunks has sides 0 and 1 and only links across are sought."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def search() -> pa.RecordBatch:
            sets = [np.frombuffer(r[4], np.uint64) for r in held]
            sides = [[i for i, r in enumerate(held) if r[1] == s] for s in (0, 1)]
            found = tree_links(sets, [r[3] for r in held], *(sides if sides[1] else (None, None)))
            return pa.RecordBatch.from_arrays([pa.array([held[i][2] for i, _ in found], pa.int64()),
                                               pa.array([held[j][2] for _, j in found], pa.int64())], names=["a", "b"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != now:
                    if len(held) > 1:
                        yield search()
                    now, held = row[0], []
                held.append(row)
        if len(held) > 1:
            yield search()

    return (rows.select("block", "side", "node", "comp", "set").repartition("block").sortWithinPartitions("block")
            .mapInArrow(run, "a long, b long"))


def open_groups(groups: DataFrame, comps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(group, node, shared, comp, least, size): what is left of the groups for
    links between components.

    Two nodes of different components that link share enough prefix shingles,
    in groups that have several components among sizes that may link; so nodes
    that share too few in such groups have no link to find.  Fewer nodes close
    further groups.  A size class spans more than 1.25 ** 0.5 here: sizes that
    may link are at most two apart."""
    n = F.col("n_shingles")
    size = F.floor(F.log(n) / F.log(F.lit(1.12))).cast("int")
    rows = written(groups.join(comps, "node").join(nodes.select("node", least_shared(n).alias("least"), size.alias("size")), "node"))
    for _ in range(PASSES):
        several = (rows.groupBy("group", "size").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .select("group", F.explode(F.sequence(F.col("size") - 2, F.col("size") + 2)).alias("size"), "lo", "hi")
                   .groupBy("group", "size").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi"))
        rows = rows.join(several.select("group", "size"), ["group", "size"])
        enough = rows.groupBy("node").agg(F.sum("shared").alias("s"), F.first("least").alias("l")).where("s >= l").select("node")
        rows = written(rows.join(enough, "node"))
    return rows


def strongest(rows: DataFrame) -> DataFrame:
    """The open groups without the weakest of each node: those that stand for
    the fewest shingles, the ones with most members first, up to one shingle
    less than a link needs.

    The order is the same for all nodes, and two nodes that link share as much
    as either needs, so the last group that they share stays for both.  What
    goes are mostly shingles that unrelated texts share by chance.  These would
    hang clusters together, the more so the larger the corpus is."""
    members = rows.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    order = Window.partitionBy("node").orderBy("shared", F.desc("members"), "group").rowsBetween(Window.unboundedPreceding, 0)
    left = rows.join(members, "group").withColumn("upto", F.sum("shared").over(order)).where("upto >= least").drop("members", "upto")
    spans = left.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return written(left.join(spans.where("lo <> hi").select("group", "members"), "group"))


def small_group_pairs(small: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes of small groups that share enough in all open groups."""
    of = lambda x: small.select("group", F.col("node").alias(x), F.col("comp").alias(f"comp_{x}"), F.col("size").alias(f"size_{x}"))
    pairs = (of("a").join(of("b"), "group").where("a < b and comp_a <> comp_b and abs(size_a - size_b) <= 2")
             .select("a", "b").distinct())
    both = (pairs.join(rows.select(F.col("node").alias("a"), "group", "shared", F.col("least").alias("least_a")), "a")
            .join(rows.select(F.col("node").alias("b"), "group", F.col("least").alias("least_b")), ["b", "group"]))
    return written(both.groupBy("a", "b").agg(F.sum("shared").alias("s"), F.max(F.greatest("least_a", "least_b")).alias("l"))
                   .where("s >= l").select("a", "b"))


def open_blocks(groups: DataFrame) -> DataFrame:
    """(block, side, node, comp) for the groups (group, node, comp) with
    several components, so that every two nodes of a group meet in a block.

    Groups that hang together through their nodes form a cluster.  A cluster
    is a block, or where it is large one for every pair of its chunks; where
    its groups have fewer rows than that in all, each group is treated so.
    """
    spans = groups.groupBy("group").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("node").alias("a")).where("lo <> hi")
    rows = written(groups.join(spans.select("group", "a"), "group").select("group", "a", "node", "comp"))
    clusters = components(rows.select("a", F.col("node").alias("b")))
    placed = written(rows.drop("a").join(clusters.withColumnRenamed("comp", "cluster"), "node"))
    members = placed.select("cluster", "node", "comp").distinct()
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    by_group = placed.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", chunks)
    by_cluster = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", chunks)
    costs = (by_group.groupBy("cluster").agg(F.sum(F.col("n") * F.col("chunks")).alias("cost"))
             .join(by_cluster, "cluster").withColumn("whole", F.col("n") * F.col("chunks") <= F.col("cost")))
    whole = members.join(costs.where("whole").select("cluster", "chunks"), "cluster").withColumn("name", F.concat(F.lit("c"), "cluster"))
    apart = (placed.join(by_group.join(costs.where("not whole").select("cluster"), "cluster").select("group", "chunks"), "group")
             .withColumn("name", F.concat(F.lit("g"), "group")))
    columns = ["name", "node", "comp", "chunks"]
    dealt = (whole.select(columns).unionByName(apart.select(columns))
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    lo, hi = F.least("chunk", "other"), F.greatest("chunk", "other")
    return dealt.select(F.concat_ws(":", "name", lo, hi).alias("block"), (F.col("chunk") > F.col("other")).cast("int").alias("side"), "node", "comp")


# --- numbers of links -----------------------------------------------------

def block_counts(rows: DataFrame) -> DataFrame:
    """(node, links) from each block of (block, side, across, node, copies, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def search() -> Iterator[pa.RecordBatch]:
            sides = [[i for i, r in enumerate(held) if r[1] == s] for s in (0, 1)]
            if held[0][2] and not all(sides):
                return
            links = tree_counts([np.frombuffer(r[5], np.uint64) for r in held], np.array([r[4] for r in held], np.int64),
                                *(sides if held[0][2] else sides[:1]))
            yield pa.RecordBatch.from_arrays([pa.array([r[3] for r in held], pa.int64()), pa.array(links)], names=["node", "links"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != now:
                    if held:
                        yield from search()
                    now, held = row[0], []
                held.append(row)
        if held:
            yield from search()

    return (rows.select("block", "side", "across", "node", "copies", "set").repartition("block").sortWithinPartitions("block")
            .mapInArrow(run, "node long, links long"))


def link_counts(nodes: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, links): with how many documents of other nodes each node links.

    Links are within components, so every two nodes of one meet once: in the
    block of their component or, where it is large, of their two chunks."""
    members = comps.join(nodes.select("node", "copies", "n_shingles"), "node")
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / COUNT_CHUNK), F.ceil(F.sum("n_shingles") / COUNT_SHINGLES)).cast("int")
    several = members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), chunks.alias("chunks")).where("n > 1").select("comp", "chunks")
    dealt = (members.join(several, "comp").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    rows = dealt.select(F.concat_ws(":", "comp", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"),
                        (F.col("chunk") > F.col("other")).cast("int").alias("side"), (F.col("chunk") != F.col("other")).alias("across"),
                        "node", "copies")
    return block_counts(rows.join(sets, "node")).groupBy("node").agg(F.sum("links").alias("links"))


# --- the join -------------------------------------------------------------

def node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes, from (doc_id, _text, node) of one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, data, offsets in runs(b.column(1)):
                grams, owner = shingles(data, offsets)
                ends = np.searchsorted(owner, np.arange(z - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array([grams[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                    names=["node", "set"])

    want = wanted.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_t"), "node")
    found = docs.join(want, docs["doc_id"].eqNullSafe(want["_id"]) & (docs["_text"] == want["_t"]))
    return found.select("node", "text").mapInArrow(run, "node long, set binary").dropDuplicates(["node"])


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """(doc_id, _text, n_shingles, comp, component_id, n_links) of every
    document; `comp` is the component's key, which tells rows with one id
    apart, n_links (unless it isn't wanted) the other documents it links with."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(docs[id_col].alias("doc_id"), text_key(docs[text_col]).alias("_text"), docs[text_col].alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs))  # MAX_FREQUENT entries at most
    own = saved(document_nodes(docs, frequent))
    # one document stands for each node
    nodes = saved(own.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "_text")).alias("of"), F.min("doc_id").alias("smallest"),
        F.first("frequent").alias("frequent"), F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("copies")))
    groups = saved(rare_groups(docs, frequent, partitions).unionByName(frequent_groups(nodes)))
    for _ in range(2):  # a group that lost its members lends no shared shingles
        groups = saved(promising(groups.select("group", "node", "shared"), nodes))
    wanted = groups.select("node").distinct().join(nodes.select("node", "of.doc_id", "of._text"), "node")
    sets = saved(node_sets(docs, wanted))
    comps = written(sets.select("node", F.col("node").alias("comp")))
    for seed in range(ROUNDS):
        now = groups.join(comps, "node")
        if seed:
            now = now.where(F.col("members") > SMALL)
        pairs = written(centre_pairs(now, seed))
        if not pairs.limit(1).count():
            break
        comps = joined(comps, compare(pairs, sets))
    groups = open_groups(groups.select("group", "node", "shared"), comps, nodes)
    strong = strongest(groups)
    found = compare(small_group_pairs(strong.where(F.col("members") <= SMALL), groups), sets)
    blocks = open_blocks(strong.where(F.col("members") > SMALL).select("group", "node", "comp")).join(sets, "node")
    comps = joined(comps, found.unionByName(block_links(blocks)))
    named = nodes.select("node", "smallest", "copies").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = named.groupBy("comp").agg(F.min("smallest").alias("component_id"))
    of_node = named.join(names, "comp").select("node", "comp", "component_id", "copies")
    columns = ["doc_id", "_text", "n_shingles", "comp",
               F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")]
    if links:
        of_node = of_node.join(link_counts(nodes, comps, sets), "node", "left")
        columns.append(F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"))
    return own.join(of_node, "node", "left").select(*columns)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one of each component (that of the smallest id), with
    all their columns; those without shingles stay."""
    found = saved(similar_documents(docs, links=False))
    first = (found.where("comp is not null").groupBy("comp")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_text")).alias("f")).select("f.doc_id", "f._text"))
    kept = (found.where("comp is null").select("doc_id", "_text").unionByName(first)
            .withColumnsRenamed({"doc_id": "_id", "_text": "_t"}).distinct())
    out = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (text_key(docs["text"]) == kept["_t"]), "left_semi")
    repeated = (found.where("comp is not null").groupBy("doc_id", "_text")
                .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if not repeated.limit(1).count():
        return out
    # rows repeated with their id: one of them stays
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = out.select(F.struct(*[out[c] for c in out.columns]).alias("_row"), out["doc_id"].alias("_id"),
                      F.when(blank, F.monotonically_increasing_id()).otherwise(text_key(out["text"])).alias("_t"), blank.alias("_blank"))
    return rows.dropDuplicates(["_id", "_t", "_blank"]).select("_row.*")
