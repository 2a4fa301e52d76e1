r"""Benchmark decontamination with a distributed positional inverted index.

Every benchmark item is cut into windows of 13 consecutive words (an item of
fewer words is one window).  The documents are split into words once, and the
postings (document, position, number of the word) of the benchmark's vocabulary
are written as a table, the index; all that follows reads postings, not texts:

1. a window's words are ranked by their number of postings, rarest first;
2. the postings of the rarest word, shifted by its offset in the window, are
   the candidate starts;
3. they are intersected with the postings of the next rarest word, which must
   stand near the start; documents without a start left have done, and in the
   others the third and fourth word must do the same: proximity matches;
4. these are intersected with the postings of all words of the window, each
   shifted by its own offset; starts that are in all lists are exact matches.

Each step joins on the document and the word (and the position, or its block),
so a frequent word or a document with many postings is spread, and postings are
first reduced to the words or documents that the step asks for.  The benchmark
side of a join is broadcast only if it has been counted below
`BROADCAST_ROWS`; beyond that the joins are ordinary shuffled joins.

Defined cases: null or empty texts have no words, windows or hits; items
without words are ignored; repeated items each count by their id; rows with a
repeated id are told apart by their text, equal rows have equal results; equal
frequencies go to the smaller offset; empty tables give no rows or no hits;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.licenses import word_array
from auric.llm.textbatch import saved, text_key, written

WINDOW = 13
#: Contaminated: at least one word in this many is hit.
SHARE = 20
#: No word of a text: it stands after the last word of every document, at its number of words.
END, END_TERM = " ", -1
#: The benchmark's side of a join is broadcast up to so many rows (a window takes some 200 bytes).
BROADCAST_ROWS = 200_000
#: Rarest words of a window that must stand near each other, and how near.
NEAR_WORDS = 4
NEAR_SLACK = 6
#: Nearness is looked up by blocks of so many positions.
BLOCK = 32


def small(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, start, words) for every window of every item."""
    cut = items.where(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(size)))
    return cut.select("item_id", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("start"),
                      "words", "len").select(
        "item_id", "start", F.expr("slice(words, start + 1, len)").alias("window"))


def numbered(words: DataFrame) -> DataFrame:
    """The vocabulary (word, term): a number for every distinct word."""
    return saved(words.distinct().select("word", F.monotonically_increasing_id().alias("term")))


def positional_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The postings (doc, at, term) of the vocabulary in all documents, positions
    from 0, as a stored table; a posting END_TERM of every document holds its
    number of words.  `doc` is (doc_id, _text), equal for equal rows."""
    n = vocabulary.count()
    end = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(END_TERM).cast("long").alias("term"))
    doc = F.struct(docs[id_col].alias("doc_id"), text_key(docs[text_col]).alias("_text")).alias("doc")
    words = F.concat(word_array(docs[text_col]), F.array(F.lit(END)))
    return written(docs.select(doc, F.posexplode(words).alias("at", "word"))
                   .join(small(vocabulary.unionByName(end), n), "word").select("doc", "at", "term"))


def ranked_windows(windows: DataFrame, index: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """A row per window: `terms` (offset, term), the rarest as `anchor` and
    `offset`, and its rarest distinct terms as `rare`, the anchor first."""
    n = vocabulary.count()
    counted = vocabulary.join(small(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")), n), "term", "left")
    at = windows.select("item_id", "start", F.posexplode("window").alias("offset", "word"), "window")
    ranked = (at.join(small(counted, n), "word")
              .groupBy("item_id", "start", "window")
              .agg(F.array_sort(F.collect_set(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("by_rarity")))
    return ranked.select(
        F.monotonically_increasing_id().alias("win"), "item_id", F.size("by_rarity").alias("len"),
        F.transform("by_rarity", lambda t: F.struct(t["offset"].alias("offset"), t["term"].alias("term"))).alias("terms"),
        F.col("by_rarity")[0]["term"].alias("anchor"), F.col("by_rarity")[0]["offset"].alias("offset"),
        F.array_distinct(F.transform(F.slice("by_rarity", 1, NEAR_WORDS), lambda t: t["term"])).alias("rare"))


def starts(index: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Starts (doc, win, start) that the postings of each window's rarest word give."""
    lists = windows.select(F.col("anchor").alias("term"), "offset", "win")
    return (index.join(small(lists, n), "term")
            .select("doc", "win", (F.col("at") - F.col("offset")).alias("start")).distinct())


def near_starts(found: DataFrame, postings: DataFrame, windows: DataFrame, n: int, first: int, last: int) -> DataFrame:
    """Those starts near which the window's rarest words number `first` to `last` (from 1) stand."""
    others = F.slice("rare", first, last - first + 1)
    about = found.join(small(windows.select("win", "len", others.alias("others")), n), "win")
    low, high = F.col("start") - NEAR_SLACK, F.col("start") + F.col("len") + (NEAR_SLACK - 1)
    blocks = F.sequence(F.floor(low / BLOCK), F.floor(high / BLOCK))
    need = (about.select("doc", "win", "start", low.alias("low"), high.alias("high"), F.size("others").alias("n_others"),
                         blocks.alias("blocks"), F.explode("others").alias("term"))
            .withColumn("block", F.explode("blocks")).drop("blocks"))
    wanted = windows.select(F.explode(others).alias("term")).distinct()
    there = (postings.join(small(wanted, n * (last - first + 1)), "term", "left_semi")
             .withColumn("block", F.floor(F.col("at") / BLOCK)))
    close = (need.join(there, ["doc", "term", "block"]).where(F.col("at").between(F.col("low"), F.col("high")))
             .groupBy("doc", "win", "start", "n_others").agg(F.count_distinct("term").alias("n"))
             .where("n = n_others").select("doc", "win", "start"))
    return close.unionByName(about.where(F.size("others") == 0).select("doc", "win", "start"))


def postings_of(found: DataFrame, index: DataFrame) -> DataFrame:
    """The postings of those documents that still have a start, as a stored table."""
    left = saved(found.select("doc").distinct())
    return written(index.join(small(left, left.count()), "doc", "left_semi"))


def exact_starts(found: DataFrame, postings: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Those starts at which every word of the window has a posting at its own offset."""
    need = (found.join(small(windows.select("win", "len", "terms"), n), "win")
            .select("doc", "win", "start", "len", F.explode("terms").alias("place"))
            .select("doc", "win", "start", "len", F.col("place.term").alias("term"),
                    (F.col("start") + F.col("place.offset")).alias("at")))
    return (need.join(postings, ["doc", "term", "at"])
            .groupBy("doc", "win", "start", "len").agg(F.count_distinct("at").alias("n"))
            .where("n = len").select("doc", "win", "start"))


def _lookup(docs, benchmark, size, id_col, text_col, item_col, item_text) -> tuple[DataFrame, DataFrame]:
    """The index, and the matches (doc, item_id, start, len, exact, near) found in it."""
    items = benchmark.select(benchmark[item_col].alias("item_id"), word_array(benchmark[item_text]).alias("words"))
    cut = saved(item_windows(items, size))
    vocabulary = numbered(cut.select(F.explode("window").alias("word")))
    index = positional_index(docs, vocabulary, id_col, text_col)
    windows = saved(ranked_windows(cut, index, vocabulary))
    n = windows.count()
    found = saved(starts(index, windows, n))
    close = saved(near_starts(found, index, windows, n, 2, 2))
    postings = postings_of(close, index)
    close = saved(near_starts(close, postings, windows, n, 3, NEAR_WORDS))
    exact = exact_starts(close, postings, windows, n).withColumn("exact", F.lit(True))
    found = (close.join(exact, ["doc", "win", "start"], "left")
             .join(small(windows.select("win", "item_id", "len"), n), "win")
             .select("doc", "item_id", "start", "len", F.coalesce("exact", F.lit(False)).alias("exact"))
             .withColumn("near", ~F.col("exact") & (F.col("len") > NEAR_WORDS))
             .where("exact or near"))
    return index, saved(found)


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Exact and proximity matches: (doc_id, item_id, start, len, exact, near)."""
    _, found = _lookup(docs, benchmark, size, id_col, text_col, item_col, item_text)
    return found.select("doc.doc_id", "item_id", "start", "len", "exact", "near")


def _hit_words(found: DataFrame) -> DataFrame:
    """Words inside any exact match, per document: matches in order of their
    start add what lies beyond the furthest end so far."""
    spans = found.where("exact").groupBy("doc", "start").agg(F.max("len").alias("len"))
    before = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    return (spans.withColumn("new", F.greatest(end - F.greatest("start", reached), F.lit(0)))
            .groupBy("doc").agg(F.sum("new").cast("long").alias("n_hit")))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = SHARE,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its words, hits and items, and the verdict.

    Columns: doc_id, _text (fingerprint of the text), n_words, n_hit,
    n_items, items, items_sha256, n_near_items, contaminated.
    """
    index, found = _lookup(docs, benchmark, size, id_col, text_col, item_col, item_text)
    names = F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string"))))
    items = found.groupBy("doc").agg(names.alias("items"),
                                     F.count_distinct(F.when(F.col("near"), F.col("item_id"))).alias("n_near_items"))
    rows = (index.where(F.col("term") == END_TERM).select("doc", F.col("at").cast("long").alias("n_words"))
            .join(items, "doc", "left").join(_hit_words(found), "doc", "left"))
    items_or_none: Column = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return rows.select(
        "doc.doc_id", "doc._text", "n_words", n_hit.cast("long").alias("n_hit"),
        F.size(items_or_none).cast("long").alias("n_items"), items_or_none.alias("items"),
        F.sha2(F.array_join(items_or_none, ",").cast("binary"), 256).alias("items_sha256"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = (contamination(docs, benchmark).where("contaminated")
           .select(F.col("doc_id").alias("_id"), F.col("_text").alias("_t")).distinct())
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (text_key(docs["text"]) == bad["_t"])
    return docs.join(bad, same, "left_anti")


#: Contract columns in DuckDB's SQL, over relations `deco_docs` and `benchmark`.
DECONTAM_SQL = r"""
deco_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM deco_docs),
deco_items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
deco_windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS n, words[s + 1 : s + least(len(words), 13)] AS w
  FROM (SELECT item_id, words, unnest(range(0, len(words) - least(len(words), 13) + 1)) AS s
        FROM deco_items WHERE len(words) > 0)),
deco_at AS (
  SELECT doc_id, words, unnest(range(0, len(words))) AS s FROM deco_words),
deco_grams AS (
  SELECT a.doc_id, a.s, l.n, a.words[a.s + 1 : a.s + l.n] AS w
  FROM deco_at a, (SELECT DISTINCT n FROM deco_windows) l WHERE a.s + l.n <= len(a.words)),
deco_found AS (
  SELECT DISTINCT g.doc_id, g.s, g.n, w.item_id FROM deco_grams g JOIN deco_windows w ON g.n = w.n AND g.w = w.w),
deco_hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM deco_found) GROUP BY doc_id),
deco_named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM deco_found) GROUP BY doc_id),
deco_rows AS (
  SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
         CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
         coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.words) AS contaminated
  FROM deco_words d LEFT JOIN deco_hits h ON d.doc_id = h.doc_id LEFT JOIN deco_named i ON d.doc_id = i.doc_id)
"""
OP7_SQL = ("WITH deco_docs AS (SELECT doc_id, text FROM documents), " + DECONTAM_SQL
           + "SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM deco_rows")
