"""Mixing sources to target weights by capped water-filling.

Sources share a total of words in proportion to their weights, but none may
be repeated more than `max_epochs` times.  Water-filling raises one level for
all: each round clamps the sources whose share is above their cap and deals
the excess to the others by weight, until none is above.  A round is one
small aggregate over the table of sources.

A source's target is then made of whole repetitions of all its documents and
one fractional repetition: the documents that come first in a seeded order,
up to the one whose middle passes the words that are missing.  The taken
words miss the target by at most half a document plus a word.

No source passes through one task: sizes are summed by (source, hash bucket),
only the one bucket in which a source's cut falls is looked at row by row,
and the cut is a value (the order key of the last document taken), so the
decision on each document is a filter of the scan.

Defined cases: a null source is a source of its own, the last; a null text
has size 0; ties and repeated rows share an order key and are taken together;
an empty table mixes to an empty one; a source without words has target 0;
other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.textbatch import saved

SEED = "auric-mix"
MAX_EPOCHS = 3
#: Hex digits of the order key that number the buckets of a source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    r"""Number of words [^\x20\x09-\x0D]+ (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded place of a document in its source's order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Sources with their place by code point, null last, counted from 0.

    The sort is a range partitioning; places come from the number of rows in
    the partitions before, so no task sees all sources.
    """
    ordered = saved(sizes.orderBy(F.col("source").asc_nulls_last())
                    .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (ordered.withColumn("_part", part).join(before, "_part")
            .withColumn("place", F.col("_before") + F.col("_at") - F.shiftleft("_part", 33))
            .drop("_at", "_part", "_before"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add `target` to (source, size, weight): its share of all sizes, capped."""
    cap = F.lit(max_epochs) * F.col("source_size")
    level, clamped = None, -1
    while True:
        full = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        total, filled, weight, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))),
            F.count(F.when(full, 1))).first()
        if n == clamped or not weight:
            break
        level, clamped = (total - (filled or 0)) / weight, n
    return sources.withColumn(
        "target", F.least(cap.cast("double"), F.lit(float(level or 0.0)) * F.col("weight")))


def plan_mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (key, source, size, ord, id): one row per source with its target,
    its whole repetitions and the cut of its fractional one."""
    by_bucket = saved(docs.groupBy("key", F.substring("ord", 1, BUCKET_DIGITS).alias("bucket"))
                      .agg(F.first("source").alias("source"), F.sum("size").alias("bucket_size")))
    sizes = by_bucket.groupBy("key").agg(F.first("source").alias("source"),
                                         F.sum("bucket_size").alias("source_size"))
    ranked = ranked_sources(sizes).withColumn("weight", (F.col("place") % 3 + 1).cast("long"))
    target = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    plan = saved(water_fill(saved(ranked), max_epochs)
                 .withColumn("whole", whole)
                 .withColumn("missing", target - F.col("whole") * F.col("source_size")))
    running = Window.partitionBy("key").orderBy("bucket")
    cut_bucket = (by_bucket.drop("source")
                  .withColumn("before", F.sum("bucket_size").over(running) - F.col("bucket_size"))
                  .join(plan.where("missing > 0").select("key", "missing"), "key")
                  .where("before <= missing and before + bucket_size > missing")
                  .select("key", "bucket", "before", "missing"))
    order = F.struct("ord", "size", "id")
    in_order = (Window.partitionBy("key", "bucket").orderBy("ord", "size", "id")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = (docs.withColumn("bucket", F.substring("ord", 1, BUCKET_DIGITS))
           .join(cut_bucket, ["key", "bucket"])
           .withColumn("through", F.col("before") + F.sum("size").over(in_order))
           .where("2 * through - size <= 2 * missing")
           .groupBy("key").agg(F.max(order).alias("cut")))
    edge = cut_bucket.select("key", F.col("bucket").alias("edge"))
    return saved(plan.join(edge, "key", "left").join(cut, "key", "left")
                 .select("key", "source_size", "target", "whole", "edge", "cut"))


def take(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the copies that the mix takes to rows with (key, size, ord, id)."""
    bucket = F.substring("ord", 1, BUCKET_DIGITS)
    chosen = F.col("edge").isNotNull() & (
        (bucket < F.col("edge"))
        | ((bucket == F.col("edge")) & F.coalesce(F.struct("ord", "size", "id") <= F.col("cut"), F.lit(False))))
    return (docs.join(plan, "key")
            .withColumn("copies", F.col("whole") + F.coalesce(chosen, F.lit(False)).cast("long")))


def described(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", seed: str = SEED) -> list[Column]:
    """The columns that planning and taking need."""
    return [source_key(docs[source_col]).alias("key"), docs[source_col].alias("source"),
            word_count(docs[text_col]).alias("size"), order_key(docs[id_col], seed).alias("ord"),
            docs[id_col].alias("id")]


def mix_sizes(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: (doc_id, size, source_size, target, taken, copies)."""
    narrow = saved(docs.select(*described(docs, seed=seed)))
    return take(narrow, plan_mix(narrow, max_epochs)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The documents that the mix takes, with all their columns and `copies`
    (how often each is to be repeated).  The decision rides on the scan: only
    the table of sources is joined."""
    plan = plan_mix(saved(docs.select(*described(docs, seed=seed))), max_epochs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *described(docs, seed=seed))
    return take(rows, plan).where("copies > 0").select("_row.*", "copies")


#: The same mix in DuckDB's SQL over a relation `mix_input(doc_id, text, source)`.
MIX_SQL = """
mix_docs AS (
  SELECT doc_id, source, md5('auric-mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM mix_input),
mix_sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM mix_docs GROUP BY source),
mix_levels AS (
  SELECT source, source_size, weight, 3 * source_size AS cap, 3.0 * source_size / weight AS ratio,
         sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER w, 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight,
         row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS clamped
  FROM mix_sources
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
mix_level AS (
  SELECT arg_min(CAST(total - filled AS DOUBLE) / CAST(open_weight AS DOUBLE), clamped)
           FILTER (ratio > CAST(total - filled AS DOUBLE) / CAST(open_weight AS DOUBLE)) AS level
  FROM mix_levels),
mix_targets AS (
  SELECT s.source, source_size, least(CAST(3 * source_size AS DOUBLE), coalesce(level, 0) * weight) AS target
  FROM mix_sources s, mix_level),
mix_plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole
  FROM mix_targets),
mix_order AS (
  SELECT d.*, p.source_size, p.target, p.whole,
         CAST(floor(p.target) AS BIGINT) - p.whole * p.source_size AS missing,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) AS through
  FROM mix_docs d JOIN mix_plan p ON d.source IS NOT DISTINCT FROM p.source),
mix_taken AS (
  SELECT doc_id, size, source_size, target,
         CAST(whole + CASE WHEN missing > 0 AND 2 * through - size <= 2 * missing THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM mix_order)
"""
OP4_SQL = f"""WITH mix_input AS (SELECT doc_id, text, source FROM documents), {MIX_SQL}
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM mix_taken"""
