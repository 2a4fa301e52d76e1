"""The pipeline's three raw feeds, derived from the given parquet tables.

The engine's operators are generic; these functions only give them inputs of
the right shape, computed by Spark from ``events`` and ``conversations`` so
that every query's work grows with the tables:

* :func:`tickets_cdc` — change records (op c/u/d) of support tickets, with the
  ``priority`` field sent as text in three generations (numbers, labels,
  garbage) and an arrival time ``_ingested_at`` after ``event_time``.
* :func:`runtime_events` — agent runtime events with the same two clocks.
* :func:`transcripts` — one row per conversation, turns as ``array<string>``.

The arrival-delay law (5 % late by 1.8–2.95 days, the rest within 5.8 hours)
follows the reference's seed generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; a scan with fewer splits than the cluster has cores
    (one small file = one row group = one task) is spread out first, so the
    per-row derivations below do not run in a single task.  On large inputs
    the scan already has enough splits and this is a no-op."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df


# The arrival-delay law — 50 in 1000 events are late by
# 155,520 s + bucket × 99 s (1.8–2.95 days), the others by bucket × 21 s
# (0–5.8 hours), bucket in 0..999.
LATE_PER_MILLE = 50
LATE_BASE_SECONDS = 155520
LATE_STEP_SECONDS = 99
ON_TIME_STEP_SECONDS = 21


def _late(event_id: Column) -> Column:
    return (event_id * 104729) % 1000 < LATE_PER_MILLE


def _delay_seconds(event_id: Column) -> Column:
    bucket = (event_id * 7919) % 1000
    return (F.when(_late(event_id), F.lit(LATE_BASE_SECONDS) + bucket * LATE_STEP_SECONDS)
             .otherwise(bucket * ON_TIME_STEP_SECONDS))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        _delay_seconds(F.col("event_id")).alias("delay_s"),
        "props",
    )


def _ticket_id(user_id: Column, k: Column) -> Column:
    return F.concat(F.lit("T"), user_id.cast("string"), F.lit("-"), (k % 20).cast("string"))


def _customer_cols(user_id: Column) -> list[Column]:
    return [
        F.concat(F.lit("C"), user_id.cast("string")).alias("customer_id"),
        F.concat(F.lit("Cust_"), user_id.cast("string")).alias("customer_name"),
        F.when(user_id % 3 == 0, "Enterprise").when(user_id % 3 == 1, "SMB")
         .otherwise("Startup").alias("segment"),
    ]


def _arrival(ts: Column, delay_s: Column) -> Column:
    return ts + F.make_dt_interval(secs=delay_s)


def _priority_raw(event_id: Column, k: Column) -> Column:
    """Numbers 1..4 (old contract), then labels with case/space noise, then junk."""
    n4 = event_id % 4
    n8 = event_id % 8
    label = (F.when(n4 == 0, "urgent").when(n4 == 1, "High")
              .when(n4 == 2, " medium ").otherwise("low"))
    junk = (F.when(n8 == 0, "P1").when(n8 == 1, "P2").when(n8 == 2, "0")
             .when(n8 == 3, "5").when(n8 == 4, "-1").when(n8 == 5, "")
             .when(n8 == 6, F.lit(None).cast("string")).otherwise("unknown"))
    return (F.when(k < 40, (n4 + 1).cast("string"))
             .when(k < 80, label).otherwise(junk))


def tickets_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base_events(spark, sf_dir)
    eid, uid = F.col("event_id"), F.col("user_id")
    n4 = eid % 4
    return b.select(
        F.when(F.col("event_type") == "signup", "c")
         .when(F.col("event_type") == "error", "d").otherwise("u").alias("op"),
        _ticket_id(uid, F.col("k")).alias("ticket_id"),
        eid.alias("cdc_seq"),
        F.col("ts").alias("event_time"),
        _arrival(F.col("ts"), F.col("delay_s")).alias("_ingested_at"),
        F.lit("app.tickets").alias("_source"),
        *_customer_cols(uid),
        _priority_raw(eid, F.col("k")).alias("priority_raw"),
        F.col("event_type").alias("category"),
        F.when(eid % 3 == 0, "chat").when(eid % 3 == 1, "email").otherwise("voice").alias("channel"),
        F.when(n4 == 0, "open").when(n4 == 1, "pending").when(n4 == 2, "resolved")
         .otherwise("closed").alias("status"),
        (eid % 5 + 1).cast("int").alias("csat"),
        (eid % 1400 + 60).cast("int").alias("first_response_sec"),
        F.concat(F.col("event_type"), F.lit(" #"), eid.cast("string")).alias("subject"),
        F.col("props").alias("body"),
    )


def runtime_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base_events(spark, sf_dir)
    eid, uid = F.col("event_id"), F.col("user_id")
    return b.select(
        eid.alias("event_id"),
        _ticket_id(uid, F.col("k")).alias("ticket_id"),
        *_customer_cols(uid),
        "event_type",
        F.when(eid % 3 == 0, "model-s").when(eid % 3 == 1, "model-m")
         .otherwise("model-l").alias("model"),
        F.floor(F.col("value") * 10).cast("int").alias("latency_ms"),
        (eid % 3000 + 200).cast("int").alias("tokens_in"),
        (eid % 900 + 40).cast("int").alias("tokens_out"),
        (F.col("event_type") == "error").alias("is_escalated"),
        F.col("ts").alias("event_time"),
        _arrival(F.col("ts"), F.col("delay_s")).alias("_ingested_at"),
        F.lit("agent-events").alias("_topic"),
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation; ``turns`` ordered by turn number.

    The array holds one conversation (a handful of turns), which is the
    grain of the source feed itself.
    """
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))),
                    lambda x: x["text"]).alias("turns"))
    cid = F.col("conv_id")
    start = (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
             + F.make_dt_interval(hours=(cid % 720).cast("int")))
    return g.select(
        cid.alias("transcript_id"),
        F.concat(F.lit("T"), (cid % 150).cast("string"), F.lit("-"),
                 (cid % 20).cast("string")).alias("ticket_id"),
        F.when(cid % 10 == 0, "vi").otherwise("en").alias("lang"),
        "turns",
        start.alias("event_time"),
        (start + F.make_dt_interval(mins=F.lit(11))).alias("_ingested_at"),
        F.lit("store.transcripts").alias("_source"),
    )


def landed(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same feeds, derived from the tables once and stored: a plan that reads
    them again, or filters by a derived column, reads what is stored."""
    from auric.operators.write import stage
    return {name: stage(df, f"feed-{name}", force=True) for name, df in feeds.items()}


SHUFFLED_BYTES = 32 * 1024 * 1024


def shuffled(df: DataFrame, parts: int) -> DataFrame:
    """The same rows dealt out anew, in another order for another ``parts``: so
    many partitions, and more as the rows grow, so that none outgrows a task."""
    from auric.operators.layout import estimated_bytes
    return df.repartition(parts + (estimated_bytes(df) or 0) // SHUFFLED_BYTES)


def with_replayed_duplicates(events: DataFrame) -> DataFrame:
    """Events plus a redelivered copy of every tenth one, one hour later."""
    dup = (events.where(F.col("event_id") % 10 == 0)
           .withColumn("_ingested_at", F.col("_ingested_at") + F.make_dt_interval(hours=F.lit(1))))
    return events.unionByName(dup)
