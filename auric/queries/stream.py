"""Streaming queries: each runs a real Structured Streaming query over a JSON
topic written from the tables, then returns the sink's final content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.oracle import sql
from auric.plans.audit import delivery_audit as audit_delivery
from auric.plans.incremental import read_gold
from auric.queries import register
from auric.session import ensure_conf, workspace
from auric.sources import driver_tables as dtb
from auric.sources.jsonl import EVENT_SCHEMA
from auric.streaming import ingest
from auric.streaming.features import FeatureUpkeep

TOPIC_FILES = 12                   # at least; more as the table grows
TOPIC_FILE_BYTES = 64 * 1024 * 1024
FILES_PER_TRIGGER = 3              # bounded micro-batches: ≤ 3 files each
CRASH_AFTER_BATCH = 1
DEDUP_DELAY = "3 days"        # ≥ the longest arrival lag (lag profile: ceil(P99) days)
STREAM_COLUMNS = ["event_id", "ticket_id", "customer_id", "customer_name", "event_type",
                  "latency_ms", "event_time", "_ingested_at"]
_COLS = ", ".join(STREAM_COLUMNS)


def _topic(spark: SparkSession, sf_dir: str, with_redelivery: bool = False) -> str:
    ensure_conf(spark)
    ev = dtb.runtime_events(spark, sf_dir)
    if with_redelivery:
        ev = dtb.with_replayed_duplicates(ev)
    path = workspace(spark, "topic")
    ingest.write_topic(ev, path, topic_files(ev))
    return path


def topic_files(df: DataFrame) -> int:
    from auric.operators.layout import estimated_bytes
    return max(TOPIC_FILES, -(-(estimated_bytes(df) or 0) // TOPIC_FILE_BYTES))


def _stream(spark: SparkSession, topic: str, files_per_trigger: int = FILES_PER_TRIGGER):
    return lambda: ingest.read_topic(spark, topic, EVENT_SCHEMA, files_per_trigger).select(
        *STREAM_COLUMNS)


@register("stream_ingest", sql(f"SELECT {_COLS} FROM v_events", "v_events"))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain the topic in micro-batches into one folder per batch id."""
    topic = _topic(spark, sf_dir)
    sink, ckpt = workspace(spark, "sink"), workspace(spark, "ckpt")
    ingest.run_with_restart(_stream(spark, topic), ingest.sink_writer("batch_folder", sink),
                            ckpt, None)
    return ingest.read_sink(spark, "batch_folder", sink)


@register("stream_upsert", sql(f"SELECT {_COLS} FROM v_events", "v_events"))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash after writing a batch, restart: the replayed batch is absorbed by
    the keyed upsert sink — every message stored exactly once."""
    topic = _topic(spark, sf_dir)
    sink, ckpt = workspace(spark, "sink"), workspace(spark, "ckpt")
    ingest.run_with_restart(_stream(spark, topic), ingest.sink_writer("upsert", sink),
                            ckpt, CRASH_AFTER_BATCH)
    return ingest.read_sink(spark, "upsert", sink)


_DEDUP_COLS = [c for c in STREAM_COLUMNS if c != "_ingested_at"]


@register("stream_dedup", sql(f"SELECT {', '.join(_DEDUP_COLS)} FROM v_events", "v_events"))
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivered messages dropped by a watermark-bounded streaming dedup."""
    topic = _topic(spark, sf_dir, with_redelivery=True)
    sink, ckpt = workspace(spark, "sink"), workspace(spark, "ckpt")
    make = _stream(spark, topic)
    ingest.run_with_restart(lambda: ingest.dedup_stream(make(), "event_id", "event_time",
                                                        DEDUP_DELAY),
                            ingest.sink_writer("batch_folder", sink), ckpt, None)
    return ingest.read_sink(spark, "batch_folder", sink).select(*_DEDUP_COLS)


@register("stream_feature_daily", sql("SELECT * FROM feature_daily", "feature_daily"))
def stream_feature_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily features kept current from the stream, late events included."""
    topic = _topic(spark, sf_dir)
    path, gold_path = workspace(spark, "feature-state"), workspace(spark, "gold-features")
    ckpt = workspace(spark, "ckpt")
    make = lambda: ingest.read_topic(spark, topic, EVENT_SCHEMA, FILES_PER_TRIGGER)
    ingest.run_with_restart(make, FeatureUpkeep(path, gold_path), ckpt, None)
    return read_gold(spark, gold_path)


@register("delivery_audit", sql("""
SELECT 'append' AS sink, count(*) AS n_sent, 2 * count(*) AS n_stored, count(*) AS n_distinct,
       CAST(0 AS BIGINT) AS n_lost, count(*) AS n_duplicated, CAST(0 AS BIGINT) AS n_unknown,
       FALSE AS ok
FROM v_events
UNION ALL
SELECT 'upsert', count(*), count(*), count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
       CAST(0 AS BIGINT), TRUE
FROM v_events""", "v_events"))
def delivery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crash scenario over the whole topic, delivered as one batch: crash
    after the sink wrote, restart, then audit sent vs stored for a plain
    append sink (the replayed batch is stored twice) and the upsert sink."""
    ensure_conf(spark)
    topic = _topic(spark, sf_dir)
    sent = spark.read.schema(EVENT_SCHEMA).json(topic).select("event_id")
    rows = []
    for kind in ("append", "upsert"):
        sink, ckpt = workspace(spark, f"sink-{kind}"), workspace(spark, "ckpt")
        ingest.run_with_restart(_stream(spark, topic, files_per_trigger=1 << 30),
                                ingest.sink_writer(kind, sink), ckpt, 0)
        stored = ingest.read_sink(spark, kind, sink)
        rows.append(audit_delivery(sent, stored).select(F.lit(kind).alias("sink"), "*"))
    return rows[0].unionByName(rows[1])
