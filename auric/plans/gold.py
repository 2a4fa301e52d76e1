"""Gold tables: document chunks, training set, daily features.

All three are plain DataFrame plans; their incremental (keyed) forms live in
:mod:`auric.plans.incremental`, which feeds these plans with a slice of
Silver and hands the result to a keyed write strategy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.functions.numeric import exact_percentile_int, round_binary
from auric.functions.time import day_slice

CHUNK_COLUMNS = ["chunk_id", "transcript_id", "ticket_id", "lang", "chunk_index",
                 "chunk_text", "n_chars", "event_time"]


def doc_chunks(transcripts: DataFrame) -> DataFrame:
    """One row per turn: ``<transcript_id>#<index>``; empty/NULL arrays give no rows.

    ``posexplode`` is a narrow operation — no shuffle, partitions stay where
    the scan put them.
    """
    x = transcripts.select("transcript_id", "ticket_id", "lang", "event_time",
                           F.posexplode("turns").alias("chunk_index", "chunk_text"))
    return x.select(
        F.concat(F.col("transcript_id").cast("string"), F.lit("#"),
                 F.col("chunk_index").cast("string")).alias("chunk_id"),
        "transcript_id", "ticket_id", "lang",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        "chunk_text",
        F.length("chunk_text").alias("n_chars"),
        "event_time",
    )


TRAINING_COLUMNS = ["ticket_id", "customer_id", "customer_name", "segment", "priority",
                    "category", "channel", "status", "csat", "first_response_sec",
                    "text_len", "label_resolved", "updated_at", "_ingested_at"]

# Ticket statuses that count as a positive training label.
RESOLVED_STATUSES = ("resolved", "closed")


def training_set(silver_tickets: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """Features + label per ticket; with ``run_date`` only tickets that arrived that day."""
    src = silver_tickets
    if run_date is not None:
        src = src.where(day_slice("_ingested_at", run_date))
    return src.select(
        "ticket_id", "customer_id", "customer_name", "segment", "priority", "category",
        "channel", "status", "csat", "first_response_sec",
        (F.length("subject") + F.length("body")).alias("text_len"),
        F.when(F.col("status").isin(*RESOLVED_STATUSES), 1).otherwise(0).alias("label_resolved"),
        "updated_at", "_ingested_at",
    )


FEATURE_KEYS = ["event_date", "customer_id"]
FEATURE_GROUP = ["event_date", "customer_id", "customer_name", "segment"]


def feature_daily(silver_events: DataFrame) -> DataFrame:
    """Seven measures per (event_date, customer).

    Exact distinct and exact percentile are kept on purpose (the table is
    fingerprinted); both aggregate partially on the map side, and the
    percentile buffer holds one entry per distinct latency value, not per row,
    so a customer with a third of all events stays cheap.
    """
    return (silver_events.groupBy(*FEATURE_GROUP).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("ticket_id").alias("n_tickets"),
        F.sum(F.when(F.col("is_escalated"), 1).otherwise(0)).cast("bigint").alias("n_escalated"),
        round_binary(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        exact_percentile_int("latency_ms", 0.95).alias("p95_latency_ms"),
        F.sum("tokens_in").cast("bigint").alias("tokens_in"),
        F.sum("tokens_out").cast("bigint").alias("tokens_out"),
    ))
