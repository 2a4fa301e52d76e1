"""Silver: typed, validated, one row per entity.

* :func:`split_valid` — one validity rule, two outputs that partition the
  input exactly (valid rows carry the clean value, rejected rows the reason).
* :func:`silver_tickets` — change records → current ticket state: drop invalid
  records *first*, then pick the latest record per ticket, then drop
  tombstones.  A bad newest record therefore leaves the older valid state.
* :func:`quarantine_tickets` — one row per rejected change record.
* :func:`silver_events` / :func:`silver_transcripts` — dedup on the id,
  earliest delivery wins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.functions.domain import normalize_domain, reject_reason
from auric.operators.state import earliest_per_key, latest_per_key

TICKET_COLUMNS = ["ticket_id", "customer_id", "customer_name", "segment", "priority",
                  "category", "channel", "status", "csat", "first_response_sec",
                  "subject", "body", "updated_at", "_ingested_at"]

QUARANTINE_COLUMNS = ["ticket_id", "cdc_seq", "op", "event_time", "_ingested_at",
                      "priority_raw", "reject_reason", "customer_id", "customer_name",
                      "category", "status"]


def with_clean_priority(cdc: DataFrame, raw: str = "priority_raw",
                        clean: str = "priority_clean") -> DataFrame:
    return cdc.withColumn(clean, normalize_domain(raw))


def split_valid(cdc: DataFrame, raw: str = "priority_raw") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) from the single rule ``normalize_domain(raw) IS NULL``."""
    tagged = with_clean_priority(cdc, raw)
    valid = tagged.where(F.col("priority_clean").isNotNull())
    rejected = (tagged.where(F.col("priority_clean").isNull())
                .drop("priority_clean")
                .withColumn("reject_reason", reject_reason(raw)))
    return valid, rejected


def current_state(cdc: DataFrame) -> DataFrame:
    """Latest *valid* change record per ticket, tombstones included."""
    valid, _ = split_valid(cdc)
    return latest_per_key(valid, "ticket_id", ("event_time", "cdc_seq"))


def live_tickets(state: DataFrame) -> DataFrame:
    """Tickets whose latest record is no tombstone."""
    return (state.where(F.col("op") != "d")
            .select(*[F.col("priority_clean").alias("priority") if c == "priority"
                      else F.col("event_time").alias("updated_at") if c == "updated_at"
                      else F.col(c) for c in TICKET_COLUMNS]))


def silver_tickets(cdc: DataFrame) -> DataFrame:
    return live_tickets(current_state(cdc))


def quarantine_tickets(cdc: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rejected change records; ``keep`` carries extra columns (a batch date)."""
    _, rejected = split_valid(cdc)
    return rejected.select(*QUARANTINE_COLUMNS, *keep)


EVENT_COLUMNS = ["event_id", "ticket_id", "customer_id", "customer_name", "segment",
                 "event_type", "model", "latency_ms", "tokens_in", "tokens_out",
                 "is_escalated", "event_time", "_ingested_at"]


def silver_events(events: DataFrame) -> DataFrame:
    deduped = earliest_per_key(events.select(*EVENT_COLUMNS), "event_id", ("_ingested_at",))
    return deduped.select(
        *EVENT_COLUMNS,
        F.to_date("event_time").alias("event_date"),
        F.to_date("_ingested_at").alias("ingested_date"),
    )


TRANSCRIPT_COLUMNS = ["transcript_id", "ticket_id", "lang", "turns", "event_time", "_ingested_at"]


def silver_transcripts(transcripts: DataFrame) -> DataFrame:
    return earliest_per_key(transcripts.select(*TRANSCRIPT_COLUMNS), "transcript_id",
                            ("_ingested_at",))


# ---------------------------------------------------------------- maintained tables
# Silver is stored so that both a full rebuild and a per-day refresh write
# the same layout: tickets and transcripts hash-bucketed by their key,
# events partitioned by event_date, quarantine by the Bronze batch day.

def rebuild(bronze: Mapping[str, DataFrame], paths: Mapping[str, str], batch_col: str) -> list:
    """Full rebuild of the Silver tables (and the ticket-state table the
    per-day refresh maintains) from all of Bronze (returns the
    independent write steps, for the caller to run concurrently)."""
    from auric.operators.write import full_refresh, read_table, rebuild_keyed
    cdc, ev, tr = bronze["tickets_cdc"], bronze["events"], bronze["transcripts"]

    def tickets() -> None:      # the state is found once, tickets are its rows that live
        rebuild_keyed(current_state(cdc.drop(batch_col)), paths["ticket_state"], "ticket_id")
        state = read_table(cdc.sparkSession, paths["ticket_state"]).drop("_bucket")
        rebuild_keyed(live_tickets(state), paths["tickets"], "ticket_id")

    return [
        tickets,
        lambda: full_refresh(quarantine_tickets(cdc, (batch_col,)), paths["quarantine"], batch_col),
        lambda: full_refresh(silver_events(ev.drop(batch_col)), paths["events"], "event_date"),
        lambda: rebuild_keyed(silver_transcripts(tr.drop(batch_col)), paths["transcripts"],
                              "transcript_id"),
    ]


# ---------------------------------------------------------------- incremental refresh
def _ticket_rows(state: DataFrame) -> DataFrame:
    return state.select(*[F.col("priority_clean").alias("priority") if c == "priority"
                          else F.col("event_time").alias("updated_at") if c == "updated_at"
                          else F.col(c) for c in TICKET_COLUMNS],
                        (F.col("op") == "d").alias("_tombstone"))


def refresh_tickets(bronze_day: DataFrame, state_path: str, path: str) -> None:
    """Apply one Bronze day of change records.

    1. The day's *valid* records are merged into the ticket-state table
       (latest valid record per ticket, tombstones included) with "latest
       wins" on (event_time, cdc_seq) — out-of-order arrivals are handled, a
       late older record never overrides a newer state.
    2. The new state of every ticket the day touched replaces its Silver row;
       tickets whose state is a tombstone are removed.
    Both steps read and rewrite only the hash buckets of the touched tickets,
    so a day costs O(day + touched buckets), not O(history).  Equal to
    :func:`silver_tickets` over all of Bronze (tests).
    """
    from auric.operators.write import merge_upsert, read_keys
    valid, _ = split_valid(bronze_day)
    spark = bronze_day.sparkSession
    merge_upsert(valid, state_path, "ticket_id", on_match="latest",
                 order_by=["event_time", "cdc_seq"])
    from auric.sources import fs
    if not fs.has_data(spark, state_path):
        return
    touched = valid.select("ticket_id").distinct()
    state = read_keys(spark, state_path, touched)
    merge_upsert(_ticket_rows(state), path, "ticket_id", on_match="update",
                 delete_col="_tombstone")


def refresh_quarantine(bronze_day: DataFrame, path: str, run_date, batch_col: str) -> None:
    """The day's rejected records replace that day's quarantine partition."""
    from auric.operators.write import replace_partition
    replace_partition(quarantine_tickets(bronze_day), path, batch_col, run_date)


def refresh_events(bronze_day: DataFrame, path: str) -> None:
    """Merge the day's events by (event_date, event_id), earliest delivery
    wins; partitioned by event_date so Gold's lookback read is pruned.
    (An event's ``event_time`` is part of the message and never changes.)"""
    from auric.operators.write import delete_insert
    delete_insert(silver_events(bronze_day), path, ["event_date", "event_id"], "event_date",
                  on_match="earliest", order_by=["_ingested_at"])


def refresh_transcripts(bronze_day: DataFrame, path: str) -> None:
    from auric.operators.write import merge_upsert
    merge_upsert(silver_transcripts(bronze_day), path, "transcript_id", on_match="earliest",
                 order_by=["_ingested_at"])
