"""Incremental Gold: the keyed, re-runnable forms of the Gold tables.

* training set — slice of Silver that *arrived* on the run date, merged by
  ``ticket_id`` (an entity table: a ticket updated on a later day moves, so
  "delete the day, write the day" would duplicate it);
* daily features — the last ``lookback`` days before the target's newest
  ``event_date`` are recomputed and replace their (date, customer) keys, so
  events that arrive up to ``lookback`` days late still land in their day;
* document chunks — full refresh (the control table: never changes).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.time import as_date, date_literal, day_slice
from auric.operators.write import (delete_insert, full_refresh, merge_upsert, read_table,
                                   replace_partitions)
from auric.plans import gold
from auric.sources import fs

DEFAULT_LOOKBACK_DAYS = 3


def lookback_filter(source: DataFrame, target: DataFrame | None, date_col: str = "event_date",
                    days: int = DEFAULT_LOOKBACK_DAYS, anchor: str = "target",
                    run_date: dt.date | str | None = None) -> DataFrame:
    """Rows of ``source`` to recompute.

    ``target is None`` (first run) → everything.  ``anchor='target'`` uses
    ``max(date_col)`` of the target as a scalar subquery (it becomes a
    partition filter on a partitioned source); ``anchor='run_date'`` uses the
    run date instead, so one future-dated row cannot hide late data.
    """
    if target is None:
        return source
    if anchor == "target":
        start = F.date_sub(target.select(F.max(date_col)).scalar(), days)
    elif anchor == "run_date":
        if run_date is None:
            raise ValueError("anchor='run_date' needs run_date")
        start = date_literal(as_date(run_date) - dt.timedelta(days=days))
    else:
        raise ValueError("anchor must be 'target' or 'run_date'")
    return source.where(F.col(date_col) >= start)


def update_training_set(silver_tickets: DataFrame, path: str, run_date: dt.date | str,
                        buckets: int | None = None,
                        ticket_state: DataFrame | None = None) -> None:
    """Merge the tickets that arrived on ``run_date`` by ``ticket_id``.

    Like the reference, a ticket deleted on a later day stays in the
    training set.  Pass ``ticket_state`` (latest valid record per ticket,
    tombstones included) to propagate deletes: tickets whose state became a
    tombstone on ``run_date`` are removed in the same merge.
    """
    rows = gold.training_set(silver_tickets, run_date).withColumn("_deleted", F.lit(False))
    if ticket_state is not None:
        gone = (ticket_state.where((F.col("op") == "d") & day_slice("_ingested_at", run_date))
                .select("ticket_id"))
        rows = rows.unionByName(gone.select(*[
            F.col("ticket_id") if f.name == "ticket_id"
            else F.lit(f.name == "_deleted").alias(f.name) if f.name == "_deleted"
            else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]))
    merge_upsert(rows, path, "ticket_id", buckets=buckets, delete_col="_deleted")


def update_feature_daily(silver_events: DataFrame, path: str,
                         lookback: int = DEFAULT_LOOKBACK_DAYS, anchor: str = "target",
                         run_date: dt.date | str | None = None,
                         replace_window: bool = False) -> None:
    """Recompute the lookback window and write it back.

    Default (the reference's delete+insert): keys present in the recomputed
    window replace their rows; a (day, customer) that vanished from Silver
    stays.  ``replace_window=True`` rewrites every day of the window whole,
    so vanished groups disappear as well.
    """
    spark = silver_events.sparkSession
    start = None
    if not fs.has_data(spark, path):
        src = silver_events                       # first run: everything
    elif anchor == "target":
        newest = newest_partition_date(spark, path, "event_date")
        if newest is not None:
            start = newest - dt.timedelta(days=lookback)
        src = (silver_events if start is None
               else silver_events.where(F.col("event_date") >= date_literal(start)))
    else:
        if run_date is None:
            raise ValueError("anchor='run_date' needs run_date")
        start = as_date(run_date) - dt.timedelta(days=lookback)
        src = silver_events.where(F.col("event_date") >= date_literal(start))
    batch = gold.feature_daily(src)
    if replace_window and start is not None:
        replace_partitions(batch, path, gold.FEATURE_KEYS, "event_date", start)
    else:
        delete_insert(batch, path, gold.FEATURE_KEYS, "event_date")


def newest_partition_date(spark: SparkSession, path: str, col: str) -> dt.date | None:
    """``max(col)`` of a table partitioned by the date ``col``, from folder names.

    The same value as ``SELECT max(col)`` over the table (a partition folder
    exists only if it holds rows of that day), read from the file listing
    instead of the data — a metadata lookup, bounded by the number of days.
    """
    prefix = f"{col}="
    days = [as_date(n[len(prefix):]) for n in fs.list_dirs(spark, path) if n.startswith(prefix)]
    return max(days) if days else None


def refresh_doc_chunks(silver_transcripts: DataFrame, path: str) -> None:
    full_refresh(gold.doc_chunks(silver_transcripts), path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A Gold table without its storage-only bucket column."""
    df = read_table(spark, path)
    return df.drop("_bucket") if "_bucket" in df.columns else df
