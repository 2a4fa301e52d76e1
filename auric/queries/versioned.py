"""Queries on versioned tables, differences between tables and global quantiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.time import date_literal, ts_literal
from auric.operators import diff, quantiles
from auric.operators.versioned import VersionedTable
from auric.operators.write import stage
from auric.oracle import sql
from auric.plans import gold, quality, replay, silver
from auric.plans.incremental import read_gold
from auric.queries import ORACLES, register
from auric.queries import writes  # noqa: F401 - the oracles below are those of the plain strategies
from auric.queries.core import silver_events_of
from auric.queries.writes import CUTOFF, LOOKBACK, STREAM_COLUMNS
from auric.session import ensure_conf, workspace
from auric.sources import driver_tables as dtb


@register("versioned_merge", ORACLES["merge_upsert"])
def versioned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set merged by key as a delta segment, read merged."""
    ensure_conf(spark)
    cdc = dtb.tickets_cdc(spark, sf_dir)
    table = VersionedTable(spark, workspace(spark, "versioned-training-set"), "ticket_id")
    table.refresh(gold.training_set(silver.silver_tickets(cdc.where(F.col("_ingested_at") < ts_literal(CUTOFF)))))
    table.upsert(gold.training_set(silver.silver_tickets(cdc)).where(F.col("_ingested_at") >= ts_literal(CUTOFF)))
    return table.read()


@register("versioned_ignore", ORACLES["upsert_ignore"])
def versioned_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered as numbered micro-batches, one of them twice, and late
    copies that are ignored."""
    ensure_conf(spark)
    ev = dtb.runtime_events(spark, sf_dir).select(*STREAM_COLUMNS)
    table = VersionedTable(spark, workspace(spark, "versioned-events"), "event_id")
    for number in (0, 1, 1):
        table.upsert(ev.where(F.col("event_id") % 2 == number), "ignore", batch=("events", number))
    late = ev.where(F.col("event_id") % 10 == 0).withColumn("_ingested_at", F.col("_ingested_at") + F.make_dt_interval(hours=F.lit(1)))
    table.upsert(late, "ignore", batch=("events", 2))
    return table.read()


@register("versioned_delete_insert", ORACLES["delete_insert"])
def versioned_delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as of the cut-off, the last days replaced by key, then folded."""
    se = silver_events_of(spark, sf_dir)
    cut = dt.date.fromisoformat(CUTOFF)
    table = VersionedTable(spark, workspace(spark, "versioned-features"), gold.FEATURE_KEYS)
    table.refresh(gold.feature_daily(se.where(F.col("ingested_date") < date_literal(cut))))
    table.replace_keys(gold.feature_daily(se.where(F.col("event_date") >= date_literal(cut - dt.timedelta(days=LOOKBACK)))))
    table.fold()
    return table.read()


@register("versioned_refresh", sql(
    "SELECT 1 AS version, * FROM silver_tickets UNION ALL "
    "SELECT 2 AS version, * FROM silver_tickets WHERE priority <= 2", "silver_tickets"))
def versioned_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table refreshed from itself; the version before stays readable."""
    ensure_conf(spark)
    table = VersionedTable(spark, workspace(spark, "versioned-tickets"), "ticket_id")
    table.refresh(silver.silver_tickets(dtb.tickets_cdc(spark, sf_dir)))
    table.refresh(table.read().where("priority <= 2"))
    return table.read(1).withColumn("version", F.lit(1)).unionByName(table.read(2).withColumn("version", F.lit(2)))


# --- replay = backfill ----------------------------------------------------
FIRST_DAY, DAYS = dt.date(2024, 1, 1), 4
_END = FIRST_DAY + dt.timedelta(days=DAYS)
_COUNTS = ("CAST(count(*) AS BIGINT) AS n_left, CAST(count(*) AS BIGINT) AS n_right, CAST(0 AS BIGINT) AS n_only_left, "
           "CAST(0 AS BIGINT) AS n_only_right, CAST(0 AS BIGINT) AS n_changed")
_REPLAY_SQL = sql(
    f"SELECT 'gold_training_set' AS table_name, {_COUNTS} FROM training_set_incremental "
    f"UNION ALL SELECT 'gold_feature_daily', {_COUNTS} FROM feature_daily_incremental "
    f"UNION ALL SELECT 'gold_doc_chunks', {_COUNTS} FROM (SELECT unnest(turns) FROM v_transcripts "
    f"WHERE _ingested_at < TIMESTAMP '{_END} 00:00:00')",
    "training_set_incremental", "feature_daily_incremental", "v_transcripts",
).replace("\nFROM v_base", f"\nFROM v_base WHERE ts + to_seconds(delay_s) < TIMESTAMP '{_END} 00:00:00'")


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three feeds, stored once for all days and sides, events with redeliveries."""
    feeds = dtb.landed({"tickets_cdc": dtb.tickets_cdc(spark, sf_dir), "events": dtb.runtime_events(spark, sf_dir),
                        "transcripts": dtb.transcripts(spark, sf_dir)})
    return feeds | {"events": dtb.with_replayed_duplicates(feeds["events"])}


@register("replay_equals_backfill", _REPLAY_SQL)
def replay_equals_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a day-by-day replay against the set-based backfill of the same
    days: rows of both sides and how many differ."""
    ensure_conf(spark)
    feeds = _feeds(spark, sf_dir)
    days = replay.run_dates(FIRST_DAY, _END - dt.timedelta(days=1))
    layout = replay.Layout(workspace(spark, "replay"))
    replay.replay(spark, feeds, layout, days, LOOKBACK)
    by_end = F.col("_ingested_at") < ts_literal(_END.isoformat())
    arrived = feeds["transcripts"].where(by_end)
    # a later delivery can't be an event's earliest unless all are later, and those
    # the backfill leaves out; a delivery without a time comes before all others
    events = feeds["events"].where(by_end | F.col("_ingested_at").isNull())
    sides = {
        "gold_training_set": ("training_set", "ticket_id", replay.backfill_training_set(feeds["tickets_cdc"], days[0], days[-1])),
        "gold_feature_daily": ("feature_daily", gold.FEATURE_KEYS, replay.backfill_feature_daily(
            silver.silver_events(events), days[0], days[-1], LOOKBACK)),
        "gold_doc_chunks": ("doc_chunks", "chunk_id", gold.doc_chunks(silver.silver_transcripts(arrived))),
    }
    return quality.union_all([
        diff.diff_counts(read_gold(spark, layout.path("gold", name)), stage(backfill, f"backfill-{name}"), keys, title)
        for title, (name, keys, backfill) in sides.items()])


_STABLE = "CAST(2 AS BIGINT) AS n_runs, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed_ranges, TRUE AS stable"


@register("replay_stability", _REPLAY_SQL.replace(_COUNTS, _STABLE))
def replay_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days replayed twice into the same tables, from feeds that arrive in
    another order the second time: digests of Gold after each run, and the number
    of key ranges in which they differ (``diff.changed_ranges`` names them)."""
    ensure_conf(spark)
    days = replay.run_dates(FIRST_DAY, _END - dt.timedelta(days=1))
    layout = replay.Layout(workspace(spark, "replay"))
    tables = {"training_set": "ticket_id", "feature_daily": gold.FEATURE_KEYS, "doc_chunks": "chunk_id"}
    runs: dict[str, list[DataFrame]] = {name: [] for name in tables}
    feeds = _feeds(spark, sf_dir)
    for parts in (3, 8):
        replay.replay(spark, {n: dtb.shuffled(df, parts) for n, df in feeds.items()}, layout, days, LOOKBACK)
        for name, keys in tables.items():
            path = workspace(spark, f"digests-{name}")
            diff.digest_snapshot(read_gold(spark, layout.path("gold", name)), keys).write.parquet(path)
            runs[name].append(spark.read.parquet(path))
    rows = []
    for name, snapshots in runs.items():
        changed = diff.changed_ranges(*snapshots).agg(F.count(F.lit(1)).alias("n_changed_ranges"))
        rows.append(snapshots[-1].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).select(
            F.lit(f"gold_{name}").alias("table_name"), F.lit(len(snapshots)).cast("bigint").alias("n_runs"), "n_rows",
            changed.scalar().alias("n_changed_ranges")).withColumn("stable", F.col("n_changed_ranges") == 0))
    return quality.union_all(rows)


@register("table_diff", sql(
    "SELECT ticket_id, 'only_left' AS difference, CAST(NULL AS VARCHAR) AS changed_columns FROM training_set "
    "WHERE first_response_sec % 97 = 0 "
    "UNION ALL SELECT ticket_id, 'changed', 'csat,status' FROM training_set WHERE first_response_sec % 97 = 1 "
    "UNION ALL SELECT ticket_id || '-x', 'only_right', NULL FROM training_set WHERE first_response_sec % 97 = 2",
    "training_set"))
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set against a copy with seeded faults: rows lost, changed in
    two columns, and added; the diff names exactly those."""
    ensure_conf(spark)
    left = gold.training_set(silver.silver_tickets(dtb.tickets_cdc(spark, sf_dir))).checkpoint(eager=True)
    part = F.col("first_response_sec") % 97
    right = (left.where(part != 0)
             .withColumn("status", F.when(part == 1, F.lit("reopened")).otherwise(F.col("status")))
             .withColumn("csat", F.when(part == 1, F.lit(None)).otherwise(F.col("csat"))))
    right = right.unionByName(left.where(part == 2).withColumn("ticket_id", F.concat("ticket_id", F.lit("-x"))))
    return diff.table_diff(left, right, "ticket_id").select("ticket_id", "difference", "changed_columns")


# --- global quantiles -----------------------------------------------------
PROBABILITIES = (0.0, 0.01, 0.5, 0.95, 0.99, 1.0)
_MEASURES = {"event_value": ("events", "value + event_id / 1000000.0"), "order_price": ("orders", "o_totalprice"),
             "line_price": ("lineitem", "l_extendedprice")}


@register("global_quantiles", " UNION ALL ".join(
    f"SELECT '{name}' AS measure, CAST({p} AS DOUBLE) AS p, "
    f"round(quantile_cont(CAST({expression} AS DOUBLE), {p}), 6) AS quantile FROM {table}"
    for name, (table, expression) in _MEASURES.items() for p in PROBABILITIES))
def global_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of whole columns, one of them with all values distinct,
    by selection instead of one buffer of all values."""
    ensure_conf(spark)
    rows = []
    for name, (table, expression) in _MEASURES.items():
        df = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.expr(f"cast({expression} as double)").alias("x"))
        rows += [(name, p, q) for p, q in zip(PROBABILITIES, quantiles.exact_quantiles(df, "x", PROBABILITIES), strict=True)]
    return spark.createDataFrame(rows, "measure string, p double, quantile double").withColumn("quantile", F.round("quantile", 6))
