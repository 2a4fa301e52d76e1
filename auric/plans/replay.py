"""Replay day by day, and the set-based backfill that must end in the same state.

``replay`` is the operational form: for each run date in order, load the
day's Bronze partitions, rebuild Silver, and update Gold with the keyed
write strategies.  The loop runs on the driver but only *submits* Spark jobs;
no rows pass through it.

``backfill_training_set`` / ``backfill_feature_daily`` compute, in one
distributed plan each, the table a replay of a contiguous run-date range
ends with.  Tests check the two agree; the backfill is also how a new
deployment fills history without replaying every day.

Derivation (training set): Silver's state of a ticket on run ``r`` is its
greatest valid record (by ``event_time, cdc_seq``) among records arrived by
``r``; run ``r`` upserts the ticket iff that record arrived *on* ``r`` and is
not a tombstone.  So per (ticket, arrival day) take the day's greatest
record, keep the days on which it beats every earlier day (a running max
over at most one row per run day and ticket — no hot-key blow-up), drop
tombstones, and keep the last such day.

Derivation (features): with ``M(r)`` the newest ``event_date`` among events
arrived by ``r``, run ``r`` recomputes dates ``d >= M(r-1) - L``.  ``M`` never
decreases, so the last run that recomputes ``d`` is ``R(d)``, and the final
row of ``(d, customer)`` aggregates that key's events arrived by ``R(d)``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auric.functions.time import as_date
from auric.operators.write import read_table, stage
from auric.plans import bronze, gold, incremental, silver
from auric.plans.incremental import DEFAULT_LOOKBACK_DAYS


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    @property
    def bronze_root(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"


FEEDS = ("tickets_cdc", "events", "transcripts")


def run_dates(first: dt.date | str, last: dt.date | str) -> list[dt.date]:
    a, b = as_date(first), as_date(last)
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def concurrently(*steps: Callable[[], None]) -> None:
    """Submit independent Spark jobs from parallel driver threads (the
    scheduler interleaves their tasks); re-raises the first failure."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for f in [pool.submit(s) for s in steps]:
            f.result()


def run_day(spark: SparkSession, feeds: Mapping[str, DataFrame], layout: Layout,
            run_date: dt.date | str, lookback: int = DEFAULT_LOOKBACK_DAYS,
            incremental_silver: bool = False, propagate_deletes: bool = False) -> None:
    """One operational day; each layer's tables are written concurrently,
    layers in order (Bronze → Silver → Gold).

    ``incremental_silver``: ``False`` rebuilds Silver from all of Bronze (as
    the reference does), ``True`` refreshes it from the day's Bronze partition
    (work proportional to the day).  Both write the same layout, and give the
    same tables as long as no loaded day is reloaded with other rows: only a
    rebuild takes corrections of a day back out of Silver.
    """
    load_bronze(feeds, layout, run_date)
    refresh_silver(spark, layout, run_date, incremental_silver)
    _update_gold(spark, layout, run_date, lookback, propagate_deletes)


def load_bronze(feeds: Mapping[str, DataFrame], layout: Layout, run_date) -> None:
    concurrently(*[
        (lambda n=n: bronze.load_day({n: feeds[n]}, layout.bronze_root, run_date))
        for n in FEEDS])


def refresh_silver(spark: SparkSession, layout: Layout, run_date,
                   incremental_silver: bool = False) -> None:
    b = {n: bronze.read_bronze(spark, layout.bronze_root, n) for n in FEEDS}
    paths = {n: layout.path("silver", n) for n in ("tickets", "ticket_state", "quarantine",
                                                     "events", "transcripts")}
    if incremental_silver:
        day = {n: bronze.read_bronze(spark, layout.bronze_root, n, only=run_date)
               .drop(bronze.BATCH_COL) for n in FEEDS}
        concurrently(
            lambda: silver.refresh_tickets(day["tickets_cdc"], paths["ticket_state"],
                                           paths["tickets"]),
            lambda: silver.refresh_quarantine(day["tickets_cdc"], paths["quarantine"],
                                              as_date(run_date), bronze.BATCH_COL),
            lambda: silver.refresh_events(day["events"], paths["events"]),
            lambda: silver.refresh_transcripts(day["transcripts"], paths["transcripts"]))
    else:
        concurrently(*silver.rebuild(b, paths, bronze.BATCH_COL))


def _update_gold(spark: SparkSession, layout: Layout, run_date, lookback: int,
                 propagate_deletes: bool = False) -> None:
    st = read_table(spark, layout.path("silver", "tickets")).drop("_bucket")
    state = (read_table(spark, layout.path("silver", "ticket_state")).drop("_bucket")
             if propagate_deletes else None)
    se = read_table(spark, layout.path("silver", "events")).select(
        *silver.EVENT_COLUMNS, "event_date", "ingested_date")
    tr = read_table(spark, layout.path("silver", "transcripts")).drop("_bucket")
    concurrently(
        lambda: incremental.update_training_set(st, layout.path("gold", "training_set"), run_date,
                                                ticket_state=state),
        lambda: incremental.update_feature_daily(se, layout.path("gold", "feature_daily"), lookback),
        lambda: incremental.refresh_doc_chunks(tr, layout.path("gold", "doc_chunks")))


def replay(spark: SparkSession, feeds: Mapping[str, DataFrame], layout: Layout,
           dates: Sequence[dt.date | str], lookback: int = DEFAULT_LOOKBACK_DAYS,
           after_day: Callable[[dt.date], None] | None = None,
           incremental_silver: bool = False, propagate_deletes: bool = False) -> None:
    for d in sorted(as_date(x) for x in dates):
        run_day(spark, feeds, layout, d, lookback, incremental_silver, propagate_deletes)
        if after_day:
            after_day(d)


# ---------------------------------------------------------------- backfill
def _arrival_day(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    day = F.to_date("_ingested_at")
    return (df.withColumn("_arrival", day)
              .where((F.col("_arrival") >= F.lit(first.isoformat()).cast("date"))
                     & (F.col("_arrival") <= F.lit(last.isoformat()).cast("date"))))


def backfill_training_set(cdc: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    first, last = as_date(first), as_date(last)
    valid, _ = silver.split_valid(_arrival_day(cdc, first, last))
    rank = F.struct("event_time", "cdc_seq")
    per_day = (valid.groupBy("ticket_id", "_arrival")
               .agg(F.max_by(F.struct(*[c for c in valid.columns]), rank).alias("rec"),
                    F.max(rank).alias("_best")))
    w = Window.partitionBy("ticket_id").orderBy("_arrival").rowsBetween(
        Window.unboundedPreceding, -1)
    setters = (per_day.withColumn("_before", F.max("_best").over(w))
               .where(F.col("_before").isNull() | (F.col("_best") > F.col("_before")))
               .where(F.col("rec.op") != "d"))
    last_set = (setters.groupBy("ticket_id")
                .agg(F.max_by("rec", "_arrival").alias("rec")).select("rec.*"))
    tickets = last_set.select(*[F.col("priority_clean").alias("priority") if c == "priority"
                                else F.col("event_time").alias("updated_at") if c == "updated_at"
                                else F.col(c) for c in silver.TICKET_COLUMNS])
    return gold.training_set(tickets)


def backfill_feature_daily(silver_events: DataFrame, first: dt.date | str, last: dt.date | str,
                           lookback: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    first, last = as_date(first), as_date(last)
    # read three times below (newest dates, date list, rows): staged once, as
    # columns, so that the first two read a date or two of each row
    ev = stage(silver_events.where(
        (F.col("ingested_date") >= F.lit(first.isoformat()).cast("date"))
        & (F.col("ingested_date") <= F.lit(last.isoformat()).cast("date"))), "backfill-events")
    spark = silver_events.sparkSession
    runs = spark.createDataFrame([(d,) for d in run_dates(first, last)], "run_date date")
    # newest event_date among arrivals by each run (one row per run day)
    newest = ev.groupBy(F.col("ingested_date").alias("run_date")).agg(
        F.max("event_date").alias("_day_max"))
    w = Window.orderBy("run_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = (runs.join(newest, "run_date", "left")
         .withColumn("_m", F.max("_day_max").over(w))
         .withColumn("_m_before", F.lag("_m").over(Window.orderBy("run_date")))
         .withColumn("_first", F.min(F.when(F.col("_m").isNotNull(), F.col("run_date")))
                     .over(Window.orderBy("run_date").rowsBetween(Window.unboundedPreceding,
                                                                   Window.unboundedFollowing))))
    # R(d): last run that recomputes date d.  Run r recomputes d >= t(r) with
    # t(r) = M(r-1) - L (the first non-empty run recomputes everything); t
    # never decreases, so R(d) is a running max of run_date over thresholds
    # and dates merged in one order — both tables are calendar-sized.
    never = F.lit("0001-01-01").cast("date")
    thresholds = (m.where(F.col("run_date") >= F.col("_first"))
                  .select(F.when(F.col("run_date") == F.col("_first"), never)
                           .otherwise(F.date_sub(F.col("_m_before"), lookback)).alias("_v"),
                          F.lit(0).alias("_kind"), "run_date"))
    dates = ev.select(F.col("event_date").alias("_v"), F.lit(1).alias("_kind"),
                      F.lit(None).cast("date").alias("run_date")).distinct()
    order = Window.orderBy("_v", "_kind").rowsBetween(Window.unboundedPreceding,
                                                      Window.currentRow)
    r_of_d = (thresholds.unionByName(dates)
              .withColumn("_r", F.max("run_date").over(order))
              .where(F.col("_kind") == 1)
              .select(F.col("_v").alias("event_date"), "_r"))
    # a row per date: sent to the events, which then need no shuffle by date
    kept = ev.join(F.broadcast(r_of_d), "event_date", "inner").where(F.col("ingested_date") <= F.col("_r"))
    return gold.feature_daily(kept.drop("_r"))
