"""What keeps replays, stability runs and streamed features in proportion to their input."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from auric.operators.write import read_table
from auric.plans import bronze, replay, silver
from auric.queries import versioned, writes
from auric.sources import driver_tables as dtb
from auric.streaming import features
from auric.streaming.features import FeatureUpkeep
from tests.test_feature_state import SCHEMA, expected, made_events, rows


def _events(spark, n=400):
    made = [(*r[:4], r[4], "view", "m", *r[5:]) for r in made_events(n)]
    schema = SCHEMA.replace("latency_ms int", "event_type string, model string, latency_ms int")
    return spark.createDataFrame(made, schema)


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_shuffled_feeds_get_more_partitions_as_they_grow(spark, work, monkeypatch):
    path = work("rows")
    spark.range(50_000).write.parquet(path)
    df = spark.read.parquet(path)
    assert dtb.shuffled(df, 3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(dtb, "SHUFFLED_BYTES", 1000)
    many = dtb.shuffled(df, 3)
    assert many.rdd.getNumPartitions() > 50
    assert rows(many) == rows(df)


def test_landed_feeds_hold_the_same_rows_and_are_plain_scans(spark):
    df = _events(spark).withColumn("x", F.col("event_id") + 1)
    landed = dtb.landed({"events": df})["events"]
    assert rows(landed) == rows(df) and landed.columns == df.columns
    assert len(landed.inputFiles()) >= 1


def test_stability_run_dedups_events_once(spark, monkeypatch):
    """The arrival range and the backfill read one stored copy of deduplicated events."""
    seen = []
    real = replay.backfill_feature_daily
    monkeypatch.setattr(writes.replay, "backfill_feature_daily", lambda se, *a: seen.append(se) or real(se, *a))
    small = "/root/testdata/sf0.001"
    feeds = dtb.landed({"tickets_cdc": dtb.tickets_cdc(spark, small), "events": dtb.runtime_events(spark, small),
                        "transcripts": dtb.transcripts(spark, small)})
    writes._stability_tables(feeds, 0)
    assert _shuffles(seen[0]) == 0
    assert seen[0].count() == feeds["events"].count()


def test_backfill_sends_dates_and_shuffles_no_event_by_date(spark):
    se = silver.silver_events(_events(spark))
    plan = replay.backfill_feature_daily(se, "2024-05-01", "2024-05-09")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rebuild_finds_the_ticket_state_once(spark, work, monkeypatch):
    calls = []
    real = silver.current_state
    monkeypatch.setattr(silver, "current_state", lambda cdc: calls.append(1) or real(cdc))
    cdc = dtb.tickets_cdc(spark, "/root/testdata/sf0.001")
    day = cdc.withColumn(bronze.BATCH_COL, F.to_date("_ingested_at"))
    paths = {n: work(n) for n in ("tickets", "ticket_state", "quarantine", "events", "transcripts")}
    silver.rebuild({"tickets_cdc": day, "events": day, "transcripts": day}, paths, bronze.BATCH_COL)[0]()
    assert len(calls) == 1
    assert rows(read_table(spark, paths["tickets"]).drop("_bucket")) == rows(silver.silver_tickets(cdc))


def test_backfilled_events_are_bounded_before_the_dedup(spark, monkeypatch):
    """Deliveries after the last day can't win and stay out; one without a time wins and is left out by its date."""
    seen = []

    class Seen(Exception):
        pass

    def take(se, *a):
        seen.append(se)
        raise Seen
    ev = _events(spark, 3)
    at = lambda i, when: ev.where(F.col("event_id") == i).withColumn("_ingested_at", F.lit(when).cast("timestamp_ntz"))
    given = at(0, "2024-01-02 00:00:00").unionByName(at(0, "2024-02-02 00:00:00")).unionByName(at(1, "2024-02-02 00:00:00"))
    given = given.unionByName(at(2, None)).unionByName(at(2, "2024-01-03 00:00:00"))
    monkeypatch.setattr(versioned, "_feeds", lambda *a: {"tickets_cdc": None, "events": given, "transcripts": at(0, "2024-01-02 00:00:00")})
    monkeypatch.setattr(versioned.replay, "replay", lambda *a, **k: None)
    monkeypatch.setattr(versioned.replay, "backfill_training_set", lambda *a: None)
    monkeypatch.setattr(versioned.replay, "backfill_feature_daily", take)
    try:
        versioned.replay_equals_backfill(spark, "")
    except Seen:
        pass
    got = {(r["event_id"], r["_ingested_at"]) for r in seen[0].collect()}
    assert got == {(0, dt.datetime(2024, 1, 2)), (2, None)}


def test_a_batch_sorts_whole_events_once(spark, work, monkeypatch):
    """Which keys are known is told from ids and times, not from a second dedup of the batch."""
    calls = []
    real = features.earliest_per_key
    monkeypatch.setattr(features, "earliest_per_key", lambda *a: calls.append(1) or real(*a))
    read = []
    known = FeatureUpkeep._known
    monkeypatch.setattr(FeatureUpkeep, "_known", lambda self, e, log, n: read.append(n) or known(self, e, log, n))
    given = made_events(120, seed=4)
    handler = FeatureUpkeep(work("features"), work("gold"))
    for k in range(3):
        handler(spark.createDataFrame(given[k::3], SCHEMA), k)
    assert len(calls) == 3 and read == [1, 2]
    assert rows(read_table(spark, handler.gold_path)) == expected(spark, given)
