"""Replay day by day must end where the set-based backfill ends (sf0.001)."""
from __future__ import annotations

import datetime as dt

from auric.operators.write import read_table
from auric.plans import incremental, quality, replay, silver
from auric.sources import driver_tables as dtb

SMALL = "/root/testdata/sf0.001"
DAYS = replay.run_dates("2024-01-01", "2024-01-07")


def _fp(df, table):
    return quality.fingerprint(df, quality.FINGERPRINT_KEYS[table]).first()


def test_replay_equals_backfill_and_is_stable(spark, work):
    # events include redeliveries an hour later (sometimes the next day)
    feeds = {"tickets_cdc": dtb.tickets_cdc(spark, SMALL),
             "events": dtb.with_replayed_duplicates(dtb.runtime_events(spark, SMALL)),
             "transcripts": dtb.transcripts(spark, SMALL)}
    layout = replay.Layout(work("replay"))
    replay.replay(spark, feeds, layout, DAYS[:3], incremental_silver=False)   # rebuild ...
    replay.replay(spark, feeds, layout, DAYS[3:], incremental_silver=True)    # ... then refresh
    ts = incremental.read_gold(spark, layout.path("gold", "training_set"))
    fd = incremental.read_gold(spark, layout.path("gold", "feature_daily"))
    bts = replay.backfill_training_set(feeds["tickets_cdc"], DAYS[0], DAYS[-1])
    se_all = silver.silver_events(feeds["events"])
    bfd = replay.backfill_feature_daily(se_all, DAYS[0], DAYS[-1])
    assert ts.count() > 0 and fd.count() > 0
    assert _fp(ts, "gold_training_set") == _fp(bts, "gold_training_set")
    assert _fp(fd, "gold_feature_daily") == _fp(bfd, "gold_feature_daily")
    # replaying the last days again changes nothing (idempotent re-runs)
    before = (_fp(ts, "gold_training_set"), _fp(fd, "gold_feature_daily"))
    replay.replay(spark, feeds, layout, DAYS[-2:], incremental_silver=True)
    ts2 = incremental.read_gold(spark, layout.path("gold", "training_set"))
    fd2 = incremental.read_gold(spark, layout.path("gold", "feature_daily"))
    assert (_fp(ts2, "gold_training_set"), _fp(fd2, "gold_feature_daily")) == before
    # one row per ticket, and the Bronze partitions hold exactly their day
    assert ts2.groupBy("ticket_id").count().where("count > 1").count() == 0
    b = read_table(spark, layout.bronze_root + "/events")
    assert b.where("to_date(_ingested_at) <> _batch_date").count() == 0
    # incrementally refreshed Silver equals a full rebuild from all of Bronze
    bt = read_table(spark, layout.bronze_root + "/tickets_cdc").drop("_batch_date")
    full = silver.silver_tickets(bt)
    inc = read_table(spark, layout.path("silver", "tickets")).drop("_bucket")
    keys = quality.FINGERPRINT_KEYS["gold_training_set"] + ["updated_at", "_ingested_at"]
    assert (quality.fingerprint(inc, keys).first() == quality.fingerprint(full, keys).first())
    q_inc = read_table(spark, layout.path("silver", "quarantine"))
    assert set(q_inc.columns) >= {"ticket_id", "cdc_seq", "reject_reason", "_batch_date"}
    assert q_inc.count() == silver.quarantine_tickets(bt).count()
    ev_inc = read_table(spark, layout.path("silver", "events"))
    ev_full = silver.silver_events(b.drop("_batch_date"))
    ek = ["event_id", "_ingested_at", "event_date", "latency_ms"]
    assert quality.fingerprint(ev_inc, ek).first() == quality.fingerprint(ev_full, ek).first()


def test_full_rebuild_mode_matches_backfill(spark, work):
    feeds = {"tickets_cdc": dtb.tickets_cdc(spark, SMALL), "events": dtb.runtime_events(spark, SMALL),
             "transcripts": dtb.transcripts(spark, SMALL)}
    layout = replay.Layout(work("replay-full"))
    days = DAYS[:4]
    replay.replay(spark, feeds, layout, days, incremental_silver=False)
    ts = incremental.read_gold(spark, layout.path("gold", "training_set"))
    bts = replay.backfill_training_set(feeds["tickets_cdc"], days[0], days[-1])
    assert _fp(ts, "gold_training_set") == _fp(bts, "gold_training_set")


def test_lookback_recovers_late_rows_that_a_naive_run_misses(spark):
    se = silver.silver_events(dtb.runtime_events(spark, SMALL))
    full = replay.backfill_feature_daily(se, "2024-01-01", "2024-02-02", lookback=3)
    none = replay.backfill_feature_daily(se, "2024-01-01", "2024-02-02", lookback=0)
    agg = lambda df: df.selectExpr("sum(n_events)").first()[0]
    assert agg(full) == se.where("ingested_date <= date'2024-02-02'").count()
    assert agg(none) < agg(full)


def test_lookback_anchor_on_run_date(spark, work):
    """anchor='run_date' recomputes [run_date - L, ...] whatever the target holds."""
    import datetime as dt
    from pyspark.sql import functions as F
    from auric.plans import gold
    se = silver.silver_events(dtb.runtime_events(spark, SMALL))
    path = work("features")
    incremental.update_feature_daily(se.where("ingested_date <= date'2024-01-05'"), path)
    # a future-dated row would move a target anchor; the run-date anchor ignores it
    incremental.update_feature_daily(se.where("ingested_date <= date'2024-01-06'"), path,
                                     anchor="run_date", run_date=dt.date(2024, 1, 6))
    got = incremental.read_gold(spark, path)
    want = gold.feature_daily(se.where("ingested_date <= date'2024-01-06'"))
    days = F.col("event_date") >= F.lit("2024-01-03").cast("date")
    assert _fp(got.where(days), "gold_feature_daily") == _fp(want.where(days), "gold_feature_daily")


def test_propagated_deletes_remove_tombstoned_tickets(spark, work):
    feeds = {"tickets_cdc": dtb.tickets_cdc(spark, SMALL), "events": dtb.runtime_events(spark, SMALL),
             "transcripts": dtb.transcripts(spark, SMALL)}
    days = DAYS[:5]
    keep = replay.Layout(work("keep"))
    drop = replay.Layout(work("drop"))
    replay.replay(spark, feeds, keep, days)
    replay.replay(spark, feeds, drop, days, propagate_deletes=True)
    kept = incremental.read_gold(spark, keep.path("gold", "training_set"))
    dropped = incremental.read_gold(spark, drop.path("gold", "training_set"))
    state = read_table(spark, drop.path("silver", "ticket_state"))
    dead = state.where("op = 'd'").select("ticket_id")
    assert dead.count() > 0
    assert dropped.join(dead, "ticket_id", "left_semi").count() == 0
    expected = kept.join(dead, "ticket_id", "left_anti")
    assert _fp(dropped, "gold_training_set") == _fp(expected, "gold_training_set")


def test_replace_window_drops_vanished_groups(spark, work):
    from pyspark.sql import functions as F
    se = silver.silver_events(dtb.runtime_events(spark, SMALL)).where(
        "ingested_date <= date'2024-01-08'")
    victim = se.where("event_date = date'2024-01-07'").select("customer_id").first()[0]
    shrunk = se.where(~((F.col("event_date") == F.lit("2024-01-07").cast("date"))
                        & (F.col("customer_id") == victim)))
    for replace_window, expected in ((False, 1), (True, 0)):
        path = work("features")
        incremental.update_feature_daily(se, path)
        incremental.update_feature_daily(shrunk, path, replace_window=replace_window)
        got = incremental.read_gold(spark, path).where(
            (F.col("event_date") == F.lit("2024-01-07").cast("date"))
            & (F.col("customer_id") == victim)).count()
        assert got == expected
