from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from auric.operators.state import earliest_per_key
from auric.operators.write import WriteError, read_table
from auric.plans import gold
from auric.streaming.features import EVENT_KEY, FeatureUpkeep, facts, features, net

SCHEMA = ("event_id long, ticket_id string, customer_id string, customer_name string, segment string, latency_ms int, "
          "tokens_in int, tokens_out int, is_escalated boolean, event_time timestamp_ntz, _ingested_at timestamp_ntz")
START = dt.datetime(2024, 5, 1)


def made_events(n, seed=3, ids=None):
    """Events of few customers, one with a third of them, a segment that changes in a day, NULL measures."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = "c0" if rng.random() < 0.33 else f"c{rng.randint(1, 4)}"
        rows.append((rng.choice(ids) if ids else i, rng.choice([None, "t1", "t2", f"t{i}"]), c, c.upper(),
                     rng.choice(["a", "b"]) if c == "c1" else "a", rng.choice([None, 5, rng.randint(0, 4000)]),
                     rng.choice([None, 3, 9]) if c != "c2" else None, rng.randint(0, 9), rng.choice([None, True, False]),
                     START + dt.timedelta(hours=rng.randint(0, 70)), START + dt.timedelta(days=3, minutes=rng.randint(0, 50))))
    return rows


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def expected(spark, given):
    events = spark.createDataFrame(given, SCHEMA).withColumn("event_date", F.to_date("event_time"))
    return rows(gold.feature_daily(earliest_per_key(events, EVENT_KEY)))


def test_features_from_facts_are_those_from_events(spark):
    given = made_events(600)
    events = spark.createDataFrame(given, SCHEMA).withColumn("event_date", F.to_date("event_time"))
    signed = events.withColumn("_sign", F.lit(1))
    assert rows(features(facts(signed))) == expected(spark, given)
    first, second = signed.where("event_id % 3 = 0"), signed.where("event_id % 3 <> 0")
    assert rows(features(net(facts(first).unionByName(facts(second))))) == expected(spark, given)
    back = facts(signed.unionByName(second.withColumn("_sign", F.lit(-1))))
    assert rows(features(back)) == expected(spark, [g for g in given if g[0] % 3 == 0])
    assert facts(signed.unionByName(signed.withColumn("_sign", F.lit(-1)))).count() == 0


@pytest.mark.parametrize("every", [0, 2])
def test_batches_in_any_order_with_redeliveries_and_replays(spark, work, every):
    """Ids come back with other arrivals, customers and measures; each batch is replayed once."""
    given = made_events(240, seed=9, ids=range(60))
    given += given[:20]
    handler = FeatureUpkeep(work("features"), work("gold"), snapshot_every=every)
    for k in range(4):
        batch = spark.createDataFrame(given[k::4], SCHEMA)
        for _ in range(2):
            handler(batch, k)
    stored = read_table(spark, handler.gold_path)
    assert rows(stored) == expected(spark, given)


def test_an_earlier_delivery_moves_an_event_to_another_customer(spark, work):
    base = made_events(1)[0]
    late = (7, "t", "c9", "C9", *base[4:10], START + dt.timedelta(days=2))
    early = (7, "t", "c8", "C8", *base[4:10], START + dt.timedelta(days=1))
    handler = FeatureUpkeep(work("features"), work("gold"))
    handler(spark.createDataFrame([late], SCHEMA), 0)
    assert [r["customer_id"] for r in read_table(spark, handler.gold_path).collect()] == ["c9"]
    handler(spark.createDataFrame([early], SCHEMA), 1)
    handler(spark.createDataFrame([], SCHEMA), 2)
    handler(spark.createDataFrame([late], SCHEMA), 3)
    assert [r["customer_id"] for r in read_table(spark, handler.gold_path).collect()] == ["c8"]


def test_null_keys_fail_before_anything_is_written(spark, work):
    handler = FeatureUpkeep(work("features"), work("gold"))
    with pytest.raises(WriteError):
        handler(spark.createDataFrame([(None, *made_events(1)[0][1:])], SCHEMA), 0)
    assert not handler._numbers(spark, "log", "batch_id")
