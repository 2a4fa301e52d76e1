from __future__ import annotations

from auric.plans.audit import delivery_audit
from auric.sources import driver_tables as dtb
from auric.sources.jsonl import EVENT_SCHEMA
from auric.streaming import ingest

SMALL = "/root/testdata/sf0.001"


def _run(spark, work, sink_kind, crash):
    ev = dtb.runtime_events(spark, SMALL)
    topic = work("topic")
    ingest.write_topic(ev, topic, 6)
    sink, ckpt = work("sink"), work("ckpt")
    make = lambda: ingest.read_topic(spark, topic, EVENT_SCHEMA, 2)
    restarts = ingest.run_with_restart(make, ingest.sink_writer(sink_kind, sink), ckpt, crash)
    stored = ingest.read_sink(spark, sink_kind, sink)
    return restarts, delivery_audit(ev, stored).first()


def test_crash_after_write_replays_batch(spark, work):
    restarts, a = _run(spark, work, "append", 1)
    assert restarts == 1 and a.n_lost == 0 and a.n_duplicated > 0 and not a.ok


def test_idempotent_sinks_store_each_message_once(spark, work):
    for kind in ("upsert", "batch_folder"):
        restarts, a = _run(spark, work, kind, 1)
        assert restarts == 1 and a.ok and a.n_stored == a.n_sent
