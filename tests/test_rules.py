from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auric.functions.domain import normalize_domain, reject_reason
from auric.plans import silver

CASES = [("1", 1), (" 2 ", 2), ("+3", 3), ("4", 4), ("urgent", 1), ("High", 2),
         (" medium ", 3), ("LOW", 4), ("P1", None), ("unknown", None), ("0", None),
         ("5", None), ("-1", None), ("", None), (None, None), ("1.5", None), ("1e0", None),
         ("99999999999", None)]


def test_normalize_domain(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "raw string")
    got = {r["raw"]: r["p"] for r in df.select("raw", normalize_domain("raw").alias("p")).collect()}
    assert got == {r: e for r, e in CASES}


def test_reject_reason_order(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("7",), ("P2",)], "raw string")
    got = [r["why"] for r in df.select(reject_reason("raw").alias("why")).collect()]
    assert got == ["priority is null", "priority is blank",
                   "priority number outside 1..4", "priority not mappable to 1..4"]


def _cdc(spark, rows):
    schema = ("op string, ticket_id string, cdc_seq long, event_time timestamp_ntz, "
              "_ingested_at timestamp_ntz, customer_id string, customer_name string, "
              "segment string, priority_raw string, category string, channel string, "
              "status string, csat int, first_response_sec int, subject string, body string")
    base = dict(customer_id="C1", customer_name="A", segment="SMB", category="x",
                channel="chat", csat=3, first_response_sec=60, subject="s", body="b")
    import datetime as dt
    out = []
    for op, tid, seq, day, prio, status in rows:
        t = dt.datetime(2024, 1, day, 12)
        out.append(dict(op=op, ticket_id=tid, cdc_seq=seq, event_time=t, _ingested_at=t,
                        priority_raw=prio, status=status, **base))
    return spark.createDataFrame(out, schema)


def test_bad_newest_record_keeps_older_state(spark):
    cdc = _cdc(spark, [("c", "T1", 0, 1, "2", "open"), ("u", "T1", 2, 3, "P1", "closed")])
    st = silver.silver_tickets(cdc).collect()
    assert [(r.ticket_id, r.priority, r.status) for r in st] == [("T1", 2, "open")]
    assert silver.quarantine_tickets(cdc).count() == 1


def test_labels_are_not_quarantined_and_tombstone_drops(spark):
    cdc = _cdc(spark, [("c", "T1", 0, 1, "urgent", "open"), ("c", "T2", 0, 1, "3", "open"),
                       ("d", "T2", 1, 1, "3", "closed")])
    assert silver.quarantine_tickets(cdc).count() == 0
    assert [r.ticket_id for r in silver.silver_tickets(cdc).collect()] == ["T1"]


def test_bad_tombstone_is_quarantined_and_ticket_lives(spark):
    cdc = _cdc(spark, [("c", "T1", 0, 1, "1", "open"), ("d", "T1", 1, 2, "", "closed")])
    assert [r.ticket_id for r in silver.silver_tickets(cdc).collect()] == ["T1"]


def test_split_partitions_input(spark):
    from auric.sources import driver_tables as dt
    cdc = dt.tickets_cdc(spark, "/root/testdata/sf0.001")
    valid, rejected = silver.split_valid(cdc)
    n, v, r = cdc.count(), valid.count(), rejected.count()
    assert v + r == n and v > 0 and r > 0
    keys = ["ticket_id", "cdc_seq"]
    assert valid.select(*keys).intersect(rejected.select(*keys)).count() == 0


@pytest.mark.parametrize("unit,a,b,expected", [
    ("hour", "2024-01-01 10:59:00", "2024-01-01 11:01:00", 1),
    ("hour", "2024-01-01 10:00:00", "2024-01-01 10:59:59", 0),
    ("second", "2024-01-01 10:00:00.9", "2024-01-01 10:00:01.1", 1),
    ("day", "2024-01-01 23:00:00", "2024-01-03 01:00:00", 2),
])
def test_units_between_counts_boundaries(spark, unit, a, b, expected):
    from auric.functions.time import units_between
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert df.select(units_between("a", "b", unit)).first()[0] == expected


def test_rounding_rules(spark):
    from auric.functions.numeric import round_binary, to_int_half_even
    df = spark.createDataFrame([(8.575, 2.5, 3.5, 8.95)], "a double, b double, c double, d double")
    r = df.select(round_binary("a", 2), to_int_half_even("b"), to_int_half_even("c"),
                  to_int_half_even("d")).first()
    assert list(r) == [8.57, 2, 4, 9]
