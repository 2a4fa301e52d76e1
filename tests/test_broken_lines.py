"""Change records that can't be read are set aside with their text."""
from __future__ import annotations

from auric.sources import driver_tables as dtb
from auric.sources import jsonl

SMALL = "/root/testdata/sf0.001"


def test_broken_lines_keep_their_text_and_reason(spark, work):
    good = '{"op":"c","ticket_id":"T-1","cdc_seq":1,"event_time":"2024-01-01T00:00:00","priority":2}'
    lines = [good, good[:40], "not json", '{"op":"c","ticket_id":"T-2","cdc_seq":"many"}', '{"op":"d"}', "[1, 2]", "17", "   ",
             '{"op":"u","ticket_id":"T-3","priority":null,"more":{"a":[1]}}', '{"op":"u","ticket_id":"T-4","priority":"  High"}']
    path = work("landing")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    records, broken = jsonl.read_cdc_checked(spark, path)
    assert [(r["ticket_id"], r["cdc_seq"], r["priority_raw"]) for r in records.orderBy("ticket_id").collect()] == [
        ("T-1", 1, "2"), ("T-3", None, None), ("T-4", None, "  High")]
    assert {(r["line"], r["reject_reason"]) for r in broken.collect()} == {
        (lines[1], jsonl.BROKEN), (lines[2], jsonl.BROKEN), (lines[3], jsonl.WRONG_TYPE), (lines[4], jsonl.NO_KEY),
        (lines[5], jsonl.BROKEN), (lines[6], jsonl.BROKEN)}
    assert broken.where("file_path like 'file:%landing%'").count() == 6


def test_whole_feed_reads_alike(spark, work):
    path = work("landing")
    jsonl.write_lines(jsonl.cdc_json_lines(dtb.tickets_cdc(spark, SMALL)), path)
    records, broken = jsonl.read_cdc_checked(spark, path)
    plain = jsonl.read_cdc(spark, path)
    assert broken.count() == 0 and records.columns == plain.columns
    assert records.exceptAll(plain).count() == 0 and plain.exceptAll(records).count() == 0
