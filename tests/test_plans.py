"""Physical-plan properties the design relies on, read from explain()."""
from __future__ import annotations

from auric.operators.layout import compact, layout_summary
from auric.plans import quality, silver
from auric.plans.dashboard import dashboard, dashboard_wrapped, scan_metrics
from auric.queries import layout as L
from auric.sources import driver_tables as dtb

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_the_shuffle(spark):
    st = silver.current_state(dtb.tickets_cdc(spark, SMALL))
    text = _plan(st)
    # a partial WindowGroupLimit runs map-side, below the Exchange
    assert text.count("WindowGroupLimit") >= 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_dashboard_prunes_folders_and_pushes_the_customer(spark, work):
    small = L.write_small_files(spark, SMALL)
    comp = L.write_compacted(spark, small)
    ev_s, ev_c = spark.read.parquet(small), spark.read.parquet(comp)
    top = L.top_customer(ev_s)
    pruned = dashboard(ev_c, top, L.DASHBOARD_DAY)
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "EqualTo(customer_name" in text
    before = scan_metrics(dashboard_wrapped(ev_s, top, L.DASHBOARD_DAY))
    after = scan_metrics(pruned)
    assert after["files"] < before["files"] and after["rows_scanned"] < before["rows_scanned"]
    assert pruned.collect() == dashboard_wrapped(ev_s, top, L.DASHBOARD_DAY).collect()


def test_compaction_keeps_every_row_and_cuts_files(spark, work):
    small = L.write_small_files(spark, SMALL)
    dst = work("compacted")
    compact(spark.read.parquet(small), dst, "event_date", ("customer_name", "event_time"))
    a, b = spark.read.parquet(small), spark.read.parquet(dst)
    cols = ["event_id", "customer_id", "event_date", "latency_ms"]
    assert (quality.fingerprint(a, cols).first()["fingerprint"]
            == quality.fingerprint(b, cols).first()["fingerprint"])
    s_small = layout_summary(a, "small").first()
    s_comp = layout_summary(b, "compacted").first()
    assert s_comp.n_files < s_small.n_files and s_comp.n_rows == s_small.n_rows


def test_page_index_and_bloom_filters_skip_rows(spark, work):
    small = L.write_small_files(spark, "/root/testdata/sf0.1")
    plain, lookup = spark.read.parquet(L.write_compacted(spark, small)), spark.read.parquet(L.write_lookup(spark, small))
    top = L.top_customer(plain)
    before, after = (scan_metrics(dashboard(df, top, L.DASHBOARD_DAY)) for df in (plain, lookup))
    assert dashboard(lookup, top, L.DASHBOARD_DAY).collect() == dashboard(plain, top, L.DASHBOARD_DAY).collect()
    # a ticket inside most files' range that few files hold
    one = plain.groupBy("ticket_id").count().orderBy("count", "ticket_id").first()["ticket_id"]
    without = work("no-bloom")
    plain.write.option("parquet.enable.dictionary#ticket_id", "false").partitionBy("event_date").parquet(without)
    found = [scan_metrics(df.where(df.ticket_id == one)) for df in (spark.read.parquet(without), lookup)]
    print(before, after, found)
    assert after["rows_scanned"] < before["rows_scanned"]
    assert found[1]["rows_scanned"] < found[0]["rows_scanned"]
    assert lookup.where(lookup.ticket_id == one).count() == plain.where(plain.ticket_id == one).count() > 0
