"""Layout queries: JSONL round trips, small files vs compacted, dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.operators.compaction import compact_files
from auric.operators.layout import compact, export_sorted_jsonl, layout_summary
from auric.oracle import sql
from auric.plans.dashboard import dashboard, dashboard_wrapped
from auric.queries import register
from auric.queries.core import silver_events_of
from auric.session import ensure_conf, workspace
from auric.sources import driver_tables as dtb
from auric.sources import jsonl

SMALL_FILES = 200
DASHBOARD_DAY = "2024-01-09"
CDC_SORT = ("event_time", "ticket_id", "cdc_seq")


@register("jsonl_events", sql("SELECT * FROM v_events", "v_events"))
def jsonl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a JSON Lines landing file, read back with the typed schema."""
    ensure_conf(spark)
    path = workspace(spark, "landing-events")
    jsonl.write_jsonl(dtb.runtime_events(spark, sf_dir), path)
    return jsonl.read_events(spark, path)


@register("jsonl_roundtrip", sql("SELECT * FROM v_tickets_cdc", "v_tickets_cdc"))
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records exported as globally sorted JSON Lines and read back raw."""
    ensure_conf(spark)
    path = workspace(spark, "export-cdc")
    cdc = dtb.tickets_cdc(spark, sf_dir)
    export_sorted_jsonl(cdc.withColumnRenamed("priority_raw", "priority"), path, CDC_SORT)
    return jsonl.read_cdc(spark, path)


def gold_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_events_of(spark, sf_dir).drop("_ingested_at", "ingested_date")


def write_small_files(spark: SparkSession, sf_dir: str) -> str:
    """The dashboard's source as it grew: many small files, rows in no order."""
    path = workspace(spark, "gold-events-small")
    gold_events(spark, sf_dir).repartition(SMALL_FILES).write.mode("overwrite").parquet(path)
    return path


def write_compacted(spark: SparkSession, small_path: str) -> str:
    path = workspace(spark, "gold-events-compact")
    compact(spark.read.parquet(small_path), path, "event_date", ("customer_name", "event_time"))
    return path


def top_customer(events: DataFrame) -> str:
    """The customer with the most events (ties by name) — one bounded row."""
    r = (events.groupBy("customer_name").agg(F.count(F.lit(1)).alias("n"))
         .orderBy(F.col("n").desc(), F.col("customer_name")).first())
    return r["customer_name"]


_DASH_SQL = sql(f"""
SELECT customer_name, count(*) AS n_events, count(DISTINCT ticket_id) AS n_tickets,
       round(avg(latency_ms), 1) AS avg_latency_ms,
       CAST(round_even(round(quantile_cont(latency_ms, 0.95), 6), 0) AS INT) AS p95_latency_ms,
       CAST(sum(CASE WHEN is_escalated THEN 1 ELSE 0 END) AS BIGINT) AS n_escalated,
       CAST(sum(tokens_in + tokens_out) AS BIGINT) AS tokens_total
FROM silver_events
WHERE customer_name = (SELECT customer_name FROM top_customer)
  AND strftime(event_time, '%Y-%m-%d') = '{DASHBOARD_DAY}'
GROUP BY 1""", "silver_events", local="""top_customer AS (
    SELECT customer_name FROM silver_events GROUP BY 1 ORDER BY count(*) DESC, customer_name LIMIT 1)""")


@register("dashboard", _DASH_SQL)
def dashboard_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original form: glob scan of small files, day tested on a formatted timestamp."""
    ensure_conf(spark)
    ev = spark.read.parquet(write_small_files(spark, sf_dir))
    return dashboard_wrapped(ev, top_customer(ev), DASHBOARD_DAY)


@register("dashboard_pruned", _DASH_SQL)
def dashboard_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After compaction: day folders, sorted rows, sargable filters."""
    ensure_conf(spark)
    small = write_small_files(spark, sf_dir)
    ev = spark.read.parquet(write_compacted(spark, small))
    return dashboard(ev, top_customer(ev), DASHBOARD_DAY)


@register("compact_roundtrip", sql(
    "SELECT * EXCLUDE (_ingested_at, ingested_date) FROM silver_events", "silver_events"))
def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row survives the re-layout (the compacted table, read back)."""
    ensure_conf(spark)
    return spark.read.parquet(write_compacted(spark, write_small_files(spark, sf_dir)))


def write_lookup(spark: SparkSession, small_path: str) -> str:
    """Compacted for two kinds of point query: pages of few rows for the customer
    that the files are sorted by, Bloom filters for the ticket."""
    path = workspace(spark, "gold-events-lookup")
    compact(spark.read.parquet(small_path), path, "event_date", ("customer_name", "event_time"),
            page_rows=500, bloom_columns=("ticket_id",))
    return path


@register("dashboard_page_index", _DASH_SQL)
def dashboard_page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pruned dashboard over pages of few rows: the page index leaves out other customers."""
    ensure_conf(spark)
    ev = spark.read.parquet(write_lookup(spark, write_small_files(spark, sf_dir)))
    return dashboard(ev, top_customer(ev), DASHBOARD_DAY)


@register("compact_incremental", sql("SELECT * EXCLUDE (_ingested_at, ingested_date) FROM silver_events", "silver_events"))
def compact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row survives when a table that grew by appended batches is compacted
    file by file, twice: after the first batches and again after the others."""
    ensure_conf(spark)
    path = workspace(spark, "gold-events-appended")
    events = gold_events(spark, sf_dir)
    for batches in ((0, 1, 2), (3, 4)):
        for k in batches:
            (events.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == k).repartition(4, "event_date")
             .write.mode("append").partitionBy("event_date").parquet(path))
        compact_files(spark, path, ("customer_name", "event_time"))
    return spark.read.parquet(path)


@register("layout_audit")
def layout_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows per file before and after compaction (no SQL oracle)."""
    ensure_conf(spark)
    small = write_small_files(spark, sf_dir)
    compacted = write_compacted(spark, small)
    return layout_summary(spark.read.parquet(small), "small_files").unionByName(
        layout_summary(spark.read.parquet(compacted), "compacted"))
