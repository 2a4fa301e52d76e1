"""Core Silver and Gold queries over the derived feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.domain import normalize_domain, reject_reason
from auric.oracle import sql
from auric.plans import gold, silver
from auric.queries import register
from auric.session import ensure_conf, workspace
from auric.sources import driver_tables as dt
from auric.sources import jsonl


def _cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return dt.tickets_cdc(spark, sf_dir)


def events_with_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return dt.with_replayed_duplicates(dt.runtime_events(spark, sf_dir))


def silver_events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_events(events_with_redelivery(spark, sf_dir))


def silver_tickets_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return silver.silver_tickets(dt.tickets_cdc(spark, sf_dir))


# ---------------------------------------------------------------- sources
@register("json_extract_raw", sql("SELECT * EXCLUDE (_source) FROM v_tickets_cdc", "v_tickets_cdc"))
def json_extract_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC written as mixed-type JSON lines, read back with raw ``priority`` text."""
    ensure_conf(spark)
    path = workspace(spark, "landing-cdc")
    jsonl.write_lines(jsonl.cdc_json_lines(dt.tickets_cdc(spark, sf_dir)), path)
    return jsonl.read_cdc(spark, path).drop("_source")


@register("cdc_broken_lines", sql("""
SELECT op, count(*) FILTER (WHERE cdc_seq % 20 <> 0) AS n_records, count(*) FILTER (WHERE cdc_seq % 20 = 0) AS n_broken,
       coalesce(max(CASE WHEN cdc_seq % 20 = 0 THEN 'line is not a JSON object' END), '') AS reject_reason
FROM v_tickets_cdc GROUP BY op""", "v_tickets_cdc"))
def cdc_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 20th change record arrives cut off: it is set aside with its text, the others are read."""
    ensure_conf(spark)
    path = workspace(spark, "landing-cut")
    lines = jsonl.cdc_json_lines(dt.tickets_cdc(spark, sf_dir))
    seq = F.regexp_extract("value", r'"cdc_seq":(\d+)', 1).cast("bigint")
    cut = F.when(seq % 20 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    jsonl.write_lines(lines.select(cut.alias("value")), path)
    records, broken = jsonl.read_cdc_checked(spark, path)
    none = F.lit(None).cast("string")
    both = records.select("op", none.alias("why")).unionByName(
        broken.select(F.regexp_extract("line", r'"op":"(\w+)"', 1).alias("op"), F.col("reject_reason").alias("why")))
    return both.groupBy("op").agg(F.count_if(F.col("why").isNull()).alias("n_records"), F.count("why").alias("n_broken"),
                                  F.coalesce(F.max("why"), F.lit("")).alias("reject_reason"))


@register("transcripts_array", sql(
    "SELECT transcript_id, ticket_id, lang, CAST(len(turns) AS INT) AS n_turns, "
    "array_to_string(turns, chr(10)) AS turns_text, event_time, _ingested_at "
    "FROM v_transcripts", "v_transcripts"))
def transcripts_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts through a JSON landing file with an ``array<string>`` column."""
    ensure_conf(spark)
    path = workspace(spark, "landing-transcripts")
    jsonl.write_jsonl(dt.transcripts(spark, sf_dir), path)
    t = jsonl.read_transcripts(spark, path)
    return t.select("transcript_id", "ticket_id", "lang",
                    F.size("turns").alias("n_turns"),
                    F.array_join("turns", "\n").alias("turns_text"),
                    "event_time", "_ingested_at")


# ---------------------------------------------------------------- rules
@register("normalize_domain", sql(
    "SELECT ticket_id, cdc_seq, priority_raw, priority_clean AS priority FROM cdc_clean",
    "cdc_clean"))
def normalize_domain_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdc = _cdc(spark, sf_dir)
    return cdc.select("ticket_id", "cdc_seq", "priority_raw",
                      normalize_domain("priority_raw").alias("priority"))


@register("reject_reason", sql(
    "SELECT reject_reason, count(*) AS n FROM quarantine GROUP BY 1", "quarantine"))
def reject_reason_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdc = _cdc(spark, sf_dir)
    bad = cdc.where(normalize_domain("priority_raw").isNull())
    return (bad.groupBy(reject_reason("priority_raw").alias("reject_reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("quarantine", sql("SELECT * FROM quarantine", "quarantine"))
def quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quarantine_tickets(_cdc(spark, sf_dir))


# ---------------------------------------------------------------- state
@register("latest_state", sql(
    "SELECT ticket_id, cdc_seq, op, priority_clean AS priority, event_time FROM current_state",
    "current_state"))
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = silver.current_state(_cdc(spark, sf_dir))
    return st.select("ticket_id", "cdc_seq", "op", F.col("priority_clean").alias("priority"),
                     "event_time")


@register("dedup_earliest", sql(
    "SELECT event_id, customer_id, latency_ms, event_time, _ingested_at FROM silver_events",
    "silver_events"))
def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_events_of(spark, sf_dir)
    return s.select("event_id", "customer_id", "latency_ms", "event_time", "_ingested_at")


@register("silver_events", sql("SELECT * FROM silver_events", "silver_events"))
def silver_events_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_events_of(spark, sf_dir)


@register("silver_tickets", sql("SELECT * FROM silver_tickets", "silver_tickets"))
def silver_tickets_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_tickets_of(spark, sf_dir)


@register("cdc_union", sql(
    "SELECT op, ticket_id, cdc_seq, event_time FROM v_tickets_cdc", "v_tickets_cdc"))
def cdc_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates, deletes and updates as three feeds, glued by a 3-way UNION ALL."""
    cdc = _cdc(spark, sf_dir).select(
        "op", "ticket_id", "cdc_seq", "event_time")
    creates = cdc.where(F.col("op") == "c")
    deletes = cdc.where(F.col("op") == "d")
    updates = cdc.where(F.col("op") == "u")
    return creates.unionByName(deletes).unionByName(updates)


# ---------------------------------------------------------------- gold
@register("doc_chunks", sql("SELECT * FROM doc_chunks", "doc_chunks"))
def doc_chunks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    t = silver.silver_transcripts(dt.transcripts(spark, sf_dir))
    return gold.doc_chunks(t)


@register("training_set", sql("SELECT * FROM training_set", "training_set"))
def training_set_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.training_set(silver_tickets_of(spark, sf_dir))


@register("feature_daily", sql("SELECT * FROM feature_daily", "feature_daily"))
def feature_daily_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.feature_daily(silver_events_of(spark, sf_dir))
