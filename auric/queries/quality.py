"""Quality queries: fingerprints, column tests, invariants, expected counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.domain import PRIORITY_HI, PRIORITY_LO, as_strict_int, normalize_domain
from auric.oracle import sql
from auric.plans import gold, quality, silver
from auric.queries import register
from auric.queries.core import events_with_redelivery, silver_events_of
from auric.session import ensure_conf
from auric.sources import driver_tables as dt


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    return {
        "gold_training_set": gold.training_set(silver.silver_tickets(cdc)),
        "gold_feature_daily": gold.feature_daily(silver_events_of(spark, sf_dir)),
        "gold_doc_chunks": gold.doc_chunks(silver.silver_transcripts(dt.transcripts(spark, sf_dir))),
        "quarantine_tickets": silver.quarantine_tickets(cdc),
    }


_GOLD_CTE = {"gold_training_set": "training_set", "gold_feature_daily": "feature_daily",
             "gold_doc_chunks": "doc_chunks", "quarantine_tickets": "quarantine"}


def _fp_sql(table: str) -> str:
    cols = quality.FINGERPRINT_KEYS[table]
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    h = f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)"
    return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, "
            f"CAST(coalesce(sum(CAST({h} AS DECIMAL(38,0))), 0) AS VARCHAR) AS hash_sum "
            f"FROM {_GOLD_CTE[table]}")


_FP_UNION = " UNION ALL ".join(_fp_sql(t) for t in quality.FINGERPRINT_KEYS)
_FP_NEEDS = tuple(_GOLD_CTE.values())


@register("fingerprint_sum", sql(f"SELECT * FROM ({_FP_UNION})", *_FP_NEEDS))
def fingerprint_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fingerprints(gold_tables(spark, sf_dir)).drop("fingerprint")


@register("fingerprint_md5", sql(
    "SELECT table_name, CASE WHEN n_rows = 0 THEN 'empty' "
    "ELSE md5(CAST(n_rows AS VARCHAR) || ':' || hash_sum) END AS fingerprint "
    f"FROM ({_FP_UNION})", *_FP_NEEDS))
def fingerprint_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fingerprints(gold_tables(spark, sf_dir)).select("table_name", "fingerprint")


# ---------------------------------------------------------------- column tests
@register("test_unique", sql("""
SELECT 'silver_events' AS model, 'unique' AS test, 'event_id' AS column_name,
       (SELECT count(*) FROM (SELECT event_id FROM silver_events GROUP BY 1 HAVING count(*) > 1)) AS n_failing
UNION ALL
SELECT 'silver_tickets', 'unique', 'ticket_id',
       (SELECT count(*) FROM (SELECT ticket_id FROM silver_tickets GROUP BY 1 HAVING count(*) > 1))
UNION ALL
SELECT 'gold_doc_chunks', 'unique', 'chunk_id',
       (SELECT count(*) FROM (SELECT chunk_id FROM doc_chunks GROUP BY 1 HAVING count(*) > 1))
UNION ALL
SELECT 'bronze_events', 'unique', 'event_id',
       (SELECT count(*) FROM (SELECT event_id FROM v_events_dup GROUP BY 1 HAVING count(*) > 1))
""", "silver_events", "silver_tickets", "doc_chunks", "v_events_dup"))
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    chunks = gold.doc_chunks(silver.silver_transcripts(dt.transcripts(spark, sf_dir)))
    return quality.union_all([
        quality.test_unique(silver_events_of(spark, sf_dir), "event_id", "silver_events"),
        quality.test_unique(silver.silver_tickets(cdc), "ticket_id", "silver_tickets"),
        quality.test_unique(chunks, "chunk_id", "gold_doc_chunks"),
        quality.test_unique(events_with_redelivery(spark, sf_dir), "event_id", "bronze_events"),
    ])


@register("test_not_null", sql("""
SELECT 'silver_tickets' AS model, 'not_null' AS test, 'ticket_id' AS column_name,
       count(*) FILTER (WHERE ticket_id IS NULL) AS n_failing FROM silver_tickets
UNION ALL SELECT 'silver_tickets', 'not_null', 'priority', count(*) FILTER (WHERE priority IS NULL) FROM silver_tickets
UNION ALL SELECT 'silver_events', 'not_null', 'event_id', count(*) FILTER (WHERE event_id IS NULL) FROM silver_events
UNION ALL SELECT 'silver_events', 'not_null', 'event_date', count(*) FILTER (WHERE event_date IS NULL) FROM silver_events
UNION ALL SELECT 'bronze_tickets_cdc', 'not_null', 'priority_raw', count(*) FILTER (WHERE priority_raw IS NULL) FROM v_tickets_cdc
""", "silver_tickets", "silver_events", "v_tickets_cdc"))
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    return quality.union_all([
        quality.test_not_null(silver.silver_tickets(cdc), ["ticket_id", "priority"], "silver_tickets"),
        quality.test_not_null(silver_events_of(spark, sf_dir), ["event_id", "event_date"],
                              "silver_events"),
        quality.test_not_null(cdc, ["priority_raw"], "bronze_tickets_cdc"),
    ])


_STRICT = "(CASE WHEN regexp_matches(priority_raw, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(priority_raw AS INTEGER) END)"


@register("test_accepted_values", sql(f"""
SELECT 'silver_tickets' AS model, 'accepted_values' AS test, 'priority' AS column_name,
       count(*) FILTER (WHERE priority IS NOT NULL AND priority NOT IN (1, 2, 3, 4)) AS n_failing
FROM silver_tickets
UNION ALL
SELECT 'bronze_tickets_cdc', 'accepted_values', 'priority_int',
       count(*) FILTER (WHERE {_STRICT} IS NOT NULL AND {_STRICT} NOT IN (1, 2, 3, 4))
FROM v_tickets_cdc""", "silver_tickets", "v_tickets_cdc"))
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    accepted = range(PRIORITY_LO, PRIORITY_HI + 1)
    return quality.union_all([
        quality.test_accepted_values(silver.silver_tickets(cdc), "priority", accepted,
                                     "silver_tickets"),
        quality.test_accepted_values(cdc.withColumn("priority_int", as_strict_int("priority_raw")),
                                     "priority_int", accepted, "bronze_tickets_cdc"),
    ])


@register("domain_violations", sql(f"""
SELECT ticket_id, cdc_seq, priority_raw FROM v_tickets_cdc
WHERE {_STRICT} IS NULL OR {_STRICT} NOT BETWEEN 1 AND 4""", "v_tickets_cdc"))
def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a plain integer cast (no label mapping, no range) lets through or loses."""
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir).withColumn("_p", as_strict_int("priority_raw"))
    return quality.domain_violations(cdc, "_p", PRIORITY_LO, PRIORITY_HI).select(
        "ticket_id", "cdc_seq", "priority_raw")


# ---------------------------------------------------------------- invariants
def _live_tickets_by_aggregate(cdc: DataFrame) -> DataFrame:
    """Tickets whose newest valid record is not a tombstone — via max_by, not a window."""
    valid = cdc.where(normalize_domain("priority_raw").isNotNull())
    latest = valid.groupBy("ticket_id").agg(
        F.max_by("op", F.struct("event_time", "cdc_seq")).alias("op"))
    return latest.where(F.col("op") != "d")


@register("invariants", sql("""
SELECT 'silver_priority_in_domain' AS check_name,
       (SELECT count(*) FROM silver_tickets WHERE priority IS NULL OR priority NOT BETWEEN 1 AND 4) AS n,
       (SELECT count(*) FROM silver_tickets WHERE priority IS NULL OR priority NOT BETWEEN 1 AND 4) = 0 AS ok
UNION ALL
SELECT 'quarantine_is_complement', (SELECT count(*) FROM quarantine),
       (SELECT count(*) FROM quarantine) + (SELECT count(*) FROM cdc_clean WHERE priority_clean IS NOT NULL)
           = (SELECT count(*) FROM v_tickets_cdc)
UNION ALL
SELECT 'training_set_one_row_per_ticket',
       (SELECT count(*) FROM (SELECT ticket_id FROM training_set GROUP BY 1 HAVING count(*) > 1)),
       (SELECT count(*) FROM (SELECT ticket_id FROM training_set GROUP BY 1 HAVING count(*) > 1)) = 0
UNION ALL
SELECT 'silver_keeps_live_tickets', (SELECT count(*) FROM silver_tickets),
       (SELECT count(*) FROM silver_tickets) = (SELECT count(*) FROM current_state WHERE op <> 'd')
""", "silver_tickets", "quarantine", "cdc_clean", "training_set", "current_state"))
def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    st = silver.silver_tickets(cdc)
    valid, rejected = silver.split_valid(cdc)
    ts = gold.training_set(st)
    one = spark.range(1)
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    bad_priority = n(quality.domain_violations(st, "priority", PRIORITY_LO, PRIORITY_HI))
    n_quar, n_valid, n_cdc = n(rejected), n(valid), n(cdc)
    dup = n(ts.groupBy("ticket_id").count().where(F.col("count") > 1))
    n_silver, n_live = n(st), n(_live_tickets_by_aggregate(cdc))
    rows = [
        ("silver_priority_in_domain", bad_priority, bad_priority == 0),
        ("quarantine_is_complement", n_quar, n_quar + n_valid == n_cdc),
        ("training_set_one_row_per_ticket", dup, dup == 0),
        ("silver_keeps_live_tickets", n_silver, n_silver == n_live),
    ]
    return quality.union_all([one.select(F.lit(name).alias("check_name"), v.alias("n"),
                                         ok.alias("ok")) for name, v, ok in rows])


_EXPECTED_CTES = """
expected AS (
    SELECT 'gold_doc_chunks' AS table_name, CAST(sum(len(turns)) AS BIGINT) AS expected_rows
    FROM v_transcripts
    UNION ALL SELECT 'gold_feature_daily', count(*)
    FROM (SELECT DISTINCT CAST(event_time AS DATE), customer_id FROM v_events)
    UNION ALL SELECT 'gold_training_set', count(*) FROM current_state WHERE op <> 'd'
    UNION ALL SELECT 'quarantine_tickets',
        (SELECT count(*) FROM cdc_clean) - (SELECT count(*) FROM cdc_clean WHERE priority_clean IS NOT NULL)),
actual AS (
    SELECT 'gold_doc_chunks' AS table_name, count(*) AS actual_rows FROM doc_chunks
    UNION ALL SELECT 'gold_feature_daily', count(*) FROM feature_daily
    UNION ALL SELECT 'gold_training_set', count(*) FROM training_set
    UNION ALL SELECT 'quarantine_tickets', count(*) FROM quarantine)"""


@register("expected_counts", sql("""
SELECT e.table_name, e.expected_rows, a.actual_rows, a.actual_rows - e.expected_rows AS diff,
       coalesce(a.actual_rows = e.expected_rows, false) AS ok
FROM expected e FULL OUTER JOIN actual a USING (table_name)""",
    "v_transcripts", "v_events", "current_state", "cdc_clean", "training_set", "feature_daily",
    "doc_chunks", "quarantine", local=_EXPECTED_CTES))
def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold row counts against counts derived independently from the raw feeds."""
    ensure_conf(spark)
    cdc = dt.tickets_cdc(spark, sf_dir)
    tr = dt.transcripts(spark, sf_dir)
    ev = dt.runtime_events(spark, sf_dir)
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    valid = cdc.where(normalize_domain("priority_raw").isNotNull())
    one = spark.range(1)
    expected = quality.union_all([
        one.select(F.lit("gold_doc_chunks").alias("table_name"),
                   tr.select(F.sum(F.size("turns")).cast("bigint")).scalar().alias("expected_rows")),
        one.select(F.lit("gold_feature_daily").alias("table_name"),
                   n(ev.select(F.to_date("event_time"), "customer_id").distinct()).alias("expected_rows")),
        one.select(F.lit("gold_training_set").alias("table_name"),
                   n(_live_tickets_by_aggregate(cdc)).alias("expected_rows")),
        one.select(F.lit("quarantine_tickets").alias("table_name"),
                   (n(cdc) - n(valid)).alias("expected_rows")),
    ])
    return quality.expected_counts(gold_tables(spark, sf_dir), expected).select(
        "table_name", "expected_rows", "actual_rows", "diff", "ok")
