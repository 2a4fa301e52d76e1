"""Slices, audits, joins, scalar mappings and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.numeric import round_binary
from auric.functions.time import date_literal, day_slice
from auric.operators.sample import exact_n_sample, rank_cohorts
from auric.operators.spine import densify, lateral_range
from auric.oracle import sql
from auric.plans import audit, gold, silver
from auric.queries import register
from auric.queries.core import silver_events_of, silver_tickets_of
from auric.session import ensure_conf
from auric.sources import driver_tables as dt

RUN_DATE = "2024-01-10"
TARGET_CUTOFF = "2024-01-15"      # target built from arrivals before this day
LOOKBACK_DAYS = 3
FIRST_N = 20000                   # the reference's topic excerpt size
SAMPLE_N = 500
COHORTS = (("update", 300), ("bad_update", 100))


def _cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return dt.tickets_cdc(spark, sf_dir)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return dt.runtime_events(spark, sf_dir)


# ---------------------------------------------------------------- slices
@register("ingest_slice", sql(
    f"SELECT event_id, event_time, _ingested_at FROM v_events "
    f"WHERE _ingested_at >= TIMESTAMP '{RUN_DATE} 00:00:00' "
    f"AND _ingested_at < TIMESTAMP '{RUN_DATE} 00:00:00' + INTERVAL 1 DAY", "v_events"))
def ingest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.where(day_slice("_ingested_at", RUN_DATE)).select("event_id", "event_time",
                                                                "_ingested_at")


@register("lookback_slice", sql(
    f"SELECT event_id, event_date, customer_id FROM silver_events "
    f"WHERE event_date >= (SELECT CAST(max(event_date) - INTERVAL {LOOKBACK_DAYS} DAY AS DATE) "
    f"FROM silver_events WHERE ingested_date < DATE '{TARGET_CUTOFF}')", "silver_events"))
def lookback_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to recompute: event_date ≥ max(event_date of target) − 3 days."""
    from auric.plans.incremental import lookback_filter
    se = silver_events_of(spark, sf_dir)
    target = gold.feature_daily(se.where(F.col("ingested_date") < date_literal(TARGET_CUTOFF)))
    return lookback_filter(se, target, "event_date", LOOKBACK_DAYS).select(
        "event_id", "event_date", "customer_id")


# ---------------------------------------------------------------- audits
# Quantiles by ordered ranks: rank p * (n - 1), between its two neighbours.
_LAG_CTES = """ranked AS (
    SELECT lag, row_number() OVER (ORDER BY lag) - 1 AS k, count(*) OVER () AS n
    FROM (SELECT (epoch(_ingested_at) // 1 - epoch(event_time) // 1) / 86400 AS lag FROM silver_events)),
spots AS (
    SELECT p, round(sum(lag * greatest(0, 1 - abs(k - p * (n - 1)))), 6) AS days
    FROM ranked, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) AS v(p)
    GROUP BY p),
lagged AS (SELECT lag FROM ranked),
prof AS (
    SELECT (SELECT days FROM spots WHERE p = 0.5) AS p50_days,
           (SELECT days FROM spots WHERE p = 0.95) AS p95_days,
           (SELECT days FROM spots WHERE p = 0.99) AS p99_days,
           (SELECT round(max(lag), 6) FROM ranked) AS max_days,
           (SELECT round(count(*) FILTER (age > INTERVAL 1 DAY) / count(*), 6)
            FROM (SELECT _ingested_at - event_time AS age FROM silver_events)) AS late_share,
           (SELECT count(*) FROM ranked) AS n_rows,
           CAST((SELECT ceil(days) FROM spots WHERE p = 0.99) AS INT) AS lookback_days)"""
_LAG = """SELECT prof.*,
       round((SELECT count(*) FROM lagged WHERE lag > prof.lookback_days) / prof.n_rows, 6)
           AS beyond_share
FROM prof"""


@register("lag_profile", sql(_LAG, "silver_events", local=_LAG_CTES))
def lag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.lag_profile(silver_events_of(spark, sf_dir), p=0.99)


@register("lag_histogram", sql(
    "SELECT date_diff('hour', event_time, _ingested_at) AS lag_hours, count(*) AS n "
    "FROM silver_events GROUP BY 1", "silver_events"))
def lag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.lag_histogram(silver_events_of(spark, sf_dir), "hour")


@register("value_histogram", sql(
    "SELECT priority_raw, count(*) AS n FROM v_tickets_cdc GROUP BY 1", "v_tickets_cdc"))
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.value_histogram(_cdc(spark, sf_dir), "priority_raw")


@register("drift_timeline", sql(
    "SELECT CAST(event_time AS DATE) AS day, "
    "count(*) FILTER (WHERE (CASE WHEN regexp_matches(priority_raw, '^\\s*[+-]?\\d+\\s*$') "
    "THEN try_cast(priority_raw AS INTEGER) END) IS NULL) AS n_non_numeric, "
    "count(*) AS n_total FROM v_tickets_cdc GROUP BY 1", "v_tickets_cdc"))
def drift_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.drift_timeline(_cdc(spark, sf_dir))


@register("duplicate_keys", sql(
    "SELECT event_id, count(*) AS n FROM v_events_dup GROUP BY 1 HAVING count(*) > 1",
    "v_events_dup"))
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return audit.duplicate_keys(dt.with_replayed_duplicates(_events(spark, sf_dir)), "event_id")


@register("topk_duplicates", sql(
    "SELECT ticket_id, count(*) AS n FROM v_tickets_cdc GROUP BY 1 HAVING count(*) > 1 "
    "ORDER BY n DESC, ticket_id LIMIT 10", "v_tickets_cdc"))
def topk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.top_duplicates(_cdc(spark, sf_dir), "ticket_id", 10)


@register("first_n", sql(
    f"SELECT event_id, ticket_id, customer_id, event_type, latency_ms, event_time, _ingested_at "
    f"FROM v_events ORDER BY event_id LIMIT {FIRST_N}", "v_events"))
def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first N messages of the topic (offset order = event_id)."""
    e = _events(spark, sf_dir)
    return (e.orderBy("event_id").limit(FIRST_N)
            .select("event_id", "ticket_id", "customer_id", "event_type", "latency_ms",
                    "event_time", "_ingested_at"))


_NAIVE_GOLD = """naive_gold AS (
    SELECT DISTINCT event_date, customer_id FROM silver_events WHERE ingested_date = event_date)"""


def _naive_target(se: DataFrame) -> DataFrame:
    """What a run without lookback ends with: only same-day arrivals made it."""
    return gold.feature_daily(se.where(F.col("ingested_date") == F.col("event_date")))


@register("missing_pairs", sql("""
SELECT event_date, count(*) AS n_missing
FROM (SELECT event_date, customer_id FROM silver_events EXCEPT SELECT event_date, customer_id FROM naive_gold)
GROUP BY event_date""", "silver_events", local=_NAIVE_GOLD))
def missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    se = silver_events_of(spark, sf_dir)
    return audit.missing_by_day(se, _naive_target(se))


@register("missing_arrivals", sql("""
SELECT event_date, min(ingested_date) AS first_arrival, max(ingested_date) AS last_arrival, count(*) AS n_rows
FROM (SELECT *, bool_or(ingested_date = event_date) OVER (PARTITION BY event_date, customer_id) AS same_day
      FROM silver_events)
WHERE NOT same_day GROUP BY event_date""", "silver_events"))
def missing_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    se = silver_events_of(spark, sf_dir)
    return audit.missing_arrivals(se, _naive_target(se))


# ---------------------------------------------------------------- spine / range
@register("spine_densify", sql("""
SELECT c.customer_id, CAST(d.d AS DATE) AS event_date,
       coalesce(f.n_events, 0) AS n_events, f.n_events IS NULL AS is_gap
FROM (SELECT DISTINCT customer_id FROM silver_events) c
CROSS JOIN generate_series((SELECT min(event_date) FROM silver_events)::TIMESTAMP,
                           (SELECT max(event_date) FROM silver_events)::TIMESTAMP,
                           INTERVAL 1 DAY) AS d(d)
LEFT JOIN feature_daily f ON f.customer_id = c.customer_id AND f.event_date = CAST(d.d AS DATE)
""", "feature_daily"))
def spine_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    se = silver_events_of(spark, sf_dir)
    feats = gold.feature_daily(se)
    return densify(feats, se, ["customer_id"], "event_date", {"n_events": 0})


@register("lateral_range", sql(
    "SELECT event_date, customer_id, unnest(range(n_tickets)) AS i FROM feature_daily",
    "feature_daily"))
def lateral_range_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = gold.feature_daily(silver_events_of(spark, sf_dir))
    return lateral_range(feats.select("event_date", "customer_id", "n_tickets"),
                         "n_tickets").drop("n_tickets")


# ---------------------------------------------------------------- joins
@register("join_inner", sql(
    "SELECT e.event_id, ticket_id, t.priority, t.status, e.latency_ms "
    "FROM silver_events e JOIN silver_tickets t USING (ticket_id)",
    "silver_events", "silver_tickets"))
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = silver_events_of(spark, sf_dir).select("event_id", "ticket_id", "latency_ms")
    t = silver_tickets_of(spark, sf_dir).select("ticket_id", "priority", "status")
    return e.join(t, "ticket_id", "inner")


@register("join_flag", sql(
    "SELECT t.ticket_id, coalesce(q.flag, false) AS has_rejected "
    "FROM silver_tickets t LEFT JOIN (SELECT DISTINCT ticket_id, true AS flag FROM quarantine) q "
    "USING (ticket_id)", "silver_tickets", "quarantine"))
def join_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdc = _cdc(spark, sf_dir)
    t = silver.silver_tickets(cdc).select("ticket_id")
    q = (silver.quarantine_tickets(cdc).select("ticket_id").distinct()
         .withColumn("flag", F.lit(True)))
    return (t.join(q, "ticket_id", "left")
            .select("ticket_id", F.coalesce("flag", F.lit(False)).alias("has_rejected")))


@register("join_computed_key", sql("""
SELECT t.ticket_id, c.event_date AS follow_up_date
FROM silver_tickets t
JOIN cal c ON c.day_idx = least(
    date_diff('day', (SELECT min(event_date) FROM silver_events), CAST(t.updated_at AS DATE))
        + 1 + t.csat % 3,
    (SELECT max(day_idx) FROM cal))""", "silver_events", "silver_tickets", local="""
cal AS (
    SELECT event_date, date_diff('day', (SELECT min(event_date) FROM silver_events), event_date)
               AS day_idx
    FROM (SELECT DISTINCT event_date FROM silver_events))"""))
def join_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ticket's follow-up day: ``least(created + 1 + csat % 3, last day)``."""
    se = silver_events_of(spark, sf_dir)
    first = se.select(F.min("event_date")).scalar()
    cal = (se.select("event_date").distinct()
           .withColumn("day_idx", F.datediff("event_date", first)))
    last = cal.select(F.max("day_idx")).scalar()
    t = silver_tickets_of(spark, sf_dir).select(
        "ticket_id",
        F.least(F.datediff(F.to_date("updated_at"), first) + 1 + F.col("csat") % 3, last)
        .alias("follow_idx"))
    return (t.join(cal, t["follow_idx"] == cal["day_idx"], "inner")
            .select("ticket_id", F.col("event_date").alias("follow_up_date")))


# ---------------------------------------------------------------- projections / scalars
@register("project_except", sql("SELECT * EXCLUDE (_topic, model) FROM v_events", "v_events"))
def project_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).drop("_topic", "model")


@register("scalar_string", sql(
    "SELECT cdc_seq, lpad(CAST(cdc_seq AS VARCHAR), 8, '0') AS seq_padded, "
    "repeat('*', csat) AS stars, lower(trim(priority_raw)) AS prio_norm, "
    "customer_id || ':' || ticket_id AS ck, CAST(length(subject) AS INT) AS subject_len "
    "FROM v_tickets_cdc", "v_tickets_cdc"))
def scalar_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cdc(spark, sf_dir)
    return c.select(
        "cdc_seq",
        F.lpad(F.col("cdc_seq").cast("string"), 8, "0").alias("seq_padded"),
        F.repeat(F.lit("*"), F.col("csat")).alias("stars"),
        F.lower(F.trim("priority_raw")).alias("prio_norm"),
        F.concat("customer_id", F.lit(":"), "ticket_id").alias("ck"),
        F.length("subject").alias("subject_len"))


@register("scalar_date", sql(
    "SELECT event_id, event_date, CAST(event_date - INTERVAL 3 DAY AS DATE) AS minus3, "
    "event_date + 1 AS plus1, strftime(event_time, '%Y-%m-%d') AS day_text, "
    "event_time + to_seconds(latency_ms) AS done_at FROM silver_events", "silver_events"))
def scalar_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    se = silver_events_of(spark, sf_dir)
    return se.select(
        "event_id", "event_date",
        F.date_sub("event_date", 3).alias("minus3"),
        F.date_add("event_date", 1).alias("plus1"),
        F.date_format("event_time", "yyyy-MM-dd").alias("day_text"),
        (F.col("event_time") + F.make_dt_interval(secs=F.col("latency_ms"))).alias("done_at"))


@register("scalar_math", sql(
    "SELECT event_id, event_id % 7 AS m7, event_id >> 3 AS sr3, "
    "round(CAST(latency_ms AS DOUBLE) / 7, 1) AS r1, "
    "least(tokens_in, tokens_out * 4) AS lo FROM v_events", "v_events"))
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(
        "event_id",
        F.pmod("event_id", F.lit(7)).alias("m7"),
        F.shiftright("event_id", 3).alias("sr3"),
        round_binary(F.col("latency_ms").cast("double") / 7, 1).alias("r1"),
        F.least("tokens_in", F.col("tokens_out") * 4).alias("lo"))


@register("scalar_array", sql(
    "SELECT transcript_id, turns[1] AS first_turn, CAST(len(turns) AS INT) AS n_turns, "
    "array_to_string(list_transform(turns, lambda x: CAST(length(x) AS VARCHAR)), ',') AS turn_lengths "
    "FROM v_transcripts", "v_transcripts"))
def scalar_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    t = dt.transcripts(spark, sf_dir)
    return t.select(
        "transcript_id",
        F.element_at("turns", 1).alias("first_turn"),
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: F.length(x).cast("string")), ",")
        .alias("turn_lengths"))


# ---------------------------------------------------------------- sampling
@register("exact_n_sample", sql(
    f"SELECT ticket_id, priority FROM silver_tickets "
    f"QUALIFY row_number() OVER (ORDER BY md5(ticket_id), ticket_id) <= {SAMPLE_N}",
    "silver_tickets"))
def exact_n_sample_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver_tickets_of(spark, sf_dir).select("ticket_id", "priority")
    return exact_n_sample(t, "ticket_id", SAMPLE_N)


_COHORT_CASE = " ".join(
    f"WHEN rk <= {sum(n for _, n in COHORTS[:i + 1])} THEN '{name}'"
    for i, (name, _) in enumerate(COHORTS))


@register("cohort_split", sql(
    f"SELECT ticket_id, CASE {_COHORT_CASE} END AS cohort FROM ("
    f"SELECT ticket_id, row_number() OVER (ORDER BY md5(ticket_id), ticket_id) AS rk "
    f"FROM silver_tickets) WHERE rk <= {sum(n for _, n in COHORTS)}", "silver_tickets"))
def cohort_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver_tickets_of(spark, sf_dir).select("ticket_id")
    return rank_cohorts(t, "ticket_id", [n for _, n in COHORTS], [c for c, _ in COHORTS])
