"""Write-strategy queries: each writes real tables in the shared work folder
and returns the final table, whose content the oracle states in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.time import date_literal, ts_literal
from auric.operators import write as W
from auric.oracle import features_over, silver_tickets_before, sql
from auric.plans import bronze, gold, quality, replay, silver
from auric.plans.incremental import read_gold
from auric.queries import register
from auric.queries.core import silver_events_of
from auric.session import ensure_conf, workspace
from auric.sources import driver_tables as dtb

REPLACED_DAY = "2024-01-10"
CLEARED_DAY = "2024-01-11"
CUTOFF = "2024-01-15"
LOOKBACK = 3
STREAM_COLUMNS = ["event_id", "ticket_id", "customer_id", "customer_name", "event_type",
                  "latency_ms", "event_time", "_ingested_at"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return dtb.runtime_events(spark, sf_dir)


@register("bronze_partition_replace", sql(
    f"SELECT *, CAST(_ingested_at AS DATE) AS _batch_date FROM v_events "
    f"WHERE CAST(_ingested_at AS DATE) <> DATE '{CLEARED_DAY}'", "v_events"))
def bronze_partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill Bronze by arrival day, reload one day twice, clear another with
    an empty batch: the reloaded day is unchanged, the cleared day is gone."""
    ev = _events(spark, sf_dir)
    path = workspace(spark, "bronze-events")
    (ev.withColumn(bronze.BATCH_COL, F.to_date("_ingested_at"))
       .write.mode("overwrite").partitionBy(bronze.BATCH_COL).parquet(path))
    for _ in range(2):
        W.replace_partition(bronze.day_batch(ev, REPLACED_DAY), path, bronze.BATCH_COL,
                            dt.date.fromisoformat(REPLACED_DAY))
    empty = bronze.day_batch(ev, CLEARED_DAY).where(F.lit(False))
    W.replace_partition(empty, path, bronze.BATCH_COL, dt.date.fromisoformat(CLEARED_DAY))
    return W.read_table(spark, path)


@register("full_refresh", sql("SELECT * FROM silver_tickets", "silver_tickets"))
def full_refresh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild twice, the second time from the table itself."""
    ensure_conf(spark)
    path = workspace(spark, "silver-tickets")
    W.full_refresh(silver.silver_tickets(dtb.tickets_cdc(spark, sf_dir)), path)
    W.full_refresh(W.read_table(spark, path).where(F.col("priority").isNotNull()), path)
    return W.read_table(spark, path)


@register("append_rerun", sql(
    "SELECT * FROM training_set UNION ALL SELECT * FROM training_set", "training_set"))
def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key-less incremental write: running it twice stores every row twice."""
    ensure_conf(spark)
    path = workspace(spark, "append")
    ts = gold.training_set(silver.silver_tickets(dtb.tickets_cdc(spark, sf_dir)))
    W.append(ts, path)
    W.append(ts, path)
    return W.read_table(spark, path)


@register("delete_insert", sql(
    "SELECT * FROM (" + features_over("silver_events", f"ingested_date < DATE '{CUTOFF}'") + ") "
    f"WHERE event_date < DATE '{CUTOFF}' - INTERVAL {LOOKBACK} DAY "
    "UNION ALL " + features_over(
        "silver_events", f"event_date >= DATE '{CUTOFF}' - INTERVAL {LOOKBACK} DAY"),
    "silver_events"))
def delete_insert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as of the cut-off, then the last days recomputed from all arrivals."""
    se = silver_events_of(spark, sf_dir)
    path = workspace(spark, "feature-daily")
    cut = dt.date.fromisoformat(CUTOFF)
    first = gold.feature_daily(se.where(F.col("ingested_date") < date_literal(cut)))
    W.delete_insert(first, path, gold.FEATURE_KEYS, "event_date")
    redo = gold.feature_daily(se.where(
        F.col("event_date") >= date_literal(cut - dt.timedelta(days=LOOKBACK))))
    W.delete_insert(redo, path, gold.FEATURE_KEYS, "event_date")
    return W.read_table(spark, path)


@register("merge_upsert", sql(
    "SELECT * FROM ts_before WHERE ticket_id NOT IN (SELECT ticket_id FROM ts_after) "
    "UNION ALL SELECT * FROM ts_after",
    "cdc_clean", "training_set",
    local=f"""ts_before AS (
    SELECT ticket_id, customer_id, customer_name, segment, priority, category, channel, status,
           csat, first_response_sec,
           CAST(length(subject) + length(body) AS INT) AS text_len,
           CASE WHEN status IN ('resolved', 'closed') THEN 1 ELSE 0 END AS label_resolved,
           updated_at, _ingested_at
    FROM ({silver_tickets_before(CUTOFF)})),
ts_after AS (SELECT * FROM training_set WHERE _ingested_at >= TIMESTAMP '{CUTOFF} 00:00:00')"""))
def merge_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training set as of the cut-off, then tickets that changed since merged by key."""
    ensure_conf(spark)
    cdc = dtb.tickets_cdc(spark, sf_dir)
    path = workspace(spark, "training-set")
    before = gold.training_set(silver.silver_tickets(
        cdc.where(F.col("_ingested_at") < ts_literal(CUTOFF))))
    W.merge_upsert(before, path, "ticket_id")
    after = gold.training_set(silver.silver_tickets(cdc)).where(
        F.col("_ingested_at") >= ts_literal(CUTOFF))
    W.merge_upsert(after, path, "ticket_id")
    return read_gold(spark, path)


def _upsert_redelivery(spark: SparkSession, sf_dir: str, on_match: str) -> DataFrame:
    ev = _events(spark, sf_dir).select(*STREAM_COLUMNS)
    path = workspace(spark, f"upsert-{on_match}")
    W.merge_upsert(ev, path, "event_id", on_match=on_match)
    again = (ev.where(F.col("event_id") % 10 == 0)
             .withColumn("_ingested_at", F.col("_ingested_at") + F.make_dt_interval(hours=F.lit(1))))
    W.merge_upsert(again, path, "event_id", on_match=on_match)
    return read_gold(spark, path)


_COLS = ", ".join(STREAM_COLUMNS)


@register("upsert_update", sql(
    f"SELECT * REPLACE (CASE WHEN event_id % 10 = 0 THEN _ingested_at + INTERVAL 1 HOUR "
    f"ELSE _ingested_at END AS _ingested_at) FROM (SELECT {_COLS} FROM v_events)", "v_events"))
def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivered messages replace the stored row (ON CONFLICT DO UPDATE)."""
    return _upsert_redelivery(spark, sf_dir, "update")


@register("upsert_ignore", sql(f"SELECT {_COLS} FROM v_events", "v_events"))
def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivered messages are dropped, the first stored row wins (DO NOTHING)."""
    return _upsert_redelivery(spark, sf_dir, "ignore")


def _arrival_range(df: DataFrame, col: str = "_ingested_at") -> tuple[dt.date, dt.date]:
    r = df.agg(F.min(F.to_date(col)).alias("a"), F.max(F.to_date(col)).alias("b")).first()
    return r["a"], r["b"]


@register("training_set_incremental",
          sql("SELECT * FROM training_set_incremental", "training_set_incremental"))
def training_set_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set a day-by-day replay over every arrival day ends with."""
    ensure_conf(spark)
    cdc = dtb.tickets_cdc(spark, sf_dir)
    first, last = _arrival_range(cdc)
    return replay.backfill_training_set(cdc, first, last)


@register("feature_daily_incremental",
          sql("SELECT * FROM feature_daily_incremental", "feature_daily_incremental"))
def feature_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily features a replay with a 3-day lookback ends with."""
    se = W.stage(silver_events_of(spark, sf_dir), "silver-events")
    first, last = _arrival_range(se)
    return replay.backfill_feature_daily(se, first, last, LOOKBACK)


STABILITY_RUNS = 3


def _stability_tables(feeds: dict[str, DataFrame], run: int) -> dict[str, DataFrame]:
    """The Gold tables recomputed from inputs shuffled differently per run."""
    parts = 3 + 5 * run
    first, last = _arrival_range(feeds["tickets_cdc"])      # before the shuffle, which changes no row
    cdc = dtb.shuffled(feeds["tickets_cdc"], parts)
    # read for the range and four times by the backfill: deduplicated once
    se = W.stage(silver.silver_events(dtb.shuffled(
        dtb.with_replayed_duplicates(feeds["events"]), parts)), "silver-events")
    sfirst, slast = _arrival_range(se)
    return {
        "gold_training_set": replay.backfill_training_set(cdc, first, last),
        "gold_feature_daily": replay.backfill_feature_daily(se, sfirst, slast, LOOKBACK),
        "gold_doc_chunks": gold.doc_chunks(silver.silver_transcripts(
            dtb.shuffled(feeds["transcripts"], parts))),
        "quarantine_tickets": silver.quarantine_tickets(cdc),
    }


_STAB_CTE = {"gold_training_set": "training_set_incremental",
             "gold_feature_daily": "feature_daily_incremental",
             "gold_doc_chunks": "doc_chunks", "quarantine_tickets": "quarantine"}


def _stab_fp_sql(table: str) -> str:
    cols = quality.FINGERPRINT_KEYS[table]
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    h = f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)"
    return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, "
            f"CAST(coalesce(sum(CAST({h} AS DECIMAL(38,0))), 0) AS VARCHAR) AS hash_sum "
            f"FROM {_STAB_CTE[table]}")


@register("stability_report", sql(
    f"SELECT table_name, CAST({STABILITY_RUNS} AS BIGINT) AS n_runs, CAST(1 AS BIGINT) AS n_fingerprints, "
    "TRUE AS stable, n_rows, CASE WHEN n_rows = 0 THEN 'empty' "
    "ELSE md5(CAST(n_rows AS VARCHAR) || ':' || hash_sum) END AS fingerprint FROM ("
    + " UNION ALL ".join(_stab_fp_sql(t) for t in quality.FINGERPRINT_KEYS) + ")",
    *_STAB_CTE.values()))
def stability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recompute the Gold tables three times from differently shuffled inputs;
    a table is stable iff all runs give one fingerprint."""
    ensure_conf(spark)
    feeds = dtb.landed({"tickets_cdc": dtb.tickets_cdc(spark, sf_dir), "events": dtb.runtime_events(spark, sf_dir),
                        "transcripts": dtb.transcripts(spark, sf_dir)})
    runs = []
    for run in range(STABILITY_RUNS):
        fp = quality.fingerprints(_stability_tables(feeds, run))
        runs.append(fp.withColumn("run", F.lit(run)))
    allfp = quality.union_all(runs)
    return allfp.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_distinct("fingerprint").alias("n_fingerprints"),
        (F.count_distinct("fingerprint") == 1).alias("stable"),
        F.max("n_rows").alias("n_rows"),
        F.max("fingerprint").alias("fingerprint"))
