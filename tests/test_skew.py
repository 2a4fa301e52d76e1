"""One key holding a third of all rows: results stay exact and the heavy
steps are split before the shuffle."""
from __future__ import annotations

from pyspark.sql import functions as F

from auric.operators.sample import exact_n_sample
from auric.operators.state import latest_per_key
from auric.plans import gold


def _skewed(spark, n=30000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0                              # a third of all rows
    return ids.select(
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("ticket_id"),
        F.col("id").alias("cdc_seq"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(F.col("id") % 86400))).alias("event_time"),
        F.when(hot, "C_HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string")))
        .alias("customer_id"),
        F.lit("n").alias("customer_name"), F.lit("SMB").alias("segment"),
        (F.col("id") % 4800 + 120).cast("int").alias("latency_ms"),
        F.lit(200).alias("tokens_in"), F.lit(40).alias("tokens_out"),
        (F.col("id") % 7 == 0).alias("is_escalated"),
    ).repartition(8)


def test_latest_state_of_a_hot_key(spark):
    df = _skewed(spark)
    latest = latest_per_key(df, "ticket_id", ("event_time", "cdc_seq"))
    hot = latest.where("ticket_id = 'HOT'").first()
    expected = (df.where("ticket_id = 'HOT'")
                .orderBy(F.col("event_time").desc(), F.col("cdc_seq").desc()).first())
    assert hot.cdc_seq == expected.cdc_seq
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")   # map-side top-1


def test_exact_features_for_a_hot_customer(spark):
    df = _skewed(spark).withColumn("event_date", F.to_date("event_time"))
    feats = gold.feature_daily(df)
    hot = feats.where("customer_id = 'C_HOT'").first()
    raw = df.where("customer_id = 'C_HOT'")
    assert hot.n_events == raw.count() == 10000
    assert hot.n_tickets == raw.select("ticket_id").distinct().count()
    p95 = raw.select(F.percentile("latency_ms", F.lit(0.95))).first()[0]
    assert hot.p95_latency_ms == int(round(p95))


def test_exact_sample_size_under_skew(spark):
    df = _skewed(spark).select("cdc_seq").withColumnRenamed("cdc_seq", "k")
    assert exact_n_sample(df, "k", 1234).count() == 1234
