"""Audits: arrival lag, drift, gaps, duplicates.

Every function returns a small DataFrame computed by distributed
aggregation; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions.domain import as_strict_int
from auric.functions.time import seconds_between, units_between

DAY_SECONDS = 86400.0


def lag_days(event_time: str = "event_time", arrived: str = "_ingested_at") -> Column:
    return seconds_between(event_time, arrived).cast("double") / F.lit(DAY_SECONDS)


def lag_profile(df: DataFrame, p: float = 0.99, event_time: str = "event_time",
                arrived: str = "_ingested_at") -> DataFrame:
    """P50/P95/P99/max of the arrival lag in days, the late share, and the
    recommended lookback ``ceil(P<p>)`` with the share of rows beyond it.

    Exact percentiles (``percentile``), computed with partial aggregation.
    """
    lag = lag_days(event_time, arrived)
    late = F.col(arrived) > F.col(event_time) + F.make_dt_interval(days=F.lit(1))
    prof = df.select(lag.alias("_lag"), late.alias("_late")).agg(
        F.percentile("_lag", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99), F.lit(p))).alias("_q"),
        F.max("_lag").alias("_max"),
        F.avg(F.when(F.col("_late"), 1.0).otherwise(0.0)).alias("_late_share"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    look = F.ceil(F.round(F.col("_q")[3], 6)).cast("int")
    prof = prof.select(
        F.round(F.col("_q")[0], 6).alias("p50_days"),
        F.round(F.col("_q")[1], 6).alias("p95_days"),
        F.round(F.col("_q")[2], 6).alias("p99_days"),
        F.round("_max", 6).alias("max_days"),
        F.round("_late_share", 6).alias("late_share"),
        "n_rows",
        look.alias("lookback_days"),
    )
    beyond = df.where(lag > prof.select("lookback_days").scalar()).select(F.count(F.lit(1))).scalar()
    return prof.withColumn("beyond_share", F.round(beyond / F.col("n_rows"), 6))


def lag_histogram(df: DataFrame, unit: str = "hour", event_time: str = "event_time",
                  arrived: str = "_ingested_at") -> DataFrame:
    return (df.groupBy(units_between(event_time, arrived, unit).alias(f"lag_{unit}s"))
            .agg(F.count(F.lit(1)).alias("n")))


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    """Count per value, NULLs last (as ``ORDER BY 1 NULLS LAST``)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col(col).asc_nulls_last()))


def drift_timeline(df: DataFrame, raw: str = "priority_raw",
                   time_col: str = "event_time") -> DataFrame:
    """Per day: rows whose raw value is not a plain integer, next to the total."""
    non_numeric = as_strict_int(raw).isNull()
    return (df.groupBy(F.to_date(time_col).alias("day"))
            .agg(F.count_if(non_numeric).alias("n_non_numeric"),
                 F.count(F.lit(1)).alias("n_total")))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def top_duplicates(df: DataFrame, keys: str | Sequence[str], k: int = 10) -> DataFrame:
    """Top-k keys by row count (a report; TakeOrdered keeps k rows per task)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (duplicate_keys(df, keys)
            .orderBy(F.col("n").desc(), *[F.col(c).asc() for c in keys]).limit(k))


def missing_pairs(present: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples of ``present`` that ``target`` lacks (left anti join)."""
    return present.select(*keys).distinct().join(target.select(*keys), list(keys), "left_anti")


def missing_by_day(present: DataFrame, target: DataFrame, day: str = "event_date",
                   entity: str = "customer_id") -> DataFrame:
    gaps = missing_pairs(present, target, [day, entity])
    return gaps.groupBy(day).agg(F.count(F.lit(1)).alias("n_missing"))


def missing_arrivals(present: DataFrame, target: DataFrame, day: str = "event_date",
                     entity: str = "customer_id", arrived_day: str = "ingested_date") -> DataFrame:
    """For each day with gaps: earliest/latest arrival day and rows of the gap."""
    gaps = missing_pairs(present, target, [day, entity])
    rows = present.join(gaps, [day, entity], "left_semi")
    return rows.groupBy(day).agg(
        F.min(arrived_day).alias("first_arrival"),
        F.max(arrived_day).alias("last_arrival"),
        F.count(F.lit(1)).alias("n_rows"))


def delivery_audit(sent: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """(sent, stored, distinct stored, lost, duplicated, ok) in one row."""
    s = sent.select(key)
    t = stored.select(key)
    n_sent = s.select(F.count(F.lit(1))).scalar()
    n_stored = t.select(F.count(F.lit(1))).scalar()
    n_distinct = t.select(F.count_distinct(key)).scalar()
    lost = s.join(t, key, "left_anti").select(F.count(F.lit(1))).scalar()
    extra = t.join(s, key, "left_anti").select(F.count(F.lit(1))).scalar()
    one = sent.sparkSession.range(1)
    return one.select(
        n_sent.alias("n_sent"), n_stored.alias("n_stored"), n_distinct.alias("n_distinct"),
        lost.alias("n_lost"), (n_stored - n_distinct).alias("n_duplicated"),
        extra.alias("n_unknown"),
    ).withColumn("ok", (F.col("n_lost") == 0) & (F.col("n_duplicated") == 0)
                 & (F.col("n_unknown") == 0))
