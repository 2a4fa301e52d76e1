"""The dashboard query: one customer, one day, seven measures.

``dashboard_wrapped`` is the form that cannot prune: the day is tested on a
formatted timestamp, so neither folder names nor row-group statistics help
and every file is opened.  ``dashboard`` states the same filter on the bare
partition column (``event_date = DATE``) plus the customer equality, which
Catalyst turns into ``PartitionFilters`` and a pushed Parquet filter.
Both give the same row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.functions.numeric import exact_percentile_int, round_binary
from auric.functions.time import as_date, date_literal


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("ticket_id").alias("n_tickets"),
        round_binary(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
        exact_percentile_int("latency_ms", 0.95).alias("p95_latency_ms"),
        F.sum(F.when(F.col("is_escalated"), 1).otherwise(0)).cast("bigint").alias("n_escalated"),
        F.sum(F.col("tokens_in") + F.col("tokens_out")).cast("bigint").alias("tokens_total"),
    ]


def dashboard(events: DataFrame, customer_name: str, day: dt.date | str,
              date_col: str = "event_date") -> DataFrame:
    d = as_date(day)
    return (events.where((F.col("customer_name") == customer_name)
                         & (F.col(date_col) == date_literal(d)))
            .groupBy("customer_name").agg(*_measures()))


def dashboard_wrapped(events: DataFrame, customer_name: str, day: dt.date | str) -> DataFrame:
    d = as_date(day)
    return (events.where((F.col("customer_name") == customer_name)
                         & (F.date_format("event_time", "yyyy-MM-dd") == d.isoformat()))
            .groupBy("customer_name").agg(*_measures()))


def scan_metrics(df: DataFrame) -> dict[str, int]:
    """Run ``df`` and sum the file-scan metrics of its executed plan.

    ``files`` = data files opened, ``rows_scanned`` = rows the Parquet reader
    produced (row groups skipped by min/max statistics and folders pruned by
    partition filters are not counted) — the "rows scanned" of the
    reference's dashboard budget.
    """
    df.collect()                            # the result is one row
    totals = {"files": 0, "rows_scanned": 0}

    def metric(node, name: str) -> int:
        m = node.metrics()
        return int(m.apply(name).value()) if m.contains(name) else 0

    def walk(node) -> None:
        cls = node.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
            return
        if cls.endswith("QueryStageExec"):
            walk(node.plan())
            return
        if cls.startswith("FileSourceScanExec"):
            totals["files"] += metric(node, "numFiles")
            totals["rows_scanned"] += metric(node, "numOutputRows")
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return totals
