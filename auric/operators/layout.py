"""Physical layout: compaction, file audit, sorted export.

``compact`` rewrites a dataset so that a point query (one customer, one day)
opens few files and few row groups:

* folders by the day (``partitionBy``) — a filter on the day prunes whole
  folders before any file is opened; a day has tens, not thousands, of
  values per year, so the folder count stays small;
* inside a day, rows sorted by (customer, time) so each row group's min/max
  on customer is tight and Parquet's min/max skipping works;
* one ``repartitionByRange`` on (day, customer, time) decides which task
  writes which rows.  Range boundaries come from a distributed sample, so a
  day or a customer holding a third of all rows is split across many tasks
  (the time column breaks up even a single hot (day, customer)), and each
  task writes one contiguous key range → few, similarly sized files.

Row-group size is set in *bytes* (``parquet.block.size``), the unit
Spark's Parquet writer uses.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 128 * 1024 * 1024


class CompactionError(RuntimeError):
    """The compacted copy doesn't hold the rows of its source."""


# Catalyst's "unknown" is the largest long; a join's estimate is a product of
# its sides' and says nothing about the result.
UNKNOWN_BYTES = 1 << 62


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan without joins (from file sizes for a scan); None if it has none."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES or "Join" in plan.toString():
        return None
    return size


def table_bytes(df: DataFrame) -> int:
    """Size of a result: the estimate, or else its rows times the schema's default row size."""
    size = estimated_bytes(df)
    return df.count() * int(df._jdf.schema().defaultSize()) if size is None else size


def compact(df: DataFrame, dst: str, partition_by: str = "event_date",
            sort_by: Sequence[str] = ("customer_name", "event_time"),
            n_tasks: int | None = None, target_file_bytes: int = TARGET_FILE_BYTES,
            row_group_bytes: int | None = None, max_records_per_file: int | None = None,
            page_rows: int | None = None, bloom_columns: Sequence[str] = ()) -> None:
    """Rewrite ``df`` into ``dst``; fails if the rows written are not those read.

    ``page_rows`` bounds the rows of a page, the unit that a sorted column's page
    index skips.  ``bloom_columns`` are near-unique columns that the files are not
    sorted by: their row groups get Bloom filters, which an equality skips by
    (written without a dictionary, which would take the filter's place).
    """
    if n_tasks is None:
        n_tasks = max(1, math.ceil(table_bytes(df) / target_file_bytes))
    keys = [partition_by, *sort_by]
    out = df.repartitionByRange(n_tasks, *keys).sortWithinPartitions(*keys)
    w = out.write.mode("overwrite").partitionBy(partition_by)
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if page_rows:
        w = w.option("parquet.page.row.count.limit", str(page_rows))
    for c in bloom_columns:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.enable.dictionary#{c}", "false")
             .option("parquet.bloom.filter.adaptive.enabled", "true"))
    w.parquet(dst)
    before, after = df.count(), df.sparkSession.read.parquet(dst).count()
    if before != after:
        raise CompactionError(f"compaction of {before} rows wrote {after} to {dst}")


def file_stats(df: DataFrame) -> DataFrame:
    """Rows per data file of a file-based DataFrame (``_metadata.file_path``)."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows"))


def layout_summary(df: DataFrame, label: str) -> DataFrame:
    stats = file_stats(df)
    return stats.agg(
        F.lit(label).alias("layout"),
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.min("n_rows").alias("min_rows_per_file"),
        F.max("n_rows").alias("max_rows_per_file"),
        F.round(F.avg("n_rows"), 1).alias("avg_rows_per_file"))


def export_sorted_jsonl(df: DataFrame, path: str, sort_by: Sequence[str]) -> None:
    """Globally sorted JSON Lines: range-partitioned sort, files in key order."""
    from auric.sources.jsonl import write_jsonl
    write_jsonl(df.orderBy(*sort_by), path)
