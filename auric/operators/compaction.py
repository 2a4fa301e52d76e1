"""Incremental compaction: only small or overlapping files are rewritten.

``compact`` in `layout` rewrites a whole dataset.  Here a table of Parquet files
(in partition folders or in one) is kept compact at the cost of what was added:

* **Plan.**  One scan of the sort columns gives each file's size and its first
  and last sort key.  In a folder, files whose key ranges overlap form a group;
  groups of several files and files below a quarter of the target size are
  loose.  Neighbouring loose groups are packed into bins of about the target
  size; a bin of one file stays as it is.  A file of good size whose range no
  other file touches is never read further.
* **Rewrite.**  A bin becomes one sorted file, written by one task.  A bin of
  overlapping files beyond twice the target is split by ranges of the sort key,
  so no task holds more than about a file.
* **Commit.**  New files are written beside the table, their rows counted, and a
  journal of moves and removals is published; then the files are moved and the
  old ones removed.  After a crash ``recover`` (which every run begins with)
  finishes a published journal and drops an unpublished attempt.  Between the
  first move and the last removal, metadata calls only, a reader may see rows
  twice; for readers that must never do so see `versioned`.  One compaction of a
  table runs at a time.

The driver holds the names of the files to rewrite, as Spark's own file listing does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auric.operators.layout import TARGET_FILE_BYTES, CompactionError
from auric.sources import fs

#: A file is small below this part of the target size.
SMALL_PART = 4
#: Rewriting changes sizes a little, so neighbours may be packed again.
MAX_ROUNDS = 5


def file_spans(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """(folder, file, n_bytes, n_rows, first, last) for every data file that holds
    rows; ``first`` and ``last`` are structs of the sort columns, NULLs first."""
    at = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes"),
                   F.struct(*sort_by).alias("key"))
    return (at.groupBy("file", "n_bytes")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("first"), F.max("key").alias("last"))
            .withColumn("folder", F.regexp_replace("file", r"/[^/]+$", "")))


def plan_bins(spans: DataFrame, target_file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """(file, folder, island, bin, n_out, n_rows) for every file to rewrite; a bin
    is (folder, island, bin) and becomes ``n_out`` files."""
    by_key = Window.partitionBy("folder").orderBy("first", "last", "file")
    reach = F.max("last").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reach.isNull() | (F.col("first") >= reach), 1).otherwise(0)
    files = (spans.withColumn("apart", apart)
             .withColumn("group", F.sum("apart").over(by_key.rowsBetween(Window.unboundedPreceding, 0))))
    groups = files.groupBy("folder", "group").agg(F.count(F.lit(1)).alias("files"), F.sum("n_bytes").alias("bytes"))
    in_order = Window.partitionBy("folder").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    loose = (F.col("files") > 1) | (F.col("bytes") * SMALL_PART < target_file_bytes)
    filled = Window.partitionBy("folder", "island").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    packed = (groups.withColumn("loose", loose)
              .withColumn("island", F.sum(F.when(F.col("loose"), 0).otherwise(1)).over(in_order)).where("loose")
              .withColumn("bin", F.floor((F.sum("bytes").over(filled) - F.col("bytes")) / target_file_bytes)))
    bins = (packed.groupBy("folder", "island", "bin")
            .agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes")).where("files > 1")
            .select("folder", "island", "bin", F.greatest(F.floor(F.col("bytes") / target_file_bytes), F.lit(1)).alias("n_out")))
    return (files.join(packed.select("folder", "group", "island", "bin"), ["folder", "group"])
            .join(bins, ["folder", "island", "bin"])
            .select("file", "folder", "island", "bin", "n_out", "n_rows"))


def _plain(spark: SparkSession, uri: str) -> str:
    """A file's path as readers and the file system take it (``_metadata`` gives it encoded)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def _write(rows: DataFrame, path: str, n_tasks: int, sort_by: Sequence[str], ranges: bool) -> None:
    keys = ["_out", *sort_by]
    dealt = rows.repartitionByRange(n_tasks, *keys) if ranges else rows.repartition(n_tasks, "_out")
    dealt.sortWithinPartitions(*keys).write.partitionBy("_out").parquet(path)


def _round(spark: SparkSession, path: str, sort_by: Sequence[str], target_file_bytes: int) -> dict[str, int]:
    chosen = plan_bins(file_spans(spark.read.parquet(path), sort_by), target_file_bytes).collect()
    if not chosen:
        return {"files_read": 0, "files_written": 0, "rows": 0}
    bins = sorted({(r["folder"], r["island"], r["bin"]) for r in chosen})
    number = {b: k for k, b in enumerate(bins)}
    out = [number[r["folder"], r["island"], r["bin"]] for r in chosen]
    files = [_plain(spark, r["file"]) for r in chosen]
    plan = spark.createDataFrame([(r["file"], k, r["n_out"]) for r, k in zip(chosen, out, strict=True)],
                                 "_file string, _out long, _n_out long")
    data = spark.read.option("mergeSchema", "true").parquet(*files)   # files alone: no partition columns
    rows = data.withColumn("_file", F.col("_metadata.file_path")).join(plan, "_file").drop("_file")
    n_out = {k: r["n_out"] for r, k in zip(chosen, out, strict=True)}
    single, split = [k for k in n_out if n_out[k] == 1], sum(n for n in n_out.values() if n > 1)
    attempt = f"{path}/_compaction-{uuid.uuid4().hex[:12]}"
    parts = []
    if single:
        parts.append(f"{attempt}/whole")
        _write(rows.where("_n_out = 1").drop("_n_out"), parts[-1], len(single), sort_by, ranges=False)
    if split:
        parts.append(f"{attempt}/split")
        _write(rows.where("_n_out > 1").drop("_n_out"), parts[-1], split, sort_by, ranges=True)
    want, got = sum(r["n_rows"] for r in chosen), sum(spark.read.parquet(p).count() for p in parts)
    if want != got:
        raise CompactionError(f"compaction of {want} rows wrote {got}; {path} is as it was")
    moves = []
    for part in parts:
        for name in fs.list_dirs(spark, part):
            k = int(name.split("=")[1])
            folder = _plain(spark, bins[k][0])
            moves += [[f, f"{folder}/c{k}-{f.rsplit('/', 1)[1]}"] for f in fs.data_files(spark, f"{part}/{name}")]
    fs.publish_text(spark, f"{attempt}.json", json.dumps({"moves": moves, "drop": files}))
    recover(spark, path)
    return {"files_read": len(files), "files_written": len(moves), "rows": want}


def recover(spark: SparkSession, path: str) -> int:
    """Finish published journals and drop unpublished attempts; how many journals were finished."""
    path = path.rstrip("/")
    journals = [n for n in fs.list_files(spark, path) if n.startswith("_compaction-") and n.endswith(".json")]
    for name in journals:
        journal = json.loads(fs.read_text(spark, f"{path}/{name}"))
        for src, dst in journal["moves"]:
            if fs.exists(spark, src) and not fs.rename(spark, src, dst):
                raise CompactionError(f"can't move {src} to {dst}; run recover again")
        for old in journal["drop"]:
            fs.delete(spark, old)
        fs.delete(spark, f"{path}/{name}")
    for name in fs.list_dirs(spark, path):
        if name.startswith("_compaction-"):
            fs.delete(spark, f"{path}/{name}")
    return len(journals)


def compact_files(spark: SparkSession, path: str, sort_by: Sequence[str],
                  target_file_bytes: int = TARGET_FILE_BYTES) -> dict[str, int]:
    """Rewrite what is small or overlaps in the table at ``path`` until nothing is
    left to do; returns the number of files read and written and rows rewritten
    (all 0 for a compact table)."""
    path = path.rstrip("/")
    recover(spark, path)
    total = {"files_read": 0, "files_written": 0, "rows": 0}
    for _ in range(MAX_ROUNDS):
        done = _round(spark, path, sort_by, target_file_bytes)
        total = {k: total[k] + done[k] for k in total}
        if not done["files_read"]:
            break
    return total
