"""Incremental compaction: what is rewritten, what stays, and crashes."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auric.operators import compaction
from auric.operators.compaction import compact_files, file_spans, plan_bins
from auric.sources import fs

KEY = ("name", "at")
TARGET = 40_000


def _add(spark, path, low, high, files, mode="append"):
    rows = spark.range(low, high).select(
        (F.col("id") % 97).cast("string").alias("name"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("body"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("d "), (F.col("id") % 3).cast("string"))).alias("day"))
    rows.repartition(files).write.mode(mode).partitionBy("day").parquet(path)


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("name", "at", "body", "day").collect()), key=str)


def _files(spark, path):
    return {r["file"]: r for r in file_spans(spark.read.parquet(path), KEY).collect()}


def test_compact_table_is_left_alone_and_rows_stay(spark, work):
    path = work("files")
    _add(spark, path, 0, 4000, 6)
    want = _rows(spark, path)
    before = _files(spark, path)
    first = compact_files(spark, path, KEY, TARGET)
    after = _files(spark, path)
    assert first["files_read"] >= len(before) and len(after) < len(before)
    assert _rows(spark, path) == want
    assert compact_files(spark, path, KEY, TARGET) == {"files_read": 0, "files_written": 0, "rows": 0}
    assert _files(spark, path) == after
    for a in after.values():        # no two files of a folder overlap
        for b in after.values():
            if a["folder"] == b["folder"] and a["file"] != b["file"]:
                assert a["last"] <= b["first"] or b["last"] <= a["first"]


def test_only_touched_folders_and_ranges_are_rewritten(spark, work):
    path = work("files")
    _add(spark, path, 0, 4000, 6)
    compact_files(spark, path, KEY, TARGET)
    old = _files(spark, path)
    # new rows of one day and of the largest names only
    spark.range(3).select(F.lit("zz").alias("name"), F.col("id").alias("at"), F.lit("x").alias("body"),
                          F.lit("d 1").alias("day")).repartition(3).write.mode("append").partitionBy("day").parquet(path)
    want = _rows(spark, path)
    report = compact_files(spark, path, KEY, TARGET)
    kept = set(old) & set(_files(spark, path))
    assert {f for f in old if "d%201" not in f} <= kept and report["files_written"] == 1
    assert len(old) - len(kept) <= 1 and _rows(spark, path) == want


def test_plan_packs_neighbours_and_spares_good_files(spark):
    spans = spark.createDataFrame(
        [("a/1", 10, 5, (1,), (2,)), ("a/2", 10, 5, (2,), (3,)),          # touch, don't overlap; small
         ("a/3", 90, 50, (3,), (9,)),                                     # good size, apart
         ("a/4", 60, 5, (10,), (20,)), ("a/5", 60, 5, (15,), (30,)),      # overlap
         ("b/1", 5, 1, (1,), (2,)), ("c/1", 300, 9, (None,), (4,)), ("c/2", 300, 9, (2,), (5,))],
        "file string, n_bytes long, n_rows long, first struct<k:int>, last struct<k:int>").withColumn("folder", F.substring("file", 1, 1))
    got = {(r["file"], r["n_out"]) for r in plan_bins(spans, 100).collect()}
    assert got == {("a/1", 1), ("a/2", 1), ("a/4", 1), ("a/5", 1), ("c/1", 6), ("c/2", 6)}


@pytest.mark.parametrize("fail_at", ["publish", "rename", "delete"])
def test_crash_leaves_all_rows_and_the_next_run_finishes(spark, work, monkeypatch, fail_at):
    path = work("files")
    _add(spark, path, 0, 1500, 4)
    want = _rows(spark, path)
    name = "publish_text" if fail_at == "publish" else fail_at
    real, calls = getattr(fs, name), []

    def fails(*args, **kwargs):
        calls.append(args)
        if len(calls) == (1 if fail_at == "publish" else 2):
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(compaction.fs, name, fails)
    with pytest.raises(RuntimeError, match="lost"):
        compact_files(spark, path, KEY, TARGET)
    monkeypatch.setattr(compaction.fs, name, real)
    finished = compaction.recover(spark, path)
    assert finished == (0 if fail_at == "publish" else 1)
    assert _rows(spark, path) == want
    compact_files(spark, path, KEY, TARGET)
    assert _rows(spark, path) == want and not [d for d in fs.list_dirs(spark, path) if d.startswith("_")]
