from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from auric.operators import write as W
from auric.plans import quality


def _fp(df, cols):
    return quality.fingerprint(df, cols).first()["fingerprint"]


def test_replace_partition_is_idempotent_and_empty_clears(spark, work):
    path = work("bronze")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    W.replace_partition(df, path, "_batch_date", d1)
    W.replace_partition(df, path, "_batch_date", d1)
    W.replace_partition(df.limit(3), path, "_batch_date", d2)
    t = W.read_table(spark, path)
    assert t.count() == 13
    W.replace_partition(df.where(F.lit(False)), path, "_batch_date", d2)
    assert W.read_table(spark, path).groupBy("_batch_date").count().collect()[0]["count"] == 10
    assert W.read_table(spark, path).count() == 10


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def test_merge_upsert_update_and_ignore(spark, work):
    for on_match, expected in (("update", {1: "a", 2: "B", 3: "C"}),
                               ("ignore", {1: "a", 2: "b", 3: "C"})):
        path = work("merge")
        W.merge_upsert(_kv(spark, [(1, "a"), (2, "b")]), path, "k", buckets=4, on_match=on_match)
        batch = _kv(spark, [(2, "B"), (3, "C")])
        W.merge_upsert(batch, path, "k", buckets=4, on_match=on_match)
        W.merge_upsert(batch, path, "k", buckets=4, on_match=on_match)  # re-run: no change
        got = {r.k: r.v for r in W.read_table(spark, path).collect()}
        assert got == expected


def test_merge_rejects_duplicate_and_null_keys(spark, work):
    path = work("merge")
    with pytest.raises(W.WriteError):
        W.merge_upsert(_kv(spark, [(1, "a"), (1, "b")]), path, "k")
    with pytest.raises(W.WriteError):
        W.merge_upsert(_kv(spark, [(None, "a")]), path, "k")


def test_schema_change_fails(spark, work):
    path = work("merge")
    W.merge_upsert(_kv(spark, [(1, "a")]), path, "k", buckets=4)
    other = spark.createDataFrame([(2, 5)], "k long, v int")
    with pytest.raises(W.SchemaChanged, match="column v"):
        W.merge_upsert(other, path, "k", buckets=4)


def test_delete_insert_replaces_only_batch_keys(spark, work):
    path = work("features")
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    first = spark.createDataFrame([(d[0], "c1", 1), (d[1], "c1", 1), (d[1], "c2", 1)],
                                  "event_date date, customer_id string, n long")
    W.delete_insert(first, path, ["event_date", "customer_id"], "event_date")
    batch = spark.createDataFrame([(d[1], "c1", 5), (d[2], "c3", 7)],
                                  "event_date date, customer_id string, n long")
    W.delete_insert(batch, path, ["event_date", "customer_id"], "event_date")
    W.delete_insert(batch, path, ["event_date", "customer_id"], "event_date")
    got = sorted((r.event_date.day, r.customer_id, r.n) for r in W.read_table(spark, path).collect())
    assert got == [(1, "c1", 1), (2, "c1", 5), (2, "c2", 1), (3, "c3", 7)]


def test_full_refresh_from_itself_and_append_duplicates(spark, work):
    path = work("refresh")
    W.full_refresh(spark.range(5), path)
    W.full_refresh(W.read_table(spark, path).where("id > 1"), path)
    assert sorted(r.id for r in W.read_table(spark, path).collect()) == [2, 3, 4]
    apath = work("append")
    W.append(spark.range(3), apath)
    W.append(spark.range(3), apath)
    assert W.read_table(spark, apath).count() == 6


def test_bucketed_merge_writes_one_file_per_bucket(spark, work):
    path = work("merge")
    W.merge_upsert(spark.range(1000).withColumnRenamed("id", "k"), path, "k", buckets=8)
    files = W.read_table(spark, path).select(F.input_file_name()).distinct().count()
    assert files <= 8 * 2


def test_merge_earliest_and_deletes(spark, work):
    path = work("earliest")
    schema = "k long, v string, t int, gone boolean"
    W.merge_upsert(spark.createDataFrame([(1, "a", 5, False), (2, "b", 5, False),
                                          (1, "a2", 3, False)], schema),
                   path, "k", buckets=2, on_match="earliest", order_by=["t"], delete_col="gone")
    W.merge_upsert(spark.createDataFrame([(1, "late", 9, False), (2, "early", 1, False)], schema),
                   path, "k", buckets=2, on_match="earliest", order_by=["t"], delete_col="gone")
    got = {r.k: (r.v, r.t) for r in W.read_table(spark, path).collect()}
    assert got == {1: ("a2", 3), 2: ("early", 1)}
    # deleting every key of a bucket empties that bucket's folder too
    W.merge_upsert(spark.createDataFrame([(1, "x", 0, True), (2, "x", 0, True)], schema),
                   path, "k", on_match="update", delete_col="gone")
    assert W.read_table(spark, path).count() == 0


def test_full_refresh_recovers_after_crash_between_delete_and_rename(spark, work):
    from auric.sources import fs
    path = work("refresh")
    W.full_refresh(spark.range(4), path)
    # simulate the crash: a committed staging copy exists, the table folder is gone
    spark.range(7).write.parquet(path + ".__staging__")
    fs.delete(spark, path)
    assert W.recover_refresh(spark, path)
    assert W.read_table(spark, path).count() == 7
    # the next refresh of the table from itself works on the recovered data
    W.full_refresh(W.read_table(spark, path).where("id < 5"), path)
    assert W.read_table(spark, path).count() == 5


def test_merge_grows_buckets_with_the_table(spark, work):
    path = work("grow")
    tiny = 2048                                     # bytes per bucket, to force growth
    W.merge_upsert(spark.range(10).withColumnRenamed("id", "k"), path, "k",
                   target_bucket_bytes=tiny)
    first = W.table_meta(spark, path)["buckets"]
    W.merge_upsert(spark.range(20000).withColumnRenamed("id", "k"), path, "k",
                   target_bucket_bytes=tiny)
    meta = W.table_meta(spark, path)
    assert meta["buckets"] > first
    t = W.read_table(spark, path)
    assert t.count() == 20000 and t.select("k").distinct().count() == 20000
    assert t.where(F.col("_bucket") >= meta["buckets"]).count() == 0


def test_size_estimate_and_compaction_tasks(spark, work):
    from auric.operators import layout
    src, dst = work("big"), work("compacted")
    spark.range(200_000).selectExpr("id", "id % 7 AS event_date", "cast(id AS string) AS customer_name", "id AS event_time").write.parquet(src)
    df = spark.read.parquet(src)
    size = layout.estimated_bytes(df)
    assert size and abs(size - fs_bytes(spark, src)) < size
    assert layout.estimated_bytes(df.join(df.select("id"), "id")) is None
    assert layout.table_bytes(df.join(df.select("id"), "id")) > 200_000 * 8
    layout.compact(df, dst, target_file_bytes=size // 4)
    assert spark.read.parquet(dst).select("event_date").inputFiles().__len__() > 7
    assert W.size_buckets(df, size // 4) == 4 or W.size_buckets(df, size // 4) == 5


def fs_bytes(spark, path):
    from auric.sources import fs
    return fs.total_bytes(spark, path)


def test_failed_rebucket_leaves_the_table(spark, work, monkeypatch):
    path = work("rebucket")
    W.merge_upsert(spark.range(100).selectExpr("id", "id AS v"), path, "id", buckets=2)

    def fail(*_a, **_k):
        raise RuntimeError("injected")
    monkeypatch.setattr(W.fs, "rename", fail)
    with pytest.raises(RuntimeError):
        W.rebucket(spark, path, 5)
    monkeypatch.undo()
    assert W.recover_refresh(spark, path)
    assert W.read_table(spark, path).count() == 100 and W.table_meta(spark, path)["buckets"] == 5
    monkeypatch.setattr(W, "_save_meta", fail)
    with pytest.raises(RuntimeError):
        W.rebucket(spark, path, 7)
    monkeypatch.undo()
    assert W.read_table(spark, path).count() == 100 and W.table_meta(spark, path)["buckets"] == 5


@pytest.mark.parametrize("on_match", ["update", "earliest", "latest"])
def test_null_keys_are_rejected(spark, work, on_match):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "id long, v long")
    with pytest.raises(W.WriteError):
        W.merge_upsert(df, work("nulls"), "id", on_match=on_match, order_by=["v"])


def test_delete_insert_takes_several_rows_of_a_key(spark, work):
    """Grouping by more columns than the key (a customer whose segment changes within
    a day) gives two rows of one key: the key's old rows go, both come in."""
    schema = "event_date date, customer_id string, segment string, n long"
    d = dt.date(2024, 1, 1)
    path = work("segments")
    W.delete_insert(spark.createDataFrame([(d, "a", "SMB", 3), (d, "b", "SMB", 1)], schema), path,
                    ["event_date", "customer_id"], "event_date")
    both = spark.createDataFrame([(d, "a", "SMB", 2), (d, "a", "Startup", 1)], schema)
    for _ in range(2):
        W.delete_insert(both, path, ["event_date", "customer_id"], "event_date")
    got = sorted((r.customer_id, r.segment, r.n) for r in W.read_table(spark, path).collect())
    assert got == [("a", "SMB", 2), ("a", "Startup", 1), ("b", "SMB", 1)]
    with pytest.raises(W.WriteError):
        W.delete_insert(spark.createDataFrame([(d, None, "SMB", 2)], schema), path, ["event_date", "customer_id"], "event_date")


def test_daily_features_of_a_customer_who_changes_segment(spark, work):
    """The feature update and the window rewrite go on when a group is finer than the key."""
    from auric.plans import gold, incremental, silver
    from auric.sources import driver_tables as dtb
    ev = silver.silver_events(dtb.runtime_events(spark, "/root/testdata/sf0.001"))
    moved = ev.withColumn("segment", F.when(F.col("event_id") % 2 == 0, F.lit("Moved")).otherwise(F.col("segment")))
    path = work("feature-segments")
    for replace_window in (False, True):
        incremental.update_feature_daily(ev, path)
        incremental.update_feature_daily(moved, path, replace_window=replace_window)
        start = F.date_sub(F.lit(moved.agg(F.max("event_date")).first()[0]), 3)
        got, want = (df.where(F.col("event_date") >= start) for df in (W.read_table(spark, path), gold.feature_daily(moved)))
        assert got.groupBy("event_date", "customer_id").count().where("count > 1").count() > 0
        assert _fp(got, want.columns) == _fp(want, want.columns)


def test_a_crash_in_the_first_merge_keeps_the_bucket_count(spark, work, monkeypatch):
    path = work("first")
    rows = spark.range(200).selectExpr("id AS k", "id * 2 AS v")
    real = W._dynamic_overwrite

    def written_then_lost(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(W, "_dynamic_overwrite", written_then_lost)
    with pytest.raises(RuntimeError, match="lost"):
        W.merge_upsert(rows, path, "k", buckets=7)
    monkeypatch.setattr(W, "_dynamic_overwrite", real)
    W.merge_upsert(spark.range(150, 300).selectExpr("id AS k", "id * 3 AS v"), path, "k", buckets=3)
    got = {r["k"]: r["v"] for r in W.read_table(spark, path).collect()}
    assert got == {k: 2 * k if k < 150 else 3 * k for k in range(300)}
    assert W.read_table(spark, path).count() == 300 and W.table_meta(spark, path)["buckets"] == 7


def test_buckets_without_their_count_are_refused(spark, work):
    from auric.sources import fs
    path = work("nometa")
    rows = spark.range(20).selectExpr("id AS k", "id AS v")
    W.merge_upsert(rows, path, "k", buckets=4)
    fs.delete(spark, f"{path}/{W.META_FILE}")
    with pytest.raises(W.WriteError, match="number isn't known"):
        W.merge_upsert(rows, path, "k")
