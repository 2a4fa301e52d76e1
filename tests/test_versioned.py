"""Versioned tables: all or nothing under failures, pinned readers, small writes."""
from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from auric.operators import versioned
from auric.operators.versioned import VersionedTable
from auric.operators.write import SchemaChanged, WriteError
from auric.sources import fs


@pytest.fixture(autouse=True)
def no_early_fold(monkeypatch):
    """Tables of some rows would fold at once, as a file's fixed bytes weigh more than its rows."""
    monkeypatch.setattr(versioned, "FOLD_SHARE", 1e9)


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def _rows(df):
    return sorted((r.k, r.v) for r in df.collect())


@pytest.fixture()
def table(spark, work):
    t = VersionedTable(spark, work("versioned"), "k")
    t.refresh(_kv(spark, [(i, "base") for i in range(20)]))
    return t


def test_update_ignore_delete_and_history(spark, table):
    table.upsert(_kv(spark, [(1, "new"), (30, "new")]))
    table.upsert(_kv(spark, [(1, "late"), (31, "late")]), on_match="ignore")
    gone = _kv(spark, [(2, None), (30, None)]).withColumn("dead", F.lit(True))
    table.upsert(gone.unionByName(_kv(spark, [(3, "last")]).withColumn("dead", F.lit(False))), delete_col="dead")
    expected = {i: "base" for i in range(20)} | {1: "new", 3: "last", 31: "late"}
    del expected[2]
    assert _rows(table.read()) == sorted(expected.items())
    assert _rows(table.read(1)) == [(i, "base") for i in range(20)]
    table.fold()
    assert table.manifest()["delta"] == [] and _rows(table.read()) == sorted(expected.items())


def test_first_write_may_be_an_upsert_and_reruns_change_nothing(spark, work):
    t = VersionedTable(spark, work("fresh"), "k")
    for _ in range(3):
        t.upsert(_kv(spark, [(1, "a"), (2, "b")]))
    assert _rows(t.read()) == [(1, "a"), (2, "b")]
    t.refresh(t.read().where("k = 1"))
    assert _rows(t.read()) == [(1, "a")]
    t.refresh(t.read().where("false"))
    assert t.read().count() == 0 and t.read().columns == ["k", "v"]


def test_several_rows_of_a_key_are_replaced_together(spark, work):
    """A group-by finer than the key gives two rows of one key: both replace what was there."""
    t = VersionedTable(spark, work("pairs"), "k")
    t.replace_keys(_kv(spark, [(1, "x"), (2, "y")]))
    t.replace_keys(_kv(spark, [(1, "x1"), (1, "x2")]))
    assert _rows(t.read()) == [(1, "x1"), (1, "x2"), (2, "y")]
    t.replace_keys(_kv(spark, [(1, "x3")]))
    assert _rows(t.read()) == [(1, "x3"), (2, "y")]


def test_bad_batches_are_refused(spark, table):
    before = table.versions()
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(WriteError):
            table.upsert(_kv(spark, bad))
    with pytest.raises(SchemaChanged):
        table.upsert(_kv(spark, [(1, "a")]).withColumn("more", F.lit(1)))
    with pytest.raises(WriteError):
        VersionedTable(spark, table.path, "v").read()
    assert table.versions() == before


@pytest.mark.parametrize("action", ["upsert", "refresh", "fold", "replace_keys"])
@pytest.mark.parametrize("step", ["_write_segment", "_publish", "after"])
def test_a_failure_at_any_step_leaves_one_whole_version(spark, table, monkeypatch, action, step):
    table.upsert(_kv(spark, [(0, "delta")]))
    before = _rows(table.read())
    batch = _kv(spark, [(1, "batch"), (50, "batch")])
    do = {"upsert": lambda: table.upsert(batch), "refresh": lambda: table.refresh(batch),
          "fold": table.fold, "replace_keys": lambda: table.replace_keys(batch)}[action]
    real = getattr(VersionedTable, "_publish" if step == "after" else step)

    def broken(self, *args):
        if step != "_publish":
            real(self, *args)  # fails when its work is done
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish" if step == "after" else step, broken)
        with pytest.raises(OSError):
            do()
    found = _rows(table.read())
    done = {"refresh": [(1, "batch"), (50, "batch")], "fold": before}.get(
        action, sorted((dict(before) | {1: "batch", 50: "batch"}).items()))
    assert found == (done if step == "after" else before)
    do()  # running it again is the recovery
    assert _rows(table.read()) == done


def test_readers_see_whole_versions_during_writes(spark, table):
    """Every version has rows of one generation only, and a reader never sees a mix."""
    seen, stop, errors = set(), threading.Event(), []

    def loop():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted({r.v for r in table.read().select("v").distinct().collect()})))
            except Exception as e:  # noqa: BLE001 - reported below
                errors.append(e)
                return

    reader = threading.Thread(target=loop)
    reader.start()
    for n in range(4):
        rows = _kv(spark, [(i, f"g{n}") for i in range(20)])
        if n % 2:
            table.refresh(rows)
        else:
            table.upsert(rows)
    stop.set()
    reader.join()
    assert not errors, errors
    assert all(len(s) == 1 for s in seen), seen


def test_the_second_of_two_writers_adds_to_the_first(spark, table, monkeypatch):
    other = VersionedTable(spark, table.path, "k")
    real = VersionedTable._publish
    raced = []

    def late(self, manifest):
        if self is table and not raced:
            raced.append(1)
            other.upsert(_kv(spark, [(1, "other"), (60, "other")]))
        return real(self, manifest)

    monkeypatch.setattr(VersionedTable, "_publish", late)
    table.upsert(_kv(spark, [(1, "mine"), (61, "mine")]))
    got = dict(_rows(table.read()))
    assert got[1] == "mine" and got[60] == "other" and got[61] == "mine"


def test_a_refresh_does_not_undo_another_write(spark, table, monkeypatch):
    real = VersionedTable._write_segment
    raced = []

    def slow(self, df, buckets):
        out = real(self, df, buckets)
        if not raced:
            raced.append(1)
            VersionedTable(spark, table.path, "k").upsert(_kv(spark, [(70, "other")]))
        return out

    monkeypatch.setattr(VersionedTable, "_write_segment", slow)
    with pytest.raises(versioned.Conflict):
        table.refresh(table.read())
    assert (70, "other") in _rows(table.read())


def test_a_small_batch_writes_little(spark, work):
    t = VersionedTable(spark, work("large"), "k")
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    t.refresh(rows)
    base = t.manifest()["base"][0]["bytes"]
    t.upsert(rows.where("k % 100 = 0").withColumn("v", F.reverse("v")))
    written = t.manifest()["delta"][0]["bytes"]
    assert written < 0.03 * base
    assert t.read().count() == 200_000


def test_fold_rewrites_only_touched_buckets(spark, work, monkeypatch):
    monkeypatch.setattr(versioned, "size_buckets", lambda df: 8)
    t = VersionedTable(spark, work("buckets"), "k")
    t.refresh(_kv(spark, [(i, "base") for i in range(100)]))
    t.upsert(_kv(spark, [(5, "new")]))
    folded = t.fold()
    assert len(folded["base"]) == 2 and sorted(b for s in folded["base"] for b in s["buckets"]) == list(range(8))
    assert len(folded["base"][1]["buckets"]) == 1
    assert dict(_rows(t.read()))[5] == "new" and t.read().count() == 100


def test_deltas_are_folded_in_time(spark, table):
    for n in range(versioned.MAX_DELTAS + 2):
        table.upsert(_kv(spark, [(100 + n, "x")]))
    assert len(table.manifest()["delta"]) <= versioned.MAX_DELTAS
    assert table.read().count() == 20 + versioned.MAX_DELTAS + 2


def test_a_stream_batch_is_applied_once(spark, table):
    for number, value in ((0, "zero"), (1, "one"), (0, "again"), (1, "again")):
        table.upsert(_kv(spark, [(number, value)]), batch=("stream", number))
    got = dict(_rows(table.read()))
    assert got[0] == "zero" and got[1] == "one"
    table.upsert(_kv(spark, [(0, "elsewhere")]), batch=("other", 0))
    assert dict(_rows(table.read()))[0] == "elsewhere"


def test_vacuum_keeps_what_versions_list(spark, table):
    for n in range(3):
        table.upsert(_kv(spark, [(n, f"v{n}")]))
    table.fold()
    kept = _rows(table.read())
    assert table.vacuum(keep=1, min_age_seconds=3600) == []  # young: may be a write under way
    table.upsert(_kv(spark, [(9, "after")]))
    gone = table.vacuum(keep=1, min_age_seconds=0)
    assert gone and _rows(table.read()) == sorted((dict(kept) | {9: "after"}).items())
    assert len(table.versions()) == 1
    assert len(fs.list_dirs(spark, f"{table.path}/data")) == len(table.manifest()["base"]) + len(table.manifest()["delta"])
