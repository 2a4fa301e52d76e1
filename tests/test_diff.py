"""Table differences against plain Python on seeded faults."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from auric.operators import diff

SCHEMA = "k long, a string, b int"


def _diff(left, right, **kw):
    return sorted((r["k"], r["difference"], r["changed_columns"]) for r in diff.table_diff(left, right, "k", **kw).collect())


def test_equal_tables_have_no_differences(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("a"), F.lit(1).alias("b"))
    assert diff.unequal_ranges(df, df.select("b", "k", "a").repartition(7), "k")[1] == []
    assert _diff(df, df.repartition(3)) == []


def test_nulls_repeats_and_moved_values(spark):
    left = spark.createDataFrame([(1, "x", None), (2, "x", 1), (3, None, None), (4, "r", 1), (4, "r", 1), (5, "s", 1), (5, "t", 1)], SCHEMA)
    right = spark.createDataFrame([(1, None, None), (2, "x", 1), (3, None, 0), (4, "r", 1), (5, "s", 1), (5, "u", 2), (6, "n", 1)], SCHEMA)
    assert _diff(left, right) == [
        (1, "changed", "a"), (3, "changed", "b"), (4, "only_left", None), (5, "changed", "a,b"), (6, "only_right", None)]
    # A value that moves to another column must not look the same.
    p = spark.createDataFrame([(1, "x", None)], "k long, a string, c string")
    q = spark.createDataFrame([(1, None, "x")], "k long, a string, c string")
    assert _diff(p, q) == [(1, "changed", "a,c")]


@pytest.mark.parametrize("leaf_rows", [1, 100, 1_000_000])
def test_seeded_faults_are_named_exactly(spark, leaf_rows):
    rnd = random.Random(leaf_rows)
    base = {k: (rnd.choice("abc"), rnd.choice([None, 1, 2])) for k in range(4000)}
    other, expected = dict(base), []
    for k in rnd.sample(range(4000), 12):
        way = rnd.choice(["drop", "change", "add"])
        if way == "drop":
            del other[k]
            expected.append((k, "only_left", None))
        elif way == "change":
            other[k] = ("z", base[k][1])
            expected.append((k, "changed", "a"))
        else:
            other[10_000 + k] = ("n", 0)
            expected.append((10_000 + k, "only_right", None))
    make = lambda rows: spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)
    left, right = make(base), make(other)
    assert _diff(left, right, leaf_rows=leaf_rows) == sorted(expected)
    bits, ranges = diff.unequal_ranges(left, right, "k", leaf_rows=leaf_rows)
    assert 0 < len(ranges) <= 12
    if leaf_rows == 1:  # narrowed down to the rows themselves
        assert bits > diff.LEVEL_BITS and sum(r["n_left"] + r["n_right"] for r in ranges) <= 24


def test_tables_that_differ_everywhere(spark, monkeypatch):
    monkeypatch.setattr(diff, "MAX_RANGES", 100)
    left = spark.range(1000).select(F.col("id").alias("k"), F.lit("l").alias("a"), F.lit(1).alias("b"))
    right = left.withColumn("a", F.lit("r"))
    assert len(_diff(left, right)) == 1000
    counts = diff.diff_counts(left, right.where("k < 900"), "k", "t").first()
    assert tuple(counts) == ("t", 1000, 900, 100, 0, 900)


def test_columns_must_agree(spark):
    with pytest.raises(diff.DiffError):
        diff.table_diff(spark.range(1).toDF("k"), spark.range(1).select(F.col("id").alias("k"), F.lit(1).alias("x")), "k")


def test_snapshots_name_the_ranges_that_changed(spark):
    from auric.operators import diff
    rows = spark.range(3000).selectExpr("id AS k", "if(id % 7 = 0, null, id * 2) AS v", "if(id % 11 = 0, null, 'x') AS w")
    before = diff.digest_snapshot(rows, "k")
    # other order and column order: nothing changed
    again = rows.select("w", "k", "v").repartition(7)
    assert diff.changed_ranges(before, diff.digest_snapshot(again, "k")).count() == 0
    # one row changed, one lost, one added twice, one NULL moved to the other column
    twice = spark.range(9000, 9001).selectExpr("id AS k", "id AS v", "'x' AS w")
    other = rows.where("k <> 5").selectExpr(
        "k", "if(k = 77, null, if(k = 100, -1, v)) AS v", "if(k = 77, 'y', w) AS w").unionByName(twice).unionByName(twice)
    got = diff.changed_ranges(before, diff.digest_snapshot(other, "k")).collect()
    hashes = {r["k"]: r["h"] for r in spark.createDataFrame([(5,), (77,), (100,), (9000,)], "k long").selectExpr(
        "k", "lower(lpad(hex(xxhash64(k)), 16, '0')) AS h").collect()}
    assert len(got) == 4 and {k for k, h in hashes.items() for r in got if r["first_hash"] <= h <= r["last_hash"]} == set(hashes)
    assert sum(r["n_after"] - r["n_before"] for r in got) == 1
    empty = diff.digest_snapshot(rows.where("false"), "k")
    assert diff.changed_ranges(empty, empty).count() == 0
    assert sum(r["n_after"] for r in diff.changed_ranges(empty, before).collect()) == 3000
