from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from auric.plans import quality, silver
from auric.sources import driver_tables as dt

SMALL = "/root/testdata/sf0.001"


def test_contract_passes_and_lists_every_mismatch(spark):
    st = silver.silver_tickets(dt.tickets_cdc(spark, SMALL))
    quality.enforce_contract(st, quality.SILVER_TICKETS_CONTRACT)
    bad = st.withColumn("priority", F.col("priority").cast("string")).drop("body")
    with pytest.raises(quality.ContractError) as e:
        quality.enforce_contract(bad, quality.SILVER_TICKETS_CONTRACT)
    assert "missing column body" in str(e.value) and "column priority" in str(e.value)


def test_fingerprint_properties(spark):
    df = spark.range(200).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"))
    cols = ["a", "b"]
    fp = quality.fingerprint(df, cols).first()["fingerprint"]
    shuffled = df.repartition(7).orderBy(F.rand(1))
    assert quality.fingerprint(shuffled, cols).first()["fingerprint"] == fp
    assert quality.fingerprint(df.withColumn("extra", F.lit(1)), cols).first()["fingerprint"] == fp
    assert quality.fingerprint(df.union(df.limit(1)), cols).first()["fingerprint"] != fp
    assert quality.fingerprint(df.where("false"), cols).first()["fingerprint"] == "empty"


def test_column_tests(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 7)], "k int, p int")
    assert quality.test_unique(df, "k").first()["n_failing"] == 1
    assert quality.test_not_null(df, ["k", "p"]).collect()[1]["n_failing"] == 1
    assert quality.test_accepted_values(df, "p", [1, 2, 3, 4]).first()["n_failing"] == 1
