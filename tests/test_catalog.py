from __future__ import annotations

import pytest
from pyspark.sql import types as T

from auric.catalog import Catalog, TableSpec
from auric.operators.write import SchemaChanged, merge_upsert
from auric.plans import quality


def test_catalog_source_ref_create_and_views(spark, work):
    cat = Catalog(spark, work("catalog"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    cat.register(TableSpec("raw_kv", "bronze", schema))
    cat.register(TableSpec("gold_kv", "gold", schema, keys=("k",)))
    cat.register(TableSpec("silver_tickets", "silver", quality.SILVER_TICKETS_CONTRACT))
    assert cat.source("raw_kv").count() == 0              # absent → empty, typed
    cat.create_if_absent("raw_kv")
    assert cat.exists("raw_kv") and cat.source("raw_kv").schema == schema
    merge_upsert(spark.createDataFrame([(1, "a")], schema), cat.path("gold_kv"), "k")
    assert cat.ref("gold_kv").drop("_bucket").count() == 1
    assert set(cat.register_views()) >= {"raw_kv", "gold_kv"}
    assert spark.sql("SELECT count(*) AS n FROM gold_kv").first().n == 1
    with pytest.raises(KeyError):
        cat.source("gold_kv")


def test_catalog_detects_schema_drift(spark, work):
    cat = Catalog(spark, work("catalog"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    cat.register(TableSpec("t", "silver", schema))
    spark.createDataFrame([(1, 2)], "k long, v int").write.parquet(cat.path("t"))
    with pytest.raises(SchemaChanged):
        cat.ref("t")
