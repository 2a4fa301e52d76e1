"""Data quality: contracts, column tests, invariants, fingerprints.

Every check is one distributed aggregation that returns a small verdict
DataFrame — failing rows are counted, not collected.

Fingerprint
    Row-order-free and layout-free: per row, ``md5`` of the chosen key
    columns (``coalesce(cast(c as string), '~')`` joined by ``|``), its first
    60 bits as a number, summed as DECIMAL(38,0) next to the row count, then
    ``md5(count ':' sum)``.  It is a partial aggregate (no single-task sort),
    columns outside the key list do not change it, an empty table gives
    ``'empty'``, and duplicates change it (count *and* sum).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auric.operators.write import schema_diff


class ContractError(ValueError):
    pass


# The Silver ticket contract (14 typed columns).
SILVER_TICKETS_CONTRACT = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("csat", T.IntegerType()),
    T.StructField("first_response_sec", T.IntegerType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
])

# Key columns each Gold table is fingerprinted on.
FINGERPRINT_KEYS = {
    "gold_training_set": ["ticket_id", "priority", "category", "status"],
    "gold_feature_daily": ["event_date", "customer_id", "n_events", "p95_latency_ms"],
    "gold_doc_chunks": ["chunk_id", "transcript_id", "chunk_index"],
    "quarantine_tickets": ["ticket_id", "cdc_seq"],
}


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Stop before writing if names or types differ; report every mismatch."""
    diff = schema_diff(contract, df.schema)
    if diff:
        raise ContractError("; ".join(diff))
    return df.select(*[f.name for f in contract.fields])


# ---------------------------------------------------------------- fingerprint
def row_key_text(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])


def row_hash60(cols: Sequence[str]) -> Column:
    return F.conv(F.substring(F.md5(row_key_text(cols)), 1, 15), 16, 10).cast("bigint")


def fingerprint(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``hash_sum`` (text) and ``fingerprint``."""
    have = [c for c in cols if c in df.columns]
    if not have:
        raise ValueError("no fingerprint column present")
    agg = df.select(row_hash60(have).alias("_h")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")),
                   F.lit(0).cast("decimal(38,0)")).cast("string").alias("hash_sum"))
    return agg.withColumn(
        "fingerprint",
        F.when(F.col("n_rows") == 0, F.lit("empty"))
         .otherwise(F.md5(F.concat_ws(":", F.col("n_rows").cast("string"), "hash_sum"))))


def fingerprints(tables: Mapping[str, DataFrame],
                 keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    keys = FINGERPRINT_KEYS if keys is None else keys
    parts = [fingerprint(df, keys[name]).select(F.lit(name).alias("table_name"), "*")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- column tests
def _result(model: str, test: str, column: str, failing: Column) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(test).alias("test"),
            F.lit(column).alias("column_name"), failing.cast("bigint").alias("n_failing")]


def test_unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    dup = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(
        (F.col("_n") > 1) & F.col(column).isNotNull())
    return dup.agg(F.count(F.lit(1)).alias("_f")).select(
        *_result(model, "unique", column, F.col("_f")))


def test_not_null(df: DataFrame, columns: Sequence[str], model: str = "") -> DataFrame:
    """All not-null tests of one table in a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    parts = [counts.select(*_result(model, "not_null", c, F.col(c))) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_accepted_values(df: DataFrame, column: str, values: Iterable, model: str = "") -> DataFrame:
    """Rows whose value is outside ``values``; NULL is not a failure (not_null owns it)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return df.agg(F.count_if(bad).alias("_f")).select(
        *_result(model, "accepted_values", column, F.col("_f")))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_status(report: DataFrame) -> DataFrame:
    return report.withColumn("status", F.when(F.col("n_failing") == 0, "pass").otherwise("fail"))


def domain_violations(df: DataFrame, column: str, lo: int, hi: int) -> DataFrame:
    """Rows where ``column`` is NULL or outside ``lo..hi``."""
    c = F.col(column)
    return df.where(c.isNull() | ~c.between(lo, hi))


def expected_counts(actual: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Row counts of ``actual`` tables next to ``expected(table_name, expected_rows)``:
    difference and verdict per table."""
    counts = union_all([df.agg(F.count(F.lit(1)).alias("actual_rows"))
                        .select(F.lit(name).alias("table_name"), "actual_rows")
                        for name, df in actual.items()])
    return (expected.join(counts, "table_name", "full_outer")
            .withColumn("diff", F.col("actual_rows") - F.col("expected_rows"))
            .withColumn("ok", F.coalesce(F.col("diff") == 0, F.lit(False))))
