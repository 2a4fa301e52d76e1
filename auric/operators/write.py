"""Repeatable write strategies on plain Parquet folders.

=====================  ==================================================
``replace_partition``  overwrite one partition folder (an empty input
                       clears it)
``full_refresh``       rebuild the whole table via a staging folder
``append``             add rows (a re-run adds them again)
``merge_upsert``       keyed upsert: new rows replace old rows with the same
                       key, other old rows stay; ``on_match='ignore'``
                       keeps the old row instead
``delete_insert``      keyed replace restricted to the partitions the batch
                       touches (partition column is part of the key); a
                       batch may hold several rows of one key
=====================  ==================================================

Keyed tables are laid out so that a batch rewrites only what it touches:
``merge_upsert`` hash-buckets rows into ``_bucket = pmod(xxhash64(keys), B)``
folders, ``delete_insert`` partitions by a key column (a day).  The rewrite is
"old rows of the touched partitions, minus the batch's keys, plus the
batch", written with dynamic partition overwrite, so untouched partitions
are never read or written.  Partitions being read are replaced only when the
job commits, after every task has finished reading them; a lost executor
just re-reads the old files.  Each strategy is idempotent: running the same
batch twice leaves the same table, which is also the recovery procedure
after a crash in the middle of a commit.

No table format (Delta/Iceberg) is assumed; with one, these become MERGE /
replaceWhere and gain atomic commits.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auric.sources import fs

BUCKET_COL = "_bucket"
TARGET_BUCKET_BYTES = 128 * 1024 * 1024
MAX_TOUCHED_PARTITIONS = 10_000
META_FILE = "_auric_table.json"     # ignored by Parquet readers (leading underscore)


class WriteError(RuntimeError):
    pass


class SchemaChanged(WriteError):
    """The batch's columns differ from the stored table (on_schema_change='fail')."""


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _partition_text(v) -> str:
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


# ---------------------------------------------------------------- checks
def schema_diff(expected: T.StructType, actual: T.StructType) -> list[str]:
    """Every name/type mismatch between two schemas (order-insensitive)."""
    e = {f.name: f.dataType for f in expected.fields}
    a = {f.name: f.dataType for f in actual.fields}
    out = [f"missing column {n} ({t.simpleString()})" for n, t in e.items() if n not in a]
    out += [f"unexpected column {n} ({t.simpleString()})" for n, t in a.items() if n not in e]
    out += [f"column {n}: expected {e[n].simpleString()}, got {a[n].simpleString()}"
            for n in e if n in a and e[n] != a[n]]
    return out


def guard_schema(stored: T.StructType, batch: T.StructType, ignore: Sequence[str] = ()) -> None:
    strip = lambda s: T.StructType([f for f in s.fields if f.name not in ignore])
    diff = schema_diff(strip(stored), strip(batch))
    if diff:
        raise SchemaChanged("; ".join(diff))


def _inspect_batch(df: DataFrame, keys: Sequence[str], partition_col: str, check_keys: bool,
                   limit: int = MAX_TOUCHED_PARTITIONS, unique: bool = True) -> list:
    """One job: key uniqueness / NULL check and the touched partition values
    (``unique=False`` allows several rows of one key).

    The partition column is a function of the key (bucket) or part of it
    (day), so per-key groups carry one partition value; the partition list
    is bounded (buckets, or ``limit`` days) and checked before use.
    """
    keys = list(keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    F.first(partition_col).alias("_p"))
    bad = ((F.col("_n") > 1) | null_key) if unique else null_key
    r = per_key.agg(
        F.count_if(bad).alias("_bad"),
        F.slice(F.collect_set("_p"), 1, limit + 1).alias("_parts")).first()
    if check_keys and r["_bad"]:
        sample = per_key.where(bad).limit(5).collect()
        raise WriteError(f"batch keys {keys} not unique / NULL ({r['_bad']} keys), "
                         f"e.g. {[x.asDict() for x in sample]}")
    parts = r["_parts"] or []
    if len(parts) > limit:
        raise WriteError(f"batch touches more than {limit} partitions of {partition_col}")
    return parts


# ---------------------------------------------------------------- strategies
def replace_partition(df: DataFrame, path: str, col: str, value) -> None:
    """Write ``df`` as the whole content of partition ``col=value`` of ``path``.

    The partition *folder* is overwritten, so an empty batch clears it —
    dynamic partition overwrite would leave a partition that gets no rows.
    """
    target = f"{path.rstrip('/')}/{col}={_partition_text(value)}"
    out = df.drop(col) if col in df.columns else df
    out.write.mode("overwrite").parquet(target)


def full_refresh(df: DataFrame, path: str, partition_by: str | None = None,
                 meta: dict | None = None) -> None:
    """Replace the table: write a staging copy, then swap folders.

    ``df`` may read ``path`` itself: the old folder is removed only after the
    staging copy is complete.  ``partition_by`` keeps a partitioned layout
    (``rebalance`` on it, as the keyed writes do); ``meta`` is stored as the
    table's metadata file.
    """
    spark = df.sparkSession
    staging = path.rstrip("/") + ".__staging__"
    recover_refresh(spark, path)
    w = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(staging)
    if meta:
        _save_meta(spark, staging, meta)
    fs.delete(spark, path)
    if not fs.rename(spark, staging, path):
        raise WriteError(f"could not move {staging} to {path}")


def recover_refresh(spark: SparkSession, path: str) -> bool:
    """Finish a refresh that crashed between removing the old folder and
    moving the new one in: a *committed* staging copy (``_SUCCESS`` written
    at job commit) is moved into place.  Returns True if it recovered."""
    staging = path.rstrip("/") + ".__staging__"
    if not fs.exists(spark, path) and fs.exists(spark, f"{staging}/_SUCCESS"):
        return fs.rename(spark, staging, path)
    return False


def rebuild_keyed(df: DataFrame, path: str, keys: str | Sequence[str],
                  buckets: int | None = None) -> None:
    """Full rebuild into the bucketed layout :func:`merge_upsert` maintains,
    so later batches can be merged into it."""
    spark = df.sparkSession
    keys = _keys(keys)
    old = table_meta(spark, path) if fs.has_data(spark, path) else {}
    if old.get("keys") == keys:
        buckets = int(old["buckets"])
    elif buckets is None:
        buckets = size_buckets(df)
    new = with_bucket(df, keys, buckets)
    full_refresh(new, path, BUCKET_COL,
                 {"keys": keys, "buckets": buckets, "schema": new.schema.json()})


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _dynamic_overwrite(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace exactly the partitions present in ``df``.

    ``rebalance`` on the partition column sends each partition's rows to
    few tasks (few files per folder instead of tasks × partitions) while
    AQE splits a partition that holds a large share of the rows across
    several tasks and packs small ones together.
    """
    (df.hint("rebalance", partition_col)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


# Logical operators that make re-reading a batch as cheap as reading a staged
# copy of it: plain scans with projections and filters.
_CHEAP_NODES = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation",
                "SubqueryAlias", "Union", "StreamingDataSourceV2ScanRelation"}


def is_plain_scan(df: DataFrame) -> bool:
    """True if ``df`` is only scans + projections/filters (no shuffle, no
    aggregation, no window): recomputing it is a re-read of its files."""
    def walk(node) -> bool:
        if node.getClass().getSimpleName() not in _CHEAP_NODES:
            return False
        children = node.children()
        return all(walk(children.apply(i)) for i in range(children.size()))
    try:
        return walk(df._jdf.queryExecution().optimizedPlan())
    except Exception:  # noqa: BLE001 - unknown plan shape: stage it
        return False


def stage(df: DataFrame, name: str = "batch", force: bool = False) -> DataFrame:
    """Materialise a batch once in the shared work folder and read it back.

    Cuts the lineage (checks, merge and retries read the written copy instead
    of recomputing the batch) and decouples the batch from the target table
    it may have been computed from.  A batch that is already a plain scan is
    returned as is — re-reading it costs what reading a copy would — unless
    ``force`` (the caller is about to replace the folders it reads).
    """
    if not force and is_plain_scan(df):
        return df
    from auric.session import workspace
    path = workspace(df.sparkSession, f"stage-{name}")
    df.write.mode("overwrite").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._auric_stage_path = path  # noqa: SLF001 - removed by the caller when done
    return staged


def _unstage(df: DataFrame) -> None:
    path = getattr(df, "_auric_stage_path", None)
    if path:
        fs.delete(df.sparkSession, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table folder; a keyed table's stored schema is used when known,
    so a table whose rows were all deleted still reads (as empty)."""
    if schema is None:
        stored = table_meta(spark, path).get("schema")
        if stored:
            schema = T.StructType.fromJson(json.loads(stored))
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def table_meta(spark: SparkSession, path: str) -> dict:
    text = fs.read_text(spark, f"{path.rstrip('/')}/{META_FILE}")
    return json.loads(text) if text else {}


def _save_meta(spark: SparkSession, path: str, meta: dict) -> None:
    fs.write_text(spark, f"{path.rstrip('/')}/{META_FILE}", json.dumps(meta, sort_keys=True))


def size_buckets(df: DataFrame, target_bytes: int = TARGET_BUCKET_BYTES) -> int:
    """Bucket count for a table whose first load is ``df``: ~target bytes each."""
    from auric.operators.layout import table_bytes
    return max(1, math.ceil(table_bytes(df) / target_bytes))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET_COL,
                         F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


ON_MATCH = ("update", "ignore", "earliest", "latest")


REBUCKET_FACTOR = 4


def merge_upsert(df: DataFrame, path: str, keys: str | Sequence[str],
                 buckets: int | None = None, on_match: str = "update",
                 order_by: Sequence[str] = (), delete_col: str | None = None,
                 check_keys: bool = True, on_schema_change: str = "fail",
                 target_bucket_bytes: int = TARGET_BUCKET_BYTES) -> None:
    """Keyed upsert into a bucketed Parquet table.

    ``on_match='update'``   a batch row replaces the stored row with its key;
    ``on_match='ignore'``   stored rows win, only new keys are inserted;
    ``on_match='earliest'`` per key the row with the smallest ``order_by``
                            wins, stored or new (redelivery-safe dedup);
    ``on_match='latest'``   the row with the greatest ``order_by`` wins
                            (applying change records out of order).
    ``delete_col`` names a boolean batch column: rows with it true remove
    their key from the table.  Stored rows whose key is not in the batch are
    kept.

    The bucket count is fixed when the table is created (``buckets``, or
    sized from the first batch at ~128 MB per bucket) and kept in the table's
    metadata file; a batch only rewrites the buckets its keys hash to.
    When the average bucket outgrows ``REBUCKET_FACTOR`` × the target (the
    table grew since it was created), the table is rebucketed to the target
    size once — a full rewrite, amortised over that growth.
    """
    if on_match not in ON_MATCH:
        raise ValueError(f"on_match must be one of {ON_MATCH}")
    spark = df.sparkSession
    keys = _keys(keys)
    df = stage(df, "merge")
    try:
        recover_refresh(spark, path)
        meta = table_meta(spark, path) if fs.has_data(spark, path) else {}
        if meta:
            if meta.get("keys") != keys:
                raise WriteError(f"table keyed on {meta.get('keys')}, batch on {keys}")
            buckets = int(meta["buckets"])
        elif any(d.startswith(f"{BUCKET_COL}=") for d in fs.list_dirs(spark, path)):
            raise WriteError(f"{path} holds buckets but no {META_FILE}, so their number isn't known")
        elif buckets is None:
            buckets = size_buckets(df, target_bucket_bytes)
        new = with_bucket(df, keys, buckets)
        create = None
        if not meta:    # written before any data, so that no bucket ever stands without its count
            stored = new.drop(delete_col) if delete_col else new
            create = {"keys": keys, "buckets": buckets, "schema": stored.schema.json()}
        _rewrite(new, path, keys, BUCKET_COL, on_match, order_by,
                 delete_col, check_keys, on_schema_change, buckets, create=create)
        size = fs.total_bytes(spark, path)
        if size > REBUCKET_FACTOR * target_bucket_bytes * buckets:
            rebucket(spark, path, math.ceil(size / target_bucket_bytes))
    finally:
        _unstage(df)


def rebucket(spark: SparkSession, path: str, buckets: int) -> None:
    """Rewrite a bucketed table with a new bucket count (full rewrite).

    The new layout is written next to the table, with its metadata, and
    swapped in only when it is complete; a failure before leaves the table."""
    meta = table_meta(spark, path)
    if not meta:
        raise WriteError(f"{path} is not a bucketed table")
    rows = read_table(spark, path).drop(BUCKET_COL)
    full_refresh(with_bucket(rows, meta["keys"], buckets), path, BUCKET_COL, dict(meta, buckets=buckets))


def delete_insert(df: DataFrame, path: str, keys: str | Sequence[str], partition_col: str,
                  on_match: str = "update", order_by: Sequence[str] = (),
                  delete_col: str | None = None, check_keys: bool = True,
                  on_schema_change: str = "fail") -> None:
    """Replace the stored rows whose key occurs in the batch, then insert the batch.

    The batch may hold several rows of one key (a group-by on more columns
    than the key): all stored rows of that key go and all of the batch's rows
    come in.  NULL keys are refused.  ``partition_col`` must be one of ``keys``; only partitions present in the
    batch are read and rewritten.  Keys absent from the batch stay as they are.
    ``on_match`` / ``order_by`` / ``delete_col`` as in :func:`merge_upsert`.
    """
    if on_match not in ON_MATCH:
        raise ValueError(f"on_match must be one of {ON_MATCH}")
    keys = _keys(keys)
    if partition_col not in keys:
        raise ValueError("partition column must be part of the key")
    df = stage(df, "delete-insert")
    try:
        _rewrite(df, path, keys, partition_col, on_match, order_by, delete_col, check_keys,
                 on_schema_change, MAX_TOUCHED_PARTITIONS, unique=False)
    finally:
        _unstage(df)


def replace_partitions(df: DataFrame, path: str, keys: str | Sequence[str], partition_col: str,
                       window_start, check_keys: bool = True,
                       on_schema_change: str = "fail") -> None:
    """Every partition ``>= window_start`` becomes exactly the batch's rows:
    present ones are overwritten whole, ones the batch no longer has are
    removed.  Keys that vanished from the source vanish from the table too
    (unlike :func:`delete_insert`, which only replaces the batch's keys)."""
    spark = df.sparkSession
    keys = _keys(keys)
    df = stage(df, "replace-window")
    try:
        touched = _inspect_batch(df, keys, partition_col, check_keys, unique=False)
        if fs.has_data(spark, path) and on_schema_change == "fail":
            guard_schema(read_table(spark, path).schema, df.schema)
        prefix = f"{partition_col}="
        stored = [n[len(prefix):] for n in fs.list_dirs(spark, path) if n.startswith(prefix)]
        start = _partition_text(window_start)
        present = {_partition_text(p) for p in touched}
        if touched:
            _dynamic_overwrite(df, path, partition_col)
        for v in stored:             # ISO dates compare as text
            if v >= start and v not in present:
                fs.delete(spark, f"{path.rstrip('/')}/{prefix}{v}")
    finally:
        _unstage(df)


def _pick(df: DataFrame, keys: list[str], on_match: str, order_by: Sequence[str]) -> DataFrame:
    from auric.operators.state import earliest_per_key, latest_per_key
    if on_match == "earliest":
        return earliest_per_key(df, keys, tuple(order_by))
    return latest_per_key(df, keys, tuple(order_by))


def read_keys(spark: SparkSession, path: str, keys_df: DataFrame) -> DataFrame:
    """Rows of a bucketed table whose key is in ``keys_df``, reading only the
    buckets those keys hash to (a partition filter), then a semi join."""
    meta = table_meta(spark, path)
    keys = meta["keys"]
    wanted = [r[0] for r in with_bucket(keys_df.select(*keys), keys, int(meta["buckets"]))
              .select(BUCKET_COL).distinct().collect()]           # ≤ buckets values
    return (read_table(spark, path).where(F.col(BUCKET_COL).isin(wanted))
            .join(keys_df.select(*keys).distinct(), keys, "left_semi").drop(BUCKET_COL))


def _combine(old_t: DataFrame, new: DataFrame, keys: list[str], on_match: str,
             order_by: Sequence[str], delete_col: str | None) -> DataFrame:
    if delete_col:
        old_t = old_t.withColumn(delete_col, F.lit(False))
    if on_match == "update":
        out = old_t.join(new.select(*keys), keys, "left_anti").unionByName(new)
    elif on_match == "ignore":
        out = old_t.unionByName(new.join(old_t.select(*keys), keys, "left_anti"))
    else:
        if not order_by:
            raise ValueError(f"on_match='{on_match}' needs order_by")
        out = _pick(old_t.unionByName(new), keys, on_match, order_by)
    if delete_col:
        out = out.where(~F.coalesce(F.col(delete_col), F.lit(False))).drop(delete_col)
    return out


def _rewrite(new: DataFrame, path: str, keys: list[str], partition_col: str, on_match: str,
             order_by: Sequence[str], delete_col: str | None, check_keys: bool,
             on_schema_change: str, limit: int, unique: bool = True, create: dict | None = None) -> None:
    spark = new.sparkSession
    batch = new
    if on_match in ("earliest", "latest"):
        if new.where(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))).limit(1).count():
            raise WriteError(f"NULL in key {keys}")     # _pick would fold such rows into one
        batch = _pick(new, keys, on_match, order_by)    # several rows per key inside the batch
        check_keys = False
    touched = _inspect_batch(batch, keys, partition_col, check_keys, limit, unique)
    if not fs.has_data(spark, path):
        first = batch
        if delete_col:
            first = batch.where(~F.coalesce(F.col(delete_col), F.lit(False))).drop(delete_col)
        if create:
            _save_meta(spark, path, create)
        _dynamic_overwrite(first, path, partition_col)
        return
    old = read_table(spark, path)
    stored_cols = [c for c in batch.columns if c != delete_col]
    if on_schema_change == "fail":
        guard_schema(old.schema, batch.select(*stored_cols).schema)
    if not touched:
        return
    old_t = old.where(F.col(partition_col).isin(touched)).select(*stored_cols)
    out = _combine(old_t, batch, keys, on_match, order_by, delete_col)
    if create:
        _save_meta(spark, path, create)
    if not delete_col:
        _dynamic_overwrite(out, path, partition_col)
        return
    out = stage(out, "merge-result", force=True)    # read twice, joined once
    try:
        present = {r[0] for r in out.select(partition_col).distinct().collect()}
        _dynamic_overwrite(out, path, partition_col)
        for p in touched:       # dynamic overwrite leaves a partition with no rows untouched
            if p not in present:
                fs.delete(spark, f"{path.rstrip('/')}/{partition_col}={_partition_text(p)}")
    finally:
        _unstage(out)
