"""Where two tables differ: a digest tree over key hashes, then a keyed diff.

``unequal_ranges`` compares digests of ranges of a hash of the key.  It begins
with few wide ranges and goes down only into those whose digests differ, so
equal tables cost one aggregation a side that moves a row per range, and a
single wrong row in a large table is narrowed down by a few scans of shrinking
ranges.  ``table_diff`` then looks at the rows of the ranges that are left:
rows that stand equally often on both sides cancel out, and the others are
paired by key into only-left, only-right and changed, with the columns that
changed.

Rows are compared as a multiset: NULL equals NULL, and a key may have several
rows.  Column order does not matter; columns of one side only are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A level of the tree cuts each range into 2**LEVEL_BITS; the hash has HASH_BITS.
LEVEL_BITS, HASH_BITS = 8, 40
#: Ranges of so few rows are not cut further; so many ranges are followed at most.
LEAF_ROWS, MAX_RANGES = 50_000, 4096


class DiffError(ValueError):
    pass


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _columns(left: DataFrame, right: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    if set(left.columns) != set(right.columns):
        raise DiffError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    return list(left.columns)


def key_range(keys: Sequence[str], bits: int) -> Column:
    """The first ``bits`` bits of a row's key hash."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 64 - bits)


def _digest(df: DataFrame, columns: Sequence[str], keys: Sequence[str], bits: int) -> DataFrame:
    """(range, n, total): a row per range; sums don't depend on row order and tell
    repeated rows apart.  NULLs are hashed with their place, as xxhash64 skips them."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    row = F.xxhash64(*[F.col(c) for c in columns], nulls)
    return df.groupBy(key_range(keys, bits).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("total"))


def unequal_ranges(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                   columns: Sequence[str] | None = None, leaf_rows: int = LEAF_ROWS) -> tuple[int, list[dict]]:
    """``(bits, ranges)``: the ranges of the key hash whose digests differ, each
    with its number of rows on both sides.

    Ranges are cut on while they are larger than ``leaf_rows`` and no more than
    MAX_RANGES differ (a bounded list); tables that differ everywhere are left at
    wide ranges, as finer ones would leave nothing out.
    """
    keys, columns = _keys(keys), _columns(left, right, columns)
    bits, found = 0, []
    while bits < HASH_BITS:
        step = bits + LEVEL_BITS
        inside = F.lit(True) if not bits else key_range(keys, bits).isin([r["range"] for r in found])
        a, b = (_digest(df.where(inside), columns, keys, step) for df in (left, right))
        unequal = (a.withColumnsRenamed({"n": "n_left", "total": "left"})
                   .join(b.withColumnsRenamed({"n": "n_right", "total": "right"}), "range", "full")
                   .where(~(F.col("n_left").eqNullSafe(F.col("n_right")) & F.col("left").eqNullSafe(F.col("right"))))
                   .select("range", F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right")))
        rows = [r.asDict() for r in unequal.limit(MAX_RANGES + 1).collect()]
        if len(rows) > MAX_RANGES:
            if not bits:  # one range of everything
                found = [{"range": 0, "n_left": left.count(), "n_right": right.count()}]
            break
        bits, found = step, rows
        if not rows or max(max(r["n_left"], r["n_right"]) for r in rows) <= leaf_rows:
            break
    return bits, sorted(found, key=lambda r: r["range"])


#: A snapshot's digests are of this many bits of the key hash (65,536 ranges).
SNAPSHOT_BITS = 16


def digest_snapshot(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str] | None = None,
                    bits: int = SNAPSHOT_BITS) -> DataFrame:
    """(range, n, total): the digests of a table at this moment, a bounded number of
    rows to be stored in place of a copy and given to ``changed_ranges`` later."""
    return _digest(df, sorted(columns or df.columns), _keys(keys), bits)


def changed_ranges(before: DataFrame, after: DataFrame, bits: int = SNAPSHOT_BITS) -> DataFrame:
    """The key ranges in which two snapshots differ: ``range``, the first and last
    key hash in it as 16 hex digits, and the rows before and after."""
    both = (before.select("range", F.col("n").alias("n_before"), F.col("total").alias("before"))
            .join(after.select("range", F.col("n").alias("n_after"), F.col("total").alias("after")), "range", "full")
            .where(~(F.col("n_before").eqNullSafe(F.col("n_after")) & F.col("before").eqNullSafe(F.col("after")))))
    start = F.shiftleft("range", 64 - bits)
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return both.select("range", digits(start).alias("first_hash"),
                       digits(start.bitwiseOR(F.lit((1 << (64 - bits)) - 1))).alias("last_hash"),
                       F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))


def _within(df: DataFrame, keys: Sequence[str], bits: int, ranges: list[dict]) -> DataFrame:
    if not ranges:
        return df.where(F.lit(False))
    return df.where(key_range(keys, bits).isin([r["range"] for r in ranges])) if bits else df


def table_diff(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
               columns: Sequence[str] | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """A row per difference: the key, ``difference`` (``only_left``, ``only_right`` or
    ``changed``), ``changed_columns`` (sorted, comma-joined; for ``changed`` alone)
    and the structs ``left_row`` and ``right_row``.

    Rows of one key that differ are paired in the order of their values; what
    one side has more of is only on that side.
    """
    keys, columns = _keys(keys), _columns(left, right, columns)
    bits, ranges = unequal_ranges(left, right, keys, columns, leaf_rows)
    side = lambda df, n: _within(df, keys, bits, ranges).select(*columns, F.lit(n).alias("_side"))
    balance = (side(left, 1).unionByName(side(right, -1)).groupBy(*columns)
               .agg(F.sum("_side").alias("_more")).where("_more <> 0"))
    number = Window.partitionBy(*keys, "_left").orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    rows = (balance.withColumn("_left", F.col("_more") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_more"))))
            .withColumn("_at", F.row_number().over(number)))
    left_row, right_row = (F.max(F.when(F.col("_left") == want, F.struct(*columns))) for want in (True, False))
    paired = rows.groupBy(*keys, "_at").agg(left_row.alias("left_row"), right_row.alias("right_row"))
    others = sorted(c for c in columns if c not in keys)
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"left_row.{c}").eqNullSafe(F.col(f"right_row.{c}")), F.lit(c)) for c in others] or [F.lit(None).cast("string")]))
    both = F.col("left_row").isNotNull() & F.col("right_row").isNotNull()
    return paired.select(
        *keys,
        F.when(both, F.lit("changed")).when(F.col("right_row").isNull(), F.lit("only_left")).otherwise(F.lit("only_right")).alias("difference"),
        F.when(both, F.array_join(changed, ",")).alias("changed_columns"), "left_row", "right_row")


def diff_counts(left: DataFrame, right: DataFrame, keys: str | Sequence[str], table_name: str,
                columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``table_name``, rows of each side, and how many differ in which way."""
    keys, columns = _keys(keys), _columns(left, right, columns)
    ways = ("only_left", "only_right", "changed")
    zero = F.lit(0).cast("long")

    def part(df: DataFrame, given: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(given)).select(
            *[F.col(n) if n == given else zero.alias(n) for n in ("n_left", "n_right")], *[zero.alias(f"n_{w}") for w in ways])

    found = table_diff(left, right, keys, columns).agg(*[F.count_if(F.col("difference") == w).alias(f"n_{w}") for w in ways])
    rows = part(left, "n_left").unionByName(part(right, "n_right")).unionByName(
        found.select(zero.alias("n_left"), zero.alias("n_right"), *[f"n_{w}" for w in ways]))
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns]).select(F.lit(table_name).alias("table_name"), "*")
