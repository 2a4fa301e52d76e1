"""Keep one row per key: latest state from change records, earliest delivery.

Both are ``row_number() = 1`` over a key-partitioned window.  Catalyst turns
that filter into a WindowGroupLimit that also runs *before* the shuffle
(Spark ≥ 3.5), so a key with millions of records sends at most one row per
map task across the network — a hot ticket or a replayed topic does not
pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column],
                  rank_col: str = "_rn") -> DataFrame:
    w = Window.partitionBy(*_as_list(keys)).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1).drop(rank_col))


def latest_per_key(df: DataFrame, keys: str | Sequence[str],
                   order_by: Sequence[str] = ("event_time", "cdc_seq")) -> DataFrame:
    """Row with the greatest ``order_by`` tuple per key.

    Remaining columns act as a tie-break, so two runs pick the same row.
    """
    keys = _as_list(keys)
    return first_per_key(df, keys, [F.col(c).desc() for c in order_by] + _tie_break(df, keys, order_by))


def earliest_per_key(df: DataFrame, keys: str | Sequence[str],
                     order_by: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    """Row with the smallest ``order_by`` per key.

    Remaining columns act as a tie-break, so the pick is repeatable even when
    two deliveries arrive at the same instant with different payloads.
    """
    keys = _as_list(keys)
    return first_per_key(df, keys, [F.col(c).asc() for c in order_by] + _tie_break(df, keys, order_by))


def _tie_break(df: DataFrame, keys: list[str], order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in df.columns
            if c not in keys and c not in order_by and _orderable(df, c)]


def _orderable(df: DataFrame, name: str) -> bool:
    t = df.schema[name].dataType.typeName()
    return t not in ("map", "variant")
