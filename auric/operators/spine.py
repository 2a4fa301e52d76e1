"""Calendar × entity spines and per-row ranges, without a cross join.

A spine row per (entity, day) is produced by exploding a date sequence next
to each entity row — a narrow operation, so the spine is built where the
entity rows already live and grows linearly with entities × days (which is
the size of the result itself).  Calendar bounds come in as scalar
subqueries, so no value is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_spine(entities: DataFrame, start: Column, end: Column,
                   day_col: str = "event_date") -> DataFrame:
    return entities.select("*", F.explode(F.sequence(start, end)).alias(day_col))


def densify(facts: DataFrame, entities: DataFrame, entity_cols: Sequence[str],
            day_col: str, measures: dict[str, Column | int | float],
            gap_col: str = "is_gap") -> DataFrame:
    """Every (entity, day) between the first and last day of ``facts``;
    measures missing on a day take the fill value, and ``gap_col`` marks them."""
    start = facts.select(F.min(day_col)).scalar()
    end = facts.select(F.max(day_col)).scalar()
    spine = calendar_spine(entities.select(*entity_cols).distinct(), start, end, day_col)
    keys = list(entity_cols) + [day_col]
    f = facts.select(*keys, *measures.keys(), F.lit(True).alias("_present"))
    out = spine.join(f, keys, "left")
    cols = [F.coalesce(F.col(m), F.lit(v) if not isinstance(v, Column) else v).alias(m)
            for m, v in measures.items()]
    return out.select(*keys, *cols, F.col("_present").isNull().alias(gap_col))


def lateral_range(df: DataFrame, count_col: str, index_col: str = "i",
                  start: int = 0) -> DataFrame:
    """One row per ``i`` in ``start .. start + count - 1`` next to each input row."""
    n = F.col(count_col)
    seq = F.when(n > 0, F.sequence(F.lit(start).cast("bigint"),
                                   (F.lit(start) + n - 1).cast("bigint")))
    return df.select("*", F.explode(seq).alias(index_col))
