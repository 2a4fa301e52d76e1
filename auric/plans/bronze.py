"""Bronze: raw rows of one operational day, kept as they came.

``load_day`` writes the rows whose ``_ingested_at`` falls in ``[D, D+1)``
into partition ``_batch_date=D`` of each Bronze table, replacing the folder,
so loading a day twice gives the same table and an empty day clears it.
The filter is sargable, so a Parquet or partitioned landing source only
reads the day's files / row groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.functions.time import as_date, day_slice
from auric.operators.write import read_table, replace_partition
from auric.sources import fs

BATCH_COL = "_batch_date"


def day_batch(raw: DataFrame, run_date: dt.date | str, arrived: str = "_ingested_at") -> DataFrame:
    return raw.where(day_slice(arrived, run_date))


def load_day(feeds: Mapping[str, DataFrame], root: str, run_date: dt.date | str) -> None:
    """Replace partition ``run_date`` of ``<root>/<name>`` for every feed."""
    d = as_date(run_date)
    for name, raw in feeds.items():
        replace_partition(day_batch(raw, d), f"{root.rstrip('/')}/{name}", BATCH_COL, d)


def read_bronze(spark: SparkSession, root: str, name: str, raw_schema=None,
                upto: dt.date | str | None = None,
                only: dt.date | str | None = None) -> DataFrame:
    """A Bronze table; ``upto`` / ``only`` restrict batches by partition filter."""
    path = f"{root.rstrip('/')}/{name}"
    if not fs.exists(spark, path):
        if raw_schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], raw_schema.add(BATCH_COL, "date"))
    df = read_table(spark, path)
    if upto is not None:
        df = df.where(F.col(BATCH_COL) <= F.lit(as_date(upto).isoformat()).cast("date"))
    if only is not None:
        df = df.where(F.col(BATCH_COL) == F.lit(as_date(only).isoformat()).cast("date"))
    return df
