"""Time helpers: sargable day slices and boundary-counting differences.

Filters are written with the column alone on one side (``col >= lit`` and
``col < lit``) so Parquet min/max statistics and partition pruning apply.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def ts_literal(d: dt.date | dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (midnight for a date)."""
    if isinstance(d, dt.datetime):
        text = d.isoformat(sep=" ")
    else:
        text = f"{as_date(d).isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def date_literal(d: dt.date | str) -> Column:
    return F.lit(as_date(d).isoformat()).cast("date")


def day_slice(c: str | Column, day: dt.date | str, days: int = 1) -> Column:
    """Half-open ``[day, day + days)`` on a timestamp column."""
    start = as_date(day)
    return (_col(c) >= ts_literal(start)) & (_col(c) < ts_literal(start + dt.timedelta(days=days)))


_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
                "day": 86_400_000_000}


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (no time zone involved)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _col(c))


def _floor_div(x: Column, n: int) -> Column:
    return ((x - F.pmod(x, F.lit(n))) / F.lit(n)).cast("bigint")


def units_between(start: str | Column, end: str | Column, unit: str) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    ``10:59 → 11:01`` is one hour (Spark's ``timestampdiff`` would say 0).
    """
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unsupported unit {unit!r}")
    n = _UNIT_MICROS[unit]
    return _floor_div(epoch_micros(end), n) - _floor_div(epoch_micros(start), n)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds crossed (fractional seconds truncated on each side first)."""
    return units_between(start, end, "second")
