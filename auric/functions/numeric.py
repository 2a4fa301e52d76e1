"""Numeric helpers that reproduce the reference's rounding rules.

* ``round_binary(x, n)`` — round as the reference does on doubles
  (``round(x * 10^n) / 10^n`` on the binary value: ``round(8.575, 2)`` gives
  8.57), where Spark's ``round`` goes through a decimal and gives 8.58.
* ``to_int_half_even(x)`` — the reference's ``double::int`` rounds half to
  even; Spark's cast truncates.  The value is first rounded to 6 decimals so
  that float noise of an interpolation step cannot flip a .5 case.
* ``exact_percentile_int(x, p)`` — exact interpolated percentile (not the
  approximate sketch), converted like the reference's ``::int``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_binary(c: str | Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def to_int_half_even(c: str | Column) -> Column:
    return F.rint(F.round(_col(c), 6)).cast("int")


def exact_percentile_int(c: str | Column, p: float) -> Column:
    return to_int_half_even(F.percentile(_col(c), F.lit(p)))
