"""Domain normalisation as Column expressions (no UDF).

``normalize_domain`` maps a raw text value onto an integer domain ``lo..hi``:
integers inside the range are kept, known labels are mapped
(case- and space-insensitive), everything else becomes NULL.  NULL is the
"reject" signal; ``reject_reason`` explains it.  Both Silver and the
quarantine table use the same expression, so the two can never disagree.

Integer parsing is strict: only ``^\\s*[+-]?\\d+\\s*$`` counts as a number
(no ``1.5``, ``1e0``, ``0x2`` or ``1_0``), so both engines agree.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_PATTERN = r"^\s*[+-]?\d+\s*$"

# The ticket priority contract (1 = most urgent) and the label
# names the source switched to, as documented by the source team.
PRIORITY_LO = 1
PRIORITY_HI = 4
PRIORITY_LABELS = {"urgent": 1, "high": 2, "medium": 3, "low": 4}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_strict_int(c: str | Column) -> Column:
    """The integer written in ``c``, or NULL if it is not a plain integer."""
    s = _col(c)
    return F.when(s.rlike(INT_PATTERN), s.try_cast("int"))


def normalize_domain(c: str | Column, lo: int = PRIORITY_LO, hi: int = PRIORITY_HI,
                     labels: Mapping[str, int] | None = None) -> Column:
    """Clean value in ``lo..hi`` or NULL.

    Labels are one map lookup, so the input isn't referenced once per label.
    """
    labels = PRIORITY_LABELS if labels is None else labels
    s = _col(c)
    n = as_strict_int(s)
    number = F.when(n.between(lo, hi), n)
    names = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k.lower()), F.lit(v))])
    label = F.try_element_at(names, F.lower(F.trim(s)))
    return F.coalesce(number, label.cast("int"))


def reject_reason(c: str | Column, lo: int = PRIORITY_LO, hi: int = PRIORITY_HI,
                  field: str = "priority") -> Column:
    """Why ``normalize_domain`` rejected the value; order of the tests matters."""
    s = _col(c)
    return (F.when(s.isNull(), F.lit(f"{field} is null"))
             .when(F.trim(s) == "", F.lit(f"{field} is blank"))
             .when(s.rlike(INT_PATTERN), F.lit(f"{field} number outside {lo}..{hi}"))
             .otherwise(F.lit(f"{field} not mappable to {lo}..{hi}")))
