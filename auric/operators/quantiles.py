"""Exact global quantiles of a numeric column by distributed selection.

``percentile`` gathers every distinct value of the column in one final buffer,
which is fine for whole seconds and hopeless for a column of distinct doubles.
Here only order statistics that a quantile needs are looked for: the value
range of each is cut into BINS, rows are counted per bin (map-side, at most
BINS rows per range reach the driver), and the bin that holds the rank becomes
the next range, until it holds a single value.  A pass narrows a range by
BINS; it reads the rows of the ranges that are left, and ranges that several
ranks share are read once.  Nothing else leaves the tasks, whatever the
number of rows or of distinct values.

NULLs don't count.  Negative infinity is the least value, infinity the
greatest but for NaN, as Spark orders them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def _bin(x: Column, low: float, high: float) -> Column:
    """The bin of a value in [low, high]: never less for a greater value; low is
    in the first bin and high in the last.  Halves keep the width finite."""
    share = (x / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def order_statistics(df: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values that stand at the given 0-based ranks of the sorted column."""
    x = F.col(col).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull())
    v = F.col("x")
    odd = F.isnan(v) | (F.abs(v) == F.lit(math.inf))
    r = values.agg(F.count_if(v == F.lit(-math.inf)).alias("below"), F.count_if(F.isnan(v)).alias("nan"),
                   F.count_if(v == F.lit(math.inf)).alias("above"), F.count(F.lit(1)).alias("n"),
                   F.min(F.when(~odd, v)).alias("low"), F.max(F.when(~odd, v)).alias("high")).first()
    if any(k < 0 or k >= r["n"] for k in ranks):
        raise ValueError(f"ranks {sorted(ranks)} of {r['n']} values")
    found: dict[int, float] = {}
    open_: dict[int, tuple[float, float, int]] = {}  # rank -> range of values and rows below it
    for k in set(ranks):
        if k < r["below"]:
            found[k] = -math.inf
        elif k >= r["n"] - r["nan"]:
            found[k] = math.nan
        elif k >= r["n"] - r["nan"] - r["above"]:
            found[k] = math.inf
        else:
            open_[k] = (r["low"], r["high"], r["below"])
    values = values.where(~odd)
    while True:
        found |= {k: lo for k, (lo, hi, _) in open_.items() if lo == hi}
        open_ = {k: s for k, s in open_.items() if s[0] != s[1]}
        if not open_:
            return found
        ranges = sorted(set(open_.values()))
        # Ranges of different ranks are the same or apart, so a row is in one at most.
        of = F.coalesce(*[F.when(v.between(lo, hi), F.struct(F.lit(i).alias("range"), _bin(v, lo, hi).alias("bin")))
                          for i, (lo, hi, _) in enumerate(ranges)])
        bins = (values.select("x", of.alias("at")).where(F.col("at").isNotNull()).groupBy("at.range", "at.bin")
                .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect())
        for k, s in open_.items():
            below = s[2]
            for b in sorted((b for b in bins if ranges[b["range"]] == s), key=lambda b: b["bin"]):
                if k < below + b["n"]:
                    open_[k] = (b["low"], b["high"], below)
                    break
                below += b["n"]


def exact_quantiles(df: DataFrame, col: str, probabilities: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles, as ``percentile`` gives them; None for no values."""
    n = df.agg(F.count(col)).first()[0]
    if not n:
        return [None] * len(probabilities)
    spots = [(n - 1) * p for p in probabilities]
    known = order_statistics(df, col, [k for s in spots for k in (math.floor(s), math.ceil(s))])
    out: list[float | None] = []
    for s in spots:
        low, high = known[math.floor(s)], known[math.ceil(s)]
        if math.floor(s) == math.ceil(s) or low == high:
            out.append(low)
        else:
            out.append((math.ceil(s) - s) * low + (s - math.floor(s)) * high)
    return out
