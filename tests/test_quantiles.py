"""Exact quantiles by selection against percentile and against sorting."""
from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from auric.operators import quantiles

P = [0.0, 0.013, 0.25, 0.5, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["distinct", "ties", "wide", "one", "skewed"])
@pytest.mark.parametrize("bins", [2, 4096])
def test_equal_to_percentile(spark, monkeypatch, kind, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rnd = random.Random(kind)
    make = {"distinct": lambda: rnd.gauss(0, 1), "ties": lambda: float(rnd.randint(0, 5)), "one": lambda: 7.5,
            "wide": lambda: rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 308),
            "skewed": lambda: 0.0 if rnd.random() < 0.4 else rnd.random() * 1e-9}[kind]
    n = 60 if bins == 2 else 3000
    df = spark.createDataFrame([(make(),) for _ in range(n)] + [(None,)] * 5, "x double").repartition(3)
    want = df.agg(F.percentile("x", F.array(*map(F.lit, P)))).first()[0]
    assert quantiles.exact_quantiles(df, "x", P) == list(want)


def test_infinities_and_nan_in_order(spark):
    values = [math.inf, 1.0, -math.inf, 2.0, math.nan, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.order_statistics(df, "x", range(6))
    assert [got[k] for k in range(5)] == [-math.inf, -math.inf, 1.0, 2.0, math.inf] and math.isnan(got[5])


def test_no_values_and_integers(spark):
    assert quantiles.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]
    assert quantiles.exact_quantiles(spark.range(10), "id", [0.5, 1.0]) == [4.5, 9.0]
    with pytest.raises(ValueError):
        quantiles.order_statistics(spark.range(3), "id", [3])
