"""Property tests: Spark operators against small pure-Python models."""
from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auric.functions.domain import PRIORITY_LABELS, normalize_domain
from auric.operators import write as W

_INT = re.compile(r"^\s*[+-]?\d+\s*$")


def _model(raw):
    if raw is None:
        return None
    if _INT.match(raw):
        try:
            v = int(raw.strip())
        except ValueError:
            return None
        if -2**31 <= v < 2**31 and 1 <= v <= 4:
            return v
    return PRIORITY_LABELS.get(raw.strip(" ").lower())


_pieces = st.sampled_from(["1", "2", "4", "5", "0", "-1", "+3", "007", " ", "  ", "P", "x",
                           "urgent", "HIGH", "Medium", "low", "lo", "1.5", "e", "\t"])
_raw = st.one_of(st.none(), st.lists(_pieces, min_size=0, max_size=3).map("".join))

_SETTINGS = settings(max_examples=15, deadline=None,
                     suppress_health_check=[HealthCheck.function_scoped_fixture])


@_SETTINGS
@given(st.lists(_raw, min_size=1, max_size=40))
def test_normalize_domain_matches_model(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    got = {r.i: r.p for r in df.select("i", normalize_domain("raw").alias("p")).collect()}
    assert got == {i: _model(r) for i, r in enumerate(raws)}


_batch = st.dictionaries(st.integers(0, 30), st.text("abc", min_size=1, max_size=2),
                         min_size=0, max_size=12)


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_batch, min_size=1, max_size=3), st.sampled_from(["update", "ignore"]))
def test_merge_sequence_matches_dict_model(spark, work, batches, on_match):
    path = work("prop-merge")
    model: dict[int, str] = {}
    for b in batches:
        df = spark.createDataFrame(sorted(b.items()), "k long, v string")
        W.merge_upsert(df, path, "k", buckets=3, on_match=on_match)
        W.merge_upsert(df, path, "k", buckets=3, on_match=on_match)     # re-run: same table
        for k, v in b.items():
            if on_match == "update" or k not in model:
                model[k] = v
    if not W.fs.has_data(spark, path):
        assert model == {}
        return
    got = {r.k: r.v for r in W.read_table(spark, path).collect()}
    assert got == model
