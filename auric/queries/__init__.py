"""Registered queries: one per operator of the inventory, each with its oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built from the parquet
tables in ``sf_dir``; ``ORACLES[name]`` is DuckDB SQL over the same tables
that states the expected result.  Queries whose result cannot be stated in
SQL (file layout) have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from auric.queries import audit, core, layout, quality, stream, versioned, writes  # noqa: F401
