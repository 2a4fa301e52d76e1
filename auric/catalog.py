"""Named tables: ``source()`` for raw inputs, ``ref()`` for built tables.

A :class:`Catalog` maps a table name to its folder, declared schema, key and
layout, so plans refer to tables by name (as dbt's ``source``/``ref`` do)
and every read uses the declared schema instead of inference.  A table that
does not exist yet reads as an empty DataFrame of its schema, and
``create_if_absent`` materialises that empty table (so a first incremental
run and later runs see the same columns).  ``register_views`` exposes all
existing tables as temporary views for ``spark.sql``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from auric.operators.write import guard_schema, read_table
from auric.sources import fs


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str                                  # landing / bronze / silver / gold
    schema: T.StructType | None = None
    keys: tuple[str, ...] = ()
    partition_by: str | None = None
    fmt: str = "parquet"                        # landing tables may be "json"
    description: str = ""


@dataclass
class Catalog:
    spark: SparkSession
    root: str
    tables: dict[str, TableSpec] = field(default_factory=dict)

    def register(self, spec: TableSpec) -> TableSpec:
        self.tables[spec.name] = spec
        return spec

    def path(self, name: str) -> str:
        spec = self.tables[name]
        return f"{self.root.rstrip('/')}/{spec.layer}/{spec.name}"

    def exists(self, name: str) -> bool:
        return fs.has_data(self.spark, self.path(name))

    def _read(self, name: str) -> DataFrame:
        spec = self.tables[name]
        if not self.exists(name):
            if spec.schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], spec.schema)
        if spec.fmt == "json":
            return self.spark.read.schema(spec.schema).json(self.path(name))
        df = read_table(self.spark, self.path(name), None)
        if spec.schema is not None:
            guard_schema(spec.schema, df.schema, ignore=["_bucket"])
        return df

    def source(self, name: str) -> DataFrame:
        """A raw input (landing or Bronze)."""
        if self.tables[name].layer not in ("landing", "bronze"):
            raise KeyError(f"{name} is not a source table")
        return self._read(name)

    def ref(self, name: str) -> DataFrame:
        """A table built by the pipeline (Silver or Gold)."""
        return self._read(name)

    def create_if_absent(self, name: str) -> None:
        spec = self.tables[name]
        if self.exists(name):
            return
        if spec.schema is None:
            raise ValueError(f"{name} has no declared schema")
        empty = self.spark.createDataFrame([], spec.schema)
        w = empty.write.mode("overwrite")
        if spec.partition_by:
            w = w.partitionBy(spec.partition_by)
        w.parquet(self.path(name))

    def register_views(self, names: Sequence[str] | None = None) -> list[str]:
        done = []
        for n in names or list(self.tables):
            if self.exists(n) or self.tables[n].schema is not None:
                self._read(n).createOrReplaceTempView(n)
                done.append(n)
        return done
