"""Keyed tables with atomic versions: bucketed base, delta segments, manifests.

A table is a folder of immutable *segments* (Parquet, partitioned by a bucket
of the key hash) and of numbered *manifests*.  A manifest lists the segments
of one version, each with its buckets and a sequence number, and is published
by creating one file that must not exist yet.  So

* a write becomes visible whole or not at all: until its manifest is there, no
  reader looks into its segments, and a crash leaves only unlisted files;
* a reader is pinned to the version it opened, whatever is written meanwhile
  (until ``vacuum`` removes what no kept version lists);
* two writers can't both publish a version: the second reads the new manifest
  and tries again.

``upsert`` and ``replace_keys`` write the batch alone, as a delta segment, and
rows are merged when read: per key the rows of the greatest sequence number
win, tombstones hide the key.  A batch therefore writes in proportion to
itself, not to the table.  ``fold`` writes the buckets that hold delta rows
anew (others stay as they are) and is called by the writers when the deltas
come to FOLD_SHARE of the base or to MAX_DELTAS.

Keys must not be NULL.  ``upsert`` refuses a key that stands twice in a batch,
``replace_keys`` takes several rows of a key.  A batch may carry the name and
number of a stream's micro-batch: a number that the table has seen is not
applied again.  On stores without an atomic rename the manifest folder needs a
file system that has one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auric.operators.write import BUCKET_COL, WriteError, guard_schema, size_buckets, with_bucket
from auric.sources import fs

FOLD_SHARE, MAX_DELTAS = 0.25, 16
ATTEMPTS = 10
DELETED, SEQUENCE = "_deleted", "_sequence"


class Conflict(WriteError):
    """Other writers kept publishing first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: str | Sequence[str]):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in fs.list_files(self.spark, f"{self.path}/versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, of the newest by default; None for no table."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        text = fs.read_text(self.spark, self._manifest_path(version))
        if text is None:
            raise WriteError(f"{self.path} has no version {version}")
        found = json.loads(text)
        if found["keys"] != self.keys:
            raise WriteError(f"table keyed on {found['keys']}, asked for {self.keys}")
        return found

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}.json"

    def _publish(self, manifest: dict) -> bool:
        return fs.publish_text(self.spark, self._manifest_path(manifest["version"]), json.dumps(manifest, sort_keys=True))

    def _commit(self, change: Callable[[dict | None], dict | None]) -> dict | None:
        """Publish ``change(newest manifest)`` as the next version; from the
        start if another writer was first.  None leaves the table as it is."""
        for _ in range(ATTEMPTS):
            old = self.manifest()
            new = change(old)
            if new is None:
                return old
            new["version"] = (old["version"] if old else 0) + 1
            if self._publish(new):
                return new
        raise Conflict(f"{self.path}: {ATTEMPTS} versions were published by others meanwhile")

    # ------------------------------------------------------------ segments
    def _write_segment(self, df: DataFrame, buckets: int) -> dict:
        """Write rows as a new segment, which no reader sees yet."""
        name = f"data/{uuid.uuid4().hex}"
        out = with_bucket(df, self.keys, buckets)
        out.hint("rebalance", BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(f"{self.path}/{name}")
        prefix = f"{BUCKET_COL}="
        held = [int(d[len(prefix):]) for d in fs.list_dirs(self.spark, f"{self.path}/{name}") if d.startswith(prefix)]
        return {"name": name, "buckets": sorted(held), "bytes": fs.total_bytes(self.spark, f"{self.path}/{name}")}

    def _read_segment(self, segment: dict, schema: T.StructType) -> DataFrame:
        root = f"{self.path}/{segment['name']}"
        if not segment["buckets"]:
            return self.spark.createDataFrame([], schema).withColumn(SEQUENCE, F.lit(segment["sequence"]))
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET_COL, T.IntegerType())]))
        rows = reader.option("basePath", root).parquet(*[f"{root}/{BUCKET_COL}={b}" for b in segment["buckets"]])
        return rows.drop(BUCKET_COL).withColumn(SEQUENCE, F.lit(segment["sequence"]))

    # ------------------------------------------------------------ reading
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest by default)."""
        manifest = self.manifest(version)
        if manifest is None:
            raise WriteError(f"no table at {self.path}")
        return self._merged(manifest)

    def _merged(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        marked = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType())])

        def rows(segments: list[dict], kind: T.StructType) -> DataFrame | None:
            out = None
            for s in segments:
                if buckets is not None:
                    s = dict(s, buckets=[b for b in s["buckets"] if b in buckets])
                part = self._read_segment(s, kind)
                out = part if out is None else out.unionByName(part)
            return out

        base = rows(manifest["base"], schema)
        delta = rows(manifest["delta"], marked)
        if delta is None:
            return base.drop(SEQUENCE)
        newest = F.max(SEQUENCE).over(Window.partitionBy(*self.keys))
        latest = delta.withColumn("_newest", newest).where((F.col(SEQUENCE) == F.col("_newest")) & ~F.col(DELETED))
        kept = base.join(delta.select(*self.keys).distinct(), self.keys, "left_anti")
        return kept.select(*schema.names).unionByName(latest.select(*schema.names))

    # ------------------------------------------------------------ writing
    def refresh(self, df: DataFrame) -> dict:
        """Replace the whole table; ``df`` may read the table itself."""
        self._check_keys(df, unique=False)
        old = self.manifest()
        buckets = old["buckets"] if old else size_buckets(df)
        segment = self._write_segment(df, buckets)

        def change(found: dict | None) -> dict:
            if (found["version"] if found else 0) != (old["version"] if old else 0):
                raise Conflict(f"{self.path}: changed while it was refreshed")  # don't undo the other write
            sequence = found["sequence"] + 1 if found else 1
            return {"keys": self.keys, "buckets": buckets, "schema": json.loads(df.schema.json()), "sequence": sequence,
                    "base": [dict(segment, sequence=sequence)], "delta": [], "streams": found["streams"] if found else {}}

        return self._commit(change)

    def upsert(self, df: DataFrame, on_match: str = "update", delete_col: str | None = None,
               batch: tuple[str, int] | None = None) -> dict:
        """Batch rows replace the stored rows of their key (``update``), or come in
        only where the key is new (``ignore``); rows with ``delete_col`` true remove
        their key.  ``batch`` names a stream and its micro-batch's number."""
        if on_match not in ("update", "ignore"):
            raise ValueError("on_match must be 'update' or 'ignore'")
        return self._write_delta(df, on_match, delete_col, batch, unique=True)

    def replace_keys(self, df: DataFrame, batch: tuple[str, int] | None = None) -> dict:
        """Remove the stored rows whose key is in the batch, then insert all of its rows."""
        return self._write_delta(df, "update", None, batch, unique=False)

    def _write_delta(self, df: DataFrame, on_match: str, delete_col: str | None, batch: tuple[str, int] | None,
                     unique: bool) -> dict:
        rows = df.withColumn(DELETED, F.coalesce(F.col(delete_col), F.lit(False)) if delete_col else F.lit(False))
        rows = rows.drop(delete_col) if delete_col and delete_col != DELETED else rows
        stored = T.StructType([f for f in rows.schema.fields if f.name != DELETED])
        first = self.manifest()
        if self._seen(first, batch):
            return first
        self._check_keys(df, unique)
        if first is None:
            first = self._create(rows.select(*stored.names))
        guard_schema(T.StructType.fromJson(first["schema"]), stored)
        segment = None if on_match == "ignore" else self._write_segment(rows, first["buckets"])

        def change(found: dict) -> dict | None:
            nonlocal segment
            if self._seen(found, batch):
                return None
            if on_match == "ignore":  # what is new depends on the version that it is added to
                new = rows.join(self._merged(found).select(*self.keys), self.keys, "left_anti")
                segment = self._write_segment(new.select(*rows.columns), found["buckets"])
            streams = dict(found["streams"], **({batch[0]: batch[1]} if batch else {}))
            sequence = found["sequence"] + 1
            return dict(found, sequence=sequence, delta=[*found["delta"], dict(segment, sequence=sequence)], streams=streams)

        done = self._commit(change)
        size = lambda kind: sum(s["bytes"] for s in done[kind])
        if len(done["delta"]) > MAX_DELTAS or size("delta") > FOLD_SHARE * max(size("base"), 1):
            done = self.fold()
        return done

    def _create(self, like: DataFrame) -> dict:
        """Version 1: an empty table, its buckets sized from the first batch."""
        def change(found: dict | None) -> dict | None:
            return None if found else {
                "keys": self.keys, "buckets": size_buckets(like), "schema": json.loads(like.schema.json()), "sequence": 0,
                "base": [{"name": "data/none", "buckets": [], "bytes": 0, "sequence": 0}], "delta": [], "streams": {}}
        return self._commit(change)

    @staticmethod
    def _seen(manifest: dict | None, batch: tuple[str, int] | None) -> bool:
        return bool(manifest and batch and manifest["streams"].get(batch[0], -1) >= batch[1])

    def _check_keys(self, df: DataFrame, unique: bool) -> None:
        null = F.greatest(*[F.col(k).isNull() for k in self.keys], F.lit(False))
        bad = df.where(null).select(*self.keys)
        if unique:
            bad = bad.unionByName(df.groupBy(*self.keys).count().where("count > 1").select(*self.keys))
        found = bad.limit(5).collect()
        if found:
            raise WriteError(f"batch keys {self.keys} not unique / NULL, e.g. {[r.asDict() for r in found]}")

    # ------------------------------------------------------------ upkeep
    def fold(self) -> dict | None:
        """Write the buckets that hold delta rows anew, without deltas; other
        buckets keep their files.  Readers of older versions are not disturbed."""
        def change(found: dict | None) -> dict | None:
            if found is None or not found["delta"]:
                return None
            touched = {b for s in found["delta"] for b in s["buckets"]}
            segment = self._write_segment(self._merged(found, touched), found["buckets"]) if touched else None
            base = [dict(s, buckets=[b for b in s["buckets"] if b not in touched]) for s in found["base"]]
            base = [s for s in base if s["buckets"]]
            if segment:
                base.append(dict(segment, sequence=found["sequence"]))
            return dict(found, base=base, delta=[])
        return self._commit(change)

    def vacuum(self, keep: int = 2, min_age_seconds: float = 86_400) -> list[str]:
        """Remove manifests but the newest ``keep`` and the segments that none of
        those lists; what is younger than ``min_age_seconds`` may be a write under
        way and stays.  Returns the names of the segments that went."""
        known = self.versions()
        kept = known[-max(keep, 1):]
        used = {s["name"].split("/")[1] for v in kept for kind in ("base", "delta") for s in self.manifest(v)[kind]}
        for v in known[:-len(kept)] if len(kept) < len(known) else []:
            fs.delete(self.spark, self._manifest_path(v))
        gone = []
        for name in fs.list_dirs(self.spark, f"{self.path}/data"):
            folder = f"{self.path}/data/{name}"
            if name not in used and time.time() - fs.modified_ms(self.spark, folder) / 1000 >= min_age_seconds:
                fs.delete(self.spark, folder)
                gone.append(name)
        return gone
