"""Vectorised views of a column of texts (numpy over Arrow buffers).

A *batch* is a run of whole texts laid end to end as UTF-8 bytes; word and
window computations run over the whole batch at once and never cross a text.
Null texts count as empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in runs of about this many bytes (one longer text
#: makes a run of its own), which bounds the working memory of a task.
RUN_BYTES = 1 << 20

#: Spark's setting for shuffle files that go when their query ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The white space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Maps A-Z to a-z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}
_MULTIPLIER = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_key(text: Column) -> Column:
    """64-bit fingerprint of a text; with the id it tells rows apart when ids repeat."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def shared_dir(spark: SparkSession) -> None:
    """Make sure that checkpoint() has a folder: the cluster's shared one
    (spark.checkpoint.dir); only local runs without it get a private folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        named = tempfile.mkdtemp(prefix="auric-llm-")
    sc.setCheckpointDir(named)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run within drop their shuffle files as they end.

    Else the files stay until the driver happens to collect its garbage, and
    the steps of an operator add up on the executors' disks.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def saved(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame made here, as the setting counts when a frame is made


def written(df: DataFrame) -> DataFrame:
    """Cut lineage by a Parquet table in the shared checkpoint folder.

    For results that go round a loop: unlike a checkpoint, the table read back
    doesn't carry the plan's constraints, which multiply from round to round.
    """
    shared_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir().rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts: (first row, end row, bytes, offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Start, end and text number of every word in a run."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~space[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least n of them."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            _POWERS["up"] = np.cumprod(np.full(size, _MULTIPLIER, dtype=np.uint64))
            _POWERS["down"] = np.cumprod(np.full(size, pow(_MULTIPLIER, -1, 1 << 64), dtype=np.uint64))
    return _POWERS["up"], _POWERS["down"]


def _byte_codes() -> np.ndarray:
    if "codes" not in _POWERS:
        _POWERS["codes"] = mix64(np.arange(1, 257, dtype=np.uint64))
    return _POWERS["codes"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; span_hash() reads any span's hash from it."""
    up, _ = _powers(len(data) + 1)
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(_byte_codes()[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, the same wherever they stand."""
    _, down = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[start]) * down[start])


def gram_hash(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive words (by the number of its first)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(_MULTIPLIER) + word_hash[k:k + n]
    return mix64(out)
