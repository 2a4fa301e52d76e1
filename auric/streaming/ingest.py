"""Restartable micro-batch ingest with Structured Streaming.

Delivery semantics, as the reference teaches them:

* commit *before* write loses the batch on a crash (at-most-once) — Spark
  never does this: it logs the batch's offsets, runs the batch, and writes
  the commit only after the sink returned;
* so a crash between write and commit *replays* the batch on restart with
  the same ``batch_id`` and the same offsets (at-least-once);
* exactly-once then needs an idempotent sink.  Three sinks are offered:

  ``append``          plain append — a replay stores the batch twice;
  ``batch_folder``    one folder per ``batch_id``, overwritten on replay;
  ``upsert``          keyed merge into a bucketed table
                      (``on_match='update'`` / ``'ignore'``), which also
                      absorbs the source redelivering a message later.

``trigger(availableNow=True)`` drains what is there in bounded micro-batches
(``maxFilesPerTrigger``; ``maxOffsetsPerTrigger`` for Kafka) and stops — the
batch-job form of a consumer loop.  State lives in ``checkpointLocation``
(a folder on the shared file system), so a restarted driver resumes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from auric.operators.write import merge_upsert, read_table
from auric.sources import fs
from auric.sources.jsonl import JSON_WRITE_OPTIONS, _TS_FORMAT

SINKS = ("append", "batch_folder", "upsert")


class InjectedCrash(RuntimeError):
    """Raised on purpose after a batch was written, before Spark commits it."""


def write_topic(df: DataFrame, path: str, n_files: int,
                order: Sequence[str] = ("_ingested_at", "event_id")) -> None:
    """Lay messages down as JSON files in arrival order, as a topic delivers them.

    Part files hold consecutive key ranges; their modification times are then
    stamped in that order, because the file source picks new files by
    modification time.
    """
    (df.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
       .write.mode("overwrite").options(**JSON_WRITE_OPTIONS).json(path))
    spark = df.sparkSession
    fs.stamp_in_order(spark, fs.data_files(spark, path))


def read_topic(spark: SparkSession, path: str, schema: T.StructType,
               max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("timestampNTZFormat", _TS_FORMAT)
            .json(path))


def sink_writer(sink: str, path: str, key: str | Sequence[str] = "event_id",
                on_match: str = "update", buckets: int | None = None
                ) -> Callable[[DataFrame, int], None]:
    if sink not in SINKS:
        raise ValueError(f"sink must be one of {SINKS}")

    def write(batch: DataFrame, batch_id: int) -> None:
        if sink == "append":
            batch.write.mode("append").parquet(path)
        elif sink == "batch_folder":
            batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
        else:
            merge_upsert(batch, path, key, buckets=buckets, on_match=on_match)
    return write


def run_stream(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
               crash_after_batch: int | None = None) -> StreamingQuery:
    """Run to completion (availableNow); optionally crash after writing one batch."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        handler(batch, batch_id)
        if crash_after_batch is not None and batch_id == crash_after_batch:
            raise InjectedCrash(f"crash after writing batch {batch_id}")

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_with_restart(make_stream: Callable[[], DataFrame],
                     handler: Callable[[DataFrame, int], None], checkpoint: str,
                     crash_after_batch: int | None) -> int:
    """Run; if the injected crash fires, restart from the checkpoint. Returns restarts."""
    try:
        run_stream(make_stream(), handler, checkpoint, crash_after_batch)
        return 0
    except Exception as e:  # noqa: BLE001 - the streaming error wraps ours
        if "InjectedCrash" not in str(e) and not isinstance(e, InjectedCrash):
            raise
    run_stream(make_stream(), handler, checkpoint, None)
    return 1


def read_sink(spark: SparkSession, sink: str, path: str) -> DataFrame:
    df = read_table(spark, path)
    return df.drop("batch_id", "_bucket")


def dedup_stream(stream: DataFrame, key: str | Sequence[str], event_time: str,
                 delay: str) -> DataFrame:
    """Drop redeliveries of a key seen within the watermark; state is bounded by
    the watermark (keys expire ``delay`` after their event time)."""
    keys = [key] if isinstance(key, str) else list(key)
    # Watermarks need a zoned TIMESTAMP; the session zone is UTC, so the
    # wall-clock value is kept exactly.
    wm = "_event_ts"
    return (stream.withColumn(wm, F.col(event_time).cast(T.TimestampType()))
            .withWatermark(wm, delay).dropDuplicatesWithinWatermark(keys).drop(wm))


def has_table(spark: SparkSession, path: str) -> bool:
    return fs.has_data(spark, path)
