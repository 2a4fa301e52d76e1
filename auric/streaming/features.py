"""Daily features kept current from partial state that merges.

The state of a (day, customer) is a table of counted facts:

* ``total``    one row: events, escalated events, token sums (and how many
  events have tokens, since a sum over none is NULL);
* ``latency``  one row per value: how many events have it, which gives the
  exact average and the exact percentile;
* ``ticket``   one row per ticket: how many events name it, which gives the
  exact distinct count.

Every column is a sum, so the states of two batches merge by adding them up,
and an event is taken back by adding its facts with the sign turned.  A batch
therefore adds its own facts and finalises the keys it touches from facts, not
from the events of their days; a customer with a third of all events costs one
row per distinct latency and ticket.

Layout, below one folder: ``log`` holds the accepted events and ``state`` the
facts of each micro-batch (``batch_id=N/event_date=D``), ``snapshot`` the summed
facts of all batches up to one (``upto=N/event_date=D``).  A batch reads
batches before its own only and overwrites its own folders, so a replayed
batch gives what it gave before.  Of the log it reads ids and arrival times of
the days it touches; whole rows only of events that it takes back.

An event stands for its (event_date, event_id); the earliest delivery wins, a
tie is settled by the other columns.  NULL dates, ids or customers fail the
batch before anything is written.  A key whose last event was taken back leaves Gold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auric.functions.numeric import round_binary, to_int_half_even
from auric.operators.state import earliest_per_key
from auric.operators.write import MAX_TOUCHED_PARTITIONS, WriteError, delete_insert
from auric.plans.gold import FEATURE_GROUP, FEATURE_KEYS
from auric.sources import fs

EVENT_KEY = ["event_date", "event_id"]
ARRIVAL = "_ingested_at"
SIGN = "_sign"
TOTAL, LATENCY, TICKET = "total", "latency", "ticket"
SUMS = ["n", "n_escalated", "tokens_in", "n_tokens_in", "tokens_out", "n_tokens_out"]
FACT_KEYS = [*FEATURE_GROUP, "kind", "latency_ms", "ticket_id"]
#: A snapshot of the state is written every so many batches.
SNAPSHOT_EVERY = 16


def facts(events: DataFrame) -> DataFrame:
    """Summed facts of events, each counted ``_sign`` times (1 or -1)."""
    sign, zero, none = F.col(SIGN).cast("bigint"), F.lit(0).cast("bigint"), F.lit(None)

    def fact(kind: str, latency: Column | None = None, ticket: Column | None = None, sums=(zero,) * (len(SUMS) - 1)) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (none if latency is None else latency).cast("int").alias("latency_ms"),
                        (none if ticket is None else ticket).cast("string").alias("ticket_id"),
                        *[v.alias(name) for v, name in zip((sign, *sums), SUMS, strict=True)])

    def signed(c: str) -> Column:
        return sign * F.coalesce(F.col(c), F.lit(0))

    def held(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), sign).otherwise(zero)

    total = fact(TOTAL, sums=(F.when(F.col("is_escalated"), sign).otherwise(zero), signed("tokens_in"), held("tokens_in"),
                              signed("tokens_out"), held("tokens_out")))
    all_facts = F.array(total, fact(LATENCY, latency=F.col("latency_ms")), fact(TICKET, ticket=F.col("ticket_id")))
    told = F.filter(all_facts, lambda f: (f["kind"] == TOTAL) | f["latency_ms"].isNotNull() | f["ticket_id"].isNotNull())
    return net(events.select(*FEATURE_GROUP, F.explode(told).alias("fact")).select(*FEATURE_GROUP, "fact.*"))


def net(counted: DataFrame) -> DataFrame:
    """Facts added up; what was taken back whole is gone.  In the facts of one
    batch an event may make up for another in ``n`` and not in the other sums."""
    summed = counted.groupBy(*FACT_KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in SUMS])
    return summed.where(" OR ".join(f"{c} <> 0" for c in SUMS))


def features(summed: DataFrame) -> DataFrame:
    """The seven measures of ``gold.feature_daily`` from added-up facts."""
    def of(kind: str, value) -> Column:
        return F.when(F.col("kind") == kind, value)

    def tokens(c: str) -> Column:
        return F.when(F.sum(f"n_{c}") > 0, F.sum(c)).cast("bigint").alias(c)

    weighted = F.sum(of(LATENCY, F.col("latency_ms").cast("bigint") * F.col("n")))
    return (summed.groupBy(*FEATURE_GROUP).agg(
        F.sum(of(TOTAL, F.col("n"))).cast("bigint").alias("n_events"),
        F.count(of(TICKET, F.col("ticket_id"))).alias("n_tickets"),
        F.sum("n_escalated").cast("bigint").alias("n_escalated"),
        round_binary(weighted / F.sum(of(LATENCY, F.col("n"))), 2).alias("avg_latency_ms"),
        to_int_half_even(F.percentile(of(LATENCY, F.col("latency_ms")), F.lit(0.95), F.col("n"))).alias("p95_latency_ms"),
        tokens("tokens_in"), tokens("tokens_out")).where("n_events > 0"))


class FeatureUpkeep:
    """foreachBatch handler that keeps a Gold table of daily features current."""

    def __init__(self, path: str, gold_path: str, snapshot_every: int = SNAPSHOT_EVERY):
        self.path, self.gold_path, self.snapshot_every = path.rstrip("/"), gold_path, snapshot_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = batch.withColumn("event_date", F.to_date("event_time"))
        staged = f"{self.path}/staged/batch_id={batch_id}"
        events.write.mode("overwrite").parquet(staged)
        events = spark.read.schema(events.schema).parquet(staged)
        days = self._days(events)
        if days:
            replaces = self._accept(events, batch_id, days)
            accepted = self._read(spark, events.schema, [f"log/batch_id={batch_id}"])
            changes = accepted.withColumn(SIGN, F.lit(1))
            if replaces:
                log = self.events(spark, events.schema, batch_id).where(F.col("event_date").isin(days))
                stored = log.join(accepted.select(*EVENT_KEY), EVENT_KEY, "left_semi")
                changes = changes.unionByName(earliest_per_key(stored, EVENT_KEY, [ARRIVAL]).withColumn(SIGN, F.lit(-1)))
            self._write(facts(changes), "state", f"batch_id={batch_id}")
            self._to_gold(spark, batch_id, days, changes.select(*FEATURE_KEYS).distinct(), replaces)
        fs.delete(spark, staged)
        if self.snapshot_every and (batch_id + 1) % self.snapshot_every == 0:
            self._write(self.state(spark, batch_id), "snapshot", f"upto={batch_id}")

    @staticmethod
    def _days(events: DataFrame) -> list:
        null = F.greatest(*[F.col(c).isNull() for c in (*EVENT_KEY, "customer_id")])
        found = events.groupBy("event_date").agg(F.max(null).alias("null")).limit(MAX_TOUCHED_PARTITIONS + 1).collect()
        if any(r["null"] for r in found):
            raise WriteError(f"NULL in {EVENT_KEY} or customer_id")
        if len(found) > MAX_TOUCHED_PARTITIONS:
            raise WriteError("micro-batch touches too many days")
        return [r["event_date"] for r in found]

    # ------------------------------------------------------------ folders
    def _write(self, df: DataFrame, kind: str, folder: str) -> None:
        df.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(f"{self.path}/{kind}/{folder}")

    def _numbers(self, spark: SparkSession, kind: str, name: str) -> list[int]:
        """Numbers of the finished folders of a kind, in order."""
        found = [d[len(name) + 1:] for d in fs.list_dirs(spark, f"{self.path}/{kind}") if d.startswith(f"{name}=")]
        return sorted(int(n) for n in found if fs.exists(spark, f"{self.path}/{kind}/{name}={n}/_SUCCESS"))

    def _read(self, spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame | None:
        """Rows of folders below the root, each partitioned by event_date."""
        out = None
        for f in folders:
            root = f"{self.path}/{f}"
            part = spark.read.schema(schema).option("basePath", root).parquet(root).select(*schema.names)
            out = part if out is None else out.unionByName(part)
        return out

    def events(self, spark: SparkSession, schema: T.StructType, before: int) -> DataFrame | None:
        """Accepted deliveries of the batches before one; an event that a later
        batch replaced stands there with each of its deliveries."""
        numbers = [n for n in self._numbers(spark, "log", "batch_id") if n < before]
        return self._read(spark, schema, [f"log/batch_id={n}" for n in numbers])

    def state(self, spark: SparkSession, upto: int) -> DataFrame:
        """Added-up facts of the batches up to one."""
        types = {"event_date": T.DateType(), "latency_ms": T.IntegerType(), **{c: T.LongType() for c in SUMS}}
        schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in [*FACT_KEYS, *SUMS]])
        start = max((n for n in self._numbers(spark, "snapshot", "upto") if n < upto), default=None)
        later = [n for n in self._numbers(spark, "state", "batch_id") if (start is None or n > start) and n <= upto]
        parts = ([] if start is None else [f"snapshot/upto={start}"]) + [f"state/batch_id={n}" for n in later]
        found = self._read(spark, schema, parts)
        return net(found) if found is not None else spark.createDataFrame([], schema)

    # ------------------------------------------------------------ a batch
    def _accept(self, events: DataFrame, batch_id: int, days: list) -> bool:
        """Write the batch's events that are new or earlier than the stored ones;
        whether any of them may replace a stored one."""
        log = self.events(events.sparkSession, events.schema, batch_id)
        if log is None:
            self._write(earliest_per_key(events, EVENT_KEY, [ARRIVAL]), "log", f"batch_id={batch_id}")
            return False
        log = log.where(F.col("event_date").isin(days))
        # Ids and arrival times tell which keys are known and whether one of their
        # deliveries here isn't later than the stored ones; whole rows are sorted once.
        known = self._known(events, log, batch_id)
        fresh = earliest_per_key(events.join(known.select(*EVENT_KEY), EVENT_KEY, "left_anti"), EVENT_KEY, [ARRIVAL])
        replaced = known.where("_replaced").select(*EVENT_KEY)
        replaces = replaced.limit(1).count() > 0
        if replaces:
            contested = earliest_per_key(events.join(replaced, EVENT_KEY, "left_semi"), EVENT_KEY, [ARRIVAL])
            stored = log.join(replaced, EVENT_KEY, "left_semi")
            fresh = fresh.unionByName(earliest_per_key(stored.unionByName(contested), EVENT_KEY, [ARRIVAL]))
        self._write(fresh, "log", f"batch_id={batch_id}")
        fs.delete(events.sparkSession, f"{self.path}/known/batch_id={batch_id}")
        return replaces

    def _known(self, events: DataFrame, log: DataFrame, batch_id: int) -> DataFrame:
        """The batch's keys that the log holds, and whether the batch may replace them."""
        spark, path = events.sparkSession, f"{self.path}/known/batch_id={batch_id}"
        stored, here = log.select(*EVENT_KEY, ARRIVAL), events.select(*EVENT_KEY, ARRIVAL)
        known = stored.join(here.select(*EVENT_KEY), EVENT_KEY, "left_semi").groupBy(*EVENT_KEY).agg(F.min(ARRIVAL).alias("_known"))
        later = F.coalesce(F.col("_known") < F.col(ARRIVAL), F.lit(False))
        found = here.join(known, EVENT_KEY).groupBy(*EVENT_KEY).agg(F.bool_or(~later).alias("_replaced"))
        found.write.mode("overwrite").parquet(path)
        return spark.read.schema(found.schema).parquet(path)

    def _to_gold(self, spark: SparkSession, batch_id: int, days: list, touched: DataFrame, emptied: bool) -> None:
        """Finalise the touched keys and replace them in Gold."""
        now = self.state(spark, batch_id).where(F.col("event_date").isin(days))
        redo = features(now.join(touched, FEATURE_KEYS, "left_semi"))
        if not emptied:
            delete_insert(redo, self.gold_path, FEATURE_KEYS, "event_date")
            return
        gone = touched.join(redo.select(*FEATURE_KEYS), FEATURE_KEYS, "left_anti").withColumn("_gone", F.lit(True))
        delete_insert(redo.withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True), self.gold_path,
                      FEATURE_KEYS, "event_date", delete_col="_gone")
