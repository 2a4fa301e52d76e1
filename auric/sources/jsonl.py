"""Landing-zone readers (JSON Lines) with explicit schemas — no inference.

* :func:`read_cdc` keeps ``priority`` as raw text whatever JSON type it had
  (the source sent numbers, then labels): a STRING field in the read schema
  turns a JSON number into its text, JSON ``null`` and a missing key into
  NULL, and leaves ``""`` as ``""``.
* :func:`read_events` is a typed read (FAILFAST, as a typed warehouse load).
* :func:`read_transcripts` reads ``turns`` as ``array<string>``.

* :func:`read_cdc_checked` sets aside the lines that :func:`read_cdc` would turn
  into rows of NULLs, with their text and a reason.

The raw JSON line can also arrive as a column (a message value); then
:func:`parse_cdc_column` extracts the same fields with ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CDC_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("ticket_id", T.StringType()),
    T.StructField("cdc_seq", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("csat", T.IntegerType()),
    T.StructField("first_response_sec", T.IntegerType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ticket_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("latency_ms", T.IntegerType()),
    T.StructField("tokens_in", T.IntegerType()),
    T.StructField("tokens_out", T.IntegerType()),
    T.StructField("is_escalated", T.BooleanType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_topic", T.StringType()),
])

TRANSCRIPT_SCHEMA = T.StructType([
    T.StructField("transcript_id", T.LongType()),
    T.StructField("ticket_id", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("turns", T.ArrayType(T.StringType())),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source", T.StringType()),
])

_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
# Writers keep full microsecond precision (Spark's default stops at millis).
JSON_WRITE_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _reader(spark: SparkSession, schema: T.StructType, mode: str):
    return (spark.read.schema(schema).option("mode", mode)
            .option("timestampNTZFormat", _TS_FORMAT))


def _cdc_select(df: DataFrame) -> DataFrame:
    return df.select(*[F.col("priority").alias("priority_raw") if f.name == "priority"
                       else F.col(f.name) for f in CDC_SCHEMA.fields])


def read_cdc(spark: SparkSession, path: str) -> DataFrame:
    return _cdc_select(_reader(spark, CDC_SCHEMA, "PERMISSIVE").json(path))


BROKEN, WRONG_TYPE, NO_KEY = "line is not a JSON object", "a field has the wrong type", "ticket_id is missing"


def read_cdc_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(records, broken)``: the change records, and every other line as
    (file_path, line, reject_reason).

    A line is broken if it isn't a whole JSON object, if a field can't be read as
    its type, or if it names no ticket.  Blank lines are neither.
    """
    kept = T.StructType([*CDC_SCHEMA.fields, T.StructField("_broken", T.StringType())])
    read = F.from_json("value", kept, {"timestampNTZFormat": _TS_FORMAT, "mode": "PERMISSIVE",
                                       "columnNameOfCorruptRecord": "_broken"})
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"), read.alias("r"))
    whole = F.try_parse_json("line")
    reason = (F.when(whole.isNull() | ~F.coalesce(F.schema_of_variant(whole), F.lit("")).startswith("OBJECT"), F.lit(BROKEN))
              .when(F.col("r").isNull() | F.col("r._broken").isNotNull(), F.lit(WRONG_TYPE))
              .when(F.col("r.ticket_id").isNull(), F.lit(NO_KEY)))
    told = lines.withColumn("reject_reason", reason)
    records = _cdc_select(told.where("reject_reason is null").select("r.*").drop("_broken"))
    return records, told.where("reject_reason is not null").select("file_path", "line", "reject_reason")


def parse_cdc_column(line: str | Column) -> Column:
    c = F.col(line) if isinstance(line, str) else line
    return F.from_json(c, CDC_SCHEMA, {"timestampNTZFormat": _TS_FORMAT})


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return _reader(spark, EVENT_SCHEMA, "FAILFAST").json(path)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return _reader(spark, TRANSCRIPT_SCHEMA, "FAILFAST").json(path)


def cdc_json_lines(cdc: DataFrame) -> DataFrame:
    """Render change records as the source sends them: one JSON object per line.

    ``priority`` goes out as a JSON *number* while the source still used the
    numeric contract, as a JSON string after the switch, and as ``null`` when
    missing — the mixed typing a raw-retaining reader has to survive.
    """
    body = F.to_json(F.struct(*[F.col(f.name) for f in CDC_SCHEMA.fields
                                if f.name != "priority"]), JSON_WRITE_OPTIONS)
    p = F.col("priority_raw")
    token = (F.when(p.isNull(), F.lit("null"))
              .when(p.rlike(r"^-?\d+$") & ~p.isin("0", "5", "-1"), p)
              .otherwise(F.regexp_extract(F.to_json(F.array(p)), r"^\[(.*)\]$", 1)))
    return cdc.select(
        F.concat(F.regexp_replace(body, r"\}$", ""), F.lit(',"priority":'), token, F.lit("}"))
        .alias("value"))


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**JSON_WRITE_OPTIONS).json(path)
