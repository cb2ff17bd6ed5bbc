"""Raw exchange messages: one JSON envelope per line, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.functions.parsing import parse_ts
from tapewell.operators.quantile import value_at_rank
from tapewell.schemas import RAW_SCHEMA

_ENVELOPE = ("seq", "ts_recorded", "exchange", "channel", "payload")
_TEXT = "value string"

# Tells a payload that is an object from one that is a string holding JSON text, without
# opening the payload once more.
_OBJECT_PAYLOAD = r'"payload"\s*:\s*\{'


def _not_blank(line: Column) -> Column:
    return line.rlike(r"\S")


# A line of a live feed that is no message; null for messages.
MALFORMED = "malformed"


def parse_envelope(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Open the envelope of each line; a line that is not one stops the job.

    If not ``strict``, such a line goes on as a row with its text in :data:`MALFORMED`.
    ``json_tuple`` opens a line once for all fields. The gate is a filter, so it
    also runs when later steps need no column at all. The payload stays JSON text,
    to be opened by the normalizer of its exchange.
    """
    opened = lines.where(_not_blank(F.col("value"))).select(
        "value", F.json_tuple("value", *_ENVELOPE).alias(*_ENVELOPE)
    )
    seq = F.col("seq").try_cast("bigint")
    recorded = parse_ts(F.col("ts_recorded"))
    readable = (
        seq.isNotNull()
        & recorded.isNotNull()
        & F.col("exchange").isNotNull()
        & F.col("payload").startswith("{")
        & F.col("value").rlike(_OBJECT_PAYLOAD)
    )
    readable = F.coalesce(readable, F.lit(False))
    message = [
        seq.alias("seq"),
        recorded.alias("ts_recorded"),
        F.col("exchange"),
        F.col("channel"),
        F.col("payload"),
    ]
    if not strict:
        return opened.select(*message, F.when(~readable, F.col("value")).alias(MALFORMED))
    complaint = F.concat(F.lit("malformed raw message: "), F.col("value"))
    gate = F.when(readable, True).otherwise(F.raise_error(complaint).cast("boolean"))
    return opened.where(gate).select(*message)


def read_raw_messages(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Recorded messages from JSON lines; ``limit`` keeps the first ones by ``seq``.

    The last number that fits is found by counting, so that no task sorts or gathers the
    messages. Messages that share that number all stay.
    """
    raw = parse_envelope(spark.read.schema(_TEXT).text(path))
    if limit is None:
        return raw
    if limit <= 0:
        return raw.where(F.lit(False))
    last = value_at_rank(raw.select("seq"), "seq", limit - 1)
    return raw if last is None else raw.where(F.col("seq") <= last)


def count_raw_messages(spark: SparkSession, path: str) -> int:
    """Number of non-blank lines, without parsing them."""
    return spark.read.schema(_TEXT).text(path).where(_not_blank(F.col("value"))).count()


def stream_raw_messages(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded raw messages from a folder of JSON-lines files, or from Kafka.

    A replayed source meets a malformed line at every restart, so here such lines go on
    as rows of their own, see :func:`parse_envelope`.
    Kafka needs the connector on the class path and is read from the earliest
    offset; ``kafka`` holds its options (``kafka.bootstrap.servers``, ``subscribe``).
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")
    if kafka is not None:
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for key, value in kafka.items():
            reader = reader.option(key, value)
        texts = reader.load().select(F.col("value").cast("string").alias("value"))
        return parse_envelope(texts, strict=False)
    reader = spark.readStream.schema(_TEXT)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_envelope(reader.text(path), strict=False)


def empty_raw_messages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)
