"""Published events consumed again, from topic files or from Kafka."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.functions.events import decode_events

_RECORDS = "topic string, key string, value string"


def _of_topics(records: DataFrame, topics: Sequence[str] | None) -> DataFrame:
    return records if topics is None else records.where(F.col("topic").isin(*topics))


def read_topic_events(
    spark: SparkSession, path: str, topics: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of topic files; only the folders of the wanted topics are read.

    Rejects keep topic, key and text and say why they are no events.
    """
    return decode_events(_of_topics(spark.read.schema(_RECORDS).parquet(path), topics), content=False)


def stream_topic_events(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    topics: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` as streams, from the earliest record on.

    A record that is no event is a reject and stops nothing; a topic is replayed at each
    restart, so an error would come back forever. With Kafka, ``kafka`` holds the connector's
    options and ``topics``, if given, are what is subscribed to.
    """
    return decode_events(stream_topic_records(spark, path, kafka, topics), content=False)


def stream_topic_records(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """Records (topic, key, value) as a stream, as they were published."""
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")
    if kafka is not None:
        options = {"startingOffsets": "earliest", **kafka}
        if topics is not None:
            options["subscribe"] = ",".join(topics)
        loaded = spark.readStream.format("kafka").options(**options).load()
        text = [F.col(name).cast("string").alias(name) for name in ("key", "value")]
        return loaded.select("topic", *text)
    return _of_topics(spark.readStream.schema(_RECORDS).parquet(path), topics)
