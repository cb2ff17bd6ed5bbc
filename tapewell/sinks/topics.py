"""Topic routing: event JSON keyed by symbol, to Kafka or to files by topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.config import QUARANTINE_TOPIC, TICKER_TOPIC, TRADES_TOPIC, WINDOWS_TOPIC
from tapewell.functions.events import encode_event
from tapewell.functions.windows import iso_utc
from tapewell.schemas import WINDOW_SCHEMA


def with_topic(events: DataFrame, topic: str | None = None) -> DataFrame:
    """Name each event's topic: ticker events apart, everything else with the trades."""
    by_type = F.when(F.col("event_type") == "ticker", TICKER_TOPIC).otherwise(TRADES_TOPIC)
    return events.withColumn("topic", F.lit(topic) if topic else by_type)


def route_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (trades, tickers) by topic."""
    routed = with_topic(events)
    is_ticker = F.col("topic") == TICKER_TOPIC
    return routed.where(~is_ticker).drop("topic"), routed.where(is_ticker).drop("topic")


def topic_records(events: DataFrame, topic: str | None = None) -> DataFrame:
    """Records (topic, key, value) ready for a Kafka sink."""
    return with_topic(events, topic).select(
        "topic", F.col("symbol").alias("key"), encode_event().alias("value")
    )


def reject_records(rejects: DataFrame) -> DataFrame:
    """Records (topic, key, value) of rejected texts for the quarantine topic: text and reason as JSON."""
    key = F.col("key") if "key" in rejects.columns else F.lit(None).cast("string")
    fields = [name for name in ("topic", "exchange", "seq", "value", "payload", "reason") if name in rejects.columns]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rejects.select(F.lit(QUARANTINE_TOPIC).alias("topic"), key.alias("key"), body.alias("value"))


def publish(
    events: DataFrame,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    topic: str | None = None,
) -> None:
    """Publish a batch of events to files by topic, or to Kafka where its connector is present."""
    publish_records(topic_records(events, topic), path, kafka)


def publish_records(
    records: DataFrame, path: str | None = None, kafka: dict[str, str] | None = None
) -> None:
    """Publish records (topic, key, value), such as those of events or of rejects."""
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")
    if kafka is not None:
        records.write.format("kafka").options(**kafka).save()
    else:
        records.hint("rebalance", "topic").write.mode("append").partitionBy("topic").parquet(path)


def window_records(windows: DataFrame) -> DataFrame:
    """Closed windows as JSON records keyed by symbol, bounds as ISO text with offset."""
    bounds = ("window_start", "window_end")
    fields = [
        (iso_utc(F.col(name)) if name in bounds else F.col(name)).alias(name)
        for name in WINDOW_SCHEMA.fieldNames()
    ]
    return windows.select(
        F.lit(WINDOWS_TOPIC).alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_window_records(records: DataFrame, *extra: Column) -> DataFrame:
    """Window records back to typed windows, with any further columns asked for."""
    opened = records.select(F.from_json("value", WINDOW_SCHEMA).alias("_w"), *extra)
    return opened.select("_w.*", *opened.columns[1:])
