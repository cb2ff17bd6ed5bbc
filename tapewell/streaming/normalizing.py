"""Normalization of a live feed, with its quarantine on the side."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewell.operators.normalize import (
    EXCHANGES,
    events_of,
    normalize_tagged,
    rejects_of,
    to_quarantine,
)
from tapewell.sinks.lake import BRONZE_PARTITIONS
from tapewell.sources.raw import MALFORMED


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run a checkpoint belongs to, written beside its state when it starts.

    Batch numbers start again with a new checkpoint, so they name a batch only within a run.
    """
    path = f"{checkpoint.rstrip('/')}/tapewell-run"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(uuid.uuid4().hex,)], "value string").write.text(path)
    return spark.read.text(path).first()[0]


def split_unreadable(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(messages, rejects)``: lines that are no message and messages of an exchange
    without a normalizer are rejects."""
    if MALFORMED not in batch.columns:
        batch = batch.withColumn(MALFORMED, F.lit(None).cast("string"))
    exchange = F.col("exchange")
    followed = F.coalesce(exchange.isin(*EXCHANGES), F.lit(False))
    judged = batch.withColumn(
        "reason",
        F.when(F.col(MALFORMED).isNotNull(), "malformed raw message").when(
            ~followed,
            F.concat(F.lit("no normalizer for exchange "), F.coalesce(exchange, F.lit("null"))),
        ),
    )
    rejects = judged.where(F.col("reason").isNotNull()).select(
        F.coalesce(exchange, F.lit("unknown")).alias("exchange"),
        "seq",
        "reason",
        F.coalesce(MALFORMED, "payload").alias("record"),
    )
    return judged.where(F.col("reason").isNull()).drop("reason", MALFORMED), rejects


def stream_normalize(
    raw: DataFrame,
    dim: DataFrame | None,
    events_root: str,
    quarantine_root: str,
    checkpoint: str,
    ts_ingest: Column | None = None,
    bounded: bool = True,
) -> StreamingQuery:
    """Normalize raw messages into an event table and a quarantine table.

    A bad sub-record, a line that is no message and a message of an unknown exchange go
    to the quarantine and never stop the stream. Every
    micro-batch is parsed once and written under a folder of its run and ``batch_id``,
    which a repeated batch overwrites, so each record lands exactly once. A run is what
    shares a checkpoint: a new checkpoint on the same roots adds to them.
    """
    run = run_of(raw.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        messages, unreadable = split_unreadable(batch)
        tagged = normalize_tagged(messages, dim, ts_ingest)
        tagged = tagged.unionByName(unreadable, allowMissingColumns=True)
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (
                events_of(tagged)
                .hint("rebalance", *BRONZE_PARTITIONS)
                .write.mode("overwrite")
                .partitionBy(*BRONZE_PARTITIONS)
                .parquet(f"{events_root}/run={run}/batch_id={batch_id}")
            )
            to_quarantine(rejects_of(tagged)).write.mode("overwrite").parquet(
                f"{quarantine_root}/run={run}/batch_id={batch_id}"
            )
        finally:
            tagged.unpersist()

    trigger = {"availableNow": True} if bounded else {"processingTime": "10 seconds"}
    return (
        raw.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
