"""Analytic queries over gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewell.sinks.versioned import gold_snapshots, read_gold

MINUTE = "1m"


def _minutes(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("window_size") == MINUTE)


def vwap_moving_average(gold: DataFrame) -> DataFrame:
    """Each traded minute's VWAP and its mean over that and the two traded minutes before.

    A task holds the minutes of one symbol: at most 1,440 rows per calendar day,
    however many trades were made in them.
    """
    trailing = Window.partitionBy("symbol").orderBy("window_start").rowsBetween(-2, 0)
    return (
        _minutes(gold)
        .where("trade_count > 0")
        .select(
            "symbol",
            "window_start",
            "vwap",
            F.avg("vwap").over(trailing).alias("vwap_ma3"),
            "trade_volume",
            "trade_count",
        )
        .orderBy("symbol", "window_start")
    )


def symbol_summary(gold: DataFrame) -> DataFrame:
    """Minutes, total volume and mean spread per symbol."""
    return (
        _minutes(gold)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("windows"),
            F.sum("trade_volume").alias("total_volume"),
            F.round(F.avg("avg_spread"), 6).alias("mean_spread"),
        )
        .orderBy("symbol")
    )


def latest_per_symbol(gold: DataFrame) -> DataFrame:
    """The newest minute of each symbol, combined on the map side."""
    row = F.struct(*[F.col(name) for name in gold.columns])
    newest = _minutes(gold).groupBy("symbol").agg(F.max_by(row, "window_start").alias("_row"))
    return newest.select("_row.*").orderBy("symbol")


def trade_series(gold: DataFrame) -> DataFrame:
    """Minutes with trades: VWAP and volume over time, for plotting."""
    return (
        _minutes(gold)
        .where("trade_count > 0")
        .select("symbol", "window_start", "vwap", "trade_volume")
    )


def spread_series(gold: DataFrame) -> DataFrame:
    """Minutes with quotes: mean spread over time, for plotting."""
    return (
        _minutes(gold).where("ticker_count > 0").select("symbol", "window_start", "avg_spread")
    )


def query_gold(spark: SparkSession, root: str, sql: str) -> DataFrame:
    """Any SQL over the view ``gold``, which always shows the current generation."""
    read_gold(spark, root).createOrReplaceTempView("gold")
    return spark.sql(sql)


def time_travel(spark: SparkSession, root: str) -> DataFrame:
    """One row: snapshot count, rows now, and the id and rows of the first snapshot."""
    log = gold_snapshots(spark, root)
    return log.agg(
        F.count("snapshot_id").alias("snapshots"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("current_rows"),
        F.min_by("snapshot_id", "seq").alias("first_snapshot_id"),
        F.min_by(F.when(F.col("snapshot_id").isNotNull(), F.col("rows")), "seq").alias(
            "first_snapshot_rows"
        ),
    )
