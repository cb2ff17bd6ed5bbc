"""Silver tables: filtered, deduplicated trades and filtered quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewell.functions.parsing import mid, spread

TRADE_COLUMNS = (
    "exchange",
    "symbol",
    "trade_id",
    "price",
    "size",
    "side",
    "ts_event",
    "ts_ingest",
)


def _trade_ok() -> Column:
    return (
        (F.col("event_type") == "trade")
        & (F.col("price") > 0)
        & (F.col("size") >= 0)
        & F.col("trade_id").isNotNull()
    )


def _ticker_ok() -> Column:
    return (
        (F.col("event_type") == "ticker")
        & F.col("best_bid").isNotNull()
        & F.col("best_ask").isNotNull()
        & (F.col("best_ask") >= F.col("best_bid"))
    )


def silver_trades_filter(bronze: DataFrame) -> DataFrame:
    """Trades with a positive price, a size and an id; prunes bronze to its trade folders."""
    return bronze.where(_trade_ok())


def dedup_trades(trades: DataFrame) -> DataFrame:
    """One row per (symbol, trade_id): the first by event time, ingest time, price, size.

    The exchange is not part of the key. Exchange and side only break remaining
    ties, so that reruns keep the same row. Asking for row number 1 lets Spark
    drop all but one row per key in each input partition before the shuffle, so
    a heavily repeated trade does not travel.
    """
    first = Window.partitionBy("symbol", "trade_id").orderBy(
        *[
            F.col(name).asc_nulls_last()
            for name in ("ts_event", "ts_ingest", "price", "size", "exchange", "side")
        ]
    )
    return trades.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def silver_trades(bronze: DataFrame) -> DataFrame:
    return dedup_trades(silver_trades_filter(bronze).select(*TRADE_COLUMNS))


def silver_ticker(bronze: DataFrame) -> DataFrame:
    """Quotes with both sides and no crossed book, with spread and mid; not deduplicated."""
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return bronze.where(_ticker_ok()).select(
        "exchange",
        "symbol",
        "best_bid",
        "best_ask",
        "best_bid_size",
        "best_ask_size",
        spread(bid, ask).alias("spread"),
        mid(bid, ask).alias("mid"),
        "ts_event",
        "ts_ingest",
    )


def silver_valid(bronze: DataFrame) -> DataFrame:
    """Rows that pass either silver filter, duplicates included."""
    return bronze.where(_trade_ok() | _ticker_ok())
