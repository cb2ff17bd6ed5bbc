"""Windowed metrics per symbol.

All sums here are first taken per base window (the widest window that nests in
every requested size) and only those few rows are rolled up to the sizes. Both
steps combine on the map side, so a symbol with a large share of all rows ships
one partial row per window and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.functions.columns import once
from tapewell.functions.parsing import mid, spread
from tapewell.functions.windows import (
    WINDOW_SIZES,
    add_seconds,
    base_width,
    size_seconds,
    window_key,
    window_start,
    with_window_sizes,
)

KEYS = ["symbol", "window_size", "window_start"]

# Sums every metric is made from.
EVENT_SUMS = ["_pv", "trade_volume", "trade_count", "_spread", "_mid", "ticker_count"]


def _windowed_sums(
    df: DataFrame, sums: list[str], sizes: dict[str, int], by: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    """Sums of the named columns per ``by``, window size and window."""
    base = window_start(F.col("ts_event"), base_width(sizes))
    per_base = df.groupBy(*by, base.alias("_base")).agg(*[F.sum(c).alias(c) for c in sums])
    return (
        with_window_sizes(per_base, sizes, "_base")
        .groupBy(*by, "window_size", "window_start")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def _window_end(sizes: dict[str, int]) -> Column:
    return add_seconds(F.col("window_start"), size_seconds(F.col("window_size"), sizes))


def _ratio(total: str, weight: str) -> Column:
    """``total / weight``, null for a zero weight."""
    return F.col(total) / F.nullif(F.col(weight), F.lit(0).cast("double"))


def _mean(total: str, count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _trade_terms(trades: DataFrame) -> DataFrame:
    return trades.select(
        "symbol",
        "ts_event",
        (F.col("price") * F.col("size")).alias("_pv"),
        F.col("size").alias("trade_volume"),
        _one().alias("trade_count"),
    )


def _ticker_terms(tickers: DataFrame) -> DataFrame:
    return tickers.select(
        "symbol",
        "ts_event",
        F.col("spread").alias("_spread"),
        F.col("mid").alias("_mid"),
        _one().alias("ticker_count"),
    )


def trade_windows(silver_trades: DataFrame, sizes: dict[str, int] = WINDOW_SIZES) -> DataFrame:
    """VWAP, volume and count of trades per symbol, size and window."""
    sums = _windowed_sums(
        _trade_terms(silver_trades), ["_pv", "trade_volume", "trade_count"], sizes
    )
    return sums.select(*KEYS, _ratio("_pv", "trade_volume").alias("vwap"), *sums.columns[-2:])


def ticker_windows(silver_ticker: DataFrame, sizes: dict[str, int] = WINDOW_SIZES) -> DataFrame:
    """Mean spread, mean mid and count of quotes per symbol, size and window."""
    sums = _windowed_sums(
        _ticker_terms(silver_ticker), ["_spread", "_mid", "ticker_count"], sizes
    )
    return sums.select(
        *KEYS,
        _mean("_spread", "ticker_count").alias("avg_spread"),
        _mean("_mid", "ticker_count").alias("avg_mid"),
        "ticker_count",
    )


def join_windows(trades: DataFrame, tickers: DataFrame) -> DataFrame:
    """Full outer join of trade and ticker windows; missing volumes and counts are 0."""
    return trades.join(tickers, KEYS, "full").select(
        *KEYS,
        "vwap",
        F.coalesce("trade_volume", F.lit(0.0)).alias("trade_volume"),
        F.coalesce("trade_count", _zero()).alias("trade_count"),
        "avg_spread",
        "avg_mid",
        F.coalesce("ticker_count", _zero()).alias("ticker_count"),
    )


def gold_window_metrics(
    silver_trades: DataFrame, silver_ticker: DataFrame, sizes: dict[str, int] = WINDOW_SIZES
) -> DataFrame:
    """The gold mart: one row per symbol, size and window seen by either side.

    Same rows as :func:`join_windows` of the two sides, but both sides go through
    one aggregation, so there is neither a join nor a second shuffle of the input.
    """
    terms = _trade_terms(silver_trades).unionByName(
        _ticker_terms(silver_ticker), allowMissingColumns=True
    )
    sums = _windowed_sums(terms, EVENT_SUMS, sizes)
    trades, tickers = (
        F.coalesce(F.col(name), _zero()) for name in ("trade_count", "ticker_count")
    )
    return sums.select(
        "symbol",
        "window_size",
        "window_start",
        _window_end(sizes).alias("window_end"),
        _ratio("_pv", "trade_volume").alias("vwap"),
        F.coalesce("trade_volume", F.lit(0.0)).alias("trade_volume"),
        trades.alias("trade_count"),
        _mean("_spread", "ticker_count").alias("avg_spread"),
        _mean("_mid", "ticker_count").alias("avg_mid"),
        tickers.alias("ticker_count"),
        (trades + tickers).alias("event_count"),
        window_key(F.col("symbol"), F.col("window_size"), F.col("window_start")).alias(
            "window_key"
        ),
    )


@once
def _event_terms(keep: tuple[str, ...]) -> list[Column]:
    price, size = F.col("price"), F.col("size")
    bid, ask = F.col("best_bid"), F.col("best_ask")
    is_trade = (F.col("event_type") == "trade") & price.isNotNull() & size.isNotNull()
    is_quote = (F.col("event_type") == "ticker") & bid.isNotNull() & ask.isNotNull()
    return [
        *[F.col(name) for name in ("symbol", *keep, "ts_event")],
        F.when(is_trade, price * size).alias("_pv"),
        F.when(is_trade, size).alias("trade_volume"),
        F.when(is_trade, _one()).alias("trade_count"),
        F.when(is_quote, spread(bid, ask)).alias("_spread"),
        F.when(is_quote, mid(bid, ask)).alias("_mid"),
        F.when(is_quote, _one()).alias("ticker_count"),
    ]


def event_terms(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Terms of raw events; an event that qualifies for neither side has none."""
    return events.select(_event_terms(keep))


def event_windows(
    events: DataFrame, sizes: dict[str, int] = WINDOW_SIZES, by_source: bool = False
) -> DataFrame:
    """Windowed metrics of raw events: no dedup, no trade id needed.

    A window that only saw unusable events is still there, with zeros and nulls.
    With ``by_source`` trades and tickers are kept in windows of their own.
    """
    by: tuple[str, ...] = ("symbol",)
    if by_source:
        events = events.withColumn("source", source_of(F.col("event_type")))
        by = ("symbol", "source")
    sums = _windowed_sums(event_terms(events, by[1:]), EVENT_SUMS, sizes, by)
    ended = sums.withColumn("window_end", _window_end(sizes))
    return metrics_of_sums(ended, by[1:])


@once
def _metrics(keep: tuple[str, ...]) -> list[Column]:
    trades, tickers = (
        F.coalesce(F.col(name), _zero()) for name in ("trade_count", "ticker_count")
    )
    return [
        *[F.col(name) for name in ("symbol", "window_size", "window_start", "window_end", *keep)],
        F.when(F.col("trade_volume") > 0, F.col("_pv") / F.col("trade_volume")).alias("vwap"),
        F.coalesce("trade_volume", F.lit(0.0)).alias("trade_volume"),
        trades.alias("trade_count"),
        _mean("_spread", "ticker_count").alias("avg_spread"),
        _mean("_mid", "ticker_count").alias("avg_mid"),
        tickers.alias("ticker_count"),
        (trades + tickers).alias("event_count"),
    ]


def metrics_of_sums(sums: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Window metrics from the sums of :data:`EVENT_SUMS`."""
    return sums.select(_metrics(keep))


def compute_windows(events: DataFrame, seconds: int, label: str) -> DataFrame:
    """:func:`event_windows` of one size, sorted by symbol and window."""
    return event_windows(events, {label: seconds}).orderBy("symbol", "window_start")


def source_of(event_type: Column) -> Column:
    """Stream an event belongs to: ticker events apart, everything else with the trades."""
    return F.when(event_type == "ticker", "ticker").otherwise("trades")


def max_event_ts_by_symbol(events: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Latest event time per symbol: how far that symbol's own clock has come."""
    return events.groupBy(*by).agg(F.max("ts_event").alias("watermark"))


def closed_windows(
    metrics: DataFrame,
    watermarks: DataFrame,
    grace_seconds: int = 0,
    by: tuple[str, ...] = ("symbol",),
) -> DataFrame:
    """Windows whose symbol's clock reached ``window_end + grace``, the end included.

    A symbol without a clock has no closed window. Trades and tickers keep
    separate clocks; pass ``by=("symbol", "source")`` for that.
    """
    closes_at = add_seconds(F.col("window_end"), grace_seconds)
    return (
        metrics.join(watermarks, list(by))
        .where(F.col("watermark") >= closes_at)
        .select(*metrics.columns)
    )
