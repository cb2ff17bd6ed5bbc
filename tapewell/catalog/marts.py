"""Registered queries: silver, windows, gold and the analytics over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.catalog.base import (
    GOLD_SELECT,
    GRACE,
    SIZES,
    START,
    Query,
    arrived_events,
    gold,
    market_events,
    result,
    rounded,
    with_ctes,
)
from tapewell.functions.windows import WINDOW_SIZES, window_bounds, window_key, with_window_sizes
from tapewell.operators import analytics
from tapewell.operators.ordering import closed_windows_by_clock, count_out_of_order, late_records
from tapewell.operators.silver import (
    dedup_trades,
    silver_ticker,
    silver_trades,
    silver_trades_filter,
    silver_valid,
)
from tapewell.operators.windows import (
    closed_windows,
    compute_windows,
    event_windows,
    join_windows,
    max_event_ts_by_symbol,
    ticker_windows,
    trade_windows,
)
from tapewell.session import work_dir
from tapewell.sinks.versioned import materialize_gold


def _trades(spark: SparkSession, sf: str) -> DataFrame:
    return silver_trades(market_events(spark, sf))


def _ticker(spark: SparkSession, sf: str) -> DataFrame:
    return silver_ticker(market_events(spark, sf))


def _silver_trades(spark: SparkSession, sf: str) -> DataFrame:
    return result(_trades(spark, sf))


def _silver_trades_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver_trades_filter(market_events(spark, sf))
    return result(kept.select("event_id", "symbol", "trade_id", "price", "size", "ts_event"))


def _dedup_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Copies per trade before the dedup, next to the row the dedup kept."""
    trades = silver_trades_filter(market_events(spark, sf))
    kept = dedup_trades(trades)
    return result(kept.select("symbol", "trade_id", "price", "size", "side", "event_id"))


def _silver_ticker(spark: SparkSession, sf: str) -> DataFrame:
    return result(_ticker(spark, sf))


def _silver_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid = silver_valid(market_events(spark, sf))
    return result(valid.select("event_id", "symbol", "event_type", "price", "best_bid"))


def _window_bounds(spark: SparkSession, sf: str) -> DataFrame:
    events = market_events(spark, sf)
    for label, seconds in WINDOW_SIZES.items():
        start, end = window_bounds(F.col("ts_event"), seconds)
        events = events.withColumns({f"start_{label}": start, f"end_{label}": end})
    names = [f"{side}_{label}" for label in WINDOW_SIZES for side in ("start", "end")]
    return result(events.select("event_id", "ts_event", *names))


def _window_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sized = with_window_sizes(market_events(spark, sf), SIZES)
    counted = sized.groupBy("window_size", "symbol", "window_start").agg(F.count("*").alias("n"))
    return result(counted)


def _join_windows(spark: SparkSession, sf: str) -> DataFrame:
    return result(
        join_windows(
            trade_windows(_trades(spark, sf), SIZES), ticker_windows(_ticker(spark, sf), SIZES)
        )
    )


def _window_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = gold(spark, sf)
    key = window_key(F.col("symbol"), F.col("window_size"), F.col("window_start"))
    return keyed.select(key.alias("window_key"), "event_count")


def _compute_windows(spark: SparkSession, sf: str) -> DataFrame:
    return result(compute_windows(market_events(spark, sf), 3600, "1h"))


def _closed_windows(spark: SparkSession, sf: str) -> DataFrame:
    events = market_events(spark, sf)
    metrics = event_windows(events, SIZES)
    return result(closed_windows(metrics, max_event_ts_by_symbol(events), GRACE))


def _closed_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return result(closed_windows_by_clock(arrived_events(spark, sf), SIZES, GRACE))


def _late_flags(spark: SparkSession, sf: str) -> DataFrame:
    return result(late_records(arrived_events(spark, sf), SIZES, GRACE))


def _out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    return count_out_of_order(arrived_events(spark, sf))


def _gold_sql(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "gold")
    materialize_gold(gold(spark, sf), root)
    sql = """
        SELECT symbol, window_size, count(*) AS windows, sum(event_count) AS events,
               max(window_end) AS last_end
        FROM gold GROUP BY symbol, window_size"""
    return result(analytics.query_gold(spark, root, sql))


# Raw-event windows of one or all sizes; `tr` and `qu` mark rows usable by either side.
_EVENT_WINDOWS = """
SELECT symbol, window_size, {start} AS window_start,
  {start} + to_seconds(secs) AS window_end,
  CASE WHEN sum(CASE WHEN tr THEN size END) > 0
    THEN sum(CASE WHEN tr THEN price * size END) / sum(CASE WHEN tr THEN size END) END AS vwap,
  coalesce(sum(CASE WHEN tr THEN size END), 0) AS trade_volume,
  count(CASE WHEN tr THEN 1 END) AS trade_count,
  avg(CASE WHEN qu THEN best_ask - best_bid END) AS avg_spread,
  avg(CASE WHEN qu THEN (best_ask + best_bid) / 2.0 END) AS avg_mid,
  count(CASE WHEN qu THEN 1 END) AS ticker_count,
  count(CASE WHEN tr OR qu THEN 1 END) AS event_count
FROM (SELECT *, event_type = 'trade' AND price IS NOT NULL AND size IS NOT NULL AS tr,
        event_type = 'ticker' AND best_bid IS NOT NULL AND best_ask IS NOT NULL AS qu
      FROM market_events), sizes
GROUP BY 1, 2, 3, 4
""".replace("{start}", START)

_METRICS = GOLD_SELECT.removesuffix(", window_key")

_US = "make_timestamp((epoch_us(ts_event) // {w}) * {w})"
_M1, _M5 = _US.format(w=60_000_000), _US.format(w=300_000_000)

MART_QUERIES: dict[str, Query] = {
    "silver_trades": Query(
        _silver_trades,
        with_ctes(
            "silver_trades",
            select="SELECT exchange, symbol, trade_id, "
            + rounded("price", "size")
            + ", side, ts_event, ts_ingest FROM silver_trades",
        ),
    ),
    "silver_trades_filter": Query(
        _silver_trades_filter,
        with_ctes(
            "market_events",
            select="SELECT event_id, symbol, trade_id, "
            + rounded("price", "size")
            + ", ts_event FROM market_events WHERE event_type = 'trade' "
            "AND price > 0 AND size >= 0 AND trade_id IS NOT NULL",
        ),
    ),
    "dedup_trades": Query(
        _dedup_trades,
        with_ctes(
            "market_events",
            select="SELECT symbol, trade_id, " + rounded("price", "size") + ", "
            "side, event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_id "
            "ORDER BY ts_event, ts_ingest, price, size, exchange, side) AS rn FROM market_events "
            "WHERE event_type = 'trade' AND price > 0 AND size >= 0 AND trade_id IS NOT NULL) "
            "WHERE rn = 1",
        ),
    ),
    "silver_ticker": Query(
        _silver_ticker,
        with_ctes(
            "silver_ticker",
            select="SELECT exchange, symbol, "
            + rounded(
                "best_bid", "best_ask", "best_bid_size", "best_ask_size", "spread", "mid"
            )
            + ", ts_event, ts_ingest FROM silver_ticker",
        ),
    ),
    "silver_valid": Query(
        _silver_valid,
        with_ctes(
            "silver_valid",
            select="SELECT event_id, symbol, event_type, "
            + rounded("price", "best_bid")
            + " FROM silver_valid",
        ),
    ),
    "window_bounds": Query(
        _window_bounds,
        with_ctes(
            "market_events",
            select=f"SELECT event_id, ts_event, {_M1} AS start_1m, "
            f"{_M1} + INTERVAL 60 SECOND AS end_1m, {_M5} AS start_5m, "
            f"{_M5} + INTERVAL 300 SECOND AS end_5m FROM market_events",
        ),
    ),
    "window_sizes": Query(
        _window_sizes,
        with_ctes(
            "market_events",
            "sizes",
            select=f"SELECT window_size, symbol, {START} AS window_start, count(*) AS n "
            "FROM market_events, sizes GROUP BY 1, 2, 3",
        ),
    ),
    "trade_windows": Query(
        lambda spark, sf: result(trade_windows(_trades(spark, sf), SIZES)),
        with_ctes(
            "trade_windows",
            select="SELECT symbol, window_size, window_start, "
            + rounded("vwap", "trade_volume")
            + ", trade_count FROM trade_windows",
        ),
    ),
    "ticker_windows": Query(
        lambda spark, sf: result(ticker_windows(_ticker(spark, sf), SIZES)),
        with_ctes(
            "ticker_windows",
            select="SELECT symbol, window_size, window_start, "
            + rounded("avg_spread", "avg_mid")
            + ", ticker_count FROM ticker_windows",
        ),
    ),
    "join_windows": Query(
        _join_windows,
        with_ctes(
            "joined_windows",
            select="SELECT symbol, window_size, window_start, "
            + rounded("vwap", "trade_volume")
            + ", trade_count, "
            + rounded("avg_spread", "avg_mid")
            + ", ticker_count FROM joined_windows",
        ),
    ),
    "gold_window_metrics": Query(
        lambda spark, sf: result(gold(spark, sf)),
        with_ctes("gold", select=f"SELECT {GOLD_SELECT} FROM gold"),
    ),
    "window_key": Query(
        _window_key, with_ctes("gold", select="SELECT window_key, event_count FROM gold")
    ),
    "compute_windows": Query(
        _compute_windows,
        with_ctes(
            "market_events",
            "sizes",
            select=f"SELECT {_METRICS} FROM ({_EVENT_WINDOWS}) WHERE window_size = '1h'",
        ),
    ),
    "max_event_ts": Query(
        lambda spark, sf: result(max_event_ts_by_symbol(market_events(spark, sf))),
        with_ctes(
            "market_events",
            select="SELECT symbol, max(ts_event) AS watermark FROM market_events GROUP BY symbol",
        ),
    ),
    "closed_windows": Query(
        _closed_windows,
        with_ctes(
            "market_events",
            "sizes",
            select=f"SELECT {_METRICS} FROM ({_EVENT_WINDOWS}) JOIN (SELECT symbol, "
            "max(ts_event) AS watermark FROM market_events GROUP BY symbol) USING (symbol) "
            f"WHERE watermark >= window_end + to_seconds({GRACE})",
        ),
    ),
    "closed_windows_by_clock": Query(
        _closed_by_source,
        with_ctes(
            "closed_by_clock",
            select="SELECT source, " + _METRICS + " FROM closed_by_clock",
        ),
    ),
    "late_flags": Query(
        _late_flags,
        with_ctes(
            "late_flags",
            select="SELECT symbol, source, ts_event AS event_ts, window_size, window_start, "
            "window_end FROM late_flags WHERE late",
        ),
    ),
    "out_of_order": Query(
        _out_of_order,
        with_ctes(
            "market_events",
            select="SELECT count(*) AS out_of_order FROM (SELECT ts_event, max(ts_event) OVER "
            "(PARTITION BY symbol ORDER BY ts_ingest, event_id ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND 1 PRECEDING) AS m FROM market_events) WHERE ts_event < m",
        ),
    ),
    "vwap_moving_average": Query(
        lambda spark, sf: result(analytics.vwap_moving_average(gold(spark, sf))),
        with_ctes(
            "gold",
            select="SELECT symbol, window_start, " + rounded("vwap") + ", round(avg(vwap) OVER "
            "(PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT "
            "ROW) + 1e-11, 9) AS vwap_ma3, " + rounded("trade_volume") + ", trade_count FROM gold "
            "WHERE window_size = '1m' AND trade_count > 0",
        ),
    ),
    "symbol_summary": Query(
        lambda spark, sf: result(analytics.symbol_summary(gold(spark, sf))),
        with_ctes(
            "gold",
            select="SELECT symbol, count(*) AS windows, round(sum(trade_volume) + 1e-11, 9) AS "
            "total_volume, round(avg(avg_spread), 6) AS mean_spread FROM gold "
            "WHERE window_size = '1m' GROUP BY symbol",
        ),
    ),
    "latest_per_symbol": Query(
        lambda spark, sf: result(analytics.latest_per_symbol(gold(spark, sf))),
        with_ctes(
            "gold",
            select=f"SELECT {GOLD_SELECT} FROM (SELECT *, row_number() OVER (PARTITION BY symbol "
            "ORDER BY window_start DESC) AS rn FROM gold WHERE window_size = '1m') WHERE rn = 1",
        ),
    ),
    "trade_series": Query(
        lambda spark, sf: result(analytics.trade_series(gold(spark, sf))),
        with_ctes(
            "gold",
            select="SELECT symbol, window_start, "
            + rounded("vwap", "trade_volume")
            + " FROM gold WHERE window_size = '1m' AND trade_count > 0",
        ),
    ),
    "spread_series": Query(
        lambda spark, sf: result(analytics.spread_series(gold(spark, sf))),
        with_ctes(
            "gold",
            select="SELECT symbol, window_start, " + rounded("avg_spread") + " FROM gold "
            "WHERE window_size = '1m' AND ticker_count > 0",
        ),
    ),
    "gold_sql": Query(
        _gold_sql,
        with_ctes(
            "gold",
            select="SELECT symbol, window_size, count(*) AS windows, CAST(sum(event_count) AS "
            "BIGINT) AS events, max(window_end) AS last_end FROM gold GROUP BY 1, 2",
        ),
    ),
}
