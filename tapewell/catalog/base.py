"""Driver tables as market events, and the pieces the registered queries share.

``events`` is mapped to trades, quotes and a few odd records by one SQL text that
Spark and DuckDB both run, so each query and its SQL start from the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewell.config import DEFAULT_SYMBOLS
from tapewell.functions.windows import WINDOW_SIZES
from tapewell.operators.ordering import with_arrival_seq
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import gold_window_metrics
from tapewell.schemas import EVENT_COLUMNS
from tapewell.session import ensure_session

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A Spark query over the driver tables and the SQL that must give the same rows."""

    run: Run
    sql: str | None = None


# Events are minutes apart, so hours and days are aggregated as well as the gold sizes.
SIZES = {**WINDOW_SIZES, "1h": 3600, "1d": 86400}
SYMBOLS = DEFAULT_SYMBOLS
GOLD_BUILT_AT = "2024-02-01 00:00:00"
GRACE = 5

# Metrics are compared to this many decimals. Averages of two-decimal prices often end exactly
# halfway between two of them, where the last bit of a sum would decide; both sides therefore
# move values off the halfway points by the same hair before rounding.
DIGITS = 9
HAIR = 1e-11

_ADAPTER = """
SELECT 'coinbase' AS exchange,
  CASE WHEN user_id % 10 < 4 THEN 'BTC-USD' WHEN user_id % 10 < 7 THEN 'ETH-USD'
       WHEN user_id % 10 < 9 THEN 'SOL-USD' ELSE 'DOGE-USD' END AS symbol,
  CASE WHEN event_type IN ('view', 'signup') THEN 'ticker'
       WHEN event_type = 'error' AND k >= 90 THEN 'heartbeat' ELSE 'trade' END AS event_type,
  CASE WHEN event_type IN ('purchase', 'click') THEN value
       WHEN event_type = 'error' AND k < 50 THEN -value END AS price,
  CASE WHEN event_type IN ('purchase', 'click', 'error') THEN CAST(k AS DOUBLE) END AS size,
  CASE WHEN event_type IN ('view', 'signup') THEN NULL
       WHEN k % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
  CASE WHEN event_type IN ('purchase', 'click')
       THEN concat('t', CAST(CAST(floor(event_id / 4) AS BIGINT) AS {string})) END AS trade_id,
  CASE WHEN event_type IN ('view', 'signup') THEN value END AS best_bid,
  CASE WHEN event_type IN ('view', 'signup')
       THEN value + (k - 5) / CAST(100 AS DOUBLE) END AS best_ask,
  CAST(NULL AS DOUBLE) AS best_bid_size, CAST(NULL AS DOUBLE) AS best_ask_size,
  ts AS ts_event, ts + k * INTERVAL '1' MINUTE AS ts_ingest, event_id
FROM (SELECT *, CAST({json} AS INT) AS k FROM {table})
"""


def _spark_adapter(events: DataFrame) -> DataFrame:
    sql = _ADAPTER.format(
        string="STRING", json="get_json_object(props, '$.k')", table="{events}"
    )
    mapped = events.sparkSession.sql(sql, events=events)
    return mapped.withColumns(
        {name: F.col(name).cast("timestamp") for name in ("ts_event", "ts_ingest")}
    )


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All driver events as market events, with their ``event_id``."""
    ensure_session(spark)
    return _spark_adapter(spark.read.parquet(f"{sf_dir}/events.parquet"))


# Order of arrival in the driver tables; the id breaks ties.
ARRIVAL_ORDER = ["ts_ingest", "event_id"]


def arrived_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Market events numbered by order of arrival."""
    return with_arrival_seq(market_events(spark, sf_dir), ARRIVAL_ORDER).select(
        *EVENT_COLUMNS, *extra, "arrival_seq"
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = market_events(spark, sf_dir)
    return gold_window_metrics(silver_trades(events), silver_ticker(events), SIZES)


def result(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles and drop the time zone, as the SQL side does."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column + F.lit(HAIR), digits)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def count_rows(df: DataFrame, check: str) -> DataFrame:
    """A check as one row (name, offending rows), so that passing is a result too."""
    return df.agg(F.count("*").alias("violations")).select(
        F.lit(check).alias("check_name"), "violations"
    )


# --- the same steps as DuckDB SQL ---

SYMBOL_LIST = ", ".join(f"'{s}'" for s in SYMBOLS)
_SIZE_ROWS = ", ".join(f"('{label}', {secs})" for label, secs in SIZES.items())
START = "make_timestamp((epoch_us(ts_event) // (secs * 1000000)) * (secs * 1000000))"

_CLOCK_WINDOWS = """
SELECT symbol, source, window_size, window_start, window_end,
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
      FROM late_flags WHERE {kept})
GROUP BY ALL"""

CTES = {
    "market_events": _ADAPTER.format(
        string="VARCHAR", json="json_extract_string(props, '$.k')", table="events"
    ),
    "sizes": f"SELECT label AS window_size, CAST(width AS BIGINT) AS secs "
    f"FROM (VALUES {_SIZE_ROWS}) AS v(label, width)",
    "silver_trades": """
SELECT exchange, symbol, trade_id, price, size, side, ts_event, ts_ingest
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_id
        ORDER BY ts_event, ts_ingest, price, size, exchange, side) AS rn
      FROM market_events
      WHERE event_type = 'trade' AND price > 0 AND size >= 0 AND trade_id IS NOT NULL)
WHERE rn = 1""",
    "silver_ticker": """
SELECT exchange, symbol, best_bid, best_ask, best_bid_size, best_ask_size,
  best_ask - best_bid AS spread, (best_ask + best_bid) / 2.0 AS mid, ts_event, ts_ingest
FROM market_events
WHERE event_type = 'ticker' AND best_bid IS NOT NULL AND best_ask IS NOT NULL
  AND best_ask >= best_bid""",
    "silver_valid": """
SELECT * FROM market_events
WHERE (event_type = 'trade' AND price > 0 AND size >= 0 AND trade_id IS NOT NULL)
   OR (event_type = 'ticker' AND best_bid IS NOT NULL AND best_ask IS NOT NULL
       AND best_ask >= best_bid)""",
    "trade_windows": f"""
SELECT symbol, window_size, {START} AS window_start,
  sum(price * size) / nullif(sum(size), 0) AS vwap, sum(size) AS trade_volume,
  count(*) AS trade_count
FROM silver_trades, sizes GROUP BY 1, 2, 3""",
    "ticker_windows": f"""
SELECT symbol, window_size, {START} AS window_start,
  avg(spread) AS avg_spread, avg(mid) AS avg_mid, count(*) AS ticker_count
FROM silver_ticker, sizes GROUP BY 1, 2, 3""",
    "joined_windows": """
SELECT symbol, window_size, window_start, vwap, coalesce(trade_volume, 0) AS trade_volume,
  coalesce(trade_count, 0) AS trade_count, avg_spread, avg_mid,
  coalesce(ticker_count, 0) AS ticker_count
FROM trade_windows FULL OUTER JOIN ticker_windows USING (symbol, window_size, window_start)""",
    "gold": """
SELECT j.symbol, j.window_size, window_start, window_start + to_seconds(secs) AS window_end,
  vwap, trade_volume, trade_count, avg_spread, avg_mid, ticker_count,
  trade_count + ticker_count AS event_count,
  j.symbol || '|' || j.window_size || '|' || CAST(epoch_us(window_start) // 1000000 AS VARCHAR)
    AS window_key
FROM joined_windows j JOIN sizes USING (window_size)""",
    "clocked": """
SELECT *, max(ts_event) OVER (PARTITION BY symbol, source ORDER BY ts_ingest, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max
FROM (SELECT * REPLACE (date_trunc('milliseconds', ts_event) AS ts_event),
        CASE WHEN event_type = 'ticker' THEN 'ticker' ELSE 'trades' END AS source
      FROM market_events)""",
    "late_flags": f"""
SELECT c.*, window_size, {START} AS window_start,
  {START} + to_seconds(secs) AS window_end,
  coalesce(prior_max >= {START} + to_seconds(secs + {GRACE}), false) AS late
FROM clocked c, sizes""",
    "clock_windows": _CLOCK_WINDOWS.format(kept="NOT late"),
    "all_clock_windows": _CLOCK_WINDOWS.format(kept="true"),
    "closed_by_clock": f"""
SELECT w.* FROM clock_windows w
JOIN (SELECT symbol, source, max(ts_event) AS watermark FROM clocked GROUP BY ALL)
  USING (symbol, source)
WHERE watermark >= window_end + to_seconds({GRACE})""",
}


def with_ctes(*names: str, select: str) -> str:
    """``select`` after the named steps and everything they build on.

    A ``select`` that starts with a comma adds steps of its own.
    """
    wanted = set(names)
    for name in reversed(list(CTES)):  # steps only build on earlier ones
        if name in wanted:
            words = set(re.findall(r"\w+", CTES[name]))
            wanted |= words & CTES.keys() - {name}
    steps = [f"{name} AS ({sql.strip()})" for name, sql in CTES.items() if name in wanted]
    return "WITH " + ",\n".join(steps) + "\n" + select.strip()


def rounded(*columns: str, digits: int = DIGITS) -> str:
    return ", ".join(f"round({c} + {HAIR}, {digits}) AS {c}" for c in columns)


GOLD_SELECT = (
    "symbol, window_size, window_start, window_end, "
    + rounded("vwap", "trade_volume")
    + ", trade_count, "
    + rounded("avg_spread", "avg_mid")
    + ", ticker_count, event_count, window_key"
)

WINDOW_SELECT = (
    "symbol, window_size, window_start, window_end, source, "
    + rounded("vwap", "trade_volume")
    + ", trade_count, "
    + rounded("avg_spread", "avg_mid")
    + ", ticker_count, event_count"
)
EVENT_SELECT = (
    "exchange, symbol, event_type, "
    + rounded("price", "size")
    + ", side, trade_id, "
    + rounded("best_bid", "best_ask", "best_bid_size", "best_ask_size")
    + ", ts_event, ts_ingest"
)
