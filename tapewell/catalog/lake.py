"""Registered queries: landed tables, snapshots, streams and the whole run."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.catalog.base import (
    EVENT_SELECT,
    GOLD_BUILT_AT,
    GOLD_SELECT,
    GRACE,
    SIZES,
    SYMBOLS,
    WINDOW_SELECT,
    Query,
    arrived_events,
    gold,
    market_events,
    result,
    with_ctes,
)
from tapewell.catalog.feeds import LIVE_WINDOWS, numbered_feed
from tapewell.operators import analytics
from tapewell.operators.contract import apply_contract
from tapewell.operators.ordering import closed_windows_by_clock
from tapewell.operators.quality import parity_by_size, reconcile
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import gold_window_metrics
from tapewell.plans.marts import check_counts
from tapewell.plans.medallion import run_medallion
from tapewell.schemas import EVENT_COLUMNS
from tapewell.session import stage, streaming_session, work_dir
from tapewell.sinks.lake import (
    land_windows,
    record_emitter,
    start_bronze_sink,
    write_bronze,
    write_gold_csv,
    write_raw_messages,
)
from tapewell.sinks.topics import parse_window_records, window_records
from tapewell.sinks.versioned import gold_history, gold_snapshots, materialize_gold, read_gold
from tapewell.sources.lake import (
    read_bronze,
    read_gold_csv,
    read_windows,
    stream_bronze,
)
from tapewell.streaming.windows import (
    read_stream_output,
    run_stream,
    stream_landed_windows,
    stream_ticker_windows,
    stream_trade_windows,
    stream_windows,
    stream_windows_global,
)

GENERATION = 1  # makes snapshot ids repeatable: 2 for the first append, 3 for the second

# Ample for the state of the registered streams: a few windows of a few symbols.
STATE_PARTITIONS = 8


def _bronze(spark: SparkSession, sf: str) -> str:
    root = work_dir(spark, "bronze")
    write_bronze(arrived_events(spark, sf), root)
    return root


def _bronze_stream(spark: SparkSession, sf: str) -> DataFrame:
    return stream_bronze(streaming_session(spark, STATE_PARTITIONS), _bronze(spark, sf), 2**31 - 1)


def _gold_root(spark: SparkSession, sf: str) -> str:
    root = work_dir(spark, "gold")
    materialize_gold(gold(spark, sf), root, GENERATION)
    return root


def _bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return result(read_bronze(spark, _bronze(spark, sf)).select(*EVENT_COLUMNS))


def _bronze_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze copied by a stream: exactly the rows of the first table, by folder."""
    out = work_dir(spark, "bronze-stream")
    stream = _bronze_stream(spark, sf)
    start_bronze_sink(stream, f"{out}/bronze", f"{out}/checkpoint").awaitTermination()
    copied = read_bronze(spark, f"{out}/bronze")
    return result(
        copied.groupBy("event_type", "symbol").agg(
            F.count("*").alias("n"), F.max("ts_event").alias("newest")
        )
    )


def _reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Rows produced and rows landed per table; a difference stops the run."""
    events = market_events(spark, sf)
    split = apply_contract(events, SYMBOLS)
    out = None
    for name, part in (("valid", split.valid), ("quarantined", split.quarantined)):
        produced = part.count()
        landed = reconcile(write_bronze(part, work_dir(spark, name)), produced, name)
        one = spark.range(1).select(
            F.lit(name).alias("what"),
            F.lit(produced).cast("bigint").alias("produced"),
            F.lit(landed).cast("bigint").alias("landed"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def _gold_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return result(read_gold(spark, _gold_root(spark, sf)))


def _gold_first_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return result(read_gold(spark, _gold_root(spark, sf), snapshot_id=GENERATION * 2))


def _gold_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "gold-csv")
    write_gold_csv(gold(spark, sf), path)
    return result(read_gold_csv(spark, path))


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return gold_snapshots(spark, _gold_root(spark, sf)).select("snapshot_id", "seq", "rows")


def _gold_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Three rebuilds at once, of all gold and of the windows of two sizes: each is whole."""
    root, built = work_dir(spark, "gold"), stage(gold(spark, sf), "gold")
    parts = [built, *[built.where(F.col("window_size") == size) for size in ("1m", "5m")]]
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(lambda k: materialize_gold(parts[k], root, GENERATION + k), range(len(parts))))
    # Which one commits last is open.
    return gold_history(spark, root).select("generation", "snapshots", "rows")


def _time_travel(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.time_travel(spark, _gold_root(spark, sf))


def _windows_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "windows")
    land_windows(closed_windows_by_clock(arrived_events(spark, sf), SIZES, GRACE), root)
    return result(read_windows(spark, root))


# The registered streams take their input in as many micro-batches as there are slices.
SLICES = 3


def _streamed(
    spark: SparkSession, sf: str, build=stream_windows, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events landed slice by slice in order of arrival, each taken in by the same stream."""
    out = work_dir(spark, "stream")
    events = arrived_events(spark, sf)
    shares = [i / SLICES for i in range(1, SLICES)]
    cuts = events.approxQuantile("arrival_seq", shares, 0.01)
    number = F.when(F.lit(False), 0)
    for i, cut in enumerate(cuts):
        number = number.when(F.col("arrival_seq") < cut, i)
    sliced = events.withColumn("_slice", number.otherwise(len(cuts)))
    for i in range(SLICES):
        write_bronze(sliced.where(F.col("_slice") == i), f"{out}/in", clear=False)
        stream = stream_bronze(spark.newSession(), f"{out}/in")
        build(
            stream, f"{out}/rows", f"{out}/checkpoint", SIZES, GRACE, **options
        ).awaitTermination()
    return *read_stream_output(spark, f"{out}/rows"), read_bronze(spark, f"{out}/in")


def _emit_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Closed windows streamed out as JSON records, then parsed back."""
    out = work_dir(spark, "records")
    write = record_emitter(path=f"{out}/text")
    _streamed(spark, sf, emit=lambda closed, batch: write(window_records(closed), batch))
    lines = spark.read.schema("value string").text(f"{out}/text")
    bounds = [
        F.get_json_object("value", f"$.{name}").alias(f"{name}_text")
        for name in ("window_start", "window_end")
    ]
    return result(parse_window_records(lines, *bounds))


def _stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    return result(_streamed(spark, sf, stream_windows)[0])


def _landed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The windows of a landed table, streamed in order of arrival, some thousand rows at a time."""
    out = work_dir(spark, "landed")
    arrived = read_bronze(spark.newSession(), _bronze(spark, sf))
    rows = max(1000, arrived.count() // 4)
    stream_landed_windows(arrived, f"{out}/rows", f"{out}/checkpoint", SIZES, GRACE, rows)
    return result(read_stream_output(spark, f"{out}/rows")[0])


def _stream_trade_windows(spark: SparkSession, sf: str) -> DataFrame:
    return result(_streamed(spark, sf, stream_trade_windows)[0])


def _stream_ticker_windows(spark: SparkSession, sf: str) -> DataFrame:
    return result(_streamed(spark, sf, stream_ticker_windows)[0])


def _stream_late(spark: SparkSession, sf: str) -> DataFrame:
    return result(_streamed(spark, sf, stream_windows)[1])


def _stream_global(spark: SparkSession, sf: str) -> DataFrame:
    """Windows closed by the global watermark; all data is one micro-batch here, so nothing
    is late and every window closes that the newest event of all symbols has passed."""
    out = work_dir(spark, "global")
    windows = stream_windows_global(_bronze_stream(spark, sf), SIZES, f"{GRACE} seconds")
    run_stream(
        windows, f"{out}/rows", f"{out}/checkpoint", ("window_size", "source")
    ).awaitTermination()
    return result(read_windows(spark, f"{out}/rows"))


def _stream_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed windows against their batch definition: agreeing and disagreeing, per size."""
    streamed, _, bronze = _streamed(spark, sf)
    return parity_by_size(streamed, closed_windows_by_clock(bronze, SIZES, GRACE))


def _marts(spark: SparkSession, sf: str) -> DataFrame:
    """All mart checks over the marts of the driver events, with their numbers of offending rows."""
    events = market_events(spark, sf)
    trades = stage(silver_trades(events), "silver-trades")
    ticker = silver_ticker(events)
    built = stage(gold_window_metrics(trades, ticker, SIZES), "gold")
    return check_counts(trades, ticker, built, SIZES)


def _medallion(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run over messages made from the driver events.

    Zero-size trades leave windows without a VWAP, which the mart checks refuse; they
    are counted as violations here instead of stopping the run.
    """
    root = work_dir(spark, "run")
    write_raw_messages(numbered_feed(market_events(spark, sf)), f"{root}/raw")
    ingest, built = F.col("ts_recorded"), datetime.fromisoformat(GOLD_BUILT_AT + "+00:00")
    return result(
        run_medallion(spark, f"{root}/raw", root, ts_ingest=ingest, run_checks=False, built_at=built, rows_per_batch=20_000)
    )


# --- SQL ---

_CLOSED = f"SELECT {WINDOW_SELECT} FROM closed_by_clock"
_FIRST = "CASE WHEN window_size = '1m' THEN 2 ELSE 3 END"

_CHECK_SQL = {
    **{
        f"{table}.{name} not null": f"SELECT 1 FROM {table} WHERE {name} IS NULL"
        for table, names in {
            "silver_trades": ("trade_id", "symbol", "price"),
            "silver_ticker": ("symbol", "spread"),
            "gold": ("window_key", "symbol", "window_start", "window_size"),
        }.items()
        for name in names
    },
    "gold.window_key unique": "SELECT 1 FROM gold GROUP BY window_key HAVING count(*) > 1",
    "gold.window_size accepted": "SELECT 1 FROM gold WHERE window_size NOT IN "
    "(SELECT window_size FROM sizes) GROUP BY window_size",
    "silver_trades unique trade_id": "SELECT 1 FROM silver_trades GROUP BY symbol, trade_id "
    "HAVING count(*) > 1",
    "gold event_count": "SELECT 1 FROM gold WHERE event_count <> trade_count + ticker_count",
    "gold vwap positive": "SELECT 1 FROM gold WHERE trade_count > 0 "
    "AND (vwap IS NULL OR vwap <= 0)",
    "gold spread non negative": "SELECT 1 FROM gold WHERE ticker_count > 0 AND avg_spread < 0",
    "gold window span": "SELECT 1 FROM gold JOIN sizes USING (window_size) "
    "WHERE epoch_us(window_end) - epoch_us(window_start) <> secs * 1000000",
    "gold trade metrics recompute": "SELECT 1 FROM gold g JOIN trade_windows r "
    "USING (symbol, window_size, window_start) WHERE g.trade_count <> r.trade_count "
    "OR abs(g.trade_volume - r.trade_volume) > 1e-9 "
    "OR abs(coalesce(g.vwap, 0) - coalesce(r.vwap, 0)) > 1e-6",
}

# The whole run counted in SQL: what the feed yields, what it rejects, and the windows of both.
_RUN_SQL = LIVE_WINDOWS + """
, fed AS (SELECT *, CASE WHEN event_type = 'ticker' THEN 'ticker' ELSE 'trades' END AS source
  FROM market_events WHERE symbol IN ('BTC-USD', 'ETH-USD', 'SOL-USD')),
trades AS (SELECT * FROM fed WHERE event_type = 'trade' AND price > 0),
quotes AS (SELECT * FROM fed WHERE event_type = 'ticker' AND best_ask >= 0 AND best_ask >= best_bid),
accepted AS (SELECT symbol, event_type, source, trade_id, size, ts_event, ts_recorded FROM trades
    JOIN (SELECT event_id // 3 AS message, max(ts_ingest) AS ts_recorded FROM market_events
      WHERE event_type = 'trade' GROUP BY 1) ON event_id // 3 = message
  UNION ALL SELECT symbol, event_type, source, trade_id, size, ts_event, ts_ingest FROM quotes
    WHERE event_id % 11 <> 0
  UNION ALL SELECT symbol, event_type, source, CAST(event_id AS VARCHAR), size,
    date_trunc('milliseconds', ts_event), ts_ingest FROM trades
  UNION ALL SELECT symbol, event_type, source, trade_id, size, ts_ingest, ts_ingest FROM quotes),
kept AS (SELECT * FROM accepted WHERE event_type = 'ticker' UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_id
    ORDER BY ts_event) AS rn FROM accepted WHERE event_type = 'trade') WHERE rn = 1),
two AS (SELECT label AS window_size, CAST(width AS BIGINT) AS secs
  FROM (VALUES ('1m', 60), ('5m', 300)) AS v(label, width)),
produced AS (SELECT symbol, count(DISTINCT (window_size, epoch_us(ts_event) // (secs * 1000000)))
  AS n FROM kept, two GROUP BY symbol),
expected AS (SELECT symbol, count(DISTINCT (window_size, epoch_us(ts_event) // (secs * 1000000)))
  AS n FROM accepted, two GROUP BY symbol)
SELECT (SELECT count(*) FROM accepted) AS replayed_events,
  (SELECT count(*) FROM accepted) AS bronze_rows,
  (SELECT count(*) FROM live_closed_by_clock WHERE window_size IN ('1m', '5m')) AS window_rows,
  (SELECT CAST(sum(n) AS BIGINT) FROM produced) AS gold_rows,
  CAST(2 AS INT) AS gold_snapshots,
  2 * (SELECT count(*) FROM fed WHERE event_type = 'trade' AND (price IS NULL OR price <= 0))
  - (SELECT count(*) FROM fed WHERE event_type = 'trade' AND price IS NULL AND event_id % 3 = 0)
  + (SELECT count(*) FROM fed WHERE event_type = 'ticker' AND event_id % 11 <> 0
      AND (best_ask < 0 OR best_ask < best_bid))
  + (SELECT count(*) FROM fed WHERE event_type = 'ticker' AND (best_ask < 0 OR best_ask < best_bid))
  + (SELECT count(*) FROM market_events WHERE event_type = 'ticker' AND event_id % 11 = 0)
    AS quarantined,
  (SELECT round(quantile_cont((epoch_us(TIMESTAMP '""" + GOLD_BUILT_AT + """') - epoch_us(ts_recorded))
    / 1e6, 0.95), 3) FROM accepted) AS latency_p95_s,
  false AS sla_passed,
  (SELECT min(round(100.0 * p.n / e.n, 2)) FROM expected e JOIN produced p USING (symbol))
    AS completeness_pct,
  (SELECT count(*) FROM (SELECT 1 FROM kept, two WHERE event_type = 'trade'
    GROUP BY symbol, window_size, epoch_us(ts_event) // (secs * 1000000)
    HAVING sum(size) = 0)) AS gold_violations
"""

LAKE_QUERIES: dict[str, Query] = {
    "bronze_roundtrip": Query(
        _bronze_roundtrip,
        with_ctes("market_events", select=f"SELECT {EVENT_SELECT} FROM market_events"),
    ),
    "bronze_sink": Query(
        _bronze_sink,
        with_ctes(
            "market_events",
            select="SELECT event_type, symbol, count(*) AS n, max(ts_event) AS newest "
            "FROM market_events GROUP BY 1, 2",
        ),
    ),
    "reconcile": Query(
        _reconcile,
        with_ctes(
            "market_events",
            select="""
SELECT CASE WHEN bad THEN 'quarantined' ELSE 'valid' END AS what, count(*) AS produced,
  count(*) AS landed
FROM (SELECT coalesce(price <= 0, false) OR coalesce(size < 0, false)
    OR coalesce(best_bid < 0, false) OR coalesce(best_ask < 0, false)
    OR symbol NOT IN ('BTC-USD', 'ETH-USD', 'SOL-USD') OR event_type NOT IN ('trade', 'ticker')
    OR coalesce(best_ask < best_bid, false)
    OR (event_type = 'trade' AND (price IS NULL OR size IS NULL)) AS bad FROM market_events)
GROUP BY bad""",
        ),
    ),
    "gold_roundtrip": Query(
        _gold_roundtrip, with_ctes("gold", select=f"SELECT {GOLD_SELECT} FROM gold")
    ),
    "gold_first_snapshot": Query(
        _gold_first_snapshot,
        with_ctes("gold", select=f"SELECT {GOLD_SELECT} FROM gold WHERE window_size = '1m'"),
    ),
    "gold_csv_roundtrip": Query(
        _gold_csv, with_ctes("gold", select=f"SELECT {GOLD_SELECT} FROM gold")
    ),
    "gold_snapshots": Query(
        _snapshots,
        with_ctes(
            "gold",
            select=f"SELECT CAST({_FIRST} AS BIGINT) AS snapshot_id, CAST({_FIRST} - 2 AS BIGINT) "
            "AS seq, count(*) AS rows FROM gold GROUP BY 1, 2",
        ),
    ),
    "gold_writers": Query(
        _gold_writers,
        with_ctes(
            "gold",
            select="SELECT CAST(k AS BIGINT) AS generation, count(DISTINCT window_size = '1m') "
            "AS snapshots, count(*) AS rows FROM gold JOIN (VALUES (1, NULL), (2, '1m'), (3, '5m')) "
            "AS part(k, size) ON size IS NULL OR size = window_size GROUP BY k",
        ),
    ),
    "time_travel": Query(
        _time_travel,
        with_ctes(
            "gold",
            select="SELECT CAST(2 AS BIGINT) AS snapshots, count(*) AS current_rows, "
            "CAST(2 AS BIGINT) AS first_snapshot_id, count(*) FILTER (window_size = '1m') AS "
            "first_snapshot_rows FROM gold",
        ),
    ),
    "windows_roundtrip": Query(_windows_roundtrip, with_ctes("closed_by_clock", select=_CLOSED)),
    "emit_windows": Query(
        _emit_windows,
        with_ctes(
            "closed_by_clock",
            select=f"SELECT {WINDOW_SELECT}, "
            "strftime(window_start, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_start_text, "
            "strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_end_text "
            "FROM closed_by_clock",
        ),
    ),
    "landed_windows": Query(_landed_windows, with_ctes("closed_by_clock", select=_CLOSED)),
    "stream_windows": Query(_stream_windows, with_ctes("closed_by_clock", select=_CLOSED)),
    "stream_trade_windows": Query(
        _stream_trade_windows,
        with_ctes("closed_by_clock", select=_CLOSED + " WHERE source = 'trades'"),
    ),
    "stream_ticker_windows": Query(
        _stream_ticker_windows,
        with_ctes("closed_by_clock", select=_CLOSED + " WHERE source = 'ticker'"),
    ),
    "stream_late_records": Query(
        _stream_late,
        with_ctes(
            "late_flags",
            select="SELECT symbol, source, ts_event AS event_ts, window_size, window_start, "
            "window_end FROM late_flags WHERE late",
        ),
    ),
    "stream_windows_global": Query(
        _stream_global,
        with_ctes(
            "all_clock_windows",
            "clocked",
            select=f"SELECT {WINDOW_SELECT} FROM all_clock_windows WHERE window_end <= "
            f"(SELECT max(ts_event) FROM clocked) - to_seconds({GRACE})",
        ),
    ),
    "stream_parity": Query(
        _stream_parity,
        with_ctes(
            "closed_by_clock",
            select="SELECT window_size, count(DISTINCT (symbol, source, window_start)) AS matched, "
            "CAST(0 AS BIGINT) AS mismatches FROM closed_by_clock GROUP BY window_size",
        ),
    ),
    "mart_checks": Query(
        _marts,
        with_ctes(
            "silver_trades",
            "silver_ticker",
            "gold",
            "sizes",
            "trade_windows",
            select=" UNION ALL ".join(
                f"SELECT '{name}' AS check_name, count(*) AS violations FROM ({sql})"
                for name, sql in _CHECK_SQL.items()
            ),
        ),
    ),
    "medallion_run": Query(_medallion, with_ctes("market_events", select=_RUN_SQL)),
}
