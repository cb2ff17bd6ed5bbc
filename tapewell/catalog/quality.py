"""Registered queries: contract, service levels, checks and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.catalog.base import (
    GOLD_BUILT_AT,
    SIZES,
    START,
    SYMBOL_LIST,
    SYMBOLS,
    Query,
    count_rows,
    gold,
    market_events,
    result,
    with_ctes,
)
from tapewell.operators import quality
from tapewell.operators.contract import (
    apply_contract,
    coerce_event_frame,
    contract_report,
    tag_contract,
)
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import join_windows, ticker_windows, trade_windows

def _built() -> Column:
    return F.lit(GOLD_BUILT_AT).cast("timestamp")


def _contract_split(spark: SparkSession, sf: str) -> DataFrame:
    split = apply_contract(market_events(spark, sf), SYMBOLS)
    valid = split.valid.select("event_id", F.lit("valid").alias("side_of_split"))
    bad = split.quarantined.select("event_id", F.lit("quarantined").alias("side_of_split"))
    return valid.unionByName(bad)


def _contract_reasons(spark: SparkSession, sf: str) -> DataFrame:
    quarantined = apply_contract(market_events(spark, sf), SYMBOLS).quarantined
    return quarantined.select("event_id", "symbol", "event_type", "quarantine_reason")


def _contract_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag_contract(market_events(spark, sf), SYMBOLS)
    return tagged.groupBy(
        F.coalesce("quarantine_reason", F.lit("none")).alias("quarantine_reason")
    ).agg(F.count("*").alias("n"))


def _contract_report(spark: SparkSession, sf: str) -> DataFrame:
    report = contract_report(market_events(spark, sf), SYMBOLS)
    return report.withColumn("reasons", F.array_join("reasons", "; "))


def _coerce_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers given as text, some of it garbage, and book sizes not given at all."""
    events = market_events(spark, sf)
    garbled = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(
        F.col("price").cast("string")
    )
    loose = events.select(
        "event_id",
        garbled.alias("price"),
        F.col("size").cast("string").alias("size"),
        F.concat(
            F.date_format("ts_event", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("123Z")
        ).alias("ts_event"),
    )
    typed = coerce_event_frame(loose)
    names = ("event_id", "price", "size", "best_bid", "best_ask_size", "ts_event")
    return result(typed.select(*names))


def _latency(spark: SparkSession, sf: str) -> DataFrame:
    return quality.latency_p95(market_events(spark, sf), _built())


def _completeness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.completeness(market_events(spark, sf), gold(spark, sf), SIZES)


def _sla(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.sla_report(market_events(spark, sf), gold(spark, sf), _built(), SIZES)
    worst = F.array_min(F.map_values("completeness_by_symbol"))
    return report.withColumn("symbols", F.size("completeness_by_symbol")).withColumn(
        "worst_in_map", worst
    ).drop("completeness_by_symbol")


def _check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    events = market_events(spark, sf)
    names = ("exchange", "symbol", "price", "trade_id", "best_bid")
    parts = [count_rows(quality.check_not_null(events, name), name) for name in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _check_unique(spark: SparkSession, sf: str) -> DataFrame:
    on_gold = count_rows(quality.check_unique(gold(spark, sf), "window_key"), "window_key")
    trades = market_events(spark, sf)
    return on_gold.unionByName(count_rows(quality.check_unique(trades, "trade_id"), "trade_id"))


def _check_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_accepted_values(
        market_events(spark, sf), "event_type", ["trade", "ticker"]
    )


def _check_recompute(spark: SparkSession, sf: str) -> DataFrame:
    trades = silver_trades(market_events(spark, sf))
    return count_rows(
        quality.check_trade_metrics_recompute(gold(spark, sf), trades, SIZES), "recompute"
    )


def _check_unique_trade_id(spark: SparkSession, sf: str) -> DataFrame:
    events = market_events(spark, sf)
    raw = events.where("event_type = 'trade' AND trade_id IS NOT NULL")
    before = count_rows(quality.check_unique_trade_id(raw), "before_dedup")
    after = count_rows(quality.check_unique_trade_id(silver_trades(events)), "after_dedup")
    return before.unionByName(after)


def _on_gold(check):
    name = check.__name__
    return lambda spark, sf: count_rows(check(gold(spark, sf)), name)


def _check_window_span(spark: SparkSession, sf: str) -> DataFrame:
    return count_rows(quality.check_window_span(gold(spark, sf), SIZES), "check_window_span")


def _windows_parity(spark: SparkSession, sf: str) -> DataFrame:
    """The mart against a join of its two sides, computed separately: they must agree."""
    events = market_events(spark, sf)
    separate = join_windows(
        trade_windows(silver_trades(events), SIZES), ticker_windows(silver_ticker(events), SIZES)
    ).withColumn("event_count", F.col("trade_count") + F.col("ticker_count"))
    keys = ("symbol", "window_size", "window_start")
    return quality.parity_by_size(gold(spark, sf), separate, keys)


_ISIN_SYMBOLS = f"isin([{SYMBOL_LIST}])".replace("'", "''")
_ISIN_TYPES = "isin([''trade'', ''ticker''])"

_RULES = {
    "greater_than(0)": "price <= 0",
    "greater_than_or_equal_to(0)": "size < 0 OR best_bid < 0 OR best_ask < 0",
    _ISIN_SYMBOLS: f"symbol NOT IN ({SYMBOL_LIST})",
    _ISIN_TYPES: "event_type NOT IN ('trade', 'ticker')",
    "spread_non_negative": "best_ask < best_bid",
    "trade_has_price_and_size": "event_type = 'trade' AND (price IS NULL OR size IS NULL)",
}
_BROKEN = " || ".join(
    f"CASE WHEN {broken} THEN ['{name}'] ELSE CAST([] AS VARCHAR[]) END"
    for name, broken in _RULES.items()
)
_TAGGED = f"(SELECT *, list_sort({_BROKEN}) AS broken FROM market_events)"

_GOLD = "gold"

_EXPECTED = (
    "(SELECT symbol, count(*) AS expected FROM (SELECT DISTINCT symbol, window_size, "
    f"{START} FROM silver_valid, sizes) GROUP BY symbol)"
)
_COMPLETE = (
    "(SELECT symbol, expected, coalesce(produced, 0) AS produced, "
    "round(100.0 * coalesce(produced, 0) / expected, 2) AS completeness_pct "
    f"FROM {_EXPECTED} LEFT JOIN (SELECT symbol, count(*) AS produced FROM {_GOLD} "
    "GROUP BY symbol) USING (symbol))"
)
_LATENCY = (
    f"(SELECT round(quantile_cont((epoch_us(TIMESTAMP '{GOLD_BUILT_AT}') - epoch_us(ts_ingest)) "
    "/ 1e6, 0.95), 3) AS latency_p95_s FROM market_events)"
)
_BAD_GOLD = (
    "(ticker_count > 0 AND avg_spread < 0) OR (trade_count > 0 AND (vwap IS NULL OR vwap <= 0)) "
    "OR event_count <> trade_count + ticker_count"
)


def _count_sql(name: str, condition: str) -> str:
    return with_ctes(
        "gold",
        select=f"SELECT '{name}' AS check_name, count(*) AS violations FROM gold WHERE {condition}",
    )


QUALITY_QUERIES: dict[str, Query] = {
    "contract_split": Query(
        _contract_split,
        with_ctes(
            "market_events",
            select="SELECT event_id, CASE WHEN len(broken) = 0 THEN 'valid' ELSE 'quarantined' "
            f"END AS side_of_split FROM {_TAGGED}",
        ),
    ),
    "contract_reasons": Query(
        _contract_reasons,
        with_ctes(
            "market_events",
            select="SELECT event_id, symbol, event_type, array_to_string(broken, ', ') AS "
            f"quarantine_reason FROM {_TAGGED} WHERE len(broken) > 0",
        ),
    ),
    "contract_rules": Query(
        _contract_rule_counts,
        with_ctes(
            "market_events",
            select="SELECT CASE WHEN len(broken) = 0 THEN 'none' ELSE array_to_string(broken, "
            f"', ') END AS quarantine_reason, count(*) AS n FROM {_TAGGED} GROUP BY 1",
        ),
    ),
    "contract_report": Query(
        _contract_report,
        with_ctes(
            "market_events",
            select="SELECT count(*) FILTER (len(broken) = 0) AS n_valid, count(*) FILTER "
            "(len(broken) > 0) AS n_quarantined, count(*) FILTER (len(broken) > 0) = 0 AS ok, "
            "array_to_string(list_sort(list_distinct(flatten(list(broken)))), '; ') AS reasons "
            f"FROM {_TAGGED}",
        ),
    ),
    "coerce_frame": Query(
        _coerce_frame,
        with_ctes(
            "market_events",
            select="SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN price END AS price, size, "
            "CAST(NULL AS DOUBLE) AS best_bid, CAST(NULL AS DOUBLE) AS best_ask_size, ts_event "
            "FROM market_events",
        ),
    ),
    "latency_p95": Query(
        _latency, with_ctes("market_events", select=f"SELECT * FROM {_LATENCY}")
    ),
    "expected_windows": Query(
        lambda spark, sf: quality.expected_windows(market_events(spark, sf), SIZES),
        with_ctes("silver_valid", "sizes", select=f"SELECT * FROM {_EXPECTED}"),
    ),
    "completeness": Query(
        _completeness,
        with_ctes("silver_valid", "sizes", "gold", select=f"SELECT * FROM {_COMPLETE}"),
    ),
    "gold_violations": Query(
        lambda spark, sf: quality.gold_violations(gold(spark, sf)),
        with_ctes("gold", select=f"SELECT count(*) AS gold_violations FROM gold WHERE {_BAD_GOLD}"),
    ),
    "sla_report": Query(
        _sla,
        with_ctes(
            "silver_valid",
            "sizes",
            "gold",
            select="""
SELECT *, latency_p95_s < latency_target_s AS latency_ok,
  completeness_pct >= completeness_target_pct AS completeness_ok,
  gold_violations = 0 AS violations_ok,
  latency_p95_s < latency_target_s AND completeness_pct >= completeness_target_pct
    AND gold_violations = 0 AS passed
FROM (SELECT (SELECT latency_p95_s FROM """
            + _LATENCY
            + """) AS latency_p95_s, CAST(60 AS DOUBLE) AS latency_target_s,
  (SELECT count(*) FROM """
            + _GOLD
            + """) AS windows_produced, CAST(sum(expected) AS BIGINT) AS windows_expected,
  min(completeness_pct) AS completeness_pct, CAST(99 AS DOUBLE) AS completeness_target_pct,
  (SELECT count(*) FROM """
            + _GOLD
            + f" WHERE {_BAD_GOLD}) AS gold_violations, CAST(count(*) AS INT) AS symbols, "
            + "min(completeness_pct) AS worst_in_map FROM "
            + _COMPLETE
            + ")",
        ),
    ),
    "check_not_null": Query(
        _check_not_null,
        with_ctes(
            "market_events",
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS check_name, count(*) AS violations FROM market_events "
                f"WHERE {c} IS NULL"
                for c in ("exchange", "symbol", "price", "trade_id", "best_bid")
            ),
        ),
    ),
    "check_unique": Query(
        _check_unique,
        with_ctes(
            "gold",
            "market_events",
            select="SELECT 'window_key' AS check_name, count(*) AS violations FROM (SELECT "
            "window_key FROM gold GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'trade_id', "
            "count(*) FROM (SELECT trade_id FROM market_events WHERE trade_id IS NOT NULL "
            "GROUP BY 1 HAVING count(*) > 1)",
        ),
    ),
    "check_accepted_values": Query(
        _check_accepted,
        with_ctes(
            "market_events",
            select="SELECT event_type, count(*) AS n FROM market_events WHERE event_type NOT IN "
            "('trade', 'ticker') GROUP BY 1",
        ),
    ),
    "check_unique_trade_id": Query(
        _check_unique_trade_id,
        with_ctes(
            "market_events",
            "silver_trades",
            select="SELECT 'before_dedup' AS check_name, count(*) AS violations FROM (SELECT 1 "
            "FROM market_events WHERE event_type = 'trade' AND trade_id IS NOT NULL GROUP BY "
            "symbol, trade_id HAVING count(*) > 1) UNION ALL SELECT 'after_dedup', count(*) FROM "
            "(SELECT 1 FROM silver_trades GROUP BY symbol, trade_id HAVING count(*) > 1)",
        ),
    ),
    "check_event_count": Query(
        _on_gold(quality.check_event_count),
        _count_sql("check_event_count", "event_count <> trade_count + ticker_count"),
    ),
    "check_vwap_positive": Query(
        _on_gold(quality.check_vwap_positive),
        _count_sql("check_vwap_positive", "trade_count > 0 AND (vwap IS NULL OR vwap <= 0)"),
    ),
    "check_spread_non_negative": Query(
        _on_gold(quality.check_spread_non_negative),
        _count_sql("check_spread_non_negative", "ticker_count > 0 AND avg_spread < 0"),
    ),
    "check_window_span": Query(
        _check_window_span,
        with_ctes(
            "gold",
            "sizes",
            select="SELECT 'check_window_span' AS check_name, count(*) AS violations FROM gold "
            "JOIN sizes USING (window_size) WHERE epoch_us(window_end) - epoch_us(window_start) "
            "<> secs * 1000000",
        ),
    ),
    "check_recompute": Query(
        _check_recompute,
        with_ctes(
            "gold",
            "trade_windows",
            select="SELECT 'recompute' AS check_name, count(*) AS violations FROM gold g JOIN "
            "trade_windows r USING (symbol, window_size, window_start) WHERE g.trade_count <> "
            "r.trade_count OR abs(g.trade_volume - r.trade_volume) > 1e-9 OR "
            "abs(coalesce(g.vwap, 0) - coalesce(r.vwap, 0)) > 1e-6",
        ),
    ),
    "windows_parity": Query(
        _windows_parity,
        with_ctes(
            "gold",
            "joined_windows",
            select="SELECT window_size, count(*) FILTER (same) AS matched, "
            "count(*) FILTER (NOT same) AS mismatches FROM (SELECT window_size, "
            "g.trade_count IS NOT DISTINCT FROM j.trade_count "
            "AND g.ticker_count IS NOT DISTINCT FROM j.ticker_count "
            "AND abs(coalesce(g.vwap, 0) - coalesce(j.vwap, 0)) < 1e-6 AS same FROM gold g "
            "FULL OUTER JOIN joined_windows j USING (symbol, window_size, window_start)) "
            "GROUP BY window_size",
        ),
    ),
}
