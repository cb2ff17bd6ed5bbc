"""Bronze to silver to gold, with the table checks in between."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.functions.windows import WINDOW_SIZES
from tapewell.operators import quality
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import gold_window_metrics
from tapewell.session import stage
from tapewell.sinks.versioned import materialize_gold
from tapewell.sources.lake import read_bronze


@dataclass(frozen=True)
class MartsResult:
    gold_rows: int
    snapshot_1m: int | None
    snapshot_5m: int | None


def mart_checks(
    trades: DataFrame, ticker: DataFrame, gold: DataFrame, sizes: dict[str, int] = WINDOW_SIZES
) -> dict[str, DataFrame]:
    """Every check of the marts by name, each as its offending rows."""
    return {
        **{
            f"silver_trades.{name} not null": quality.check_not_null(trades, name)
            for name in ("trade_id", "symbol", "price")
        },
        **{
            f"silver_ticker.{name} not null": quality.check_not_null(ticker, name)
            for name in ("symbol", "spread")
        },
        **{
            f"gold.{name} not null": quality.check_not_null(gold, name)
            for name in ("window_key", "symbol", "window_start", "window_size")
        },
        "gold.window_key unique": quality.check_unique(gold, "window_key"),
        "gold.window_size accepted": quality.check_accepted_values(gold, "window_size", [*sizes]),
        "silver_trades unique trade_id": quality.check_unique_trade_id(trades),
        "gold event_count": quality.check_event_count(gold),
        "gold vwap positive": quality.check_vwap_positive(gold),
        "gold spread non negative": quality.check_spread_non_negative(gold),
        "gold window span": quality.check_window_span(gold, sizes),
        "gold trade metrics recompute": quality.check_trade_metrics_recompute(gold, trades, sizes),
    }


def check_counts(
    trades: DataFrame, ticker: DataFrame, gold: DataFrame, sizes: dict[str, int] = WINDOW_SIZES
) -> DataFrame:
    """Offending rows per check of :func:`mart_checks`: what rows break by themselves is
    counted in one pass over each table."""

    def missing(table: str, *names: str) -> dict:
        return {f"{table}.{n} not null": F.count_if(F.col(n).isNull()) for n in names}

    of_gold = {name: F.count_if(bad) for name, bad in quality.gold_row_checks(sizes).items()}
    foreign = F.when(~F.col("window_size").isin(*sizes), F.col("window_size"))
    of_gold["gold.window_size accepted"] = F.count_distinct(foreign)
    of_gold |= missing("gold", "window_key", "symbol", "window_start", "window_size")
    grouped = {
        "gold.window_key unique": quality.check_unique(gold, "window_key"),
        "silver_trades unique trade_id": quality.check_unique_trade_id(trades),
        "gold trade metrics recompute": quality.check_trade_metrics_recompute(gold, trades, sizes),
    }
    parts = [
        quality.count_in_one_pass(
            trades, missing("silver_trades", "trade_id", "symbol", "price")
        ),
        quality.count_in_one_pass(ticker, missing("silver_ticker", "symbol", "spread")),
        quality.count_in_one_pass(gold, of_gold),
        *[
            quality.count_in_one_pass(rows, {name: F.count(F.lit(1))})
            for name, rows in grouped.items()
        ],
    ]
    return reduce(DataFrame.unionByName, parts)


def failed_checks(counts: DataFrame) -> dict[str, int]:
    """Offending rows per failing check."""
    return dict(counts.where("violations > 0").collect())  # at most one row per check


def build_marts(
    spark: SparkSession,
    bronze_root: str,
    gold_root: str,
    sizes: dict[str, int] = WINDOW_SIZES,
    run_checks: bool = True,
    generation: int | None = None,
) -> MartsResult:
    """Build silver and gold from bronze; any failing check fails the build.

    Deduplicated trades and gold are written once each and read from there by the
    checks and by the snapshots, so the dedup shuffle runs a single time.
    """
    try:
        bronze = read_bronze(spark, bronze_root)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise RuntimeError(f"no bronze table under {bronze_root}") from exc
        raise
    if bronze.isEmpty():
        raise RuntimeError(f"no bronze rows under {bronze_root}")
    trades = stage(silver_trades(bronze), "silver-trades")
    ticker = silver_ticker(bronze)
    gold = stage(gold_window_metrics(trades, ticker, sizes), "gold")
    if run_checks:
        failed = failed_checks(check_counts(trades, ticker, gold, sizes))
        if failed:
            listed = ", ".join(f"{name} ({n})" for name, n in sorted(failed.items()))
            raise RuntimeError(f"mart checks failed: {listed}")
    first, second = materialize_gold(gold, gold_root, generation)
    return MartsResult(gold.count(), first, second)
