"""Service levels, table checks and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.functions.windows import (
    WINDOW_SIZES,
    base_width,
    size_seconds,
    window_start,
    with_window_sizes,
)
from tapewell.operators.quantile import exact_percentile
from tapewell.operators.silver import silver_valid
from tapewell.operators.windows import KEYS

# The three service levels.
LATENCY_TARGET_S = 60.0
COMPLETENESS_TARGET_PCT = 99.0
VIOLATIONS_TARGET = 0

LATENCY_SHARE = 0.95
RELATIVE_TOLERANCE = 1e-9


# --- service levels ---


def _timestamp(value: datetime | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def latency_seconds(bronze: DataFrame, gold_built_at: datetime | Column) -> float:
    """95th percentile of seconds from ingest to gold over all of bronze; 0 without rows.

    The slowest twentieth was ingested first, so this is the 5th percentile of the
    stored ingest time, seen from the time gold was built.
    """
    ingested = exact_percentile(bronze.select("ts_ingest"), "ts_ingest", 1 - LATENCY_SHARE)
    if ingested is None:
        return 0.0
    built = bronze.sparkSession.range(1).select(F.unix_micros(_timestamp(gold_built_at)))
    return (built.first()[0] - ingested) / 1e6


def latency_p95(bronze: DataFrame, gold_built_at: datetime | Column) -> DataFrame:
    """:func:`latency_seconds` as a one-row table, to three decimals."""
    seconds = latency_seconds(bronze, gold_built_at)
    return bronze.sparkSession.range(1).select(
        F.round(F.lit(float(seconds)), 3).alias("latency_p95_s")
    )


def expected_windows(bronze: DataFrame, sizes: dict[str, int] = WINDOW_SIZES) -> DataFrame:
    """Windows each symbol should have: those that hold rows fit for silver.

    Gaps in the data are not expected windows. Distinct base windows are found
    first, so only few rows are spread over the sizes.
    """
    base = window_start(F.col("ts_event"), base_width(sizes))
    seen = silver_valid(bronze).select("symbol", base.alias("_base")).distinct()
    return (
        with_window_sizes(seen, sizes, "_base")
        .select("symbol", "window_size", "window_start")
        .distinct()
        .groupBy("symbol")
        .agg(F.count("*").alias("expected"))
    )


def completeness(
    bronze: DataFrame, gold: DataFrame, sizes: dict[str, int] = WINDOW_SIZES
) -> DataFrame:
    """Expected and produced windows per symbol, and the share in percent.

    Symbols that only gold knows are left out.
    """
    produced = gold.groupBy("symbol").agg(F.count("*").alias("produced"))
    made = F.coalesce("produced", F.lit(0).cast("bigint"))
    return (
        expected_windows(bronze, sizes)
        .join(produced, "symbol", "left")
        .select(
            "symbol",
            "expected",
            made.alias("produced"),
            F.round(F.lit(100.0) * made / F.col("expected"), 2).alias("completeness_pct"),
        )
    )


def _bad_spread() -> Column:
    return (F.col("ticker_count") > 0) & (F.col("avg_spread") < 0)


def _bad_vwap() -> Column:
    return (F.col("trade_count") > 0) & (F.col("vwap").isNull() | (F.col("vwap") <= 0))


def _bad_count() -> Column:
    return F.col("event_count") != F.col("trade_count") + F.col("ticker_count")


def _breaks_invariant() -> Column:
    """Any invariant broken; a comparison with a missing value breaks none."""
    return (
        F.coalesce(_bad_spread(), F.lit(False))
        | F.coalesce(_bad_vwap(), F.lit(False))
        | F.coalesce(_bad_count(), F.lit(False))
    )


def gold_violations(gold: DataFrame) -> DataFrame:
    """One row with the number of gold rows breaking any invariant.

    A window whose trades all have size 0 has no VWAP and counts as a violation.
    """
    return gold.agg(F.count_if(_breaks_invariant()).alias("gold_violations"))


def sla_report(
    bronze: DataFrame,
    gold: DataFrame,
    gold_built_at: datetime | Column,
    sizes: dict[str, int] = WINDOW_SIZES,
) -> DataFrame:
    """One row with the measured service levels, their targets and the verdict.

    The completeness that counts is that of the worst symbol. The map holds one
    entry per symbol.
    """
    latency = round(latency_seconds(bronze, gold_built_at), 3)
    nothing = F.lit(None).cast("bigint")
    per_symbol = completeness(bronze, gold, sizes).select(
        "symbol", "expected", "completeness_pct", nothing.alias("rows"), nothing.alias("bad")
    )
    counts = gold.agg(
        F.count("*").alias("rows"),
        F.count_if(_breaks_invariant()).alias("bad"),
    ).select(
        F.lit(None).cast("string").alias("symbol"),
        nothing.alias("expected"),
        F.lit(None).cast("double").alias("completeness_pct"),
        "rows",
        "bad",
    )
    entry = F.when(
        F.col("symbol").isNotNull(), F.struct(F.col("symbol"), F.col("completeness_pct"))
    )
    measured = per_symbol.unionByName(counts).agg(
        F.lit(latency).alias("latency_p95_s"),
        F.lit(LATENCY_TARGET_S).alias("latency_target_s"),
        F.sum("rows").alias("windows_produced"),
        F.coalesce(F.sum("expected"), F.lit(0).cast("bigint")).alias("windows_expected"),
        F.coalesce(F.min("completeness_pct"), F.lit(100.0)).alias("completeness_pct"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("completeness_by_symbol"),
        F.lit(COMPLETENESS_TARGET_PCT).alias("completeness_target_pct"),
        F.sum("bad").alias("gold_violations"),
    )
    return with_verdict(measured)


def with_verdict(measured: DataFrame) -> DataFrame:
    """Compare measured levels with their targets: latency below, completeness at least,
    violations none."""
    return (
        measured.withColumn("latency_ok", F.col("latency_p95_s") < F.col("latency_target_s"))
        .withColumn(
            "completeness_ok", F.col("completeness_pct") >= F.col("completeness_target_pct")
        )
        .withColumn("violations_ok", F.col("gold_violations") == VIOLATIONS_TARGET)
        .withColumn("passed", F.expr("latency_ok AND completeness_ok AND violations_ok"))
    )


# --- table checks: each returns the offending rows, none means the check passes ---


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values found more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with how often they occur."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    )


def check_unique_trade_id(silver_trades: DataFrame) -> DataFrame:
    return (
        silver_trades.groupBy("symbol", "trade_id").agg(F.count("*").alias("n")).where("n > 1")
    )


def check_event_count(gold: DataFrame) -> DataFrame:
    return gold.where(_bad_count()).select(*KEYS, "event_count", "trade_count", "ticker_count")


def check_vwap_positive(gold: DataFrame) -> DataFrame:
    return gold.where(_bad_vwap()).select(*KEYS, "vwap", "trade_count")


def check_spread_non_negative(gold: DataFrame) -> DataFrame:
    return gold.where(_bad_spread()).select(*KEYS, "avg_spread", "ticker_count")


def _bad_span(sizes: dict[str, int]) -> Column:
    span = F.unix_seconds("window_end") - F.unix_seconds("window_start")
    return span != size_seconds(F.col("window_size"), sizes)


def gold_row_checks(sizes: dict[str, int] = WINDOW_SIZES) -> dict[str, Column]:
    """The checks of gold that a row breaks by itself."""
    return {
        "gold event_count": _bad_count(),
        "gold vwap positive": _bad_vwap(),
        "gold spread non negative": _bad_spread(),
        "gold window span": _bad_span(sizes),
    }


def count_in_one_pass(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """A row (``check_name``, ``violations``) for each aggregate, from one pass over ``df``."""
    names = [*counts]
    totals = df.agg(*[counts[name].alias(f"n{i}") for i, name in enumerate(names)])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"n{i}").alias("violations"))
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_window_span(gold: DataFrame, sizes: dict[str, int] = WINDOW_SIZES) -> DataFrame:
    return gold.where(_bad_span(sizes)).select(
        "symbol", "window_size", "window_start", "window_end"
    )


def check_trade_metrics_recompute(
    gold: DataFrame, silver_trades: DataFrame, sizes: dict[str, int] = WINDOW_SIZES
) -> DataFrame:
    """Gold windows whose trade metrics differ from a fresh computation out of silver.

    Trades are grouped by each size directly here, not by way of base windows. Large sums
    differ by their order alone, so the tolerance grows with the value.
    """
    again = (
        with_window_sizes(silver_trades.select("symbol", "ts_event", "price", "size"), sizes)
        .groupBy(*KEYS)
        .agg(
            F.sum(F.col("price") * F.col("size")).alias("r_value"),
            F.sum("size").alias("r_volume"),
            F.count("*").alias("r_count"),
        )
        .withColumn("r_vwap", F.col("r_value") / F.nullif("r_volume", F.lit(0.0)))
    )

    def apart(name: str, other: str, least: float) -> Column:
        a, b = F.coalesce(name, F.lit(0.0)), F.coalesce(other, F.lit(0.0))
        return F.abs(a - b) > F.greatest(F.lit(least), F.abs(b) * RELATIVE_TOLERANCE)

    differs = (
        (F.col("trade_count") != F.col("r_count"))
        | apart("trade_volume", "r_volume", 1e-9)
        | apart("vwap", "r_vwap", 1e-6)
    )
    return gold.join(again, KEYS).where(differs).select(*KEYS)


# --- reconciliation ---


def reconcile(landed: int, produced: int, what: str) -> int:
    """Fail the run when a table did not receive exactly what was produced for it."""
    if landed != produced:
        raise RuntimeError(f"{what} did not land whole: landed {landed} != produced {produced}")
    return landed


METRICS = ("vwap", "trade_volume", "avg_spread", "avg_mid")
COUNTS = ("trade_count", "ticker_count", "event_count")


def parity_by_size(
    streamed: DataFrame, batch: DataFrame, keys: Sequence[str] = (*KEYS, "source")
) -> DataFrame:
    """Per window size: windows on which two computations agree, and on which they do not."""
    keys = list(keys)
    problems = windows_parity(streamed, batch, keys)
    either = streamed.select(*keys).unionByName(batch.select(*keys)).distinct()
    return (
        either.join(problems, keys, "left")
        .groupBy("window_size")
        .agg(
            F.count_if(F.col("problem").isNull()).alias("matched"),
            F.count_if(F.col("problem").isNotNull()).alias("mismatches"),
        )
    )


def windows_parity(
    streamed: DataFrame, batch: DataFrame, keys: Sequence[str] = (*KEYS, "source")
) -> DataFrame:
    """Windows two computations disagree on, with the kind of disagreement.

    Keys must match one to one, counts exactly, and metrics up to a relative
    tolerance. No rows means the two agree.
    """
    keys = list(keys)
    columns = [*METRICS, *COUNTS]

    def reduced(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count("*").alias(f"{prefix}_rows"),
            *[F.max(c).alias(f"{prefix}_{c}") for c in columns],
        )

    both = reduced(streamed, "a").join(reduced(batch, "b"), keys, "full")

    def off(name: str) -> Column:
        a, b = F.col(f"a_{name}"), F.col(f"b_{name}")
        apart = F.abs(a - b) > RELATIVE_TOLERANCE * F.greatest(F.abs(a), F.abs(b))
        return F.when(a.isNull() | b.isNull(), ~a.eqNullSafe(b)).otherwise(apart)

    problem = (
        F.when(F.col("a_rows").isNull(), "only in batch")
        .when(F.col("b_rows").isNull(), "only in stream")
        .when((F.col("a_rows") > 1) | (F.col("b_rows") > 1), "duplicate key")
    )
    for name in COUNTS:
        problem = problem.when(~F.col(f"a_{name}").eqNullSafe(F.col(f"b_{name}")), name)
    for name in METRICS:
        problem = problem.when(off(name), name)
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull()).select(
        *keys, "problem"
    )
