"""The data contract: named row predicates, and the split they lead to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.functions.parsing import parse_ts, strict_double
from tapewell.schemas import FLOAT_COLUMNS

REQUIRED = ("exchange", "symbol", "event_type", "ts_event", "ts_ingest")
EVENT_TYPES = ("trade", "ticker")
NON_NEGATIVE = ("size", "best_bid", "best_ask", "best_bid_size", "best_ask_size")


@dataclass(frozen=True)
class ContractSplit:
    """Rows that keep the contract, and rows that break it with their reason."""

    valid: DataFrame
    quarantined: DataFrame


def _number(name: str) -> Column:
    """A numeric column with NaN counted as missing."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def _passes(condition: Column) -> Column:
    """A value check a missing value passes."""
    return F.coalesce(condition, F.lit(True))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _isin_name(values: Sequence[str]) -> str:
    return f"isin({[str(v) for v in values]})"


def spread_non_negative() -> Column:
    return _passes(_number("best_ask") >= _number("best_bid"))


def trade_has_price_and_size() -> Column:
    is_trade = F.coalesce(F.col("event_type") == "trade", F.lit(False))
    return ~is_trade | (_number("price").isNotNull() & _number("size").isNotNull())


def contract_rules(symbols: Sequence[str]) -> dict[str, Column]:
    """Rule name to a condition that is true for rows keeping it, never null.

    Names are those the quarantine reason is built from; one name covers every
    column it applies to.
    """
    return {
        "not_nullable": _all([F.col(name).isNotNull() for name in REQUIRED]),
        _isin_name(symbols): _passes(F.col("symbol").isin(*symbols)),
        _isin_name(EVENT_TYPES): _passes(F.col("event_type").isin(*EVENT_TYPES)),
        "greater_than(0)": _passes(_number("price") > 0),
        "greater_than_or_equal_to(0)": _all([_passes(_number(n) >= 0) for n in NON_NEGATIVE]),
        "spread_non_negative": spread_non_negative(),
        "trade_has_price_and_size": trade_has_price_and_size(),
    }


def _keeps_all(rules: dict[str, Column]) -> Column:
    return _all(list(rules.values()))


def _reason(rules: dict[str, Column]) -> Column:
    """Names of the broken rules in sorted order; ``concat_ws`` leaves out the others."""
    broken = [F.when(~keeps, F.lit(name)) for name, keeps in sorted(rules.items())]
    return F.concat_ws(", ", *broken)


def tag_contract(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Add ``quarantine_reason``: every broken rule's name, sorted; null if none is broken."""
    rules = contract_rules(symbols)
    return df.withColumn("quarantine_reason", F.when(~_keeps_all(rules), _reason(rules)))


def apply_contract(df: DataFrame, symbols: Sequence[str]) -> ContractSplit:
    """Test every rule on every row and split the rows; extra columns are allowed.

    Reasons are only put together for the rows that need one.
    """
    rules = contract_rules(symbols)
    keeps = _keeps_all(rules)
    return ContractSplit(
        valid=df.where(keeps),
        quarantined=df.where(~keeps).withColumn("quarantine_reason", _reason(rules)),
    )


def contract_report(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """One row: n_valid, n_quarantined, ok and the sorted names of rules broken anywhere."""
    rules = sorted(contract_rules(symbols).items())
    keeps_all = _keeps_all(dict(rules))
    counts = df.agg(
        F.count_if(keeps_all).alias("n_valid"),
        F.count_if(~keeps_all).alias("n_quarantined"),
        *[F.count_if(~keeps).alias(f"_rule{i}") for i, (_, keeps) in enumerate(rules)],
    )
    hit = [F.when(F.col(f"_rule{i}") > 0, F.lit(name)) for i, (name, _) in enumerate(rules)]
    return counts.select(
        "n_valid",
        "n_quarantined",
        (F.col("n_quarantined") == 0).alias("ok"),
        F.array_compact(F.array(*hit)).alias("reasons"),
    )


def coerce_event_frame(df: DataFrame) -> DataFrame:
    """Bring a loosely typed frame to the types the contract tests.

    Missing numeric columns are added as null, text that is not a number becomes
    null, and timestamps given as text are read as UTC.
    """
    types = dict(df.dtypes)
    out = df
    for name in FLOAT_COLUMNS:
        if name not in types:
            column = F.lit(None).cast("double")
        elif types[name] == "string":
            column = strict_double(F.col(name))
        else:
            column = F.col(name).try_cast("double")
        out = out.withColumn(name, column)
    for name in ("ts_event", "ts_ingest"):
        if types.get(name) == "string":
            out = out.withColumn(name, parse_ts(F.col(name)))
        elif name in types:
            out = out.withColumn(name, F.col(name).cast("timestamp"))
    return out
