"""Column helpers that turn exchange text into typed values.

Each returns null for input it cannot read; callers decide whether that null is
a missing optional value or a reason to reject the record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates and times as exchanges write them: a full date, optionally a time with a
# fraction of any length, optionally a zone. Keeps out forms only Spark's cast reads.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
)

# Java accepts a trailing type letter (1d, 2f) and hexadecimal; feeds never mean those.
JAVA_ONLY_NUMBER = r"[xX]|[0-9.][dDfF]$"


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to a UTC timestamp; fractions beyond microseconds are cut off.

    Text without a zone is read in the session zone, which the library pins to UTC.
    """
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_TIMESTAMP), trimmed.try_cast("timestamp"))


def ts_from_millis(millis: Column) -> Column:
    """Epoch milliseconds, as a number or as digits, to a UTC timestamp."""
    return F.timestamp_millis(millis.try_cast("bigint"))


def strict_double(text: Column) -> Column:
    """Decimal text to double, or null when it is not a number.

    For an optional field, null is only an error where :func:`is_given` holds.
    """
    trimmed = F.trim(text)
    # Empty text is sorted out first: failing to parse a number is slow.
    usable = (trimmed != "") & ~trimmed.rlike(JAVA_ONLY_NUMBER)
    return F.when(usable, trimmed.try_cast("double"))


def is_given(text: Column) -> Column:
    """True for an optional field that carries a value: neither null nor empty."""
    return text.isNotNull() & (text != "")


def finite(value: Column) -> Column:
    """NaN and infinities become null: the JSON an event travels in has neither."""
    usable = ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(usable, value)


def aggressor_side(side: Column) -> Column:
    """``BUY``/``SELL`` in any case to buy/sell; anything else is unknown (null)."""
    upper = F.upper(side)
    return F.when(upper == "BUY", "buy").when(upper == "SELL", "sell")


def side_from_maker(buyer_is_maker: Column) -> Column:
    """A buyer who was the maker means the aggressor sold; missing counts as false."""
    falsy = buyer_is_maker.isNull() | buyer_is_maker.isin("false", "0", "")
    return F.when(falsy, "buy").otherwise("sell")


def coinbase_trade_id(value: Column) -> Column:
    """Empty or zero ids count as absent."""
    return F.when(is_given(value) & (value != "0"), value)


def binance_trade_id(value: Column) -> Column:
    """Only a null id is absent; ``0`` is an id."""
    return value.cast("string")


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def mid(bid: Column, ask: Column) -> Column:
    return (ask + bid) / F.lit(2.0)
