"""First-line contract of one event, as a column holding the reason it is refused."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields that may be zero but not negative, in the order they are tested.
NON_NEGATIVE = ("size", "best_bid", "best_ask", "best_bid_size", "best_ask_size")


def crossed_book(bid: Column, ask: Column) -> Column:
    """Both sides present and the ask below the bid; a locked book is fine."""
    return ~F.isnan(bid) & (ask < bid)


def ingest_check(fields: dict[str, Column]) -> Column:
    """Reason the event breaks the contract, first failure wins; null when it is valid.

    ``fields`` maps price, size and the four book fields to their columns; a field
    left out is absent from that kind of event.
    """
    rules: list[Column] = []
    if "price" in fields:
        price = fields["price"]
        rules.append(
            F.when(price <= 0, F.concat(F.lit("price must be > 0, got "), price.cast("string")))
        )
    for name in NON_NEGATIVE:
        if name in fields:
            value = fields[name]
            text = F.concat(F.lit(f"{name} must be >= 0, got "), value.cast("string"))
            rules.append(F.when(value < 0, text))
    if "best_bid" in fields and "best_ask" in fields:
        bid, ask = fields["best_bid"], fields["best_ask"]
        text = F.concat(
            F.lit("crossed book: best_ask ("),
            ask.cast("string"),
            F.lit(") < best_bid ("),
            bid.cast("string"),
            F.lit(")"),
        )
        rules.append(F.when(crossed_book(bid, ask), text))
    return F.coalesce(*rules)
