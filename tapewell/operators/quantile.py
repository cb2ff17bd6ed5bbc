"""Exact percentile of a large integer or timestamp column.

Spark's exact ``percentile`` gathers every distinct value in one task, which does
not hold for a column of microseconds. Here the wanted rank is narrowed down: a
job counts rows in a fixed number of equal bins, the bin holding the rank becomes
the next range, and after a few rounds the range is a single value. No task and
no step ever sees more than ``bins`` counts. Later rounds only look at rows of the
range; on a stored table the range reaches the Parquet scan and skips row groups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1 << 14


def _as_number(df: DataFrame, column: str) -> Column:
    """The column as a whole number; microseconds since 1970 for timestamps."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_micros(column)
    return F.col(column).cast("bigint")


def _as_bound(df: DataFrame, column: str, number: int) -> Column:
    """A literal of the column's own type, so that comparing with it can be pushed down."""
    literal = F.lit(number).cast("bigint")
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.timestamp_micros(literal)
    return literal


def _value_at(df: DataFrame, column: str, rank: int, low: int, high: int, bins: int) -> int:
    """The value at ``rank`` (from 0) in ascending order, known to be in [low, high]."""
    while low < high:
        width = math.ceil((high - low + 1) / bins)
        in_range = F.col(column).between(
            _as_bound(df, column, low), _as_bound(df, column, high)
        )
        offset = _as_number(df, column) - F.lit(low).cast("bigint")
        counted = (
            df.where(in_range)
            .select(offset.alias("offset"))
            .groupBy(F.expr(f"offset div {width}L").alias("bin"))
            .agg(F.count("*").alias("n"))
        )
        upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        hit = (
            counted.withColumn("upto", F.sum("n").over(upto))
            .where(F.col("upto") > rank)
            .agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("before")), "bin"))
            .first()[0]
        )
        rank -= hit["before"]
        low, high = low + hit["bin"] * width, min(high, low + (hit["bin"] + 1) * width - 1)
    return low


def value_at_rank(df: DataFrame, column: str, rank: int, bins: int = BINS) -> int | None:
    """The value at ``rank`` (from 0) in ascending order; None if there are not that many."""
    value = _as_number(df, column)
    n, low, high = df.agg(F.count(value), F.min(value), F.max(value)).first()
    return _value_at(df, column, rank, low, high, bins) if rank < n else None


def exact_percentile(df: DataFrame, column: str, share: float, bins: int = BINS) -> float | None:
    """Percentile with linear interpolation between neighbours; None for no rows."""
    value = _as_number(df, column)
    n, low, high = df.agg(F.count(value), F.min(value), F.max(value)).first()
    if not n:
        return None
    position = share * (n - 1)
    rank = math.floor(position)
    at = _value_at(df, column, rank, low, high, bins)
    fraction = position - rank
    if fraction == 0 or at == high:
        return float(at)
    upto, following = df.agg(
        F.count_if(value <= at), F.min(F.when(value > at, value))
    ).first()
    nxt = at if upto > rank + 1 else following
    return at + (nxt - at) * fraction
