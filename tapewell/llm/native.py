"""Helpers for operators made of Spark expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often and deep ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def small(df: DataFrame, most: int) -> bool:
    """Whether ``df`` has at most ``most`` rows; reads no more than that."""
    return df.limit(most + 1).count() <= most


def sent_if_small(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked to be sent to all tasks if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if small(df, most) else df.hint("merge")
