"""Epoch-aligned tumbling windows as integer arithmetic on timestamps."""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.functions.columns import once

# The window sizes of the gold mart, in seconds.
WINDOW_SIZES = {"1m": 60, "5m": 300}


def window_start(ts: Column, seconds: int | Column) -> Column:
    """Start of the half-open window ``[start, start + seconds)`` that holds ``ts``.

    Rounds down, also before 1970. Stays inside whole-stage codegen, and unlike
    ``F.window`` any number of sizes can be used in one query.
    """
    width = F.lit(seconds).cast("bigint") if isinstance(seconds, int) else seconds
    epoch = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, width))


def add_seconds(ts: Column, seconds: int | Column) -> Column:
    """``ts`` shifted by whole seconds; the fraction of ``ts`` is kept."""
    width = F.lit(seconds).cast("bigint") if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + width * F.lit(1_000_000))


def window_bounds(ts: Column, seconds: int) -> tuple[Column, Column]:
    start = window_start(ts, seconds)
    return start, add_seconds(start, seconds)


def base_width(sizes: dict[str, int]) -> int:
    """Widest width whose windows nest in the windows of every size."""
    return reduce(gcd, sizes.values())


def size_seconds(label: Column, sizes: dict[str, int]) -> Column:
    """Width in seconds of a window-size label; null for an unknown label."""
    return F.coalesce(*[F.when(label == name, F.lit(secs)) for name, secs in sizes.items()]).cast(
        "bigint"
    )


@once
def _sized(sizes: tuple[tuple[str, int], ...], ts: str) -> tuple[Column, dict[str, Column]]:
    choices = F.array(
        *[
            F.struct(F.lit(name).alias("label"), F.lit(secs).cast("bigint").alias("secs"))
            for name, secs in sizes
        ]
    )
    start = window_start(F.col(ts), F.col("_size.secs"))
    bounds = {"window_start": start, "window_end": add_seconds(start, F.col("_size.secs"))}
    return F.explode(choices), {"window_size": F.col("_size.label"), **bounds}


def with_window_sizes(
    df: DataFrame, sizes: dict[str, int] = WINDOW_SIZES, ts: str = "ts_event"
) -> DataFrame:
    """Every row once per size, with ``window_size``, ``window_start``, ``window_end``.

    One scan and one ``explode`` of a literal array, not one scan per size.
    """
    choice, columns = _sized(tuple(sizes.items()), ts)
    return df.withColumn("_size", choice).withColumns(columns).drop("_size")


def window_key(symbol: Column, size: Column, start: Column) -> Column:
    """``symbol|size|epoch seconds``: text that does not depend on the session zone."""
    return F.concat_ws("|", symbol, size, F.unix_seconds(start).cast("string"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with an explicit ``+00:00`` offset, fraction only if there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    has_fraction = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0
    return F.when(has_fraction, exact).otherwise(whole)
