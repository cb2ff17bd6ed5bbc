"""Questions about order of arrival: out-of-order and late records.

Whether a record is late depends on everything that arrived before it for the
same key. A plain running maximum would put all rows of a key into one task, and
one symbol can hold a third of all rows. So rows are cut into blocks of
consecutive arrivals by ranges of the arrival number: the maximum of each block is
a small table, its running maximum is what a block starts from, and the rest is
worked out inside the block. Rows are shuffled once, by (key, block).

A block spans ``block_span`` arrival numbers: with the default, 65,536 messages of a
feed, or as many rows where each row has a number of its own (:func:`with_arrival_seq`,
the offsets of a Kafka partition). Rows of one message are told apart by their position.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewell.functions.columns import named, once, summed
from tapewell.functions.windows import (
    WINDOW_SIZES,
    add_seconds,
    base_width,
    size_seconds,
    window_bounds,
    window_start,
    with_window_sizes,
)
from tapewell.operators.windows import (
    EVENT_SUMS,
    event_terms,
    metrics_of_sums,
    source_of,
)
from tapewell.schemas import ARRIVAL, POSITION
from tapewell.session import stage

BLOCK_SPAN = 1 << 16
# Blocks whose maxima are carried on together, by one task per key.
BLOCKS_TOGETHER = 1 << 12
DEFAULT_GRACE_SECONDS = 5


def with_arrival_seq(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Number rows by an order given as columns, which must not have ties.

    A sort spreads the rows over tasks by sampled ranges of the whole order, so no
    symbol or moment is too large for it. Numbers increase in that order and are
    unique; they run on without gaps inside a task. They are written down at once,
    because sampled ranges may differ when the sort is run again.
    """
    ordered = df.orderBy(*[F.col(name).asc_nulls_first() for name in order_by])
    return stage(ordered.withColumn(ARRIVAL, F.monotonically_increasing_id()), "arrival")


def arrival_order(df: DataFrame) -> list[str]:
    """The columns a table is ordered by arrival with."""
    return [name for name in (ARRIVAL, POSITION) if name in df.columns]


def _earlier(keys: list[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _carried_on(tops: DataFrame, keys: list[str]) -> DataFrame:
    """What each block starts from: the largest maximum of the blocks before it.

    Blocks are taken together once more, so that a task sees the blocks of one such run,
    or one row per run.
    """
    runs = tops.withColumn("_run", F.expr(f"_block div {BLOCKS_TOGETHER}"))
    heads = runs.groupBy(*keys, "_run").agg(F.max("_top").alias("_head"))
    starts = heads.select(
        *keys, "_run", F.max("_head").over(_earlier(keys, "_run")).alias("_start")
    )
    within = F.max("_top").over(_earlier([*keys, "_run"], "_block"))
    return (
        runs.withColumn("_within", within)
        .join(starts, [*keys, "_run"])
        .select(*keys, "_block", F.greatest("_start", "_within").alias("_carried"))
    )


@once
def _in_one_block(keys: tuple[str, ...], value: str, order: tuple[str, ...]) -> tuple[Column, Column]:
    known = reduce(and_, [F.col(name).isNotNull() for name in (*keys, ARRIVAL)])
    return known, F.max(value).over(_earlier([*keys], *order))


def with_prior_max(
    df: DataFrame, keys: list[str], value: str = "ts_event", block_span: int | None = BLOCK_SPAN
) -> DataFrame:
    """Add ``prior_max``: the largest ``value`` among earlier arrivals with the same keys.

    Needs :data:`ARRIVAL`, a number increasing by arrival and unique, if need be
    together with :data:`POSITION`. Rows with a null key are left out. ``df`` is read
    twice (once for the few columns of the maxima), so it should be a stored table or
    cheap to compute. Without a ``block_span`` all rows are one block, for a ``df`` that is
    known to hold no more of them than a block does.
    """
    if block_span is None:
        known, earlier = _in_one_block(tuple(keys), value, tuple(arrival_order(df)))
        return df.where(known).withColumn("prior_max", earlier)
    blocks = df.withColumn("_block", F.expr(f"{ARRIVAL} div {int(block_span)}"))
    tops = blocks.groupBy(*keys, "_block").agg(F.max(value).alias("_top"))
    inside = _earlier([*keys, "_block"], *arrival_order(df))
    joined = blocks.join(_carried_on(tops, keys), [*keys, "_block"])
    return joined.withColumn(
        "prior_max", F.greatest(F.col("_carried"), F.max(value).over(inside))
    ).select(*df.columns, "prior_max")


def flag_out_of_order(
    events: DataFrame, by: str = "symbol", block_span: int = BLOCK_SPAN
) -> DataFrame:
    """Add ``out_of_order``: the event is older than one that arrived earlier for its symbol.

    An equal time is in order. Flagged, never dropped; rows without a symbol have
    no order to break and are left out.
    """
    keyed = events.where(F.col(by).isNotNull())
    prior = with_prior_max(keyed, [by], "ts_event", block_span)
    late = F.coalesce(F.col("ts_event") < F.col("prior_max"), F.lit(False))
    return prior.withColumn("out_of_order", late).drop("prior_max")


def count_out_of_order(events: DataFrame, block_span: int = BLOCK_SPAN) -> DataFrame:
    """One row with the number of out-of-order events over all symbols."""
    narrow = events.select("symbol", "ts_event", *arrival_order(events))
    flagged = flag_out_of_order(narrow, "symbol", block_span)
    return flagged.agg(F.count_if("out_of_order").alias("out_of_order"))


def event_time_ms(ts: Column) -> Column:
    """Event time as the stream sees it: cut to whole milliseconds."""
    return F.date_trunc("MILLISECOND", ts)


@once
def _clock_columns() -> dict[str, Column]:
    return {"source": source_of(F.col("event_type")), "ts_event": event_time_ms(F.col("ts_event"))}


def with_closing_clock(events: DataFrame, block_span: int | None = BLOCK_SPAN) -> DataFrame:
    """Add ``source`` and ``prior_max``, the clock of (symbol, source) before each event."""
    clocked = events.withColumns(_clock_columns())
    return with_prior_max(clocked, ["symbol", "source"], "ts_event", block_span)


def _is_late(window_end: Column, grace_seconds: int) -> Column:
    closed = F.col("prior_max") >= add_seconds(window_end, grace_seconds)
    return F.coalesce(closed, F.lit(False))


def late_flags(
    events: DataFrame,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    block_span: int = BLOCK_SPAN,
) -> DataFrame:
    """Each event once per window size, with ``late``: its window had already closed.

    Judged per size: an event can be late for its minute and in time for its hour.
    Late events are below the clock they are judged by, so letting them take part
    in the running maximum changes nothing.
    """
    sized = with_window_sizes(with_closing_clock(events, block_span), sizes)
    return sized.withColumn("late", _is_late(F.col("window_end"), grace_seconds)).drop("prior_max")


@once
def _missed(sizes: tuple[tuple[str, int], ...], grace_seconds: int) -> Column:
    labels = [
        F.when(_is_late(window_bounds(F.col("ts_event"), secs)[1], grace_seconds), F.lit(name))
        for name, secs in sizes
    ]
    return F.array_compact(F.array(*labels))


def with_missed_sizes(
    clocked: DataFrame, sizes: dict[str, int], grace_seconds: int
) -> DataFrame:
    """Add ``missed``: the sizes whose window of the event had closed before it came."""
    return clocked.withColumn("missed", _missed(tuple(sizes.items()), grace_seconds))


@once
def _missed_windows(sizes: tuple[tuple[str, int], ...]) -> tuple[Column, list[Column], dict[str, Column]]:
    seconds = size_seconds(F.col("window_size"), dict(sizes))
    event = [
        F.col("symbol"),
        F.col("source"),
        F.col("ts_event").alias("event_ts"),
        F.explode("missed").alias("window_size"),
    ]
    start = window_start(F.col("event_ts"), seconds)
    return F.size("missed") > 0, event, {"window_start": start, "window_end": add_seconds(start, seconds)}


def missed_windows(judged: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """A row for each event and window it missed; other events are not multiplied."""
    missed, event, bounds = _missed_windows(tuple(sizes.items()))
    return judged.where(missed).select(event).withColumns(bounds)


WINDOW_KEYS = ("symbol", "source", "window_size", "window_start", "window_end")


@once
def _sums_in_time(sizes: tuple[tuple[str, int], ...]) -> tuple[Column, Column, Column, Column]:
    base = window_start(F.col("ts_event"), base_width(dict(sizes))).alias("_base")
    newest = F.max("ts_event").alias("newest"), F.max("newest").alias("newest")
    return base, ~F.array_contains("missed", F.col("window_size")), *newest


def sums_in_time(judged: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Sums and the newest event of each window, over the events that did not miss it.

    Events of a base window that missed the same sizes are summed first; only these few
    rows are spread over the sizes.
    """
    by = ("symbol", "source", "missed")
    base, in_time, newest_of_base, newest = _sums_in_time(tuple(sizes.items()))
    per_base = (
        event_terms(judged, by[1:])
        .groupBy(*named(*by), base)
        .agg(*summed(*EVENT_SUMS), newest_of_base)
    )
    return (
        with_window_sizes(per_base, sizes, "_base")
        .where(in_time)
        .groupBy(*named(*WINDOW_KEYS))
        .agg(*summed(*EVENT_SUMS), newest)
    )


def late_records(
    events: DataFrame,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    block_span: int = BLOCK_SPAN,
) -> DataFrame:
    """Late events only, with the bounds of the window they missed."""
    clocked = with_closing_clock(events, block_span)
    return missed_windows(with_missed_sizes(clocked, sizes, grace_seconds), sizes)


def closed_windows_by_clock(
    events: DataFrame,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    block_span: int = BLOCK_SPAN,
) -> DataFrame:
    """Batch definition of the streamed windows: closed by their own clock, late events left out.

    The newest event of a key is never late, so the clocks come from the same small
    table of window sums that they are then compared with.
    """
    clocked = with_closing_clock(events, block_span)
    sums = sums_in_time(with_missed_sizes(clocked, sizes, grace_seconds), sizes)
    # A clock is the newest event over a key's window sums, a row per window: the sums are
    # not computed a second time to be joined with themselves.
    clock = F.max("newest").over(Window.partitionBy("symbol", "source"))
    closes_at = add_seconds(F.col("window_end"), grace_seconds)
    closed = sums.withColumn("watermark", clock).where(F.col("watermark") >= closes_at)
    return metrics_of_sums(closed.drop("watermark"), ("source",))
