"""Streamed tumbling windows per symbol.

The exact variant closes each window by its own symbol's clock, which no built-in
window does: Spark's watermark is one for the whole query. Each micro-batch is judged
by the same columns as the batch definition, from the clocks and open windows that the
batch before left as small tables: rows are spread by blocks of consecutive arrivals,
summed per window in parallel, and no task sees all rows of a symbol.
``stream_windows_global`` is the cheaper built-in variant with the global watermark,
which closes windows of quiet symbols too and judges lateness only between micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapewell.functions.columns import named, once, summed
from tapewell.functions.windows import WINDOW_SIZES, add_seconds
from tapewell.operators.ordering import (
    BLOCK_SPAN,
    DEFAULT_GRACE_SECONDS,
    WINDOW_KEYS,
    event_time_ms,
    missed_windows,
    sums_in_time,
    with_closing_clock,
    with_missed_sizes,
)
from tapewell.operators.windows import EVENT_SUMS, event_terms, metrics_of_sums, source_of
from tapewell.schemas import ARRIVAL, LATE_SCHEMA, POSITION, WINDOW_SCHEMA
from tapewell.session import ensure_session
from tapewell.sources.ranges import (
    ROWS_PER_BATCH,
    kept_ranges,
    kept_rows,
    numbers_of,
    read_range_rows,
    rows_by_range,
    rows_in_ranges,
    stream_ranges,
)
from tapewell.streaming.normalizing import run_of

# Folders of the output.
WINDOW = "windows"
LATE = "late"

KEY = ["symbol", "source"]
CLOCK_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("clock", T.TimestampType()),
        T.StructField("gone", T.BooleanType()),
    ]
)
SUMS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("window_size", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        *[
            T.StructField(name, T.LongType() if name.endswith("_count") else T.DoubleType())
            for name in EVENT_SUMS
        ],
        T.StructField("closed", T.BooleanType()),
    ]
)
_NEEDED = (
    "symbol", "event_type", "ts_event", "price", "size", "best_bid", "best_ask", ARRIVAL, POSITION
)


def with_event_time(events: DataFrame) -> DataFrame:
    """Event time is ``ts_event`` cut to whole milliseconds, whatever the broker says."""
    return events.withColumn("ts_event", event_time_ms(F.col("ts_event")))


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


@once
def _clocks() -> tuple[Column, Column]:
    return F.max("ts_event").alias("clock"), F.max("clock").alias("clock")


@once
def _present() -> Column:
    return ~F.coalesce("gone", F.lit(False))


@once
def _closed_now() -> Column:
    return F.col("closed")


@once
def _still_open() -> Column:
    return ~F.col("closed")


def _clock_before(passed: Column) -> Column:
    return F.greatest("prior_max", F.coalesce("clock", passed))


@once
def _never_quiet() -> tuple[Column, Column]:
    """The clock before an event where keys outside the state have passed nothing; no key is gone."""
    return _clock_before(F.lit(None).cast("timestamp")), F.lit(False)


@once
def _is_closed(grace_seconds: int) -> Column:
    return F.col("gone") | (F.col("clock") >= add_seconds(F.col("window_end"), grace_seconds))


def _closed_windows(flagged: DataFrame) -> DataFrame:
    metrics = metrics_of_sums(flagged.where(_closed_now()), ("source",))
    return metrics.select(named(*WINDOW_SCHEMA.fieldNames()))


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _gathered(df: DataFrame) -> DataFrame:
    """Few rows in one task, so that no step after it shuffles them."""
    return df.coalesce(1)


def _looked_up(df: DataFrame) -> DataFrame:
    """The few rows a join in one task looks its own up in; a broadcast is a job of its own."""
    return _gathered(df).hint("shuffle_hash")


@contextmanager
def _at_once(spark: SparkSession) -> Iterator[Callable]:
    """Start writes of a micro-batch that run side by side; all of them have ended on the way out."""
    running = []
    with ThreadPoolExecutor() as threads:
        yield lambda write, *args: running.append(threads.submit(inheritable_thread_target(spark)(write), *args))
    for write in running:
        write.result()


class Closing:
    """What one micro-batch does to the clocks and open windows that the one before left.

    Each batch writes its own state and output folders and reads only the state of its
    predecessor, so a repeated batch writes the same rows over its own. The state before
    that goes: a batch starts only when its predecessor is committed.

    With ``quiet_seconds`` a key (symbol and source) whose clock has fallen further than that
    behind the newest clock of all, as the batch before left it, leaves the state: its open
    windows close with what they hold. A key that is not in the state, because it left or is
    new, is then taken to have passed every window that a key which left can have closed, so
    no window comes out twice; rows of such windows are late.

    Where ``most_rows``, the most rows the next batch can hold, is known and not above those of
    a block of arrivals, one task takes the batch: sharing out so few rows costs far more than
    working on them, and a table of many small batches is mostly that cost.
    """

    most_rows: int | None = None

    def __init__(
        self,
        state: str,
        root: str,
        run: str,
        sizes: dict[str, int],
        grace_seconds: int,
        span: int,
        quiet_seconds: int | None = None,
    ) -> None:
        self.open_seconds = max(sizes.values()) + grace_seconds
        if quiet_seconds is not None and quiet_seconds < self.open_seconds:
            raise ValueError(f"a symbol must be quiet for {self.open_seconds} seconds at least")
        self.quiet_seconds = quiet_seconds
        self.state, self.root, self.run = state, root, run
        self.sizes, self.grace_seconds, self.span = sizes, grace_seconds, span

    def folder(self, batch_id: int) -> str:
        return f"run={self.run}/batch_id={batch_id}"

    def _left(self, spark: SparkSession, batch_id: int, name: str, schema: T.StructType):
        if batch_id < 0:
            return _empty(spark, schema)
        return spark.read.schema(schema).parquet(f"{self.state}/{self.folder(batch_id)}/{name}")

    def _keep(self, df: DataFrame, batch_id: int, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.state}/{self.folder(batch_id)}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(schema).parquet(path)

    def _drop_state(self, spark: SparkSession, batch_id: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{self.folder(batch_id)}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _put(self, df: DataFrame, batch_id: int, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/{self.folder(batch_id)}")

    def in_one_task(self) -> bool:
        return self.most_rows is not None and self.most_rows <= self.span

    def take(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Land the batch's late records and closed windows, and return the latter."""
        spark = batch.sparkSession
        self._drop_state(spark, batch_id - 2)
        before = self._left(spark, batch_id - 1, "clocks", CLOCK_SCHEMA)
        before = before.where(_present()).drop("gone")
        clock_before, gone = _never_quiet()
        if self.quiet_seconds is not None:
            micros = before.agg(F.max(F.unix_micros("clock"))).first()[0]
            newest_before = F.timestamp_micros(F.lit(micros).cast("bigint"))
            left = add_seconds(newest_before, -self.quiet_seconds)
            clock_before = _clock_before(add_seconds(left, self.open_seconds))
            gone = F.coalesce(F.col("clock") < left, F.lit(False))
        still_open = self._left(spark, batch_id - 1, "sums", SUMS_SCHEMA).where(_still_open())
        small = self.in_one_task()
        gathered, looked_up = (_gathered, _looked_up) if small else (_as_it_is, _as_it_is)
        clocked = (
            with_closing_clock(gathered(batch.select(named(*_NEEDED))), None if small else self.span)
            .join(looked_up(before), KEY, "left")
            .withColumn("prior_max", clock_before)
        )
        stored = with_missed_sizes(clocked, self.sizes, self.grace_seconds)
        stored = stored.persist(StorageLevel.MEMORY_AND_DISK)

        def clocks_of(judged: DataFrame) -> DataFrame:
            newest_of_batch, newest = _clocks()
            in_batch = judged.groupBy(*named(*KEY)).agg(newest_of_batch)
            clocks = gathered(before.unionByName(in_batch)).groupBy(*named(*KEY)).agg(newest)
            return clocks.withColumn("gone", gone)

        def sums_of(judged: DataFrame, clocks: DataFrame) -> DataFrame:
            in_time = sums_in_time(judged, self.sizes).drop("newest")
            sums = (
                gathered(still_open.drop("closed").unionByName(in_time))
                .groupBy(*named(*WINDOW_KEYS))
                .agg(*summed(*EVENT_SUMS))
            )
            flagged = sums.join(looked_up(clocks), KEY).withColumn("closed", _is_closed(self.grace_seconds))
            return flagged.select(named(*SUMS_SCHEMA.fieldNames()))

        try:
            if small:
                judged = gathered(stored)
                with _at_once(spark) as start:
                    start(self._put, missed_windows(judged, self.sizes), batch_id, LATE)
                    clocks = clocks_of(judged)
                    start(self._keep, clocks, batch_id, "clocks", CLOCK_SCHEMA)
                    sums = sums_of(judged, clocks)
                    start(self._keep, sums, batch_id, "sums", SUMS_SCHEMA)
                    start(self._put, _closed_windows(sums), batch_id, WINDOW)
                return spark.read.schema(WINDOW_SCHEMA).parquet(f"{self.root}/{WINDOW}/{self.folder(batch_id)}")
            self._put(missed_windows(stored, self.sizes), batch_id, LATE)
            clocks = self._keep(clocks_of(stored), batch_id, "clocks", CLOCK_SCHEMA)
            sums = self._keep(sums_of(stored, clocks), batch_id, "sums", SUMS_SCHEMA)
        finally:
            stored.unpersist()
        closed = _closed_windows(sums)
        self._put(closed, batch_id, WINDOW)
        return closed


def stream_windows(
    events: DataFrame,
    root: str,
    checkpoint: str,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    block_span: int = BLOCK_SPAN,
    bounded: bool = True,
    interval: str = "10 seconds",
    emit: Callable[[DataFrame, str], None] | None = None,
    quiet_seconds: int | None = None,
) -> StreamingQuery:
    """Land the closed windows and late records of a stream; read them back with
    :func:`read_stream_output`.

    Each window comes out once, when final. The input needs the order of arrival; within
    a micro-batch it decides what came first, and micro-batches must follow it. ``emit``
    also gets the closed windows of each micro-batch with the batch's folder name.
    ``bounded`` takes in what is there and stops; otherwise the query runs on. State is
    kept beside the checkpoint's own files, of the last two micro-batches. It holds a clock
    for each symbol ever seen, unless ``quiet_seconds`` lets quiet ones go; see
    :class:`Closing`.
    """
    spark = ensure_session(events.sparkSession)
    run = run_of(spark, checkpoint)
    state = f"{checkpoint.rstrip('/')}/tapewell-state"
    closing = Closing(
        state, root.rstrip("/"), run, sizes, grace_seconds, block_span, quiet_seconds
    )

    def take(batch: DataFrame, batch_id: int) -> None:
        closed = closing.take(batch, batch_id)
        if emit is not None:
            emit(closed, closing.folder(batch_id))

    trigger = {"availableNow": True} if bounded else {"processingTime": interval}
    return (
        events.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_landed_windows(
    events: DataFrame,
    root: str,
    checkpoint: str,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    rows: int = ROWS_PER_BATCH,
    block_span: int = BLOCK_SPAN,
) -> None:
    """:func:`stream_windows` over a landed table, about ``rows`` rows a micro-batch in order of arrival.

    Returns when all of the table is taken in; a run that was cut off goes on where it was.
    """
    spark = ensure_session(events.sparkSession)
    ranges = kept_ranges(spark, events, checkpoint, rows)
    if not ranges:
        return
    kept = kept_rows(spark, events, ranges, checkpoint)
    held = rows_by_range(kept)
    run = run_of(spark, checkpoint)
    state = f"{checkpoint.rstrip('/')}/tapewell-state"
    closing = Closing(state, root.rstrip("/"), run, sizes, grace_seconds, block_span)

    def take(batch: DataFrame, batch_id: int) -> None:
        numbers = [number for number in numbers_of(batch) if number in held]
        closing.most_rows = sum(held[number] for number in numbers)
        if not numbers or not closing.in_one_task():
            closing.take(rows_in_ranges(kept, batch), batch_id)
            return
        # The stream has a session of its own. Plans of one task have no stages to adapt.
        own = batch.sparkSession
        own.conf.set("spark.sql.adaptive.enabled", "false")
        closing.take(read_range_rows(own, kept, checkpoint, numbers), batch_id)

    query = (
        stream_ranges(spark, ranges)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds")
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def stream_trade_windows(events: DataFrame, *args, **kwargs) -> StreamingQuery:
    """Windows of the trades alone: VWAP, volume, count."""
    return stream_windows(events.where(F.col("event_type") != "ticker"), *args, **kwargs)


def stream_ticker_windows(events: DataFrame, *args, **kwargs) -> StreamingQuery:
    """Windows of the quotes alone: mean spread, mean mid, count."""
    return stream_windows(events.where(F.col("event_type") == "ticker"), *args, **kwargs)


def stream_windows_global(
    events: DataFrame, sizes: dict[str, int] = WINDOW_SIZES, delay: str = "5 seconds"
) -> DataFrame:
    """The same metrics with Spark's own watermark and windows, all JVM-side.

    Differs from :func:`stream_windows` in when windows close: by the newest event
    of any symbol, checked between micro-batches.
    """
    timed = with_event_time(events).withColumn("source", source_of(F.col("event_type")))
    marked = timed.withWatermark("ts_event", delay)
    per_size = []
    for label, seconds in sizes.items():
        sums = (
            event_terms(marked, ("source",))
            .groupBy(F.window("ts_event", f"{seconds} seconds"), "symbol", "source")
            .agg(*[F.sum(name).alias(name) for name in EVENT_SUMS])
            .withColumns(
                {
                    "window_size": F.lit(label),
                    "window_start": F.col("window.start"),
                    "window_end": F.col("window.end"),
                }
            )
        )
        per_size.append(metrics_of_sums(sums, ("source",)))
    return reduce(DataFrame.unionByName, per_size).select(*WINDOW_SCHEMA.fieldNames())


def run_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    partitions: tuple[str, ...] = ("source",),
    bounded: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Write a stream to Parquet, each row exactly once.

    ``bounded`` takes in what is there and stops; otherwise the query runs on.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partitions)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if bounded else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_stream_output(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """``(windows, late records)`` written by :func:`stream_windows`; empty before any batch."""
    both = []
    for name, schema in ((WINDOW, WINDOW_SCHEMA), (LATE, LATE_SCHEMA)):
        try:
            table = spark.read.schema(schema).parquet(f"{root}/{name}")
            both.append(table.select(*schema.fieldNames()))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            both.append(_empty(spark, schema))
    return both[0], both[1]
