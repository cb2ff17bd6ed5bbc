"""Writers for bronze, streamed windows, quarantine, raw messages and summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewell.functions.parsing import parse_ts
from tapewell.functions.windows import iso_utc
from tapewell.landed import current_folder, discard, make_current, new_folder
from tapewell.schemas import (
    ARRIVAL,
    BRONZE_SCHEMA,
    GOLD_SCHEMA,
    POSITION,
    QUARANTINE_SCHEMA,
    RAW_SCHEMA,
    WINDOW_SCHEMA,
)

BRONZE_PARTITIONS = ("event_type", "symbol")
WINDOW_PARTITIONS = ("window_size", "source")


def _land(
    df: DataFrame, root: str, partitions: tuple[str, ...], clear: bool, empties: bool = False
) -> int:
    """Replace or extend a table and return the rows landed.

    A replacement is written once, to a folder of its own, counted from its Parquet footers
    and made current by one small file; until then readers have the old table. Without rows
    the old table stays, unless the table ``empties``. An extension goes to the current
    folder, and the rows counted are those of this write, whoever else writes.
    """
    spark = df.sparkSession
    if not clear:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        _write(counted, current_folder(spark, root), partitions, "append")
        return seen.get["rows"]
    folder = new_folder(root)
    _write(df, folder, partitions, "errorifexists")
    landed = spark.read.schema(df.schema).parquet(folder).count()
    if landed or empties:
        make_current(spark, root, folder)
    else:
        discard(spark, folder)
    return landed


def _write(df: DataFrame, folder: str, partitions: tuple[str, ...], mode: str) -> None:
    """``rebalance`` groups rows by table partition so that tasks do not each write a file per
    partition, and lets adaptive execution split a partition that holds a large share of all
    rows and merge the small ones."""
    if partitions:
        df = df.hint("rebalance", *partitions)
    df.write.partitionBy(*partitions).mode(mode).parquet(folder)


def _with_order(events: DataFrame) -> DataFrame:
    """Columns of the order of arrival that the events do not have, as nulls."""
    for name in (ARRIVAL, POSITION):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("bigint"))
    return events


def write_bronze(events: DataFrame, root: str, clear: bool = True) -> int:
    """Land events by (event_type, symbol) and return the rows landed.

    With ``clear`` the table is replaced, but only if there are events to land.
    """
    return _land(_with_order(events).select(*BRONZE_SCHEMA.fieldNames()), root, BRONZE_PARTITIONS, clear)


def start_bronze_sink(
    events: DataFrame, root: str, checkpoint: str, bounded: bool = True
) -> StreamingQuery:
    """Streaming twin of :func:`write_bronze`: exactly-once files by (event_type, symbol)."""
    writer = (
        _with_order(events).select(*BRONZE_SCHEMA.fieldNames())
        .writeStream.format("parquet")
        .partitionBy(*BRONZE_PARTITIONS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if bounded else {"processingTime": "10 seconds"}
    return writer.trigger(**trigger).start()


def land_windows(windows: DataFrame, root: str, clear: bool = True) -> int:
    """Land streamed windows by (window_size, source) and return the rows landed.

    Bounds that are still ISO text become timestamps. An empty input leaves the
    old table in place.
    """
    types = dict(windows.dtypes)
    for name in ("window_start", "window_end"):
        if types[name] == "string":
            windows = windows.withColumn(name, parse_ts(F.col(name)))
    typed = windows.select(*[F.col(f.name).cast(f.dataType) for f in WINDOW_SCHEMA])
    return _land(typed, root, WINDOW_PARTITIONS, clear)


def land_quarantine(quarantine: DataFrame, root: str, clear: bool = True) -> int:
    """Land quarantine rows and return how many.

    Unlike the other tables, ``clear`` empties this one even when there is nothing
    to land: an empty table then says that the run had no violations.
    """
    typed = quarantine.select(*[F.col(f.name).cast(f.dataType) for f in QUARANTINE_SCHEMA])
    return _land(typed, root, (), clear, empties=True)


def write_raw_messages(raw: DataFrame, path: str) -> None:
    """Raw messages as JSON lines, the payload as a nested document.

    Payload text is spliced in as it stands, so nothing in it is reinterpreted; only
    line breaks, which JSON allows between tokens alone, become spaces. Files are
    range-partitioned by ``seq`` and sorted within.
    """
    head = F.to_json(
        F.struct(
            F.col("seq"),
            iso_utc(F.col("ts_recorded")).alias("ts_recorded"),
            F.col("exchange"),
            F.col("channel"),
        ),
        {"ignoreNullFields": "false"},
    )
    line = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"payload":'),
        F.translate("payload", "\r\n", "  "),
        F.lit("}"),
    )
    raw.select(*RAW_SCHEMA.fieldNames()).orderBy("seq").select(line.alias("value")).write.mode(
        "overwrite"
    ).text(path)


def with_capture_order(raw: DataFrame, order_by: list[str]) -> DataFrame:
    """Number messages that have no ``seq`` yet by the order they were captured in.

    Increasing and unique, with gaps between partitions: a gapless number would
    need all rows in one task.
    """
    ordered = raw.orderBy(*order_by)
    return ordered.withColumn("seq", F.monotonically_increasing_id()).select(
        *RAW_SCHEMA.fieldNames()
    )


def write_gold_csv(gold: DataFrame, path: str) -> None:
    """Export gold as CSV with a header line."""
    gold.select(*GOLD_SCHEMA.fieldNames()).write.mode("overwrite").csv(path, header=True)


def write_run_summary(summary: DataFrame, path: str) -> None:
    """The one-row result of a run as a JSON document."""
    summary.write.mode("overwrite").json(path)


def record_emitter(
    path: str | None = None, kafka: dict[str, str] | None = None
) -> Callable[[DataFrame, str], None]:
    """A writer for the records of one micro-batch, given with the batch's folder name.

    Text files go to that folder, which a repeated batch overwrites; Kafka gets the records
    by topic and key, at least once.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")

    def emit(records: DataFrame, batch: str) -> None:
        if kafka is not None:
            keyed = records.select("topic", "key", "value")
            keyed.write.format("kafka").options(**kafka).save()
        else:
            records.select("value").write.mode("overwrite").text(f"{path}/{batch}")

    return emit


def start_record_sink(
    records: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    bounded: bool = True,
) -> StreamingQuery:
    """Stream JSON records to text files, exactly once, or to Kafka by topic and key.

    Files get the ``value`` text; Kafka needs its connector on the class path and
    delivers at least once.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a folder or Kafka options")
    if kafka is not None:
        writer = records.select("topic", "key", "value").writeStream.format("kafka")
        writer = writer.options(**kafka)
    else:
        writer = records.select("value").writeStream.format("text").option("path", path)
    trigger = {"availableNow": True} if bounded else {"processingTime": "10 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
