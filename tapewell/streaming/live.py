"""The live plan: raw messages to bronze, quarantine, windows and late records.

Every micro-batch writes each table, and what the next one starts from, into folders of its
run and number; its commit record comes last. Readers take the folders of committed batches
only, so the tables of a batch become visible together or not at all. A batch that was cut
off is written over by its repeat; one that was committed before its repeat is left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapewell.functions.windows import WINDOW_SIZES
from tapewell.operators.normalize import events_of, normalize_tagged, rejects_of, to_quarantine
from tapewell.operators.ordering import BLOCK_SPAN, DEFAULT_GRACE_SECONDS
from tapewell.operators.quality import reconcile
from tapewell.schemas import BRONZE_SCHEMA, LATE_SCHEMA, QUARANTINE_SCHEMA, WINDOW_SCHEMA
from tapewell.session import ensure_session
from tapewell.sinks.lake import BRONZE_PARTITIONS
from tapewell.streaming.normalizing import run_of, split_unreadable
from tapewell.streaming.windows import LATE, WINDOW, Closing

BRONZE, QUARANTINE, COMMITS = "bronze", "quarantine", "commits"
TABLES = {BRONZE: BRONZE_SCHEMA, QUARANTINE: QUARANTINE_SCHEMA, WINDOW: WINDOW_SCHEMA, LATE: LATE_SCHEMA}
COUNTS = ("events", "rejects", "bronze_rows", "quarantine_rows", "window_rows", "late_rows")
_KEY = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
COMMIT_SCHEMA = T.StructType([*_KEY.fields, *[T.StructField(name, T.LongType()) for name in COUNTS]])


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class _Plan:
    def __init__(self, root: str, dim: DataFrame | None, ts_ingest: Column | None, closing: Closing, emit, landed):
        self.root, self.dim, self.ts_ingest, self.closing = root, dim, ts_ingest, closing
        self.emit, self.landed = emit or (lambda *_: None), landed or (lambda *_: None)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, self.closing.folder(batch_id)
        commit = f"{self.root}/{COMMITS}/{folder}"
        if not _written(spark, commit, COMMIT_SCHEMA).isEmpty():
            return
        messages, unreadable = split_unreadable(batch)
        tagged = normalize_tagged(messages, self.dim, self.ts_ingest)
        tagged = tagged.unionByName(unreadable, allowMissingColumns=True).persist(StorageLevel.MEMORY_AND_DISK)
        counts = {}
        try:
            counts["events"], counts["rejects"] = tagged.agg(
                F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())
            ).first()
            events = events_of(tagged).hint("rebalance", *BRONZE_PARTITIONS)
            counts["bronze_rows"] = self._put(events, BRONZE, folder, batch_id, BRONZE_PARTITIONS)
            rejects = to_quarantine(rejects_of(tagged))
            counts["quarantine_rows"] = self._put(rejects, QUARANTINE, folder, batch_id)
        finally:
            tagged.unpersist()
        reconcile(counts["bronze_rows"], counts["events"], f"{BRONZE} of batch {batch_id}")
        reconcile(counts["quarantine_rows"], counts["rejects"], f"{QUARANTINE} of batch {batch_id}")
        # From here on the batch is what was written: a lost executor parses nothing again.
        events = spark.read.schema(BRONZE_SCHEMA).parquet(f"{self.root}/{BRONZE}/{folder}")
        closed = self.closing.take(events, batch_id)
        self.landed(WINDOW, batch_id)
        counts["window_rows"] = closed.count()
        counts["late_rows"] = _written(spark, f"{self.root}/{LATE}/{folder}", LATE_SCHEMA).count()
        self.emit(WINDOW, closed, folder)
        self.emit(QUARANTINE, _written(spark, f"{self.root}/{QUARANTINE}/{folder}", QUARANTINE_SCHEMA), folder)
        row = [tuple(counts[name] for name in COUNTS)]
        record = spark.createDataFrame(row, T.StructType(COMMIT_SCHEMA.fields[2:]))
        record.coalesce(1).write.mode("overwrite").parquet(commit)

    def _put(self, df: DataFrame, name: str, folder: str, batch_id: int, partitions: tuple[str, ...] = ()) -> int:
        path = f"{self.root}/{name}/{folder}"
        df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
        self.landed(name, batch_id)
        # From the footers: a counter would count the rows of a task that ran twice twice.
        return df.sparkSession.read.schema(df.schema).parquet(path).count()


def start_live(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    dim: DataFrame | None = None,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    ts_ingest: Column | None = None,
    block_span: int = BLOCK_SPAN,
    bounded: bool = True,
    interval: str = "10 seconds",
    emit: Callable[[str, DataFrame, str], None] | None = None,
    landed: Callable[[str, int], None] | None = None,
    quiet_seconds: int | None = None,
) -> StreamingQuery:
    """Run the live plan over a stream of raw messages; read it back with :func:`read_live`.

    Micro-batches must follow the order of arrival, as those of a topic or of a folder that
    grows do. Rows produced and rows landed are compared before a batch is committed; a
    difference stops the stream. ``emit`` gets a batch's closed windows and its quarantine,
    with the batch's folder name, before its commit (at least once); ``landed`` is told of
    every table written. ``bounded`` takes in what is there and stops; ``quiet_seconds`` lets
    quiet symbols leave the state, see :class:`tapewell.streaming.windows.Closing`.
    """
    spark = ensure_session(raw.sparkSession)
    root = root.rstrip("/")
    run = run_of(spark, checkpoint)
    state = f"{checkpoint.rstrip('/')}/tapewell-state"
    closing = Closing(state, root, run, sizes, grace_seconds, block_span, quiet_seconds)
    plan = _Plan(root, dim, ts_ingest, closing, emit, landed)
    trigger = {"availableNow": True} if bounded else {"processingTime": interval}
    return (
        raw.writeStream.foreachBatch(plan.take)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed micro-batch: run, batch_id and its counts of rows."""
    return _written(spark, f"{root.rstrip('/')}/{COMMITS}", COMMIT_SCHEMA)


def read_live(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the live plan (``bronze``, ``quarantine``, ``windows`` or ``late``), committed batches only."""
    schema = TABLES[name]
    table = _written(spark, f"{root.rstrip('/')}/{name}", T.StructType([*schema.fields, *_KEY.fields]))
    committed = read_commits(spark, root).select(*_KEY.fieldNames())
    return table.join(committed, _KEY.fieldNames(), "left_semi").select(*schema.fieldNames())
