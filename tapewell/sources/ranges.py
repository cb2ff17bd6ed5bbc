"""A landed table as a stream in order of arrival, some rows at a time.

The files of a partitioned table are not in order of arrival, so a stream of its files
cannot follow it. This stream carries ranges of arrival numbers instead: one range a
micro-batch, in order, with the ranges' places as offsets. Whoever takes a micro-batch reads
that range of the table; the range reaches the Parquet scan. Ranges are cut once per
checkpoint and written beside it, so a restart goes on with the same ones. The table is
written once more beside them, in folders by range number, so that a micro-batch reads its
own rows only: the landed files hold all arrival numbers each and can't be skipped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tapewell.schemas import ARRIVAL

ROWS_PER_BATCH = 5_000_000
_RANGES = "number long, low long, high long"
# The range number of a row in the copy of the table, a partition column.
RANGE = "_range"


class ArrivalRanges(DataSource):
    """Stream source of (number, low, high); the ranges come as an option."""

    @classmethod
    def name(cls) -> str:
        return "arrival_ranges"

    def schema(self) -> str:
        return _RANGES

    def simpleStreamReader(self, schema) -> _RangeReader:  # noqa: N802  the interface's name
        return _RangeReader(json.loads(self.options["ranges"]))


class _RangeReader(SimpleDataSourceStreamReader):
    def __init__(self, ranges: list[list[int]]):
        self.ranges = ranges

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at = start["next"]
        return iter(self._rows(at, at + 1)), {"next": min(at + 1, len(self.ranges))}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter(self._rows(start["next"], end["next"]))

    def _rows(self, low: int, high: int) -> list[tuple]:
        return [(k, *self.ranges[k]) for k in range(low, min(high, len(self.ranges)))]


def cut_ranges(events: DataFrame, rows: int = ROWS_PER_BATCH) -> list[list[int]]:
    """Ranges [low, high] of arrival numbers, all of them, of about ``rows`` rows each.

    Cut at quantiles of the numbers, sketched in one pass, so that gaps in the numbering make
    no empty ranges. Rows that share a number stay together.
    """
    n, low, high = events.agg(F.count(ARRIVAL), F.min(ARRIVAL), F.max(ARRIVAL)).first()
    if not n:
        return []
    parts = -(-n // rows)
    shares = [k / parts for k in range(1, parts)]
    cuts = events.approxQuantile(ARRIVAL, shares, 1 / (8 * parts)) if shares else []
    starts = sorted({low, *(int(x) for x in cuts)})
    return [[a, b - 1] for a, b in zip(starts, [*starts[1:], high + 1], strict=True)]


def kept_ranges(spark: SparkSession, events: DataFrame, checkpoint: str, rows: int = ROWS_PER_BATCH) -> list[list[int]]:
    """The ranges a checkpoint was started with, cut and written down when it is new."""
    path = f"{checkpoint.rstrip('/')}/tapewell-ranges"
    try:
        kept = spark.read.text(path, wholetext=True).first()
        if kept is not None:  # a driver lost while writing leaves an empty folder
            return json.loads(kept[0])
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
    ranges = cut_ranges(events, rows)
    spark.createDataFrame([(json.dumps(ranges),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return ranges


def _numbering(starts: np.ndarray):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrival = batch.column(ARRIVAL)
            at = np.searchsorted(starts, arrival.fill_null(0).to_numpy(zero_copy_only=False), "right") - 1
            missing = arrival.is_null().to_numpy(zero_copy_only=False)
            yield batch.append_column(RANGE, pa.array(at, pa.int64(), mask=missing))

    return number


def _rows_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/tapewell-rows"


def kept_rows(spark: SparkSession, events: DataFrame, ranges: list[list[int]], checkpoint: str) -> DataFrame:
    """The rows of ``events`` in the ranges, with their range number, written once per checkpoint.

    In folders by number, one file each; rows without an arrival number are in no range and
    not kept. A copy whose write did not finish is written anew.
    """
    path = _rows_path(checkpoint)
    schema = T.StructType([*events.schema.fields, T.StructField(RANGE, T.LongType())])
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        starts = np.array([low for low, _ in ranges], np.int64)
        numbered = events.where(F.col(ARRIVAL).isNotNull()).mapInArrow(_numbering(starts), schema)
        numbered.repartition(RANGE).write.partitionBy(RANGE).mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def stream_ranges(spark: SparkSession, ranges: list[list[int]]) -> DataFrame:
    """Ranges as a stream, one a micro-batch."""
    spark.dataSource.register(ArrivalRanges)
    return spark.readStream.format(ArrivalRanges.name()).option("ranges", json.dumps(ranges)).load()


def in_ranges(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of the table in the ranges of a micro-batch, which follow one another."""
    low, high = ranges.agg(F.min("low"), F.max("high")).first()
    return events.where(F.lit(False) if low is None else F.col(ARRIVAL).between(low, high))


def rows_in_ranges(kept: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of :func:`kept_rows` in the ranges of a micro-batch, read from their folders alone."""
    numbers = numbers_of(ranges)
    rows = kept.where(F.col(RANGE).between(numbers[0], numbers[-1]) if numbers else F.lit(False))
    return rows.drop(RANGE)


def numbers_of(ranges: DataFrame) -> list[int]:
    """The numbers of the ranges of a micro-batch, which follow one another; one as a rule."""
    return sorted(r["number"] for r in ranges.select("number").collect())


def rows_by_range(kept: DataFrame) -> dict[int, int]:
    """How many rows of :func:`kept_rows` each range holds, from the footers of their files."""
    return dict(kept.groupBy(RANGE).count().collect())  # a row a range


def read_range_rows(spark: SparkSession, kept: DataFrame, checkpoint: str, numbers: list[int]) -> DataFrame:
    """The same rows as :func:`rows_in_ranges`, for a session of the reader's own; no other folder is listed."""
    schema = T.StructType([field for field in kept.schema if field.name != RANGE])
    paths = [f"{_rows_path(checkpoint)}/{RANGE}={number}" for number in numbers]
    return spark.read.schema(schema).parquet(*paths)
