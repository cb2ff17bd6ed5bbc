"""Readers for the tables the jobs land, always with their explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapewell.landed import current_folder
from tapewell.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, QUARANTINE_SCHEMA, WINDOW_SCHEMA


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Whole bronze table; event_type and symbol come back from the paths."""
    folder = current_folder(spark, root)
    return spark.read.schema(BRONZE_SCHEMA).parquet(folder).select(*BRONZE_SCHEMA.fieldNames())


def stream_bronze(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Bronze as a stream of whatever files are or will be in its current folder.

    Micro-batches take files by age. Where order of arrival matters, follow a table that
    grows in that order, or take a finished one by :mod:`tapewell.sources.ranges`.
    """
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(current_folder(spark, root)).select(*BRONZE_SCHEMA.fieldNames())


def read_windows(spark: SparkSession, root: str) -> DataFrame:
    folder = current_folder(spark, root)
    return spark.read.schema(WINDOW_SCHEMA).parquet(folder).select(*WINDOW_SCHEMA.fieldNames())


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(current_folder(spark, root))


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows from a CSV export with a header line."""
    return spark.read.schema(GOLD_SCHEMA).csv(path, header=True, enforceSchema=False)


def read_summary_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON summary document, such as a run result or a time-travel summary."""
    return spark.read.option("multiLine", True).json(path)
