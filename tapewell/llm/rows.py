"""A key of its own for every row of a table whose ids may be missing or repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

ROW = "row"


_OWN = "own_ids"


def number_rows(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``row``, a number no other row has: the id where all ids differ, else a written one."""
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if unclear.isEmpty():
        return docs.withMetadata("doc_id", {_OWN: True}).withColumn(ROW, F.col("doc_id"))
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def has_own_ids(numbered: DataFrame) -> bool:
    """Whether ``row`` is the id itself in a result of :func:`number_rows`."""
    return bool(numbered.schema["doc_id"].metadata.get(_OWN))
