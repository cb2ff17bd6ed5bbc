"""Which folder of a landed table is current, so that a table is replaced by one small file.

Layout under the table root::

    _tables/<folder>/...              a whole table, written by one job
    _current/<version>-<folder>       an empty file per replacement; the last name counts

A table without such a file is the root folder itself, which is also where streams and
appends to a new table write. Readers take the folder that is current when they start. A
writer that dies before its file is there changes nothing for them. Two writers at once
leave two whole tables and the same one of them current for everybody. Replaced tables
stay for the queries that still read them, until :func:`purge_replaced`.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

TABLES, CURRENT = "_tables", "_current"
# A table no file names counts as left behind by a dead writer after this long.
ABANDONED_SECONDS = 7 * 86_400


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _replacements(spark: SparkSession, root: str) -> list[str]:
    """Names of the files that made a table current, oldest first."""
    fs, path = _file_system(spark, f"{root}/{CURRENT}")
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def current_folder(spark: SparkSession, root: str) -> str:
    """Where the rows of the table at ``root`` are now."""
    names = _replacements(spark, root)
    return f"{root}/{TABLES}/{names[-1].split('-')[1]}" if names else root


def new_folder(root: str) -> str:
    """A folder of its own for a writer that replaces the table at ``root``."""
    return f"{root}/{TABLES}/{uuid.uuid4().hex}"


def make_current(spark: SparkSession, root: str, folder: str) -> None:
    """Let readers that start from now on take ``folder``, which must be written whole."""
    names = _replacements(spark, root)
    version = int(names[-1].split("-")[0]) + 1 if names else 0
    fs, path = _file_system(spark, f"{root}/{CURRENT}/{version:015d}-{folder.rsplit('/', 1)[1]}")
    fs.create(path, False).close()


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that never became current."""
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def purge_replaced(
    spark: SparkSession, root: str, abandoned_seconds: float = ABANDONED_SECONDS
) -> None:
    """Delete the tables that were replaced, a separate step as queries may still read them.

    A table no file names may be of a writer at work; it goes once untouched for
    ``abandoned_seconds``. Rows in the root folder itself stay.
    """
    named = [name.split("-")[1] for name in _replacements(spark, root)]
    fs, path = _file_system(spark, f"{root}/{TABLES}")
    if not fs.exists(path):
        return
    before = (time.time() - abandoned_seconds) * 1000
    for status in fs.listStatus(path):
        folder = status.getPath().getName()
        if folder in named[:-1] or (folder not in named and status.getModificationTime() <= before):
            fs.delete(status.getPath(), True)
