"""Gold as snapshots: data folders of one writer each, named by a versioned log.

Layout under the table root::

    data/<folder>/snapshot_id=<s>/*.parquet     what one writer wrote
    commits/version=<n>/*.json                  one row per snapshot, and the folder

Readers only see folders that the newest version of the log names, so a job that dies
while writing leaves nothing visible. A rebuild starts a new generation. Writers do not
wait for each other: each writes to a folder of its own and then claims the next free
version of the log by a rename that does not replace; who finds it taken claims the one
after. Two rebuilds at once thus leave two whole generations, the later commit the current
one. The file system's rename must not replace a folder (HDFS and local ones don't); on
stores without such a rename use ``write_gold_iceberg``, where the Iceberg runtime is on
the class path.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewell.schemas import GOLD_SCHEMA, SNAPSHOT_LOG_SCHEMA

FIRST_SIZE = "1m"
COMMIT_ATTEMPTS = 20
# Data that no commit names counts as left behind by a dead writer after this long.
ABANDONED_SECONDS = 7 * 86_400

_ENTRY_SCHEMA = T.StructType([*SNAPSHOT_LOG_SCHEMA.fields, T.StructField("folder", T.StringType())])
_LOG_SCHEMA = T.StructType([*_ENTRY_SCHEMA.fields, T.StructField("version", T.LongType())])


def _commits_path(root: str) -> str:
    return f"{root}/commits"


def _snapshot_path(root: str, folder: str, snapshot_id: int) -> str:
    return f"{root}/data/{folder}/snapshot_id={snapshot_id}"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all versions of the log; empty before the first build."""
    try:
        return spark.read.schema(_LOG_SCHEMA).json(_commits_path(root))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG_SCHEMA)


def _snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    """Entries of the newest version."""
    log = _commits(spark, root)
    current = log.agg(F.max("version").alias("version"))
    return log.join(current, "version").select(*_ENTRY_SCHEMA.fieldNames())


def _rows(spark: SparkSession, path: str) -> int:
    """Rows in a snapshot folder, from its Parquet footers; 0 if it was not written."""
    try:
        return spark.read.schema(GOLD_SCHEMA).parquet(path).count()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def _next_version(spark: SparkSession, root: str) -> int:
    newest = _commits(spark, root).agg(F.max("version")).first()[0]
    return 0 if newest is None else newest + 1


def _claim(spark: SparkSession, written: str, version_path: str) -> bool:
    """Rename ``written`` to ``version_path``; False if that is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(written), hadoop.Path(version_path)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    source, target = fs.makeQualified(source), fs.makeQualified(target)
    kind = getattr(hadoop, "Options$Rename")
    keep = spark.sparkContext._gateway.new_array(kind, 1)
    keep[0] = kind.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(source, target, keep)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in exc.java_exception.getClass().getName():
            raise
        return False
    return True


def _commit(spark: SparkSession, root: str, entries: list[tuple]) -> int:
    """Add ``entries`` to the log as its next free version; returns the version.

    A generation is committed once: a second commit of it is refused.
    """
    generation, folder = entries[0][2], entries[0][-1]
    for _ in range(COMMIT_ATTEMPTS):
        if not _commits(spark, root).filter(F.col("generation") == generation).isEmpty():
            raise ValueError(f"generation {generation} is committed already")
        version = _next_version(spark, root)
        # Hidden from readers wherever it ends up, until it has the name of a version.
        written = f"{root}/_pending/_{uuid.uuid4().hex}"
        spark.createDataFrame(entries, _ENTRY_SCHEMA).coalesce(1).write.json(written)
        path = f"{_commits_path(root)}/version={version}"
        if _claim(spark, written, path):
            # A local rename that loses the race moves its folder into the winner's.
            mine = spark.read.schema(_ENTRY_SCHEMA).json(path).filter(F.col("folder") == folder)
            if not mine.isEmpty():
                return version
    raise RuntimeError(f"no free version of the log after {COMMIT_ATTEMPTS} attempts")


def gold_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots of the current generation in chronological order."""
    return _snapshot_log(spark, root).select(*SNAPSHOT_LOG_SCHEMA.fieldNames()).orderBy("seq")


def gold_history(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit, oldest first: version, generation, snapshots and rows in them."""
    return (
        _commits(spark, root)
        .groupBy("version", "generation")
        .agg(F.count("snapshot_id").alias("snapshots"), F.sum("rows").alias("rows"))
        .orderBy("version")
    )


def materialize_gold(
    gold: DataFrame, root: str, generation: int | None = None
) -> tuple[int | None, int | None]:
    """Rebuild gold as two appends: the 1m windows, then the rest.

    Both are written by one job, so gold is computed once. An append without rows
    makes no snapshot, and the id returned for it is that of the one before, or
    None. ``generation`` only needs to be given to make ids repeatable; one that is
    committed already is refused. Others may rebuild at the same time.
    """
    spark = gold.sparkSession
    generation = generation if generation is not None else time.time_ns()
    folder = f"generation-{generation}-{uuid.uuid4().hex[:12]}"
    ids = (generation * 2, generation * 2 + 1)
    which = F.when(F.col("window_size") == FIRST_SIZE, F.lit(ids[0])).otherwise(F.lit(ids[1]))
    (
        gold.select(*GOLD_SCHEMA.fieldNames())
        .withColumn("snapshot_id", which)
        .hint("rebalance", "snapshot_id")
        .write.partitionBy("snapshot_id")
        .parquet(f"{root}/data/{folder}")
    )
    sizes = {i: _rows(spark, _snapshot_path(root, folder, i)) for i in ids}
    entries = [
        (snapshot_id, seq, generation, sizes[snapshot_id], folder)
        for seq, snapshot_id in enumerate(ids)
        if sizes.get(snapshot_id)
    ]
    if not entries:
        # Nothing to show: an entry of its own makes the empty generation current.
        entries = [(None, 0, generation, 0, folder)]
    _commit(spark, root, entries)
    first = ids[0] if sizes.get(ids[0]) else None
    second = ids[1] if sizes.get(ids[1]) else first
    return first, second


def read_gold(spark: SparkSession, root: str, snapshot_id: int | None = None) -> DataFrame:
    """Current gold, or gold as it was right after ``snapshot_id``."""
    # The log of one generation has at most two rows.
    log = [r for r in _snapshot_log(spark, root).orderBy("seq").collect() if r["snapshot_id"] is not None]
    if snapshot_id is not None:
        wanted = [r for r in log if r["snapshot_id"] == snapshot_id]
        if not wanted:
            raise ValueError(f"no snapshot {snapshot_id} in the current generation")
        log = [r for r in log if r["seq"] <= wanted[0]["seq"]]
    if not log:
        return spark.createDataFrame([], GOLD_SCHEMA)
    paths = [_snapshot_path(root, r["folder"], r["snapshot_id"]) for r in log]
    return spark.read.schema(GOLD_SCHEMA).parquet(*paths)


def purge_old_generations(
    spark: SparkSession, root: str, abandoned_seconds: float = ABANDONED_SECONDS
) -> None:
    """Delete the data of generations that are no longer current.

    A separate step, because queries that started before a rebuild still read them. Data
    that no commit names may be of a writer at work; it goes once untouched for
    ``abandoned_seconds``. The log itself stays.
    """
    current = {r["folder"] for r in _snapshot_log(spark, root).select("folder").distinct().collect()}
    named = {r["folder"] for r in _commits(spark, root).select("folder").distinct().collect()}
    data = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    fs = data.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(data):
        return
    before = (time.time() - abandoned_seconds) * 1000
    for status in fs.listStatus(data):
        folder = status.getPath().getName()
        if folder in current:
            continue
        if folder in named or status.getModificationTime() <= before:
            fs.delete(status.getPath(), True)


def write_gold_iceberg(gold: DataFrame, table: str) -> None:
    """The same two appends into an Iceberg table; needs its runtime and a catalog."""
    typed = gold.select(*GOLD_SCHEMA.fieldNames())
    first = F.col("window_size") == FIRST_SIZE
    typed.where(first).writeTo(table).using("iceberg").createOrReplace()
    typed.where(~first).writeTo(table).append()
