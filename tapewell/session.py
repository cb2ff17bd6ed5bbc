"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
# Generated methods beyond this size are not compiled by the JVM but interpreted, which costs
# more than not fusing the operators; Spark's own default allows much larger ones.
METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT = "8000"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tapewell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings below; anything in ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        STATE_STORE_CONF: ROCKSDB,
        METHOD_LIMIT_CONF: METHOD_LIMIT,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings results depend on, on a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(STATE_STORE_CONF, ROCKSDB)
    spark.conf.set(METHOD_LIMIT_CONF, METHOD_LIMIT)
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application for stateful streams.

    A stateful stream opens one state store per shuffle partition and keeps that
    number for good. Choose ``state_partitions`` for the state the stream will hold at
    its largest; without it the session's own number of shuffle partitions stays.
    """
    session = ensure_session(spark.newSession())
    session.conf.set(
        "spark.sql.shuffle.partitions",
        str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")),
    )
    return session


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder named by the cluster.

    A session that names none has its warehouse, which all executors share as well.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage so that every later branch sees the same rows, also after an
    executor is lost, and keeps column pruning for what follows. The write's shuffle files
    go with it: nothing reads them again.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)
