"""The whole run: raw messages to quarantine, bronze, streamed windows, marts and service levels."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.config import FeedConfig, default_feed
from tapewell.functions.windows import WINDOW_SIZES
from tapewell.landed import current_folder
from tapewell.operators.normalize import events_of, normalize_tagged, rejects_of, to_quarantine
from tapewell.operators.ordering import DEFAULT_GRACE_SECONDS, closed_windows_by_clock
from tapewell.operators.quality import reconcile, sla_report
from tapewell.plans.journal import LAST, Journal, fingerprint
from tapewell.plans.marts import build_marts
from tapewell.session import ensure_session
from tapewell.sinks.lake import land_quarantine, land_windows, write_bronze, write_run_summary
from tapewell.sinks.versioned import gold_snapshots, read_gold
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.lake import read_bronze
from tapewell.sources.ranges import ROWS_PER_BATCH
from tapewell.sources.raw import read_raw_messages
from tapewell.streaming.windows import read_stream_output, stream_landed_windows


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_medallion(
    spark: SparkSession,
    raw_path: str,
    root: str,
    config: FeedConfig | None = None,
    sizes: dict[str, int] = WINDOW_SIZES,
    grace_seconds: int = DEFAULT_GRACE_SECONDS,
    ts_ingest: Column | None = None,
    limit: int | None = None,
    run_checks: bool = True,
    streaming: bool = True,
    rows_per_batch: int = ROWS_PER_BATCH,
    built_at: datetime | None = None,
    resume: bool = False,
) -> DataFrame:
    """Run everything over recorded messages and return the one-row run summary.

    Tables land in fixed folders under ``root`` and replace those of the run
    before; what a run needs only for itself (stream output and checkpoint) goes
    to folders of its own, so runs cannot get in each other's way. The messages
    are parsed once: events and rejects are both taken from the persisted result.

    The closed windows come from a stream over bronze in order of arrival, about
    ``rows_per_batch`` rows a micro-batch; without ``streaming`` from their batch
    definition, which gives the same rows. ``built_at`` is when gold counts as built, the
    time of the report where it is not given.

    Finished stages are written down. With ``resume`` a run whose driver was lost is taken
    up at its first unfinished stage, if files and settings are the same and its tables
    have not been replaced since; otherwise, and after a finished run, all is done anew.
    Only resume a run that is no longer at work.
    """
    ensure_session(spark)
    paths = {name: f"{root}/{name}" for name in ("quarantine", "bronze", "windows", "gold")}
    config = config or default_feed()
    inputs = fingerprint(
        spark,
        raw_path,
        feed=repr(config),
        sizes=sizes,
        grace=grace_seconds,
        ingest=ts_ingest,
        limit=limit,
        checks=run_checks,
        streaming=streaming,
        rows_per_batch=rows_per_batch,
    )
    journal = Journal(spark, root, inputs, resume)

    def current(*names: str) -> dict[str, str]:
        return {name: current_folder(spark, paths[name]) for name in names}

    def land() -> dict:
        # One fixed time for the run, so that a recomputed partition comes out the same.
        ingest = ts_ingest if ts_ingest is not None else F.lit(_now())
        raw = read_raw_messages(spark, raw_path, limit)
        dim = symbol_dimension(spark, config)
        tagged = normalize_tagged(raw, dim, ingest).persist(StorageLevel.DISK_ONLY)
        try:
            n_rejects, n_events = tagged.agg(
                F.count_if(F.col("reason").isNotNull()), F.count_if(F.col("reason").isNull())
            ).first()
            quarantine = to_quarantine(rejects_of(tagged), F.lit(_now()))
            quarantined = reconcile(
                land_quarantine(quarantine, paths["quarantine"]), n_rejects, "quarantine"
            )
            bronze_rows = write_bronze(events_of(tagged), paths["bronze"])
            if n_events:
                reconcile(bronze_rows, n_events, "bronze")
        finally:
            tagged.unpersist()
        counts = {"events": n_events, "quarantined": quarantined, "bronze_rows": bronze_rows}
        return {**counts, "folders": current("quarantine", "bronze")}

    landed = journal.stage(
        "landed", land, lambda kept: kept["folders"] == current("quarantine", "bronze")
    )

    def close_windows() -> dict:
        if streaming:
            arrived = read_bronze(spark.newSession(), paths["bronze"])
            out = f"{root}/runs/{journal.run}/stream"
            checkpoint = f"{root}/runs/{journal.run}/checkpoint"
            stream_landed_windows(arrived, out, checkpoint, sizes, grace_seconds, rows_per_batch)
            closed, _late = read_stream_output(spark, out)
        else:
            closed = closed_windows_by_clock(read_bronze(spark, paths["bronze"]), sizes, grace_seconds)
        return {"rows": land_windows(closed, paths["windows"]), "folders": current("windows")}

    windows = journal.stage(
        "windows", close_windows, lambda kept: kept["folders"] == current("windows")
    )

    def snapshots() -> list[int]:
        return [r["snapshot_id"] for r in gold_snapshots(spark, paths["gold"]).collect()]  # two at most

    def marts() -> dict:
        built = build_marts(spark, paths["bronze"], paths["gold"], sizes, run_checks)
        return {"gold_rows": built.gold_rows, "snapshots": snapshots()}

    gold = journal.stage("marts", marts, lambda kept: kept["snapshots"] == snapshots())
    report = sla_report(
        read_bronze(spark, paths["bronze"]), read_gold(spark, paths["gold"]), built_at or _now(), sizes
    )
    summary = report.select(
        F.lit(landed["events"]).cast("bigint").alias("replayed_events"),
        F.lit(landed["bronze_rows"]).cast("bigint").alias("bronze_rows"),
        F.lit(windows["rows"]).cast("bigint").alias("window_rows"),
        F.lit(gold["gold_rows"]).cast("bigint").alias("gold_rows"),
        F.lit(len(gold["snapshots"])).cast("int").alias("gold_snapshots"),
        F.lit(landed["quarantined"]).cast("bigint").alias("quarantined"),
        "latency_p95_s",
        "completeness_pct",
        "gold_violations",
        F.col("passed").alias("sla_passed"),
    )

    def summarize() -> dict:
        write_run_summary(summary.coalesce(1), f"{root}/run_summary")
        return {}

    journal.stage(LAST, summarize)
    return spark.read.schema(summary.schema).json(f"{root}/run_summary")
