from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapewell.config import default_feed
from tapewell.operators.normalize import normalize
from tapewell.operators.ordering import closed_windows_by_clock, late_records
from tapewell.operators.quality import windows_parity
from tapewell.schemas import BRONZE_SCHEMA, RAW_SCHEMA
from tapewell.session import streaming_session
from tapewell.sinks.lake import record_emitter, start_bronze_sink, write_bronze
from tapewell.sinks.topics import parse_window_records, window_records
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.lake import read_bronze
from tapewell.sources.raw import stream_raw_messages
from tapewell.streaming.normalizing import stream_normalize
from tapewell.streaming.windows import (
    Closing,
    read_stream_output,
    run_stream,
    stream_landed_windows,
    stream_ticker_windows,
    stream_trade_windows,
    stream_windows,
    stream_windows_global,
)
from tests.conftest import at, quote, trade
from tests.test_ordering import late_market


class Feed:
    """A folder of Parquet files that arrive one at a time."""

    def __init__(self, spark, frame, folder):
        self.spark, self.frame, self.folder, self.sent = spark, frame, folder, 0

    def send(self, rows):
        numbered = [{**row, "arrival_seq": self.sent + i} for i, row in enumerate(rows)]
        self.sent += len(rows)
        self.frame(numbered).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def stream(self):
        session = streaming_session(self.spark, 8)
        return session.readStream.schema(BRONZE_SCHEMA).parquet(f"{self.folder}/in")

    def drain(self, build=stream_windows, *args):
        out, checkpoint = f"{self.folder}/out", f"{self.folder}/checkpoint"
        build(self.stream(), out, checkpoint, *args).awaitTermination()
        return read_stream_output(self.spark, f"{self.folder}/out")


@pytest.fixture
def feed(spark, frame, tmp_path):
    return Feed(spark, frame, str(tmp_path))


def naive(seconds):
    return at(seconds).replace(tzinfo=None)


def test_late_records_miss_the_windows_that_closed(feed):
    # Ten-second and one-minute windows, a grace of four seconds, ETH's clock at 44 in the end.
    rows = [trade("ETH-USD", 20.0 + s, 2.0, s) for s in (3, 8, 19, 31, 44)]
    rows += [trade("ETH-USD", 7.5, 1.0, 9.5), trade("ETH-USD", 7.5, 1.0, 35.25)]
    rows += [quote("ETH-USD", 4.0, 4.5, 2)]  # quotes have a clock of their own
    feed.send(rows)
    windows, late = feed.drain(stream_windows, {"10s": 10, "1m": 60}, 4)
    closed = {r.window_start: (r.trade_count, r.trade_volume) for r in windows.collect()}
    assert closed == {naive(0): (2, 4.0), naive(10): (1, 2.0), naive(30): (1, 2.0)}
    assert sorted((r.event_ts, r.window_size, r.window_end) for r in late.collect()) == [
        (naive(9.5), "10s", naive(10)),
        (naive(35.25), "10s", naive(40)),  # the clock had just reached the end and the grace
    ]


def test_a_symbol_closes_by_its_own_clock_alone(feed):
    rows = [quote("BTC-USD", 1.0, 2.0, s) for s in (100, 350, 901)]
    rows += [quote("ETH-USD", 3.0, 4.0, 299), trade("BTC-USD", 5.0, 1.0, 10)]
    feed.send(rows)
    windows, late = feed.drain(stream_windows, {"5m": 300}, 1)
    assert sorted((r.symbol, r.source, r.window_start) for r in windows.collect()) == [
        ("BTC-USD", "ticker", naive(0)),
        ("BTC-USD", "ticker", naive(300)),
    ]
    assert late.count() == 0


def test_state_lives_across_batches(feed):
    sizes = {"1m": 60}
    feed.send([trade("BTC-USD", 100.0, 1.0, 10)])
    assert feed.drain(stream_windows, sizes, 5)[0].count() == 0
    feed.send([trade("BTC-USD", 200.0, 3.0, 30), trade("BTC-USD", 1.0, 1.0, 64.999)])
    assert feed.drain(stream_windows, sizes, 5)[0].count() == 0
    feed.send([trade("BTC-USD", 1.0, 1.0, 65)])
    windows, late = feed.drain(stream_windows, sizes, 5)
    (first,) = windows.collect()
    assert (first.vwap, first.trade_volume, first.trade_count) == (175.0, 4.0, 2)
    assert late.count() == 0
    feed.send([trade("BTC-USD", 9.0, 9.0, 59), trade("BTC-USD", 1.0, 1.0, 125)])
    windows, late = feed.drain(stream_windows, sizes, 5)
    assert windows.count() == 2  # nothing is emitted twice
    assert [r.event_ts for r in late.collect()] == [naive(59)]


@pytest.mark.parametrize("span", [17, 1 << 30])
def test_stream_equals_its_batch_definition(feed, frame, span):
    rows = late_market(300)
    for start in range(0, 300, 120):
        feed.send(rows[start : start + 120])
        windows, late = feed.drain(stream_windows, {"1m": 60, "5m": 300}, 5, span)
    df = frame(rows)
    batch = closed_windows_by_clock(df, {"1m": 60, "5m": 300}, 5)
    assert batch.count() > 10
    assert windows_parity(windows, batch).count() == 0
    assert sorted(late.collect()) == sorted(late_records(df, {"1m": 60, "5m": 300}, 5).collect())


def test_each_side_alone(feed):
    rows = [trade("BTC-USD", 2.0, 1.0, s) for s in (1, 70)]
    feed.send(rows + [quote("BTC-USD", 1.0, 3.0, s) for s in (1, 2, 70)])
    sizes = {"1m": 60}
    (of_trades,) = feed.drain(stream_trade_windows, sizes, 5)[0].collect()
    assert (of_trades.source, of_trades.vwap, of_trades.ticker_count) == ("trades", 2.0, 0)
    feed.folder += "-again"
    feed.send(rows + [quote("BTC-USD", 1.0, 3.0, s) for s in (1, 2, 70)])
    (of_quotes,) = feed.drain(stream_ticker_windows, sizes, 5)[0].collect()
    assert (of_quotes.avg_spread, of_quotes.avg_mid, of_quotes.ticker_count) == (2.0, 2.0, 2)
    assert (of_quotes.vwap, of_quotes.trade_volume, of_quotes.event_count) == (None, 0.0, 2)


def test_global_watermark_closes_quiet_symbols(feed):
    feed.send([trade("SOL-USD", 50.0, 1.0, 10)])
    feed.send([trade("BTC-USD", 100.0, 1.0, s) for s in (10, 70, 130)])
    out = stream_windows_global(feed.stream(), {"1m": 60}, "5 seconds")
    run_stream(out, f"{feed.folder}/g", f"{feed.folder}/gc", ("source",)).awaitTermination()
    rows = feed.spark.read.parquet(f"{feed.folder}/g").collect()
    assert {(r.symbol, r.window_start) for r in rows} == {
        ("SOL-USD", naive(0)),
        ("BTC-USD", naive(0)),
        ("BTC-USD", naive(60)),
    }


def test_windows_travel_as_json(feed):
    feed.send([trade("BTC-USD", 2.0, 1.0, s) for s in (1, 70)])
    write = record_emitter(path=f"{feed.folder}/records")
    stream_windows(
        feed.stream(),
        f"{feed.folder}/out",
        f"{feed.folder}/rc",
        {"1m": 60},
        5,
        emit=lambda closed, batch: write(window_records(closed), batch),
    ).awaitTermination()
    lines = feed.spark.read.schema("value string").text(f"{feed.folder}/records")
    record = json.loads(lines.first().value)
    assert record["window_start"] == "2026-03-01T00:00:00+00:00"
    assert record["source"] == "trades" and record["avg_mid"] is None
    assert parse_window_records(lines).first().window_end == naive(60)


def test_bronze_sink_lands_each_row_once(feed, spark):
    for start in (0, 10):
        feed.send([trade("BTC-USD", 2.0, 1.0, start + i) for i in range(10)])
        root = f"{feed.folder}/bronze"
        start_bronze_sink(feed.stream(), root, f"{feed.folder}/bc").awaitTermination()
    assert spark.read.parquet(root).count() == 20


def test_live_normalization_isolates_bad_records(spark, tmp_path):
    source = tmp_path / "feed"
    source.mkdir()

    def message(seq, *prices):
        trades = [
            {"product_id": "BTC-USD", "trade_id": f"{seq}", "price": p, "size": "1",
             "time": "2026-01-01T00:00:00Z", "side": "BUY"}
            for p in prices
        ]
        payload = {"channel": "market_trades", "events": [{"type": "update", "trades": trades}]}
        return json.dumps({"seq": seq, "ts_recorded": "2026-01-01T00:00:00Z",
                           "exchange": "coinbase", "payload": payload})

    dim = symbol_dimension(spark, default_feed())
    for i, prices in enumerate((("1", "-1", "2"), ("x",), ("3",))):
        (source / f"{i}.jsonl").write_text(message(i, *prices) + "\n")
        stream_normalize(
            stream_raw_messages(spark, str(source)),
            dim,
            str(tmp_path / "events"),
            str(tmp_path / "bad"),
            str(tmp_path / "checkpoint"),
            ts_ingest=F.col("ts_recorded"),
        ).awaitTermination()
    events = read_bronze(spark, str(tmp_path / "events"))
    assert sorted(r.price for r in events.collect()) == [1.0, 2.0, 3.0]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    with pytest.raises(ValueError, match="folder or Kafka"):
        stream_raw_messages(spark)

    # A new checkpoint numbers its batches from 0 again and must not touch what is there.
    before = spark.read.parquet(str(tmp_path / "events")).count()
    stream_normalize(
        stream_raw_messages(spark, str(source)),
        dim,
        str(tmp_path / "events"),
        str(tmp_path / "bad"),
        str(tmp_path / "other"),
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "events")).count() == 2 * before


def test_live_feed_goes_on_after_unreadable_lines(spark, tmp_path):
    source = tmp_path / "feed"
    source.mkdir()
    head = '"seq": 7, "ts_recorded": "2026-01-01T00:00:00Z"'
    good = {"channel": "market_trades", "events": [{"type": "update", "trades": [
        {"product_id": "BTC-USD", "trade_id": "1", "price": "4", "size": "2",
         "time": "2026-01-01T00:00:00Z", "side": "SELL"}]}]}
    lines = [
        "{broken",
        f'{{{head}, "exchange": "nowhere", "payload": {{"a": 1}}}}',
        f'{{{head}, "exchange": "coinbase", "payload": {json.dumps(good)}}}',
        f'{{{head}, "exchange": "coinbase", "payload": "text"}}',
        "",
    ]
    (source / "a.jsonl").write_text("\n".join(lines))
    stream_normalize(
        stream_raw_messages(spark, str(source)),
        symbol_dimension(spark, default_feed()),
        str(tmp_path / "events"),
        str(tmp_path / "bad"),
        str(tmp_path / "checkpoint"),
    ).awaitTermination()
    assert [r.price for r in read_bronze(spark, str(tmp_path / "events")).collect()] == [4.0]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r.exchange, r.seq, r.reason) for r in bad) == [
        ("coinbase", 7, "malformed raw message"),
        ("nowhere", 7, "no normalizer for exchange nowhere"),
        ("unknown", 0, "malformed raw message"),
    ]
    assert lines[0] in {r.payload for r in bad}


def test_message_numbers_and_positions_are_kept_apart(spark):
    trades = [
        {"product_id": "BTC-USD", "trade_id": f"{i}", "price": f"{i + 1}", "size": "1",
         "time": "2026-01-01T00:00:00Z", "side": "BUY"}
        for i in range(500)
    ]
    payload = {"channel": "market_trades", "events": [{"type": "update", "trades": trades}]}
    raw = spark.createDataFrame(
        [(1 << 50, at(0), "coinbase", "market_trades", json.dumps(payload))], RAW_SCHEMA
    )
    events, rejects = normalize(raw, symbol_dimension(spark, default_feed()))
    assert rejects.isEmpty()
    in_order = events.where(F.col("price") == F.col("arrival_pos") + 1)
    assert in_order.where(F.col("arrival_seq") == 1 << 50).count() == 500


class Batches:
    """Micro-batches given to the closing of windows one by one."""

    def __init__(self, spark, frame, folder, quiet=None):
        self.spark, self.frame, self.folder, self.sent = spark, frame, folder, []
        self.closing = Closing(f"{folder}/state", f"{folder}/out", "r", {"10s": 10}, 2, 16, quiet)

    def take(self, *rows, batch=None):
        if batch is None:
            at_row = sum(map(len, self.sent))
            self.sent.append([{**row, "arrival_seq": at_row + i} for i, row in enumerate(rows)])
            batch = len(self.sent) - 1
        self.closing.take(self.frame(self.sent[batch]), batch)

    def states(self):
        return sorted(p.name for p in Path(f"{self.folder}/state/run=r").iterdir())

    def output(self):
        windows, late = read_stream_output(self.spark, f"{self.folder}/out")
        rows = windows.select("symbol", "window_start", "trade_count", "trade_volume").collect()
        return sorted(map(tuple, rows)), sorted((r.symbol, r.event_ts) for r in late.collect())


def test_state_of_old_batches_goes_and_a_repeat_is_exact(spark, frame, tmp_path):
    run = Batches(spark, frame, tmp_path)
    for k in range(5):
        run.take(trade("SOL-USD", 3.0, 1.0, 8 * k), trade("SOL-USD", 3.0, 2.0, 8 * k + 5))
        assert run.states() == [f"batch_id={i}" for i in (k - 1, k) if i >= 0]
    before = run.output()
    run.take(batch=4)
    assert run.output() == before and run.states() == ["batch_id=3", "batch_id=4"]
    whole = frame([row for batch in run.sent for row in batch])
    expected = closed_windows_by_clock(whole, {"10s": 10}, 2)
    columns = ("symbol", "window_start", "trade_count", "trade_volume")
    assert before[0] == sorted(map(tuple, expected.select(*columns).collect()))


def test_quiet_symbols_leave_the_state(spark, frame, tmp_path):
    run = Batches(spark, frame, tmp_path, quiet=20)
    run.take(trade("ADA-USD", 1.0, 1.0, 1), trade("SOL-USD", 3.0, 1.0, 2))
    run.take(trade("SOL-USD", 3.0, 1.0, 50))
    assert [r[0] for r in run.output()[0]] == ["SOL-USD"]  # judged by the clocks left before
    run.take(trade("SOL-USD", 3.0, 1.0, 51))
    assert ("ADA-USD", naive(0), 1, 1.0) in run.output()[0]  # closes with what it holds
    run.take(trade("SOL-USD", 3.0, 1.0, 52))
    clocks = spark.read.parquet(f"{tmp_path}/state/run=r/batch_id=3/clocks")
    assert [r.symbol for r in clocks.collect()] == ["SOL-USD"]
    # Back again: its closed window does not come out twice, new ones do.
    run.take(trade("ADA-USD", 1.0, 7.0, 4), trade("ADA-USD", 1.0, 4.0, 53), trade("ADA-USD", 1.0, 4.0, 75))
    windows, late = run.output()
    ada = [w for w in windows if w[0] == "ADA-USD"]
    assert ada == [("ADA-USD", naive(0), 1, 1.0), ("ADA-USD", naive(50), 1, 4.0)]
    assert late == [("ADA-USD", naive(4))]
    with pytest.raises(ValueError, match="12 seconds"):
        Batches(spark, frame, tmp_path, quiet=11)


def test_a_micro_batch_reads_only_the_files_of_its_ranges(spark, tmp_path):
    """Landed files hold all arrival numbers each; a micro-batch must not scan all of them."""
    from tapewell.sources.ranges import kept_rows, rows_in_ranges

    rows = [(n, "ab"[n % 2]) for n in range(40)] + [(None, "a")]
    spark.createDataFrame(rows, "arrival_seq long, symbol string").repartition(3).write.partitionBy("symbol").parquet(
        str(tmp_path / "landed")
    )
    events = spark.read.parquet(str(tmp_path / "landed"))
    ranges = [[0, 9], [10, 19], [20, 29], [30, 39]]
    kept = kept_rows(spark, events, ranges, str(tmp_path / "checkpoint"))
    batch = spark.createDataFrame([(1, 10, 19), (2, 20, 29)], "number long, low long, high long")
    taken = rows_in_ranges(kept, batch)
    assert taken.columns == events.columns
    assert sorted(r.arrival_seq for r in taken.collect()) == list(range(10, 30))
    read = {r.f for r in taken.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and all("_range=1" in f or "_range=2" in f for f in read)
    # Written once per checkpoint: a second call reads the copy that is there.
    again = kept_rows(spark, events.limit(0), ranges, str(tmp_path / "checkpoint"))
    assert again.count() == 40


def test_a_small_batch_is_taken_by_one_task_a_table(spark, frame, tmp_path):
    """Sharing out a few thousand rows costs more than the work on them, batch after batch."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    run = Batches(own, frame, tmp_path)
    run.closing.span = 1000
    run.closing.most_rows = 60
    context, rows = spark.sparkContext, late_market(180)
    for k in range(3):
        path = f"{tmp_path}/in/{k}"
        numbered = [{**row, "arrival_seq": 60 * k + i} for i, row in enumerate(rows[60 * k : 60 * k + 60])]
        frame(numbered).repartition(3).write.parquet(path)
        batch = own.read.schema(BRONZE_SCHEMA).parquet(path)
        context.setJobGroup(f"small-{tmp_path}-{k}", "a small batch")
        try:
            run.closing.take(batch, k)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(f"small-{tmp_path}-2")]
    stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    assert len(jobs) == 4 and [stage.numTasks for stage in stages] == [1] * 4
    df = frame([{**row, "arrival_seq": i} for i, row in enumerate(rows)])
    windows, late = read_stream_output(spark, f"{tmp_path}/out")
    batch = closed_windows_by_clock(df, {"10s": 10}, 2)
    assert batch.count() > 5 and windows_parity(windows, batch).count() == 0
    assert sorted(late.collect()) == sorted(late_records(df, {"10s": 10}, 2).collect())


@pytest.mark.parametrize("span", [16, 1 << 16])
def test_a_landed_table_closes_the_same_windows_in_small_and_large_batches(spark, frame, tmp_path, span):
    """With rows that have no symbol, no time or no number, and rows that come twice."""
    rows = [{**row, "arrival_seq": i} for i, row in enumerate(late_market(200))]
    rows += [{**rows[i]} for i in (20, 20, 133)]
    rows += [{**rows[40], "symbol": None}, {**rows[90], "ts_event": None}]
    write_bronze(frame([*rows, {**rows[60], "arrival_seq": None}]), str(tmp_path / "bronze"))
    out, sizes = str(tmp_path / "out"), {"1m": 60, "5m": 300}
    table = read_bronze(spark.newSession(), str(tmp_path / "bronze"))
    stream_landed_windows(table, out, str(tmp_path / "checkpoint"), sizes, 5, 45, span)
    windows, late = read_stream_output(spark, out)
    whole = read_bronze(spark, str(tmp_path / "bronze")).where("arrival_seq IS NOT NULL")
    batch = closed_windows_by_clock(whole, sizes, 5)
    assert batch.count() > 5 and windows_parity(windows, batch).count() == 0
    assert sorted(late.collect()) == sorted(late_records(whole, sizes, 5).collect())
