"""The live plan, landed tables as ordered streams, topics with damaged records, limits by rank."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tapewell.config import QUARANTINE_TOPIC, default_feed
from tapewell.functions.events import decode_events, encode_event
from tapewell.operators.ordering import closed_windows_by_clock, late_records
from tapewell.operators.quality import windows_parity
from tapewell.schemas import EVENT_COLUMNS
from tapewell.sinks.lake import write_bronze
from tapewell.sinks.topics import publish_records, reject_records, topic_records
from tapewell.sources import ranges
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.lake import read_bronze
from tapewell.sources.raw import read_raw_messages, stream_raw_messages
from tapewell.sources.topics import read_topic_events, stream_topic_events
from tapewell.streaming import windows as streamed
from tapewell.streaming.live import read_commits, read_live, start_live
from tapewell.streaming.windows import read_stream_output, stream_landed_windows
from tests.conftest import at, quote, trade
from tests.test_ordering import late_market


def line(seq: int, *prices: str, seconds: float | None = None) -> str:
    moment = at(20 * seq if seconds is None else seconds).isoformat()
    trades = [
        {"product_id": "ETH-USD", "trade_id": f"{seq}-{k}", "price": p, "size": "2", "time": moment, "side": "SELL"}
        for k, p in enumerate(prices)
    ]
    payload = {"channel": "market_trades", "events": [{"type": "update", "trades": trades}]}
    head = {"seq": seq, "ts_recorded": moment, "exchange": "coinbase", "channel": "market_trades"}
    return json.dumps({**head, "payload": payload})


class Live:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.out = spark, folder, str(folder / "out")
        (folder / "in").mkdir()

    def send(self, name, *lines):
        (self.folder / "in" / f"{name}.jsonl").write_text("\n".join(lines) + "\n")

    def run(self, **options):
        start_live(
            stream_raw_messages(self.spark.newSession(), str(self.folder / "in")),
            self.out,
            str(self.folder / "checkpoint"),
            symbol_dimension(self.spark, default_feed()),
            {"1m": 60},
            2,
            ts_ingest=F.col("ts_recorded"),
            **options,
        ).awaitTermination()

    def rows(self, name):
        return sorted(map(str, read_live(self.spark, self.out, name).collect()))


@pytest.mark.parametrize("dies_after", ["bronze", "quarantine", "windows"])
def test_tables_of_a_batch_become_visible_together(spark, tmp_path, dies_after):
    live = Live(spark, tmp_path)
    assert live.rows("bronze") == [] and read_commits(spark, live.out).count() == 0
    live.send("a", *[line(k, "5", "0") for k in range(5)], "no message")
    live.run()
    before = {name: live.rows(name) for name in ("bronze", "quarantine", "windows", "late")}
    assert [len(x) for x in before.values()] == [5, 6, 1, 0]

    def die(name, batch_id):
        if name == dies_after:
            raise RuntimeError("killed")

    live.send("b", line(9, "7"), line(10, "7"), line(11, "7", seconds=50))
    with pytest.raises(StreamingQueryException):
        live.run(landed=die)
    assert {name: live.rows(name) for name in before} == before
    live.run()
    assert [len(live.rows(name)) for name in before] == [8, 6, 2, 1]
    commits = read_commits(spark, live.out).orderBy("batch_id").collect()
    assert [(c.batch_id, c.events, c.bronze_rows, c.rejects, c.window_rows, c.late_rows) for c in commits] == [
        (0, 5, 5, 6, 1, 0),
        (1, 3, 3, 0, 1, 1),
    ]


def test_a_committed_batch_is_left_alone_and_emitted_before_its_commit(spark, tmp_path, monkeypatch):
    from tapewell.streaming import live as plan

    live = Live(spark, tmp_path)
    live.send("a", line(0, "5"), line(9, "6", "x"))
    emitted = []
    live.run(emit=lambda name, df, folder: emitted.append((name, df.count(), read_commits(spark, live.out).count())))
    assert emitted == [("windows", 1, 0), ("quarantine", 1, 0)]
    folder = spark.read.parquet(f"{live.out}/commits").first()["run"]
    closing = streamed.Closing(str(tmp_path / "s"), live.out, folder, {"1m": 60}, 2, 100)
    written = []
    again = plan._Plan(live.out, None, None, closing, None, lambda *x: written.append(x))
    again.take(spark.createDataFrame([], "seq long, ts_recorded timestamp, exchange string, payload string"), 0)
    assert written == []


def test_ranges_cover_a_table_with_gaps(frame):
    numbers = [*range(50), *range(10**12, 10**12 + 70), 10**15]
    df = frame([trade("BTC-USD", 1.0, 1.0, k, arrival_seq=n) for k, n in enumerate(numbers)])
    cut = ranges.cut_ranges(df, 20)
    assert cut[0][0] == 0 and cut[-1][1] == 10**15
    assert all(a[1] + 1 == b[0] for a, b in zip(cut[:-1], cut[1:], strict=True))
    held = [sum(a <= n <= b for n in numbers) for a, b in cut]
    assert sum(held) == len(numbers) and 0 < min(held) and max(held) <= 40 and len(cut) >= 5
    assert ranges.cut_ranges(df.where("false"), 20) == []


def test_a_landed_table_streams_in_order_and_goes_on_after_a_stop(spark, frame, tmp_path, monkeypatch):
    rows = late_market(240)
    root, out, checkpoint = (str(tmp_path / x) for x in ("bronze", "out", "checkpoint"))
    write_bronze(frame(rows), root)
    table = read_bronze(spark, root)
    take, seen = streamed.Closing.take, []

    def dying(self, batch, batch_id):
        seen.append((batch_id, batch.count()))
        if len(seen) == 3:
            raise RuntimeError("killed")
        return take(self, batch, batch_id)

    monkeypatch.setattr(streamed.Closing, "take", dying)
    sizes = {"1m": 60, "5m": 300}
    with pytest.raises(StreamingQueryException):
        stream_landed_windows(table, out, checkpoint, sizes, 5, 60)
    stream_landed_windows(table, out, checkpoint, sizes, 5, 60)
    assert [k for k, _ in seen] == [0, 1, 2, 2, 3] and max(n for _, n in seen) <= 120
    windows, late = read_stream_output(spark, out)
    batch = closed_windows_by_clock(frame(rows), sizes, 5)
    assert batch.count() > 5 and windows_parity(windows, batch).count() == 0
    assert sorted(late.collect()) == sorted(late_records(frame(rows), sizes, 5).collect())


def test_a_damaged_record_does_not_end_a_consuming_stream(spark, frame, tmp_path):
    rows = [quote("SOL-USD", 2.0, 1.0, 5), trade("SOL-USD", 3.0, 1.0, 6), trade("ETH-USD", -1.0, 1.0, 7)]
    good = topic_records(frame(rows))
    bad = spark.createDataFrame([("trades.raw", "SOL-USD", "[1]"), ("trades.raw", None, None)], good.schema)
    topics, out = str(tmp_path / "topics"), str(tmp_path / "out")
    publish_records(good.unionByName(bad), path=topics)
    events, rejects = read_topic_events(spark, topics)
    # Events that break the contract travel on; what is no event does not.
    assert events.count() == 3 and {r.reason for r in rejects.collect()} == {"not a JSON object"}
    stream, refused = stream_topic_events(spark, topics, topics=["trades.raw"])
    for df, name in ((stream, "events"), (refused, "rejects")):
        writer = df.writeStream.format("parquet").option("path", f"{out}/{name}")
        writer.option("checkpointLocation", f"{out}/c-{name}").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.price for r in spark.read.parquet(f"{out}/events").collect()) == [-1.0, 3.0]
    records = reject_records(spark.read.schema(refused.schema).parquet(f"{out}/rejects")).collect()
    assert {r.topic for r in records} == {QUARANTINE_TOPIC} and {r.key for r in records} == {"SOL-USD", None}
    assert {json.loads(r.value)["topic"] for r in records} == {"trades.raw"}


def test_reasons_of_refused_texts(spark, frame):
    whole = json.loads(frame([trade("BTC-USD", 3.0, 1.0, 6)]).select(encode_event().alias("v")).first().v)
    texts = {
        "read": whole,
        "unknown fields: colour": {**whole, "colour": 1},
        "missing field: symbol": {**whole, "symbol": None},
        "unreadable field: price": {**whole, "price": "much"},
        "unknown side: up": {**whole, "side": "up"},
        "not a JSON object": [1],
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in texts.items()] + [("null", None)], "k string, value string")
    events, rejects = decode_events(df)
    assert [r.k for r in events.collect()] == ["read"] and events.columns == ["k", *EVENT_COLUMNS]
    got = {r.k: r.reason for r in rejects.collect()}
    assert got.pop("null") == "not a JSON object"
    assert got == {k: k for k in texts if k != "read"}


def test_limit_takes_the_first_numbers_without_gathering_messages(spark, tmp_path):
    numbers = [10**12, 7, 3, 3, 900, 7, 12]
    (tmp_path / "a.jsonl").write_text("\n".join(line(n % 50, "1").replace(f'"seq": {n % 50}', f'"seq": {n}') for n in numbers))
    taken = {k: sorted(r.seq for r in read_raw_messages(spark, str(tmp_path), k).collect()) for k in (0, 1, 2, 3, 6, 7, 99)}
    assert taken[0] == [] and taken[1] == taken[2] == [3, 3]
    assert taken[3] == [3, 3, 7, 7] and taken[6] == [3, 3, 7, 7, 12, 900] and taken[7] == taken[99] == sorted(numbers)
    plan = read_raw_messages(spark, str(tmp_path), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan and "Limit" not in plan
