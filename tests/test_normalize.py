from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tapewell.config import FeedConfig, default_feed, load_feed
from tapewell.operators.normalize import (
    events_of,
    normalization_summary,
    normalize,
    normalize_binance_book,
    normalize_coinbase_ticker,
    normalize_tagged,
    reject_bad_envelope,
    rejects_of,
    to_quarantine,
)
from tapewell.schemas import RAW_SCHEMA
from tapewell.sinks.lake import with_capture_order, write_raw_messages
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.raw import count_raw_messages, read_raw_messages

INGEST = datetime(2026, 1, 1, tzinfo=timezone.utc)
T0 = "2026-01-01T00:00:00.000000Z"


@pytest.fixture(scope="module")
def dim(spark):
    return symbol_dimension(spark, default_feed())


def raw(spark, *payloads, exchange="coinbase"):
    texts = [p if isinstance(p, str) else json.dumps(p, separators=(",", ":")) for p in payloads]
    rows = [(i, INGEST, exchange, None, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def run(df, dim=None):
    events, rejects = normalize(df, dim, F.lit(INGEST))
    return events.orderBy("arrival_seq", "arrival_pos").collect(), rejects.collect()


def a_trade(product="BTC-USD", trade_id="1", price="100.0", size="1.0", time=T0, side="BUY"):
    fields = {
        "product_id": product,
        "trade_id": trade_id,
        "price": price,
        "size": size,
        "time": time,
        "side": side,
    }
    return {k: v for k, v in fields.items() if v is not ...}


def trades_message(*trades, type="update", **over):
    message = {
        "channel": "market_trades",
        "timestamp": T0,
        "sequence_num": 1,
        "events": [{"type": type, "trades": list(trades)}],
    }
    return {**message, **over}


def ticker_message(timestamp=T0, **tick):
    fields = {"type": "ticker", "product_id": "BTC-USD", **tick}
    message = {"channel": "ticker", "events": [{"type": "update", "tickers": [fields]}]}
    return message if timestamp is ... else {**message, "timestamp": timestamp}


def test_coinbase_trades(spark, dim):
    message = trades_message(
        a_trade(price="42000.50", size="0.01", time="2026-01-01T00:00:00.500000Z", trade_id="111"),
        a_trade("ETH-USD", "112", "2200.00", "1.5", "2026-01-01T00:00:01.000000Z", "SELL"),
    )
    (btc, eth), rejects = run(raw(spark, message), dim)
    assert (btc.symbol, btc.event_type, btc.side) == ("BTC-USD", "trade", "buy")
    assert (btc.price, btc.size, btc.trade_id) == (42000.5, 0.01, "111")
    assert btc.ts_event.microsecond == 500000
    assert (eth.symbol, eth.side) == ("ETH-USD", "sell")
    assert not rejects


def test_coinbase_ticker(spark, dim):
    message = ticker_message(
        "2026-01-01T00:00:02.123456789Z",
        price="42000.55",
        best_bid="42000.50",
        best_ask="42000.60",
        best_bid_quantity="0.5",
        best_ask_quantity="",
    )
    (tick,), _ = run(raw(spark, message), dim)
    assert tick.event_type == "ticker"
    assert (tick.best_bid, tick.best_ask, tick.best_bid_size) == (42000.5, 42000.6, 0.5)
    assert tick.best_ask_size is None and tick.size is None
    assert tick.ts_event.microsecond == 123456


def test_snapshots_are_skipped_for_trades_only(spark, dim):
    message = trades_message()
    message["events"] = [
        {"type": "snapshot", "trades": [a_trade(trade_id="old")]},
        {"type": "update", "trades": [a_trade(trade_id="new")]},
        {"trades": [a_trade(trade_id="untyped")]},
    ]
    events, _ = run(raw(spark, message), dim)
    assert [e.trade_id for e in events] == ["new", "untyped"]
    tick = ticker_message(best_bid="1", best_ask="2")
    tick["events"][0]["type"] = "snapshot"
    assert len(run(raw(spark, tick), dim)[0]) == 1


def test_one_bad_trade_keeps_its_siblings(spark, dim):
    message = trades_message(
        a_trade(trade_id="ok1"), a_trade(trade_id="bad", price="-5.0"), a_trade(trade_id="ok2")
    )
    events, rejects = run(raw(spark, message), dim)
    assert [e.trade_id for e in events] == ["ok1", "ok2"]
    assert json.loads(rejects[0].record)["trade_id"] == "bad"
    assert rejects[0].reason == "price must be > 0, got -5.0"


# What is wrong with a trade, and the reason it is rejected with.
BAD_TRADES = [
    (a_trade(product=...), "'product_id'"),
    (a_trade(price=...), "'price'"),
    (a_trade(price=None), "float() argument must be a string or a real number, not 'NoneType'"),
    (a_trade(price="abc"), "could not convert string to float: 'abc'"),
    (a_trade(price=""), "could not convert string to float: ''"),
    (a_trade(size="1.0d"), "could not convert string to float: '1.0d'"),
    (a_trade(time=...), "'time'"),
    (a_trade(time="yesterday"), "Invalid isoformat string: 'yesterday'"),
    (a_trade(time="2026"), "Invalid isoformat string: '2026'"),
    (5, "record is not an object"),
    ("text", "record is not an object"),
    (None, "record is not an object"),
]


def by_seq(rejects):
    return {r.seq: r.reason for r in rejects}


def test_reject_reasons(spark, dim):
    messages = [trades_message(a_trade(), bad, a_trade()) for bad, _ in BAD_TRADES]
    events, rejects = run(raw(spark, *messages), dim)
    assert len(events) == 2 * len(BAD_TRADES)
    assert by_seq(rejects) == {i: reason for i, (_, reason) in enumerate(BAD_TRADES)}
    assert len(rejects) == len(BAD_TRADES)


def test_unknown_symbols_are_dropped_before_any_check(spark, dim):
    message = trades_message(a_trade("DOGE-USD", price="garbage"), a_trade(product=None))
    assert run(raw(spark, message), dim) == ([], [])


def test_without_a_dimension_symbols_are_taken_as_they_are(spark):
    events, rejects = run(raw(spark, trades_message(a_trade("DOGE-USD"), a_trade(product=None))))
    assert [e.symbol for e in events] == ["DOGE-USD"]
    assert len(rejects) == 1


def test_garbage_in_an_optional_number_rejects(spark, dim):
    _, rejects = run(raw(spark, ticker_message(best_bid="1", best_ask="two")), dim)
    assert [r.reason for r in rejects] == ["could not convert string to float: 'two'"]


def test_bad_envelope_is_one_reject(spark, dim):
    details = {
        ...: "'timestamp'",
        None: "'NoneType' object has no attribute 'strip'",
        "soon": "Invalid isoformat string: 'soon'",
    }
    df = raw(spark, *[ticker_message(t, best_bid="1", best_ask="2") for t in details])
    events, rejects = run(df, dim)
    assert not events
    expected = [f"bad envelope timestamp: {detail}" for detail in details.values()]
    assert by_seq(rejects) == dict(enumerate(expected))
    assert all(json.loads(r.record)["channel"] == "ticker" for r in rejects)
    assert reject_bad_envelope(df).count() == 3
    assert normalize_coinbase_ticker(df, dim)[1].count() == 3


def test_other_channels_yield_nothing(spark, dim):
    assert run(raw(spark, {"channel": "heartbeats", "events": [{}]}, {}), dim) == ([], [])


def test_non_finite_prices_become_null(spark, dim):
    events, _ = run(raw(spark, trades_message(a_trade(price="nan"))), dim)
    assert events[0].price is None


def binance_trade(**over):
    data = {"e": "trade", "s": "BTCUSD", "t": 555, "p": "42000.50", "q": "0.02"}
    data |= {"T": 1735689600000, "m": True, **over}
    return {"stream": "btcusd@trade", "data": {k: v for k, v in data.items() if v is not ...}}


def binance(spark, dim, *messages):
    return run(raw(spark, *messages, exchange="binance_us"), dim)


def test_binance_trade_side(spark, dim):
    events, _ = binance(spark, dim, *[binance_trade(m=m) for m in (True, False, ...)])
    assert [e.side for e in events] == ["sell", "buy", "buy"]
    for event in events:
        assert (event.symbol, event.trade_id) == ("BTC-USD", "555")
        assert (event.price, event.size) == (42000.5, 0.02)
        assert event.ts_event == datetime(2025, 1, 1)


def test_binance_trades_are_recognized_by_their_keys(spark, dim):
    keyless = binance_trade(e=..., p=...)
    messages = (binance_trade(e=...), binance_trade(e=..., t=None), keyless)
    events, rejects = binance(spark, dim, *messages)
    assert [e.trade_id for e in events] == ["555", None]
    assert not rejects


BAD_BINANCE = [
    ({"p": ...}, "'p'"),
    ({"q": "x"}, "could not convert string to float: 'x'"),
    ({"T": ...}, "'T'"),
    ({"T": "x"}, "invalid literal for int() with base 10: 'x'"),
    ({"p": "0"}, "price must be > 0, got 0.0"),
]


def test_binance_rejects(spark, dim):
    messages = [binance_trade(**over) for over, _ in BAD_BINANCE]
    events, rejects = binance(spark, dim, *messages, binance_trade(t=0))
    assert [e.trade_id for e in events] == ["0"]
    assert by_seq(rejects) == {i: reason for i, (_, reason) in enumerate(BAD_BINANCE)}


def test_binance_unknown_symbol_is_dropped(spark, dim):
    unknown = (binance_trade(s="DOGEUSD", p="x"), binance_trade(s=None))
    assert binance(spark, dim, *unknown) == ([], [])
    assert binance(spark, None, binance_trade()) == ([], [])


def test_binance_book_ticker_takes_ingest_time(spark, dim):
    book = {"u": 400, "s": "ETHUSD", "b": "2200.00", "B": "1.2", "a": "2200.50", "A": "0.8"}
    events, _ = binance(spark, dim, {"stream": "ethusd@bookTicker", "data": book}, book)
    assert len(events) == 2
    for event in events:
        assert (event.event_type, event.symbol) == ("ticker", "ETH-USD")
        assert (event.best_bid, event.best_ask) == (2200.0, 2200.5)
        assert (event.best_bid_size, event.best_ask_size) == (1.2, 0.8)
        assert event.ts_event == event.ts_ingest
    df = raw(spark, book, exchange="binance_us")
    assert normalize_binance_book(df, dim)[0].count() == 1


def test_unknown_exchange_stops_the_job(spark, dim):
    with pytest.raises(Exception, match="no normalizer"):
        run(raw(spark, {}, exchange="nowhere"), dim)


def test_quarantine_and_summary(spark, dim):
    df = raw(
        spark,
        trades_message(a_trade(), a_trade("ETH-USD"), a_trade(price="-1")),
        ticker_message(best_bid="1", best_ask="2"),
    )
    tagged = normalize_tagged(df, dim, F.lit(INGEST))
    row = normalization_summary(df, tagged).first()
    assert (row.messages, row.events, row.trades, row.tickers, row.quarantined) == (2, 3, 2, 1, 1)
    assert row.by_symbol == {"BTC-USD": 2, "ETH-USD": 1}
    (bad,) = to_quarantine(rejects_of(tagged)).collect()
    assert (bad.exchange, bad.seq) == ("coinbase", 0)
    assert json.loads(bad.payload)["price"] == "-1"
    numbers = [(r.arrival_seq, r.arrival_pos, r.event_type) for r in events_of(tagged).collect()]
    assert len(set(numbers)) == 3


def test_symbol_dimension(spark, dim):
    rows = {(r.exchange, r.native_symbol): r.symbol for r in dim.collect()}
    assert rows[("binance_us", "BTCUSD")] == "BTC-USD"
    assert rows[("coinbase", "SOL-USD")] == "SOL-USD"
    assert len(rows) == 6


def test_feed_declaration(tmp_path):
    feed = default_feed()
    assert feed.venue.native_channel("trades") == "market_trades"
    assert feed.venue.native_channel("unmapped") == "unmapped"
    with pytest.raises(ValueError, match="symbols"):
        FeedConfig("coinbase", (), ("trades",), feed.exchanges)
    with pytest.raises(ValueError, match="nowhere"):
        _ = FeedConfig("nowhere", ("A",), ("trades",), feed.exchanges).venue
    path = tmp_path / "feed.json"
    path.write_text(
        '{"exchange": "x", "symbols": ["A-B"], "channels": ["trades"],'
        ' "exchanges": {"x": {"symbol_style": "concat"}}}'
    )
    assert load_feed(str(path)).venue.symbol_style == "concat"


def test_raw_files_roundtrip(spark, tmp_path):
    path = str(tmp_path / "raw")
    messages = raw(spark, *[trades_message(a_trade(trade_id=str(i))) for i in range(20)])
    write_raw_messages(messages, path)
    assert count_raw_messages(spark, path) == 20
    back = read_raw_messages(spark, path)
    assert back.orderBy("seq").collect() == messages.orderBy("seq").collect()
    assert [r.seq for r in read_raw_messages(spark, path, limit=3).collect()] == [0, 1, 2]


def test_blank_lines_are_skipped_and_malformed_ones_stop_the_job(spark, tmp_path):
    good = '{"seq":1,"ts_recorded":"2026-01-01T00:00:00Z","exchange":"coinbase","payload":{}}'
    path = tmp_path / "lines.jsonl"
    path.write_text(f"\n{good}\n   \n\t\n")
    assert count_raw_messages(spark, str(path)) == 1
    assert read_raw_messages(spark, str(path)).first().payload == "{}"
    for bad in (
        "not json",
        good.replace('"seq":1', '"seq":"x"'),
        good.replace('"seq":1,', ""),
        good.replace("{}", "5"),
        good.replace("{}", '"{}"'),
        good.replace("2026-01-01T00:00:00Z", "soon"),
    ):
        path.write_text(f"{good}\n{bad}\n")
        with pytest.raises(Exception, match="malformed raw message"):
            read_raw_messages(spark, str(path)).count()


def test_capture_order(spark):
    df = raw(spark, *[{"i": i} for i in range(50)]).withColumn("seq", 100 - F.col("seq"))
    ordered = with_capture_order(df.withColumn("at", -F.col("seq")), ["at"]).collect()
    texts = [json.loads(r.payload)["i"] for r in sorted(ordered, key=lambda r: r.seq)]
    assert texts == list(range(50))


def test_a_message_of_many_trades_opens_record_by_record(spark, dim):
    """No record carries its message along, so the cost of a message follows its length."""
    n = 20_000
    trades = [a_trade(trade_id=str(i), price=str(i + 1)) for i in range(n)]
    trades[n // 3] = "not a trade"
    tagged = normalize_tagged(raw(spark, trades_message(*trades)), dim, F.lit(INGEST))
    row = tagged.agg(
        F.count("*").alias("n"),
        F.count("reason").alias("bad"),
        F.sum("price").alias("sum"),
        F.count_distinct("arrival_pos").alias("places"),
    ).first()
    assert (row.n, row.bad, row.places) == (n, 1, n)
    assert row.sum == n * (n + 1) / 2 - (n // 3 + 1)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    (parted,) = [line for line in plan.splitlines() if "posexplode" in line]
    assert "payload" not in parted and "c#" not in parted
