from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapewell.functions.checks import ingest_check
from tapewell.functions.events import encode_event, with_event_columns
from tapewell.functions.parsing import (
    aggressor_side,
    binance_trade_id,
    coinbase_trade_id,
    finite,
    parse_ts,
    side_from_maker,
    strict_double,
    ts_from_millis,
)
from tapewell.schemas import EVENT_SCHEMA
from tests.conftest import BASE, event, quote, trade


def over(spark, column, values, dtype="string"):
    """The column function applied to each value, in one job."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    rows = df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


TIMESTAMPS = {
    "2026-06-22T22:14:35.153209871Z": datetime(2026, 6, 22, 22, 14, 35, 153209),
    "2026-01-01T00:00:00.5Z": datetime(2026, 1, 1, 0, 0, 0, 500000),
    "2026-01-01T02:00:00+02:00": datetime(2026, 1, 1),
    " 2026-01-01 00:00:01 ": datetime(2026, 1, 1, 0, 0, 1),
    "2026-01-01": datetime(2026, 1, 1),
    "2026": None,
    "2026-1-1": None,
    "2026-13-01T00:00:00Z": None,
    "bad": None,
    "": None,
    None: None,
}


def test_parse_ts(spark):
    got = over(spark, lambda c: parse_ts(c).cast("timestamp_ntz"), TIMESTAMPS)
    assert got == list(TIMESTAMPS.values())


def test_ts_from_millis(spark):
    def column(c):
        return ts_from_millis(c).cast("timestamp_ntz")

    assert over(spark, column, ["1735689600000", "soon"]) == [datetime(2025, 1, 1), None]
    assert over(spark, column, [1735689600000], "long") == [datetime(2025, 1, 1)]


def test_strict_double(spark):
    numbers = {"42000.50": 42000.5, " 7 ": 7.0, "1e3": 1000.0, "-.5": -0.5, "inf": float("inf")}
    garbage = ["abc", "1d", "2F", "0x1p3", "", None]
    assert over(spark, strict_double, numbers) == list(numbers.values())
    assert over(spark, strict_double, garbage) == [None] * len(garbage)


def test_non_finite_numbers_do_not_survive(spark):
    texts = ["nan", "inf", "-Infinity", "1"]
    assert over(spark, lambda c: finite(strict_double(c)), texts) == [None, None, None, 1.0]


def test_sides_and_ids(spark):
    assert over(spark, aggressor_side, ["BUY", "sell", "x", None]) == ["buy", "sell", None, None]
    assert over(spark, side_from_maker, ["true", "false", None]) == ["sell", "buy", "buy"]
    assert over(spark, coinbase_trade_id, ["7", "0", "", None]) == ["7", None, None, None]
    assert over(spark, binance_trade_id, ["0", None]) == ["0", None]


CHECKED = ("price", "size", "best_bid", "best_ask", "best_bid_size", "best_ask_size")


CHECKS = [
    (trade("BTC-USD", 1.0, 0.0, 0), None),
    (trade("BTC-USD", -1.0, -2.0, 0), "price must be > 0, got -1.0"),
    (trade("BTC-USD", 1.0, -0.1, 0), "size must be >= 0, got -0.1"),
    (quote("BTC-USD", 100.0, 100.0, 0), None),
    (quote("BTC-USD", 100.0, 99.0, 0), "crossed book: best_ask (99.0) < best_bid (100.0)"),
    (quote("BTC-USD", float("nan"), 99.0, 0), None),
    (event(best_bid_size=-1.0), "best_bid_size must be >= 0, got -1.0"),
    (event(), None),
]


def test_ingest_check(frame):
    check = ingest_check({name: F.col(name) for name in CHECKED})
    got = frame([row for row, _ in CHECKS]).orderBy("arrival_seq").select(check.alias("r"))
    assert [r["r"] for r in got.collect()] == [reason for _, reason in CHECKS]


def test_event_json_is_lossless(frame):
    rows = [
        trade("BTC-USD", 42000.5, 0.1, 0.000001, trade_id="t-1"),
        quote("ETH-USD", 1.0, 2.0, 1),
    ]
    df = frame(rows).drop("arrival_seq", "arrival_pos")
    back = with_event_columns(df.select(encode_event().alias("value")))
    assert back.collect() == df.collect()
    text = df.select(encode_event().alias("value")).first()["value"]
    assert '"best_bid":null' in text and "+00:00" in text


def test_unknown_event_fields_are_refused(spark):
    text = '{"exchange":"x","symbol":"s","event_type":"trade","surprise":1}'
    df = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(Exception, match="surprise"):
        with_event_columns(df).collect()


def test_iso_text_keeps_fractions(spark):
    from tapewell.functions.windows import iso_utc

    df = spark.createDataFrame([(BASE,), (BASE.replace(microsecond=5),)], "t timestamp")
    assert [r[0] for r in df.select(iso_utc(F.col("t"))).collect()] == [
        "2026-03-01T00:00:00+00:00",
        "2026-03-01T00:00:00.000005+00:00",
    ]


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"price": "abc"}, "unreadable field: price"),
        ({"price": -7.5}, "price must be > 0, got -7.5"),
        ({"symbol": None}, "missing field: symbol"),
        ({"side": "up"}, "unknown side: up"),
        ({"ts_event": "yesterday"}, "unreadable field: ts_event"),
        ({"note": 1}, "unknown fields: note"),
    ],
)
def test_decoding_tells_why_a_text_is_no_event(spark, change, reason):
    import json

    from tapewell.functions.events import decode_events

    good = json.loads(spark.createDataFrame([event(price=3.0)], EVENT_SCHEMA).select(encode_event()).first()[0])
    df = spark.createDataFrame([(1, json.dumps(good | change))], "n int, value string")
    events, rejects = decode_events(df)
    assert [r["reason"] for r in rejects.collect()] == ([] if reason is None else [reason])
    assert events.count() == (reason is None)


def test_null_and_broken_texts_are_rejects(spark):
    from tapewell.functions.events import decode_events

    events, rejects = decode_events(spark.createDataFrame([(None,), ("{bro",), ("[]",), ("",)], "value string"))
    assert events.count() == 0 and {r["reason"] for r in rejects.collect()} == {"not a JSON object"}
