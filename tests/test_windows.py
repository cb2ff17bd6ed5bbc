from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapewell.functions.windows import window_bounds, window_key, window_start
from tapewell.operators.silver import silver_ticker, silver_trades, silver_valid
from tapewell.operators.windows import (
    closed_windows,
    compute_windows,
    event_windows,
    gold_window_metrics,
    join_windows,
    max_event_ts_by_symbol,
    ticker_windows,
    trade_windows,
)
from tests.conftest import at, event, quote, trade


def naive(seconds):
    return at(seconds).replace(tzinfo=None)


def test_window_bounds_are_half_open_and_floor_before_1970(spark):
    times = ["2026-03-01 00:00:59.999999", "2026-03-01 00:01:00", "1969-12-31 23:59:59.5"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp").alias("t")
    )
    start, end = window_bounds(F.col("t"), 60)
    rows = df.select(start.alias("s"), end.alias("e")).collect()
    assert [r.s for r in rows] == [naive(0), naive(60), datetime(1969, 12, 31, 23, 59)]
    assert [r.e for r in rows] == [naive(60), naive(120), datetime(1970, 1, 1)]


def test_window_start_of_ntz_and_key(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-03-01 00:07:03' AS t")
    row = df.select(
        window_start(F.col("t"), 300).alias("s"),
        window_key(F.lit("BTC-USD"), F.lit("5m"), window_start(F.col("t"), 300)).alias("k"),
    ).first()
    assert row.s == naive(300)
    assert row.k == f"BTC-USD|5m|{int(at(300).timestamp())}"


def test_trades_of_a_window_weigh_by_size(frame):
    rows = [trade("SOL-USD", 8.0, 0.5, 601), trade("SOL-USD", 12.0, 1.5, 640), trade("SOL-USD", 9.0, 2.0, 899.5)]
    rows += [trade("SOL-USD", 50.0, 1.0, 900)]
    first, second = compute_windows(frame(rows), 300, "5m").orderBy("window_start").collect()
    assert (first.vwap, first.trade_volume, first.trade_count) == (10.0, 4.0, 3)
    assert (first.window_start, first.window_end, first.avg_mid) == (naive(600), naive(900), None)
    assert (second.vwap, second.event_count, second.ticker_count) == (50.0, 1, 0)


def test_quotes_of_a_window_count_alike(frame):
    rows = [quote("ETH-USD", 10.0, 10.5, 30), quote("ETH-USD", 11.0, 12.0, 31), quote("ETH-USD", 9.0, 9.0, 59)]
    (w,) = compute_windows(frame(rows), 60, "1m").collect()
    assert (w.avg_spread, w.avg_mid, w.ticker_count) == (0.5, 10.25, 3)
    assert (w.vwap, w.trade_volume, w.trade_count) == (None, 0.0, 0)


def test_unusable_events_still_make_a_window(frame):
    one_sided = event(event_type="ticker", best_bid=1.0)
    rows = [event(price=1.0), one_sided, trade("ETH-USD", 1.0, 0.0, 0)]
    btc, eth = compute_windows(frame(rows), 60, "1m").collect()
    assert (btc.event_count, btc.trade_volume, btc.vwap, btc.avg_mid) == (0, 0.0, None, None)
    assert (eth.trade_count, eth.vwap) == (1, None)


def test_order_of_arrival_does_not_matter(frame):
    rng = random.Random(7)
    rows = [
        trade("BTC-USD", rng.uniform(1, 9), rng.uniform(0, 5), rng.uniform(0, 900))
        for _ in range(200)
    ]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    one, two = (compute_windows(frame(r), 300, "5m").collect() for r in (rows, shuffled))
    assert [r.trade_count for r in one] == [r.trade_count for r in two]
    assert [r.vwap for r in one] == pytest.approx([r.vwap for r in two], rel=1e-12)


@pytest.mark.parametrize(("last", "grace", "n"), [(307, 7, 1), (306.999, 7, 0), (300, 0, 1), (900, 300, 2)])
def test_a_window_closes_when_the_clock_reaches_its_end_and_the_grace(frame, last, grace, n):
    df = frame([trade("ETH-USD", 3.0, 2.0, 250), quote("ETH-USD", 1.0, 2.0, 599), trade("ETH-USD", 4.0, 1.0, last)])
    newest = max_event_ts_by_symbol(df.where(F.col("event_type") == "trade"))
    assert closed_windows(compute_windows(df, 300, "5m"), newest, grace).count() == n


def test_each_symbol_closes_by_its_own_newest_event(frame):
    rows = [trade("ETH-USD", 1.0, 1.0, s) for s in (0, 400, 720)] + [trade("SOL-USD", 1.0, 1.0, 299)]
    df = frame([*rows, quote("SOL-USD", 1.0, 1.5, 304.5)])
    closed = closed_windows(compute_windows(df, 300, "5m"), max_event_ts_by_symbol(df), 5)
    assert sorted((r.symbol, r.window_start) for r in closed.collect()) == [
        ("ETH-USD", naive(0)),
        ("ETH-USD", naive(300)),
    ]


def market(frame):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        symbol = rng.choice(["BTC-USD", "BTC-USD", "ETH-USD"])
        at_s = rng.uniform(0, 1200)
        if rng.random() < 0.5:
            price, size = round(rng.uniform(-1, 9), 2), float(rng.randint(0, 3))
            rows.append(trade(symbol, price, size, at_s, trade_id=f"t{i // 3}"))
        else:
            rows.append(quote(symbol, 5.0, 5.0 + rng.uniform(-0.1, 1), at_s))
    return frame(rows)


def test_silver_dedup_keeps_the_first_by_time_then_value(frame):
    rows = [
        trade("BTC-USD", 3.0, 1.0, 5, trade_id="a"),
        trade("BTC-USD", 2.0, 1.0, 1, trade_id="a", exchange="other"),
        trade("BTC-USD", 1.0, 9.0, 1, trade_id="a"),
        trade("ETH-USD", 7.0, 1.0, 0, trade_id="a"),
        trade("BTC-USD", 1.0, 1.0, 0, trade_id=None),
        trade("BTC-USD", -1.0, 1.0, 0, trade_id="neg"),
        trade("BTC-USD", 1.0, -1.0, 0, trade_id="neg2"),
        quote("BTC-USD", 1.0, 2.0, 0),
    ]
    kept = silver_trades(frame(rows)).orderBy("symbol").collect()
    assert [(r.symbol, r.price, r.size) for r in kept] == [
        ("BTC-USD", 1.0, 9.0),
        ("ETH-USD", 7.0, 1.0),
    ]


def test_silver_ticker_drops_one_sided_and_crossed_books(frame):
    rows = [
        quote("BTC-USD", 100.0, 100.5, 0),
        quote("BTC-USD", 100.0, 100.0, 0),
        quote("BTC-USD", 100.0, 99.0, 0),
        quote("BTC-USD", 100.0, None, 0),
    ]
    out = silver_ticker(frame(rows)).orderBy("spread").collect()
    assert [(r.spread, r.mid) for r in out] == [(0.0, 100.0), (0.5, 100.25)]
    assert silver_valid(frame(rows)).count() == 2


def test_gold_equals_the_join_of_both_sides(frame):
    df = market(frame)
    trades, ticker = silver_trades(df), silver_ticker(df)
    gold = gold_window_metrics(trades, ticker)
    keys = ["symbol", "window_size", "window_start"]
    joined = join_windows(trade_windows(trades), ticker_windows(ticker))
    a = gold.orderBy(*keys).collect()
    b = joined.orderBy(*keys).collect()
    assert len(a) == len(b) > 10
    for x, y in zip(a, b, strict=True):
        assert [x[k] for k in keys] == [y[k] for k in keys]
        for name in ("vwap", "trade_volume", "avg_spread", "avg_mid"):
            assert x[name] == (None if y[name] is None else pytest.approx(y[name], rel=1e-9))
        assert (x.trade_count, x.ticker_count) == (y.trade_count, y.ticker_count)
        assert x.event_count == x.trade_count + x.ticker_count
    assert {r.window_size for r in a} == {"1m", "5m"}


def test_two_sizes_agree_with_each_size_alone(frame):
    df = market(frame)
    both = event_windows(df, {"1m": 60, "90s": 90})
    for label, seconds in (("1m", 60), ("90s", 90)):
        alone = compute_windows(df, seconds, label).collect()
        part = both.where(F.col("window_size") == label).orderBy("symbol", "window_start").collect()
        assert [r.event_count for r in part] == [r.event_count for r in alone]
        for x, y in zip(part, alone, strict=True):
            assert x.avg_mid == (None if y.avg_mid is None else pytest.approx(y.avg_mid, rel=1e-9))
