from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapewell.operators.ordering import (
    closed_windows_by_clock,
    count_out_of_order,
    flag_out_of_order,
    late_flags,
    late_records,
    with_arrival_seq,
)
from tapewell.operators.quantile import exact_percentile
from tests.conftest import at, quote, trade

SIZES = {"1m": 60, "5m": 300}


def late_market(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        symbol = "BTC-USD" if rng.random() < 0.8 else rng.choice(["ETH-USD", "SOL-USD"])
        seconds = max(0.0, i * 3 - rng.choice([0, 0, 0, 20, 80, 400]) + rng.random())
        make = trade if rng.random() < 0.6 else quote
        rows.append(make(symbol, 10.0 + rng.random(), 11.5 + rng.random(), seconds))
    return rows


def expected_out_of_order(rows):
    newest, out = {}, []
    for row in rows:
        top = newest.get(row["symbol"])
        out.append(top is not None and row["ts_event"] < top)
        newest[row["symbol"]] = max(row["ts_event"], top or row["ts_event"])
    return out


def cut_to_ms(ts):
    return ts.replace(microsecond=ts.microsecond // 1000 * 1000)


def expected_windows(rows, sizes, grace):
    """One pass in order of arrival, closing windows by each key's own clock."""
    clocks, open_, closed, late = {}, {}, [], []
    for row in rows:
        source = "ticker" if row["event_type"] == "ticker" else "trades"
        key, ts = (row["symbol"], source), cut_to_ms(row["ts_event"]).timestamp()
        for label, width in sizes.items():
            start = int(ts // width) * width
            if key in clocks and clocks[key] >= start + width + grace:
                late.append((*key, label, start, round(ts, 3)))
            else:
                open_.setdefault((*key, label, start), []).append(row)
        clocks[key] = max(ts, clocks.get(key, ts))
        for window in [w for w in open_ if w[:2] == key]:
            if clocks[key] >= window[3] + sizes[window[2]] + grace:
                closed.append((window, open_.pop(window)))
    return closed, late


def test_out_of_order_counts(frame):
    rows = [
        trade("BTC-USD", 1.0, 1.0, 0),
        trade("BTC-USD", 1.0, 1.0, 5),
        trade("BTC-USD", 1.0, 1.0, 3),
        trade("BTC-USD", 1.0, 1.0, 4),
        trade("BTC-USD", 1.0, 1.0, 5),
        trade("ETH-USD", 1.0, 1.0, 0),
        trade(None, 1.0, 1.0, 0),
        trade(None, 1.0, 1.0, -5),
    ]
    assert count_out_of_order(frame(rows)).first()[0] == 2
    assert count_out_of_order(frame(rows[:0])).first()[0] == 0


@pytest.mark.parametrize("span", [1, 7, 64, 1 << 30])
def test_blocks_do_not_change_what_is_out_of_order(frame, span):
    rows = late_market()
    flagged = flag_out_of_order(frame(rows), block_span=span).orderBy("arrival_seq")
    assert [r.out_of_order for r in flagged.collect()] == expected_out_of_order(rows)


@pytest.mark.parametrize("span", [13, 1 << 30])
def test_late_records_and_closed_windows_match_one_ordered_pass(frame, span):
    rows = late_market()
    df = frame(rows)
    closed, late = expected_windows(rows, SIZES, 5)
    got = late_records(df, SIZES, 5, span).select(
        "symbol",
        "source",
        "window_size",
        F.unix_seconds("window_start").alias("s"),
        F.unix_millis("event_ts").alias("t"),
    )
    expected = sorted((a, b, c, d, int(round(t * 1000))) for a, b, c, d, t in late)
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert len(expected) > 20
    windows = closed_windows_by_clock(df, SIZES, 5, span).select(
        "symbol", "source", "window_size", F.unix_seconds("window_start").alias("s"), "event_count"
    )
    assert sorted(tuple(r) for r in windows.collect()) == sorted(
        (*key, len(members)) for key, members in closed
    )


def test_lateness_is_judged_per_size(frame):
    rows = [trade("BTC-USD", 1.0, 1.0, s) for s in (10, 70, 30)]
    flags = late_flags(frame(rows), SIZES, 2).where("late").collect()
    assert [(r.window_size, r.arrival_seq) for r in flags] == [("1m", 2)]


def test_arrival_numbers_follow_the_order_even_with_one_hot_time(spark):
    rows = [(i, at(0), (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, tie long").repartition(5)
    numbered = with_arrival_seq(df, ["ts", "tie"]).orderBy("arrival_seq").collect()
    assert [r.tie for r in numbered] == list(range(1000))
    assert len({r.arrival_seq for r in numbered}) == 1000


WIDE = [random.Random(11).randint(-(10**12), 10**12) for _ in range(300)]
TIED = [0] * 90 + [random.Random(12).randint(0, 20) for _ in range(60)]


@pytest.mark.parametrize(
    ("values", "bins"),
    [([5], 4), ([1, 2, 3, 10], 2), ([7] * 50 + [8], 2), (TIED, 5), (WIDE, 1 << 14)],
)
def test_exact_percentile(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = exact_percentile(df, "v", 0.95, bins)
    assert got == pytest.approx(float(np.percentile(values, 95)), rel=1e-12)


def test_exact_percentile_of_timestamps(spark):
    df = spark.createDataFrame([(at(s),) for s in (1, 2, 3, 10)], "t timestamp")
    got = exact_percentile(df, "t", 0.5, 8)
    assert got == at(2.5).timestamp() * 1e6


def test_percentile_of_nothing(spark):
    assert exact_percentile(spark.createDataFrame([], "v long"), "v", 0.95) is None
