from __future__ import annotations

from pyspark.sql import functions as F

from tapewell.config import DEFAULT_SYMBOLS
from tapewell.operators.contract import (
    apply_contract,
    coerce_event_frame,
    contract_report,
    contract_rules,
)
from tests.conftest import event, quote, trade

NAN = float("nan")


def reasons(frame, rows):
    split = apply_contract(frame(rows), DEFAULT_SYMBOLS)
    return {r.arrival_seq: r.quarantine_reason for r in split.quarantined.collect()}


def test_clean_and_boundary_rows_pass(frame):
    rows = [
        trade("BTC-USD", 100.0, 1.0, 0),
        trade("BTC-USD", 100.0, 0.0, 0),
        quote("ETH-USD", 100.0, 100.0, 0),
        event(event_type="ticker"),
        quote("ETH-USD", NAN, 1.0, 0),
    ]
    split = apply_contract(frame(rows), DEFAULT_SYMBOLS)
    assert split.valid.count() == 5
    assert split.quarantined.count() == 0
    report = contract_report(frame(rows), DEFAULT_SYMBOLS).first()
    assert (report.n_valid, report.n_quarantined, report.ok, report.reasons) == (5, 0, True, [])


ISIN_SYMBOLS = "isin(['BTC-USD', 'ETH-USD', 'SOL-USD'])"
ISIN_TYPES = "isin(['trade', 'ticker'])"
BAD_ROWS = [
    (trade("BTC-USD", -5.0, 1.0, 0), "greater_than(0)"),
    (trade("BTC-USD", 1.0, -1.0, 0), "greater_than_or_equal_to(0)"),
    (quote("BTC-USD", -1.0, 1.0, 0), "greater_than_or_equal_to(0)"),
    (trade("BTC-USD", 1.0, 1.0, 0, exchange=None), "not_nullable"),
    (trade(None, 1.0, 1.0, 0), "not_nullable"),
    ({**trade("BTC-USD", 1.0, 1.0, 0), "ts_event": None}, "not_nullable"),
    (trade("DOGE-USD", 1.0, 1.0, 0), ISIN_SYMBOLS),
    (event(event_type="heartbeat"), ISIN_TYPES),
    (event(event_type="trade"), "trade_has_price_and_size"),
    (trade("BTC-USD", NAN, 1.0, 0), "trade_has_price_and_size"),
    (quote("BTC-USD", 101.0, 100.0, 0), "spread_non_negative"),
    (
        {**trade("DOGE-USD", -1.0, -1.0, 0), "exchange": None},
        f"greater_than(0), greater_than_or_equal_to(0), {ISIN_SYMBOLS}, not_nullable",
    ),
]


def test_every_rule_fires_with_its_name(frame):
    rows = [row for row, _ in BAD_ROWS]
    assert reasons(frame, rows) == {i: reason for i, (_, reason) in enumerate(BAD_ROWS)}


def test_report_lists_every_broken_rule_once(frame):
    rows = [row for row, _ in BAD_ROWS] + [trade("BTC-USD", 1.0, 1.0, 0)]
    report = contract_report(frame(rows), DEFAULT_SYMBOLS).first()
    assert (report.n_valid, report.n_quarantined, report.ok) == (1, len(BAD_ROWS), False)
    assert report.reasons == sorted(contract_rules(DEFAULT_SYMBOLS))


def test_coerce_event_frame(spark):
    df = spark.createDataFrame(
        [("1.5", "x", "2026-01-01T00:00:00.123456789Z"), (None, "2", "2026-01-01")],
        "price string, size string, ts_event string",
    )
    rows = coerce_event_frame(df).withColumn("ts_event", F.col("ts_event").cast("string")).collect()
    assert [(r.price, r.size, r.best_bid) for r in rows] == [(1.5, None, None), (None, 2.0, None)]
    assert rows[0].ts_event == "2026-01-01 00:00:00.123456"
