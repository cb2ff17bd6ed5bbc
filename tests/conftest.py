from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tapewell.schemas import ARRIVAL, BRONZE_SCHEMA, POSITION  # noqa: E402
from tapewell.session import build_session  # noqa: E402

# Aligned to minutes, five minutes and hours.
BASE = datetime(2026, 3, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def event(**over) -> dict:
    row = {name: None for name in BRONZE_SCHEMA.fieldNames()}
    row.update(
        exchange="coinbase",
        symbol="BTC-USD",
        event_type="trade",
        ts_event=BASE,
        ts_ingest=BASE,
    )
    row.update(over)
    return row


def trade(symbol: str, price: float, size: float, seconds: float, **over) -> dict:
    when = at(seconds)
    return event(
        symbol=symbol, price=price, size=size, side="buy", ts_event=when, ts_ingest=when, **over
    )


def quote(symbol: str, bid: float, ask: float, seconds: float, **over) -> dict:
    when = at(seconds)
    return event(
        symbol=symbol,
        event_type="ticker",
        best_bid=bid,
        best_ask=ask,
        ts_event=when,
        ts_ingest=when,
        **over,
    )


@pytest.fixture(scope="session")
def frame(spark):
    """Build an event table from row dicts, numbered in the order given."""

    def build(rows: list[dict]):
        numbered = [
            {POSITION: 0, **row, ARRIVAL: i if row.get(ARRIVAL) is None else row[ARRIVAL]}
            for i, row in enumerate(rows)
        ]
        names = BRONZE_SCHEMA.fieldNames()
        return spark.createDataFrame([tuple(r[n] for n in names) for r in numbered], BRONZE_SCHEMA)

    return build
