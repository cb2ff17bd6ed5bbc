"""Plans that must hold at scale: what is pruned, what is combined before a shuffle."""

from __future__ import annotations

import pytest

from tapewell.config import default_feed
from tapewell.operators.contract import contract_report
from tapewell.operators.normalize import normalize_tagged
from tapewell.operators.ordering import count_out_of_order
from tapewell.operators.quality import expected_windows
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import gold_window_metrics
from tapewell.sinks.lake import write_bronze
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.lake import read_bronze
from tapewell.sources.raw import read_raw_messages
from tests.conftest import quote, trade


def explain(df) -> str:
    plans = df._sc._jvm.PythonSQLUtils
    return plans.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def bronze(spark, frame, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze") / "table")
    rows = [trade("BTC-USD", 1.0, 1.0, 0, trade_id="a"), quote("ETH-USD", 1.0, 2.0, 0)]
    write_bronze(frame(rows), root)
    return read_bronze(spark, root)


def test_dedup_drops_copies_before_the_shuffle(bronze):
    text = explain(silver_trades(bronze))
    tree = text.split("\n\n")[0]
    # The tree lists the last step first: the limit is on both sides of the one shuffle.
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")
    assert "event_type" in text.split("PartitionFilters")[1].split("\n")[0]


def test_silver_ticker_is_one_pruned_scan(bronze):
    text = explain(silver_ticker(bronze))
    assert "Exchange" not in text
    assert "GreaterThanOrEqual" in text or "IsNotNull(best_bid)" in text
    assert "trade_id" not in text.split("ReadSchema")[1].split("\n")[0]


def test_gold_joins_nothing(bronze):
    text = explain(gold_window_metrics(silver_trades(bronze), silver_ticker(bronze)))
    assert "Join" not in text
    assert "partial_sum" in text


def test_no_plan_multiplies_rows(bronze):
    for df in (
        count_out_of_order(bronze),
        expected_windows(bronze),
        contract_report(bronze, default_feed().symbols),
    ):
        text = explain(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_normalization_shuffles_nothing(spark, tmp_path):
    path = tmp_path / "raw.jsonl"
    path.write_text("")
    raw = read_raw_messages(spark, str(path))
    text = explain(normalize_tagged(raw, symbol_dimension(spark, default_feed())))
    assert "BroadcastHashJoin" in text
    assert "Exchange (" not in text.replace("BroadcastExchange (", "")
    assert "Python" not in text
