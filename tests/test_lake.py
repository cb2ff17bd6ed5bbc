from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapewell.landed import current_folder, purge_replaced
from tapewell.operators import quality
from tapewell.operators.analytics import (
    latest_per_symbol,
    query_gold,
    spread_series,
    symbol_summary,
    time_travel,
    trade_series,
    vwap_moving_average,
)
from tapewell.operators.silver import silver_ticker, silver_trades
from tapewell.operators.windows import gold_window_metrics
from tapewell.plans.marts import build_marts
from tapewell.plans import medallion
from tapewell.plans.journal import Journal, fingerprint
from tapewell.plans.medallion import run_medallion
from tapewell.schemas import GOLD_SCHEMA, QUARANTINE_SCHEMA, WINDOW_SCHEMA
from tapewell.sinks import lake
from tapewell.sinks.lake import (
    land_quarantine,
    land_windows,
    write_bronze,
    write_gold_csv,
)
from tapewell.sinks.topics import publish, route_events, topic_records
from tapewell.sinks import versioned
from tapewell.sinks.versioned import (
    gold_history,
    gold_snapshots,
    materialize_gold,
    purge_old_generations,
    read_gold,
)
from tapewell.sources.lake import (
    read_bronze,
    read_gold_csv,
    read_quarantine,
    read_summary_json,
    read_windows,
)
from tests.conftest import at, event, quote, trade


def minutes(n=7):
    rows = []
    for i in range(n):
        rows.append(trade("BTC-USD", 100.0 + i, 1.0, 60 * i + 1, trade_id=f"b{i}"))
        rows.append(trade("ETH-USD", 10.0 + i, 2.0, 60 * i + 2, trade_id=f"e{i}"))
        rows.append(quote("BTC-USD", 99.0, 101.0, 60 * i + 3))
    return rows


@pytest.fixture(scope="module")
def gold(frame):
    df = frame(minutes())
    return gold_window_metrics(silver_trades(df), silver_ticker(df)).cache()


def test_bronze_is_partitioned_and_keeps_its_types(spark, frame, tmp_path):
    root = str(tmp_path / "bronze")
    df = frame([trade("BTC-USD", 1.0, 1.0, 0), trade("ETH-USD", 1.0, 1.0, 0)])
    assert write_bronze(df, root) == 2
    assert (Path(current_folder(spark, root)) / "event_type=trade" / "symbol=BTC-USD").is_dir()
    back = read_bronze(spark, root)
    assert dict(back.dtypes)["best_bid"] == "double"
    assert sorted(back.collect()) == sorted(df.collect())
    plan = back.where("symbol = 'BTC-USD' AND price > 0").select("size")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(symbol" in text
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,0.0)]" in text
    assert "ReadSchema: struct<price:double,size:double>" in text


def test_clearing_bronze_needs_something_to_land(spark, frame, tmp_path):
    root = str(tmp_path / "bronze")
    assert write_bronze(frame(minutes(2)), root) == 6
    assert write_bronze(frame([]), root) == 0
    assert read_bronze(spark, root).count() == 6
    assert write_bronze(frame(minutes(1)), root, clear=False) == 3
    assert read_bronze(spark, root).count() == 9
    assert write_bronze(frame(minutes(1)), root) == 3
    assert read_bronze(spark, root).count() == 3


def test_clearing_the_quarantine_needs_nothing(spark, tmp_path):
    root = str(tmp_path / "quarantine")
    bad = spark.createDataFrame([("coinbase", 1, "why", "{}", at(0))], QUARANTINE_SCHEMA)
    assert land_quarantine(bad, root) == 1
    assert land_quarantine(bad, root, clear=False) == 1
    assert read_quarantine(spark, root).count() == 2
    assert land_quarantine(bad.limit(0), root) == 0
    assert read_quarantine(spark, root).count() == 0


def _bytes(folder) -> int:
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_replaced_table_is_written_once_and_seen_whole(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(scratch.iterdir())
    write_bronze(frame(minutes(3)), root)
    assert _bytes(root) == _bytes(current_folder(spark, root))
    old = read_bronze(spark, root)

    # A writer that dies before its table is current leaves the old one.
    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(lake, "make_current", die)
        with pytest.raises(RuntimeError, match="killed"):
            write_bronze(frame(minutes(1)), root)
    assert read_bronze(spark, root).count() == 9
    # Nothing to land: no table is left behind either.
    tables = set((Path(root) / "_tables").iterdir())
    assert write_bronze(frame([]), root) == 0
    assert set((Path(root) / "_tables").iterdir()) == tables and len(tables) == 2

    # A reader at work keeps the table it started on; a table may be replaced by its own rows.
    assert write_bronze(read_bronze(spark, root).where("symbol = 'ETH-USD'"), root) == 3
    assert (old.count(), read_bronze(spark, root).count()) == (9, 3)
    assert set(scratch.iterdir()) == before

    purge_replaced(spark, root)
    assert len(list((Path(root) / "_tables").iterdir())) == 2  # the dead writer's may be alive
    purge_replaced(spark, root, abandoned_seconds=0)
    assert _bytes(root) == _bytes(current_folder(spark, root))
    assert read_bronze(spark, root).count() == 3


def test_writers_at_once_leave_one_whole_table(spark, frame, tmp_path):
    root = str(tmp_path / "bronze")
    sizes = (1, 2, 4)
    with ThreadPoolExecutor(3) as pool:
        landed = list(pool.map(lambda n: write_bronze(frame(minutes(n)), root), sizes))
    assert landed == [3 * n for n in sizes]
    assert read_bronze(spark, root).count() in landed


def test_appends_go_to_the_current_table(spark, frame, tmp_path):
    root = str(tmp_path / "bronze")
    assert write_bronze(frame(minutes(1)), root, clear=False) == 3
    assert current_folder(spark, root) == root  # a table never replaced is its own folder
    assert write_bronze(frame(minutes(2)), root) == 6
    assert write_bronze(frame(minutes(1)), root, clear=False) == 3
    assert read_bronze(spark, root).count() == 9


def test_windows_land_with_one_sided_data_and_text_bounds(spark, tmp_path):
    root = str(tmp_path / "windows")
    row = ("BTC-USD", "1m", "2026-03-01T00:00:00+00:00", "2026-03-01T00:01:00+00:00", "trades",
           1.0, 1.0, 1, None, None, 0, 1)
    text = ", ".join(
        f"{f.name} {'string' if f.name.startswith('window_') else f.dataType.simpleString()}"
        for f in WINDOW_SCHEMA
    )
    windows = spark.createDataFrame([row], text)
    assert land_windows(windows, root) == 1
    back = read_windows(spark, root)
    assert dict(back.dtypes)["avg_spread"] == "double"
    assert back.first().window_end == (at(60)).replace(tzinfo=None)
    assert land_windows(windows.limit(0), root) == 0
    assert read_windows(spark, root).count() == 1


def test_snapshots_and_time_travel(spark, gold, tmp_path):
    root = str(tmp_path / "gold")
    first, second = materialize_gold(gold, root)
    one_minute = gold.where("window_size = '1m'").count()
    assert [r.snapshot_id for r in gold_snapshots(spark, root).collect()] == [first, second]
    assert read_gold(spark, root).count() == gold.count()
    assert read_gold(spark, root, first).count() == one_minute
    row = time_travel(spark, root).first()
    assert row.asDict() == {
        "snapshots": 2,
        "current_rows": gold.count(),
        "first_snapshot_id": first,
        "first_snapshot_rows": one_minute,
    }
    with pytest.raises(ValueError, match="no snapshot"):
        read_gold(spark, root, 12345)


def test_a_rebuild_is_what_readers_see(spark, gold, tmp_path):
    root = str(tmp_path / "gold")
    first = materialize_gold(gold, root)
    eth = gold.where("symbol = 'ETH-USD' AND window_size = '1m'")
    only = materialize_gold(eth, root)
    assert only[0] == only[1] and only[0] not in first
    assert read_gold(spark, root).count() == eth.count()
    rows = query_gold(spark, root, "SELECT DISTINCT symbol FROM gold").collect()
    assert [r.symbol for r in rows] == ["ETH-USD"]
    purge_old_generations(spark, root)
    assert len(list((Path(root) / "data").iterdir())) == 1
    assert read_gold(spark, root).count() == eth.count()


def test_parts_without_rows_make_no_snapshot(spark, gold, tmp_path):
    root = str(tmp_path / "gold")
    first, second = materialize_gold(gold.where("window_size = '5m'"), root)
    assert first is None and second is not None
    assert materialize_gold(gold.limit(0), root) == (None, None)
    assert read_gold(spark, root).count() == 0
    row = time_travel(spark, root).first()
    assert (row.snapshots, row.current_rows) == (0, 0)
    assert (row.first_snapshot_id, row.first_snapshot_rows) == (None, None)


def test_writers_at_once_leave_whole_generations(spark, gold, tmp_path):
    root = str(tmp_path / "gold")
    parts = [gold, gold.where("symbol = 'ETH-USD'"), gold.where("window_size = '1m'"), gold.limit(0)]
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(lambda k: materialize_gold(parts[k], root, 10 + k), range(len(parts))))
    history = gold_history(spark, root).collect()
    assert [r.version for r in history] == [0, 1, 2, 3]
    rows = {r.generation: (r.snapshots, r["rows"]) for r in history}
    counts = [df.count() for df in parts]
    assert rows == dict(zip(range(10, 14), zip((2, 2, 1, 0), counts, strict=True), strict=True))
    newest = history[-1].generation - 10
    assert sorted(read_gold(spark, root).collect()) == sorted(
        parts[newest].select(*GOLD_SCHEMA.fieldNames()).collect()
    )


def test_a_taken_version_is_passed_over(spark, gold, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    materialize_gold(gold, root, 1)
    eth = gold.where("symbol = 'ETH-USD'")
    told = [0, 0]  # what a writer read before another one committed version 0
    find = versioned._next_version
    monkeypatch.setattr(versioned, "_next_version", lambda *a: told.pop() if told else find(*a))
    materialize_gold(eth, root, 2)
    assert [(r.version, r.generation) for r in gold_history(spark, root).collect()] == [(0, 1), (1, 2)]
    assert read_gold(spark, root).count() == eth.count()
    with pytest.raises(ValueError, match="committed already"):
        materialize_gold(gold, root, 1)
    assert read_gold(spark, root).count() == eth.count()


def test_a_writer_that_dies_before_its_commit_shows_nothing(spark, gold, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    eth = gold.where("symbol = 'ETH-USD'")
    materialize_gold(eth, root, 1)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versioned, "_commit", die)
        with pytest.raises(OSError, match="lost"):
            materialize_gold(gold, root, 2)
    assert read_gold(spark, root).count() == eth.count()
    purge_old_generations(spark, root)  # it may be a writer at work
    assert len(list((Path(root) / "data").iterdir())) == 2
    purge_old_generations(spark, root, abandoned_seconds=0)
    assert len(list((Path(root) / "data").iterdir())) == 1
    materialize_gold(gold, root, 2)  # not committed before, so its number is free
    assert read_gold(spark, root).count() == gold.count()


def test_nothing_built_yet(spark, tmp_path):
    assert gold_snapshots(spark, str(tmp_path)).count() == 0
    assert read_gold(spark, str(tmp_path)).columns == GOLD_SCHEMA.fieldNames()


def test_analytics(gold):
    rows = vwap_moving_average(gold).where("symbol = 'BTC-USD'").collect()
    assert [r.vwap_ma3 for r in rows] == [100.0, 100.5, 101.0, 102.0, 103.0, 104.0, 105.0]
    btc, eth = symbol_summary(gold).collect()
    assert (btc.windows, btc.total_volume, btc.mean_spread) == (7, 7.0, 2.0)
    assert (eth.total_volume, eth.mean_spread) == (14.0, None)
    latest = latest_per_symbol(gold).collect()
    assert [(r.symbol, r.vwap) for r in latest] == [("BTC-USD", 106.0), ("ETH-USD", 16.0)]
    assert trade_series(gold).count() == 14
    assert spread_series(gold).count() == 7


def test_gold_csv_roundtrip(spark, gold, tmp_path):
    write_gold_csv(gold, str(tmp_path / "csv"))
    assert sorted(read_gold_csv(spark, str(tmp_path / "csv")).collect()) == sorted(
        gold.select(*GOLD_SCHEMA.fieldNames()).collect()
    )
    path = tmp_path / "summary.json"
    path.write_text(json.dumps({"snapshots": 2, "current_rows": 27}, indent=2))
    assert read_summary_json(spark, str(path)).first().current_rows == 27


def test_routing_and_publishing(spark, frame, tmp_path):
    odd = event(event_type="x")
    df = frame([trade("BTC-USD", 1.0, 1.0, 0), quote("ETH-USD", 1.0, 2.0, 0), odd])
    trades, tickers = route_events(df)
    assert [r.event_type for r in trades.collect()] == ["trade", "x"]
    assert [r.symbol for r in tickers.collect()] == ["ETH-USD"]
    publish(df, path=str(tmp_path / "topics"))
    assert (tmp_path / "topics" / "topic=ticker.raw").is_dir()
    keys = {(r.topic, r.key) for r in topic_records(df, "one").collect()}
    assert keys == {("one", "BTC-USD"), ("one", "ETH-USD")}
    with pytest.raises(ValueError, match="folder or Kafka"):
        publish(df)


def test_build_marts(spark, frame, tmp_path):
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "gold")
    with pytest.raises(RuntimeError, match="no bronze"):
        build_marts(spark, bronze, root)
    write_bronze(frame(minutes()), bronze)
    result = build_marts(spark, bronze, root)
    assert result.gold_rows == read_gold(spark, root).count() == 14 + 4
    zero = trade("SOL-USD", 1.0, 0.0, 5, trade_id="z")
    write_bronze(frame([*minutes(), zero]), bronze)
    with pytest.raises(RuntimeError, match="gold vwap positive"):
        build_marts(spark, bronze, root)
    assert read_gold(spark, root).count() == 18  # the failed build left gold alone
    assert build_marts(spark, bronze, root, run_checks=False).gold_rows == 20


def test_checks_find_what_is_wrong(frame, gold):
    assert quality.check_window_span(gold).count() == 0
    wrong = gold.withColumn("window_end", F.col("window_start")).withColumn(
        "event_count", F.lit(9).cast("bigint")
    )
    assert quality.check_window_span(wrong).count() == gold.count()
    assert quality.check_event_count(wrong).count() > 0
    assert quality.check_unique(gold.unionAll(gold), "window_key").count() == gold.count()
    assert quality.check_accepted_values(gold, "window_size", ["1m"]).first().n == 4
    trades = silver_trades(frame(minutes()))
    assert quality.check_trade_metrics_recompute(gold, trades).count() == 0
    off = gold.withColumn("vwap", F.col("vwap") + 1e-3)
    assert quality.check_trade_metrics_recompute(off, trades).count() > 0
    bad = gold.withColumn("avg_spread", F.lit(-1.0)).withColumn("vwap", F.lit(None).cast("double"))
    assert quality.check_spread_non_negative(bad).count() == 9
    assert quality.gold_violations(bad).first()[0] == gold.count()


def test_service_levels(spark, frame, gold):
    bronze = frame(minutes())
    built = at(420)
    row = quality.sla_report(bronze, gold, built).first()
    assert row.completeness_by_symbol == {"BTC-USD": 100.0, "ETH-USD": 100.0}
    assert (row.windows_expected, row.windows_produced, row.gold_violations) == (18, 18, 0)
    assert not row.latency_ok and not row.passed
    thin = gold.where("NOT (symbol = 'ETH-USD' AND window_size = '5m')")
    assert quality.sla_report(bronze, thin, built).first().completeness_pct == 77.78
    nothing = quality.sla_report(frame([]), gold.limit(0), built).first()
    assert (nothing.latency_p95_s, nothing.completeness_pct, nothing.passed) == (0.0, 100.0, True)


@pytest.mark.parametrize(
    ("over", "passed"),
    [({}, True), ({"latency_p95_s": 60.0}, False), ({"completeness_pct": 98.9}, False),
     ({"completeness_pct": 99.0}, True), ({"gold_violations": 1}, False)],
)
def test_verdict(spark, over, passed):
    row = {
        "latency_p95_s": 10.0,
        "latency_target_s": 60.0,
        "completeness_pct": 100.0,
        "completeness_target_pct": 99.0,
        "gold_violations": 0,
        **over,
    }
    measured = spark.createDataFrame([tuple(row.values())], list(row))
    assert quality.with_verdict(measured).first().passed is passed


def test_reconcile():
    assert quality.reconcile(3, 3, "x") == 3
    with pytest.raises(RuntimeError, match="landed 2 != produced 3"):
        quality.reconcile(2, 3, "x")


def test_parity_reports_every_kind_of_difference(gold):
    keys = ("symbol", "window_size", "window_start")

    def problems(a, b):
        return {r.problem for r in quality.windows_parity(a, b, keys).collect()}

    assert problems(gold, gold) == set()
    assert problems(gold, gold.where("symbol = 'BTC-USD'")) == {"only in stream"}
    assert problems(gold.where("symbol = 'BTC-USD'"), gold) == {"only in batch"}
    assert problems(gold.unionAll(gold), gold) == {"duplicate key"}
    assert problems(gold.withColumn("vwap", F.col("vwap") * (1 + 1e-6)), gold) == {"vwap"}
    assert problems(gold.withColumn("vwap", F.col("vwap") * (1 + 1e-12)), gold) == set()
    assert "trade_count" in problems(gold.withColumn("trade_count", F.lit(99)), gold)


def raw_lines(path: Path) -> None:
    def line(seq, channel, event):
        sent = at(seq).isoformat()
        message = {
            "seq": seq,
            "ts_recorded": sent.replace("+00:00", "Z"),
            "exchange": "coinbase",
            "channel": channel,
            "payload": {"channel": channel, "timestamp": sent, "events": [event]},
        }
        return json.dumps(message)

    def a_trade(seq, k):
        bad = (seq, k) == (50, 1)
        return {
            "product_id": "BTC-USD",
            "trade_id": f"{seq}-{k}",
            "price": "-1" if bad else str(100 + k),
            "size": "1.5",
            "time": (at(seq) + timedelta(milliseconds=k)).isoformat(),
            "side": "BUY",
        }

    lines = []
    for seq in range(0, 400, 10):
        trades = [a_trade(seq, k) for k in range(2)]
        lines.append(line(seq, "market_trades", {"type": "update", "trades": trades}))
        tick = {"product_id": "ETH-USD", "best_bid": "10", "best_ask": "10.5"}
        lines.append(line(seq + 5, "ticker", {"type": "update", "tickers": [tick]}))
    path.write_text("\n".join(lines) + "\n")


def test_the_whole_run(spark, tmp_path):
    source = tmp_path / "raw.jsonl"
    raw_lines(source)
    root = str(tmp_path / "lake")
    for streaming in (False, True):  # both give the same; the second run replaces the first
        row = run_medallion(spark, str(source), root, streaming=streaming).first()
        assert (row.replayed_events, row.bronze_rows, row.quarantined) == (119, 119, 1)
        assert (row.gold_snapshots, row.gold_violations) == (2, 0)
        assert row.gold_rows == read_gold(spark, root + "/gold").count() == 2 * (7 + 2)
        # Per source: six closed minutes and one closed five minutes.
        assert row.window_rows == read_windows(spark, root + "/windows").count() == 2 * (6 + 1)
        assert row.completeness_pct == 100.0
        assert row.sla_passed
    (bad,) = read_quarantine(spark, root + "/quarantine").collect()
    assert bad.reason.startswith("price must be > 0")


def test_a_lost_run_goes_on_at_its_first_unfinished_stage(spark, tmp_path, monkeypatch):
    source = tmp_path / "raw.jsonl"
    raw_lines(source)
    root = str(tmp_path / "lake")

    def run(**options):
        return run_medallion(spark, str(source), root, streaming=False, **options).first()

    def not_again(*_, **__):
        raise AssertionError("this stage was finished")

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(medallion, "land_windows", killed)
        with pytest.raises(RuntimeError, match="killed"):
            run()
    bronze = current_folder(spark, root + "/bronze")
    with monkeypatch.context() as patched:
        patched.setattr(medallion, "read_raw_messages", not_again)
        patched.setattr(medallion, "build_marts", killed)
        with pytest.raises(RuntimeError, match="killed"):
            run(resume=True)
        patched.setattr(medallion, "build_marts", build_marts)
        patched.setattr(medallion, "land_windows", not_again)
        resumed = run(resume=True)
        assert current_folder(spark, root + "/bronze") == bronze
        # A finished run is not gone on with, nor is one of other settings or files.
        for options in ({}, {"grace_seconds": 1}):
            with pytest.raises(AssertionError, match="finished"):
                run(resume=True, **options)
    whole = run()
    same = [name for name in whole.__fields__ if name != "latency_p95_s"]
    assert [resumed[name] for name in same] == [whole[name] for name in same]


def test_a_replaced_table_is_not_gone_on_from(spark, tmp_path):
    source = tmp_path / "input.txt"
    source.write_text("one")
    root = str(tmp_path / "tables")
    inputs = fingerprint(spark, str(source), sizes=[1])
    first = Journal(spark, root, inputs, resume=True)
    assert first.stage("landed", lambda: {"n": 1}) == {"n": 1}
    assert first.stage("windows", lambda: {"n": 2}) == {"n": 2}
    again = Journal(spark, root, inputs, resume=True)
    assert again.run == first.run
    assert again.stage("landed", lambda: {"n": 9}) == {"n": 1}
    assert again.stage("windows", lambda: {"n": 3}, lambda kept: kept["n"] != 2) == {"n": 3}
    assert again.run > first.run
    third = Journal(spark, root, inputs, resume=True)
    assert (third.run, third.kept) == (again.run, {"landed": {"n": 1}, "windows": {"n": 3}})
    assert Journal(spark, root, inputs, resume=False).kept == {}
    source.write_text("one more")
    assert fingerprint(spark, str(source), sizes=[1]) != inputs
    assert fingerprint(spark, str(source), sizes=[2]) != inputs
