"""Registered queries: raw messages, normalization, events as JSON, routing.

Raw messages are built from the driver events in the shapes the exchanges send,
up to three events to a message, and normalized back. The SQL side never sees the
messages: it selects the expected events from the driver events directly.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.catalog.base import (
    CTES,
    EVENT_SELECT,
    GRACE,
    SIZES,
    SYMBOL_LIST,
    Query,
    market_events,
    result,
    rounded,
    with_ctes,
)
from tapewell.config import TICKER_TOPIC, default_feed
from tapewell.functions.events import decode_events, encode_event, with_event_columns
from tapewell.functions.parsing import mid, parse_ts, spread
from tapewell.operators.normalize import (
    events_of,
    normalization_summary,
    normalize_binance_book,
    normalize_binance_trades,
    normalize_coinbase_ticker,
    normalize_coinbase_trades,
    normalize_tagged,
    rejects_of,
    resolve_symbol,
    to_quarantine,
)
from tapewell.schemas import EVENT_COLUMNS
from tapewell.session import stage, work_dir
from tapewell.sinks.lake import land_quarantine, start_bronze_sink, write_raw_messages
from tapewell.sinks.topics import (
    publish,
    publish_records,
    reject_records,
    route_events,
    topic_records,
    with_topic,
)
from tapewell.sources.dimension import symbol_dimension
from tapewell.sources.lake import read_bronze, read_quarantine
from tapewell.sources.raw import count_raw_messages, read_raw_messages, stream_raw_messages
from tapewell.sources.topics import read_topic_events, stream_topic_events
from tapewell.streaming.live import BRONZE, QUARANTINE, read_commits, read_live, start_live
from tapewell.streaming.normalizing import stream_normalize
from tapewell.streaming.windows import LATE, WINDOW

PER_MESSAGE = 3


def iso_nanos(ts: Column) -> Column:
    """Exchange time text with nanoseconds."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _packed(events: DataFrame, record: Column) -> DataFrame:
    """Events packed into messages; a group never holds more than a few events."""
    return events.groupBy(F.expr(f"event_id div {PER_MESSAGE}").alias("seq")).agg(
        F.max("ts_ingest").alias("ts_recorded"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("event_id", record.alias("record")))),
            lambda x: x["record"],
        ).alias("records"),
        F.max("ts_event").alias("ts_sent"),
    )


def coinbase_trade_messages(events: DataFrame) -> DataFrame:
    """``market_trades`` messages; each also repeats its trades in a snapshot to be skipped."""
    record = F.struct(
        F.col("symbol").alias("product_id"),
        "trade_id",
        _text("price").alias("price"),
        _text("size").alias("size"),
        iso_nanos(F.col("ts_event")).alias("time"),
        F.upper("side").alias("side"),
    )
    packed = _packed(events.where("event_type = 'trade'"), record)
    payload = F.struct(
        F.lit("market_trades").alias("channel"),
        iso_nanos(F.col("ts_sent")).alias("timestamp"),
        F.col("seq").alias("sequence_num"),
        F.array(
            F.struct(F.lit("snapshot").alias("type"), F.col("records").alias("trades")),
            F.struct(F.lit("update").alias("type"), F.col("records").alias("trades")),
        ).alias("events"),
    )
    return packed.select(
        "seq",
        "ts_recorded",
        F.lit("coinbase").alias("exchange"),
        F.lit("market_trades").alias("channel"),
        F.to_json(payload).alias("payload"),
    )


def coinbase_ticker_messages(events: DataFrame) -> DataFrame:
    """One quote per ``ticker`` message; every 11th envelope has an unreadable timestamp."""
    readable = iso_nanos(F.col("ts_event"))
    payload = F.struct(
        F.lit("ticker").alias("channel"),
        F.when(F.col("event_id") % 11 == 0, F.lit("soon")).otherwise(readable).alias("timestamp"),
        F.array(
            F.struct(
                F.lit("update").alias("type"),
                F.array(
                    F.struct(
                        F.lit("ticker").alias("type"),
                        F.col("symbol").alias("product_id"),
                        F.lit("").alias("price"),
                        _text("best_bid").alias("best_bid"),
                        _text("best_ask").alias("best_ask"),
                        F.lit("1.5").alias("best_bid_quantity"),
                    )
                ).alias("tickers"),
            )
        ).alias("events"),
    )
    return events.where("event_type = 'ticker'").select(
        F.col("event_id").alias("seq"),
        F.col("ts_ingest").alias("ts_recorded"),
        F.lit("coinbase").alias("exchange"),
        F.lit("ticker").alias("channel"),
        F.to_json(payload).alias("payload"),
    )


def _native() -> Column:
    return F.replace("symbol", F.lit("-"), F.lit(""))


def _binance(events: DataFrame, data: Column, channel: str) -> DataFrame:
    """Combined-stream messages; odd events come as the bare object."""
    wrapped = F.to_json(F.struct(F.lit(channel).alias("stream"), data.alias("data")))
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts_ingest").alias("ts_recorded"),
        F.lit("binance_us").alias("exchange"),
        F.lit(channel).alias("channel"),
        F.when(F.col("event_id") % 2 == 0, wrapped).otherwise(F.to_json(data)).alias("payload"),
    )


def binance_trade_messages(events: DataFrame) -> DataFrame:
    """Trades; every third does not say so and has to be recognized by its keys."""
    data = F.struct(
        F.when(F.col("event_id") % 3 != 0, F.lit("trade")).alias("e"),
        _native().alias("s"),
        F.col("event_id").alias("t"),
        _text("price").alias("p"),
        _text("size").alias("q"),
        F.unix_millis("ts_event").alias("T"),
        (F.col("side") == "sell").alias("m"),
    )
    return _binance(events.where("event_type = 'trade'"), data, "trade")


def binance_book_messages(events: DataFrame) -> DataFrame:
    data = F.struct(
        _native().alias("s"),
        _text("best_bid").alias("b"),
        _text("best_ask").alias("a"),
        F.lit("2.5").alias("B"),
    )
    return _binance(events.where("event_type = 'ticker'"), data, "bookTicker")


def coinbase_messages(events: DataFrame) -> DataFrame:
    return coinbase_trade_messages(events).unionByName(coinbase_ticker_messages(events))


def all_messages(events: DataFrame) -> DataFrame:
    return (
        coinbase_messages(events)
        .unionByName(binance_trade_messages(events))
        .unionByName(binance_book_messages(events))
    )


_OUT = [c for c in EVENT_COLUMNS if c != "ts_ingest"]




def _ingest() -> Column:
    """Messages count as ingested when they were recorded."""
    return F.col("ts_recorded")


def _normalized(build, job):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = build(market_events(spark, sf))
        events, _ = job(raw, symbol_dimension(spark, default_feed()), _ingest())
        return result(events.select(*_OUT))

    return run


def _tagged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = all_messages(market_events(spark, sf))
    return raw, normalize_tagged(raw, symbol_dimension(spark, default_feed()), _ingest())


def _rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = rejects_of(_tagged(spark, sf)[1])
    return rejects.groupBy("exchange", "seq", "reason").agg(F.count("*").alias("n"))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    raw, tagged = _tagged(spark, sf)
    return normalization_summary(raw, tagged).select(
        "messages",
        "events",
        "trades",
        "tickers",
        "quarantined",
        F.array_join(
            F.transform(
                F.map_entries("by_symbol"),
                lambda x: F.concat_ws("=", x["key"], x["value"].cast("string")),
            ),
            ";",
        ).alias("by_symbol"),
    )


def _raw_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All messages written as JSON lines, counted unparsed, and read back with their payloads."""
    path = work_dir(spark, "raw")
    raw = stage(all_messages(market_events(spark, sf)), "messages")
    write_raw_messages(raw, path)
    lines = F.lit(count_raw_messages(spark, path)).cast("bigint")
    sent = raw.select("exchange", "channel", "seq", F.col("payload").alias("sent"))
    back = read_raw_messages(spark, path).join(sent, ["exchange", "channel", "seq"])
    same = (F.col("payload") == F.col("sent")).alias("same_payload")
    return result(back.select("seq", "ts_recorded", "exchange", "channel", same, lines.alias("lines")))


def _first_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The first half of the trade messages by number, as ``limit`` takes them."""
    path = work_dir(spark, "raw")
    raw = stage(coinbase_trade_messages(market_events(spark, sf)), "messages")
    write_raw_messages(raw, path)
    return read_raw_messages(spark, path, raw.count() // 2).select("seq", "exchange", "channel")


def _quarantine_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The rejects of all messages landed and read back."""
    path = work_dir(spark, "quarantine")
    land_quarantine(to_quarantine(rejects_of(_tagged(spark, sf)[1])), path)
    record = F.coalesce(
        F.get_json_object("payload", "$.product_id"), F.get_json_object("payload", "$.s"), F.lit("none")
    )
    return (
        read_quarantine(spark, path)
        .groupBy("exchange", "seq", "reason", F.replace(record, F.lit("-"), F.lit("")).alias("product"))
        .agg(F.count("*").alias("n"))
    )


_UNKNOWN_EXCHANGE = (
    '{"seq": 2, "ts_recorded": "2024-01-01T00:00:00Z", "exchange": "nowhere", "channel": "x", "payload": {"a": 1}}'
)


def _stream_normalize(spark: SparkSession, sf: str) -> DataFrame:
    events = market_events(spark, sf)
    source, sink = work_dir(spark, "feed"), work_dir(spark, "feed-out")
    write_raw_messages(all_messages(events), f"{source}/feed")
    strange = [("no message",), ('{"seq": 1}',), (_UNKNOWN_EXCHANGE,), ("  ",)]
    spark.createDataFrame(strange, "value string").coalesce(1).write.text(f"{source}/strange")
    stream = stream_raw_messages(spark, path=f"{source}/*")
    stream_normalize(
        stream,
        symbol_dimension(spark, default_feed()),
        f"{sink}/events",
        f"{sink}/quarantine",
        f"{sink}/checkpoint",
        ts_ingest=_ingest(),
    ).awaitTermination()
    landed = spark.read.parquet(f"{sink}/events").groupBy("event_type", "symbol").agg(
        F.count("*").alias("n"), F.max("ts_event").alias("newest")
    )
    rejected = spark.read.parquet(f"{sink}/quarantine").agg(F.count("*").alias("n"))
    return result(
        landed.unionByName(
            rejected.select(
                F.lit("rejected").alias("event_type"),
                F.lit("all").alias("symbol"),
                "n",
                F.lit(None).cast("timestamp").alias("newest"),
            )
        )
    )


class _Killed(Exception):
    pass


# Runs of the live plan, lines that are no message and messages of an unknown exchange in each.
LIVE_SLICES = 3


def numbered_feed(events: DataFrame) -> DataFrame:
    """All messages under numbers of their own, those of one moment side by side."""
    parts = [
        coinbase_trade_messages(events).withColumn("seq", F.expr(f"({PER_MESSAGE} * (seq + 1) - 1) * 4")),
        coinbase_ticker_messages(events).withColumn("seq", F.expr("seq * 4 + 1")),
        binance_trade_messages(events).withColumn("seq", F.expr("seq * 4 + 2")),
        binance_book_messages(events).withColumn("seq", F.expr("seq * 4 + 3")),
    ]
    return reduce(DataFrame.unionByName, parts)


def _live(spark: SparkSession, sf: str) -> tuple[str, int]:
    """The live plan over a feed that grows, killed once between two tables: its root, and batches."""
    root = work_dir(spark, "live")
    feed = stage(numbered_feed(market_events(spark, sf)), "feed")
    shares = [i / LIVE_SLICES for i in range(1, LIVE_SLICES)]
    cuts = [float("-inf"), *feed.approxQuantile("seq", shares, 0.01), float("inf")]
    killed = []

    def landed(name: str, batch_id: int) -> None:
        if batch_id == 1 and name == QUARANTINE and not killed:
            killed.append(batch_id)
            raise _Killed

    def run() -> None:
        start_live(
            stream_raw_messages(spark.newSession(), path=f"{root}/in/*"),
            f"{root}/out",
            f"{root}/checkpoint",
            symbol_dimension(spark, default_feed()),
            SIZES,
            GRACE,
            ts_ingest=_ingest(),
            landed=landed,
        ).awaitTermination()

    for number, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        strange = spark.createDataFrame([("no message",), ('{"seq": 1}',)], "value string")
        strange.coalesce(1).write.text(f"{root}/in/strange-{number}")
        write_raw_messages(feed.where((F.col("seq") >= low) & (F.col("seq") < high)), f"{root}/in/feed-{number}")
        try:
            run()
        except StreamingQueryException:
            if read_commits(spark, f"{root}/out").count() != number:
                raise
            run()
    return f"{root}/out", len(killed)


def _live_run(spark: SparkSession, sf: str) -> DataFrame:
    """What the live plan shows of its tables, in a few rows each, and what its commits say."""
    out, killed = _live(spark, sf)
    none = F.lit(None).cast("timestamp")
    bronze = read_live(spark, out, BRONZE).groupBy("event_type", "symbol")
    rejects = read_live(spark, out, QUARANTINE).groupBy("exchange")
    windows = read_live(spark, out, WINDOW).groupBy("source", F.concat_ws(" ", "symbol", "window_size").alias("part"))
    late = read_live(spark, out, LATE).groupBy("source", "window_size")
    commits = read_commits(spark, out)
    n, no_total = F.count("*").alias("n"), F.lit(0.0)
    parts = [
        bronze.agg(n, no_total, F.max("ts_event")),
        rejects.agg(n).select("exchange", F.lit("all"), "n", no_total, none),
        windows.agg(n, F.sum(F.col("trade_volume") + F.col("event_count")), F.max("window_start")),
        late.agg(n, no_total, F.max("window_start")),
        commits.select(
            F.lit("landed"), F.lit("all"), F.expr("bronze_rows + quarantine_rows + window_rows + late_rows"), no_total, none
        ).toDF("a", "b", "n", "total", "newest").groupBy("a", "b").agg(F.sum("n"), F.max("total"), F.max("newest")),
        commits.agg(n).select(F.lit("killed"), F.lit(str(killed)), "n", no_total, none),
    ]
    kinds = ("bronze", "quarantine", "windows", "late", "commits", "batches")
    named = [
        df.toDF("a", "b", "n", "total", "newest").withColumn("kind", F.lit(kind))
        for kind, df in zip(kinds, parts, strict=True)
    ]
    return result(reduce(DataFrame.unionByName, named), 3)


def _symbol_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Every event's symbol as each exchange spells it, mapped back; unknown ones dropped."""
    config = default_feed()
    events = market_events(spark, sf).select("event_id", "symbol")
    kinds = {
        "coinbase": ("coinbase_trade", F.col("symbol")),
        "binance_us": ("binance_trade", _native()),
    }
    parts = []
    for exchange, (kind, native) in kinds.items():
        fields = events.select(
            F.lit(exchange).alias("exchange"),
            F.lit(kind).alias("kind"),
            native.alias("product_id"),
            native.alias("bn_symbol"),
            F.lit('{"product_id": ""}').alias("record"),
        )
        parts.append(resolve_symbol(fields, symbol_dimension(spark, config, exchange)))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("exchange", "native_symbol", "symbol").agg(F.count("*").alias("n"))


def _route_events(spark: SparkSession, sf: str) -> DataFrame:
    trades, tickers = route_events(market_events(spark, sf))
    return (
        trades.withColumn("topic", F.lit("trades.raw"))
        .unionByName(tickers.withColumn("topic", F.lit("ticker.raw")))
        .groupBy("topic", "event_type", "symbol")
        .agg(F.count("*").alias("n"))
    )


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """Events published to topic files, read back and decoded."""
    path = work_dir(spark, "topics")
    publish(market_events(spark, sf), path=path)
    return result(read_topic_events(spark, path)[0].select("topic", "key", *EVENT_COLUMNS))


def _damaged_topic(spark: SparkSession, sf: str) -> str:
    """Topic files of the driver events, every seventh record cut off after 30 characters."""
    path = work_dir(spark, "topics")
    cut = F.when(F.col("event_id") % 7 == 0, F.substring("value", 1, 30)).otherwise(F.col("value"))
    records = with_topic(market_events(spark, sf)).select(
        "topic", F.col("symbol").alias("key"), encode_event().alias("value"), "event_id"
    )
    publish_records(records.select("topic", "key", cut.alias("value")), path=path)
    return path


def _consumed(spark: SparkSession, sf: str) -> DataFrame:
    """The ticker topic consumed as a stream from its beginning, past damaged records, landed as bronze."""
    path, out = _damaged_topic(spark, sf), work_dir(spark, "consumed")
    events, _ = stream_topic_events(spark, path=path, topics=[TICKER_TOPIC])
    start_bronze_sink(events, f"{out}/bronze", f"{out}/checkpoint").awaitTermination()
    return result(read_bronze(spark, f"{out}/bronze").select(*EVENT_COLUMNS))


def _quarantine_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged records of all topics, streamed to the quarantine topic with where they came from."""
    path, out = _damaged_topic(spark, sf), work_dir(spark, "refused")
    _, rejects = stream_topic_events(spark, path=path)

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        reject_records(batch).write.mode("overwrite").parquet(f"{out}/records/batch_id={batch_id}")

    writer = rejects.writeStream.foreachBatch(publish_batch).option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    refused = spark.read.schema("topic string, key string, value string").parquet(f"{out}/records")
    return refused.groupBy(
        "topic",
        "key",
        F.get_json_object("value", "$.topic").alias("from_topic"),
        F.get_json_object("value", "$.reason").alias("reason"),
    ).agg(F.count("*").alias("n"))


def _forced_topic(spark: SparkSession, sf: str) -> DataFrame:
    records = topic_records(market_events(spark, sf), "replay.all")
    return records.groupBy("topic", "key").agg(F.count("*").alias("n"))


def _decode_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Four of five encoded events damaged, each kind its own way: what is read and what refused."""
    encoded = market_events(spark, sf).select("event_id", encode_event().alias("value"))
    kind = F.col("event_id") % 5
    damaged = (
        F.when(kind == 1, F.lit("{}"))
        .when(kind == 2, F.substring("value", 1, 20))
        .when(kind == 3, F.regexp_replace("value", '"event_type":"[a-z]+"', '"event_type":"rumour"'))
        .when(kind == 4, F.regexp_replace("value", r"^\{", '{"colour":"red",'))
        .otherwise(F.col("value"))
    )
    events, rejects = decode_events(encoded.withColumn("value", damaged))
    read = events.select("event_id", F.lit("read").alias("outcome"))
    return read.unionByName(
        rejects.select("event_id", F.trim(F.regexp_extract("reason", "^[a-z_ ]+", 0)).alias("outcome"))
    )


def _event_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    encoded = market_events(spark, sf).select("event_id", encode_event().alias("value"))
    return result(with_event_columns(encoded).select("event_id", *EVENT_COLUMNS))


def _spread_mid(spark: SparkSession, sf: str) -> DataFrame:
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return result(
        market_events(spark, sf).select(
            "event_id", spread(bid, ask).alias("spread"), mid(bid, ask).alias("mid")
        )
    )


def _parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's time written in one of eight ways, two of them unreadable."""
    ts = F.col("ts_event")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ahead = F.date_format(ts + F.expr("INTERVAL 2 HOURS"), micros)
    ways = [
        iso_nanos(ts),
        F.concat(ahead, F.lit("+02:00")),
        F.date_format(ts, micros),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        F.concat(F.lit("  "), F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" ")),
        F.date_format(ts, "yyyy-MM-dd"),
        F.concat(F.lit("bad-"), F.col("event_id").cast("string")),
        F.date_format(ts, "yyyy"),
    ]
    text = F.element_at(F.array(*ways), (F.col("event_id") % 8 + 1).cast("int"))
    return result(market_events(spark, sf).select("event_id", parse_ts(text).alias("parsed")))


# --- SQL: the expected events, straight from the driver events ---

_KNOWN = f"symbol IN ({SYMBOL_LIST})"
_TRADE_OK = "event_type = 'trade' AND price > 0 AND size >= 0"
_QUOTE_OK = "event_type = 'ticker' AND best_bid >= 0 AND best_ask >= 0 AND best_ask >= best_bid"

_TRADE_ROW = (
    "exchange, symbol, event_type, " + rounded("price", "size") + ", side, "
    "{trade_id} AS trade_id, CAST(NULL AS DOUBLE) AS best_bid, CAST(NULL AS DOUBLE) AS best_ask, "
    "CAST(NULL AS DOUBLE) AS best_bid_size, CAST(NULL AS DOUBLE) AS best_ask_size, {ts} AS ts_event"
)
_QUOTE_ROW = (
    "{exchange} AS exchange, symbol, event_type, CAST(NULL AS DOUBLE) AS price, "
    "CAST(NULL AS DOUBLE) AS size, CAST(NULL AS VARCHAR) AS side, "
    "CAST(NULL AS VARCHAR) AS trade_id, "
    + rounded("best_bid", "best_ask")
    + ", CAST({bid_size} AS DOUBLE) AS best_bid_size, "
    "CAST(NULL AS DOUBLE) AS best_ask_size, {ts} AS ts_event"
)

_COINBASE_TRADES = (
    f"SELECT {_TRADE_ROW.format(trade_id='trade_id', ts='ts_event')} FROM market_events "
    f"WHERE {_KNOWN} AND {_TRADE_OK}"
)
_COINBASE_QUOTES = (
    "SELECT "
    + _QUOTE_ROW.format(exchange="exchange", bid_size="1.5", ts="ts_event")
    + f" FROM market_events WHERE {_KNOWN} AND {_QUOTE_OK} AND event_id % 11 <> 0"
)
_BINANCE_TRADES = (
    "SELECT 'binance_us' AS exchange, * EXCLUDE (exchange) FROM (SELECT "
    + _TRADE_ROW.format(
        trade_id="CAST(event_id AS VARCHAR)", ts="date_trunc('milliseconds', ts_event)"
    )
    + f" FROM market_events WHERE {_KNOWN} AND {_TRADE_OK})"
)
_BINANCE_QUOTES = (
    "SELECT "
    + _QUOTE_ROW.format(exchange="'binance_us'", bid_size="2.5", ts="ts_ingest")
    + f" FROM market_events WHERE {_KNOWN} AND {_QUOTE_OK}"
)

_TRADE_REASON = (
    "CASE WHEN price IS NULL THEN '''{key}''' "
    "ELSE concat('price must be > 0, got ', price) END"
)
_QUOTE_REASON = (
    "CASE WHEN best_ask < 0 THEN concat('best_ask must be >= 0, got ', best_ask) "
    "ELSE concat('crossed book: best_ask (', best_ask, ') < best_bid (', best_bid, ')') END"
)
_BAD_TRADE = f"{_KNOWN} AND event_type = 'trade' AND (price IS NULL OR price <= 0)"
_BAD_QUOTE = f"{_KNOWN} AND event_type = 'ticker' AND (best_ask < 0 OR best_ask < best_bid)"
_COINBASE_REJECTS = f"""
SELECT exchange, event_id // {PER_MESSAGE} AS seq, {_TRADE_REASON.format(key='price')} AS reason,
  symbol AS product
FROM market_events WHERE {_BAD_TRADE}
UNION ALL SELECT exchange, event_id,
  'bad envelope timestamp: Invalid isoformat string: ''soon''', 'none'
FROM market_events WHERE event_type = 'ticker' AND event_id % 11 = 0
UNION ALL SELECT exchange, event_id, {_QUOTE_REASON}, symbol
FROM market_events WHERE {_BAD_QUOTE} AND event_id % 11 <> 0"""
# A Binance trade that neither says so nor has a price is not a trade at all.
_BINANCE_REJECTS = f"""
SELECT 'binance_us' AS exchange, event_id AS seq, {_TRADE_REASON.format(key='p')} AS reason,
  symbol AS product
FROM market_events WHERE {_BAD_TRADE} AND NOT (price IS NULL AND event_id % 3 = 0)
UNION ALL SELECT 'binance_us', event_id, {_QUOTE_REASON}, symbol FROM market_events WHERE {_BAD_QUOTE}"""
_ALL_REJECTS = f"{_COINBASE_REJECTS} UNION ALL {_BINANCE_REJECTS}"
_ALL_EVENTS = " UNION ALL ".join(
    f"({q})" for q in (_COINBASE_TRADES, _COINBASE_QUOTES, _BINANCE_TRADES, _BINANCE_QUOTES)
)

# The live feed: what it accepts, numbered by arrival, through the steps that judge windows.
_JUDGED = ("clocked", "late_flags", "clock_windows", "closed_by_clock")


def _of_live(sql: str) -> str:
    sql = sql.replace("ORDER BY ts_ingest, event_id", "ORDER BY arrival, event_id")
    return re.sub(rf"\b(market_events|{'|'.join(_JUDGED)})\b", r"live_\1", sql)


_LIVE_STEPS = "".join(f", live_{name} AS ({_of_live(CTES[name])})" for name in _JUDGED)
_LIVE_COLUMNS = "symbol, event_type, price, size, best_bid, best_ask"
# Steps of a query; the last is the closed windows of the feed, late records left out.
LIVE_WINDOWS = f"""
, sizes AS ({CTES['sizes']}), live_market_events AS (
  SELECT {_LIVE_COLUMNS}, ts_event, event_id, ({PER_MESSAGE} * (event_id // {PER_MESSAGE} + 1) - 1) * 4 AS arrival
  FROM market_events WHERE {_KNOWN} AND {_TRADE_OK}
  UNION ALL SELECT {_LIVE_COLUMNS}, ts_event, event_id, event_id * 4 + 1
  FROM market_events WHERE {_KNOWN} AND {_QUOTE_OK} AND event_id % 11 <> 0
  UNION ALL SELECT {_LIVE_COLUMNS}, date_trunc('milliseconds', ts_event), event_id, event_id * 4 + 2
  FROM market_events WHERE {_KNOWN} AND {_TRADE_OK}
  UNION ALL SELECT {_LIVE_COLUMNS}, ts_ingest, event_id, event_id * 4 + 3
  FROM market_events WHERE {_KNOWN} AND {_QUOTE_OK}
){_LIVE_STEPS}"""
_LIVE_SQL = f"""{LIVE_WINDOWS}, parts AS (
  SELECT 'bronze' AS kind, event_type AS a, symbol AS b, count(*) AS n, 0.0 AS total, max(ts_event) AS newest
  FROM live_market_events GROUP BY ALL
  UNION ALL SELECT 'quarantine', exchange, 'all', count(*), 0.0, NULL
  FROM ({_ALL_REJECTS}) GROUP BY ALL
  UNION ALL SELECT 'quarantine', 'unknown', 'all', {LIVE_SLICES} * 2, 0.0, NULL
  UNION ALL SELECT 'windows', source, concat_ws(' ', symbol, window_size), count(*),
    round(sum(trade_volume + event_count), 3), max(window_start) FROM live_closed_by_clock GROUP BY ALL
  UNION ALL SELECT 'late', source, window_size, count(*), 0.0, max(window_start)
  FROM live_late_flags WHERE late GROUP BY ALL
)
SELECT kind, a, b, n, CAST(total AS DOUBLE) AS total, newest FROM parts
UNION ALL SELECT 'commits', 'landed', 'all', CAST(sum(n) AS BIGINT), 0.0, NULL FROM parts
UNION ALL SELECT 'batches', 'killed', '1', {LIVE_SLICES}, 0.0, NULL"""



def _from_events(select: str) -> str:
    return with_ctes("market_events", select=select)


_TOPIC = "CASE WHEN event_type = 'ticker' THEN 'ticker.raw' ELSE 'trades.raw' END AS topic"

FEED_QUERIES: dict[str, Query] = {
    "coinbase_trades": Query(
        _normalized(coinbase_trade_messages, normalize_coinbase_trades),
        _from_events(_COINBASE_TRADES),
    ),
    "coinbase_ticker": Query(
        _normalized(coinbase_ticker_messages, normalize_coinbase_ticker),
        _from_events(_COINBASE_QUOTES),
    ),
    "binance_trades": Query(
        _normalized(binance_trade_messages, normalize_binance_trades),
        _from_events(_BINANCE_TRADES),
    ),
    "binance_book": Query(
        _normalized(binance_book_messages, normalize_binance_book),
        _from_events(_BINANCE_QUOTES),
    ),
    "normalize_events": Query(
        lambda spark, sf: result(events_of(_tagged(spark, sf)[1]).select(*_OUT)),
        _from_events(
            " UNION ALL ".join(
                f"({q})"
                for q in (_COINBASE_TRADES, _COINBASE_QUOTES, _BINANCE_TRADES, _BINANCE_QUOTES)
            )
        ),
    ),
    "normalize_rejects": Query(
        _rejects,
        _from_events(
            f"SELECT exchange, seq, reason, count(*) AS n FROM ({_ALL_REJECTS}) GROUP BY ALL"
        ),
    ),
    "normalization_summary": Query(
        _summary,
        _from_events(
            f"""
SELECT (SELECT count(DISTINCT event_id // {PER_MESSAGE}) FROM market_events
        WHERE event_type = 'trade') + (SELECT count(*) FROM market_events
        WHERE event_type = 'trade') + 2 * (SELECT count(*) FROM market_events
        WHERE event_type = 'ticker') AS messages,
  CAST(sum(n) AS BIGINT) AS events, CAST(sum(trades) AS BIGINT) AS trades,
  CAST(sum(n - trades) AS BIGINT) AS tickers,
  (SELECT count(*) FROM ({_ALL_REJECTS})) AS quarantined,
  string_agg(symbol || '=' || n, ';' ORDER BY symbol) AS by_symbol
FROM (SELECT symbol, count(*) AS n, count(*) FILTER (event_type = 'trade') AS trades
      FROM ({_ALL_EVENTS}) GROUP BY symbol)"""
        ),
    ),
    "raw_roundtrip": Query(
        _raw_roundtrip,
        _from_events(
            f"""
SELECT *, true AS same_payload, count(*) OVER () AS lines FROM (
  SELECT event_id // {PER_MESSAGE} AS seq, max(ts_ingest) AS ts_recorded, 'coinbase' AS exchange,
    'market_trades' AS channel FROM market_events WHERE event_type = 'trade' GROUP BY 1
  UNION ALL SELECT event_id, ts_ingest, 'binance_us', 'trade' FROM market_events WHERE event_type = 'trade'
  UNION ALL SELECT event_id, ts_ingest, 'coinbase', 'ticker' FROM market_events WHERE event_type = 'ticker'
  UNION ALL SELECT event_id, ts_ingest, 'binance_us', 'bookTicker' FROM market_events
    WHERE event_type = 'ticker')"""
        ),
    ),
    "first_messages": Query(
        _first_messages,
        _from_events(
            f"""
, m AS (SELECT DISTINCT event_id // {PER_MESSAGE} AS seq FROM market_events WHERE event_type = 'trade')
SELECT seq, 'coinbase' AS exchange, 'market_trades' AS channel FROM m
QUALIFY row_number() OVER (ORDER BY seq) <= (SELECT count(*) // 2 FROM m)"""
        ),
    ),
    "quarantine_roundtrip": Query(
        _quarantine_roundtrip,
        _from_events(
            f"SELECT exchange, seq, reason, replace(product, '-', '') AS product, count(*) AS n "
            f"FROM ({_ALL_REJECTS}) GROUP BY ALL"
        ),
    ),
    "stream_normalize": Query(
        _stream_normalize,
        _from_events(
            "SELECT event_type, symbol, count(*) AS n, max(ts_event) AS newest FROM "
            f"({_ALL_EVENTS}) GROUP BY 1, 2 UNION ALL "
            f"SELECT 'rejected', 'all', count(*) + 3, NULL FROM ({_ALL_REJECTS})"
        ),
    ),
    "live_run": Query(_live_run, _from_events(_LIVE_SQL)),
    "symbol_dimension": Query(
        _symbol_dimension,
        _from_events(
            "SELECT exchange, symbol AS native_symbol, symbol, count(*) AS n FROM market_events "
            f"WHERE {_KNOWN} GROUP BY ALL UNION ALL SELECT 'binance_us', "
            "replace(symbol, '-', ''), symbol, count(*) FROM market_events "
            f"WHERE {_KNOWN} GROUP BY ALL"
        ),
    ),
    "route_events": Query(
        _route_events,
        _from_events(
            f"SELECT {_TOPIC}, event_type, symbol, count(*) AS n FROM market_events GROUP BY ALL"
        ),
    ),
    "publish_events": Query(
        _published,
        _from_events(
            f"SELECT {_TOPIC}, symbol AS key, {EVENT_SELECT} FROM market_events"
        ),
    ),
    "consume_topic": Query(
        _consumed,
        _from_events(
            f"SELECT {EVENT_SELECT} FROM market_events WHERE event_type = 'ticker' AND event_id % 7 <> 0"
        ),
    ),
    "quarantine_topic": Query(
        _quarantine_topic,
        _from_events(
            "SELECT 'contracts.quarantine' AS topic, symbol AS key, topic AS from_topic, "
            f"'not a JSON object' AS reason, count(*) AS n FROM (SELECT *, {_TOPIC} FROM market_events "
            "WHERE event_id % 7 = 0) GROUP BY ALL"
        ),
    ),
    "publish_one_topic": Query(
        _forced_topic,
        _from_events(
            "SELECT 'replay.all' AS topic, symbol AS key, count(*) AS n FROM market_events "
            "GROUP BY ALL"
        ),
    ),
    "event_json_roundtrip": Query(
        _event_roundtrip, _from_events(f"SELECT event_id, {EVENT_SELECT} FROM market_events")
    ),
    "decode_rejects": Query(
        _decode_rejects,
        _from_events(
            "SELECT event_id, CASE WHEN event_id % 5 = 1 THEN 'missing field' "
            "WHEN event_id % 5 = 2 THEN 'not a' WHEN event_id % 5 = 4 THEN 'unknown fields' "
            "WHEN event_id % 5 = 3 OR event_type NOT IN ('trade', 'ticker') THEN 'unknown event_type' "
            "WHEN price <= 0 THEN 'price must be' WHEN best_ask < best_bid THEN 'crossed book' "
            "ELSE 'read' END AS outcome FROM market_events"
        ),
    ),
    "spread_mid": Query(
        _spread_mid,
        _from_events(
            "SELECT event_id, round(best_ask - best_bid + 1e-11, 9) AS spread, "
            "round((best_ask + best_bid) / 2.0 + 1e-11, 9) AS mid FROM market_events"
        ),
    ),
    "parse_ts": Query(
        _parse_ts,
        _from_events(
            "SELECT event_id, CASE event_id % 8 WHEN 3 THEN date_trunc('second', ts_event) "
            "WHEN 5 THEN date_trunc('day', ts_event) WHEN 6 THEN NULL WHEN 7 THEN NULL "
            "ELSE ts_event END AS parsed FROM market_events"
        ),
    ),
}
