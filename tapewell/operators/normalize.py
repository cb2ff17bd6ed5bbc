"""Raw messages to market events, record by record, with rejects on the side.

One pass serves every exchange: each message is opened into its sub-records, a
sub-record into its fields, and a field that cannot be read gives that sub-record
(and only that one) a reason. The result is one *tagged* table; events are its
rows without a reason, rejects the rows with one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewell.functions.checks import ingest_check
from tapewell.functions.parsing import (
    aggressor_side,
    binance_trade_id,
    coinbase_trade_id,
    finite,
    is_given,
    parse_ts,
    side_from_maker,
    strict_double,
    ts_from_millis,
)
from tapewell.schemas import ARRIVAL, EVENT_COLUMNS, POSITION
from tapewell.schemas import FLOAT_COLUMNS as NUMBERS

# Kinds of sub-record.
COINBASE_TRADE = "coinbase_trade"
COINBASE_TICKER = "coinbase_ticker"
BAD_ENVELOPE = "bad_envelope"
BINANCE = "binance"
BINANCE_TRADE = "binance_trade"
BINANCE_BOOK = "binance_book"

_COINBASE_PAYLOAD = (
    "channel string, timestamp string, "
    "events array<struct<type: string, trades: array<string>, tickers: array<string>>>"
)

# Fields opened from the text of a sub-record, and the column each is kept in.
# Column names differ from the JSON names where those differ only by case.
_FIELDS = {
    "product_id": "product_id",
    "trade_id": "trade_id",
    "price": "price",
    "size": "size",
    "side": "side",
    "time": "time",
    "best_bid": "best_bid",
    "best_ask": "best_ask",
    "best_bid_quantity": "best_bid_quantity",
    "best_ask_quantity": "best_ask_quantity",
    "e": "bn_event",
    "s": "bn_symbol",
    "t": "bn_trade_id",
    "p": "bn_price",
    "q": "bn_quantity",
    "T": "bn_time",
    "m": "bn_maker",
    "b": "bn_bid",
    "a": "bn_ask",
    "B": "bn_bid_quantity",
    "A": "bn_ask_quantity",
}

# Exchanges with a normalizer.
EXCHANGES = ("coinbase", "binance_us")

_RECORD = "record"


def _gate_exchanges(raw: DataFrame) -> DataFrame:
    known = F.col("exchange").isin(*EXCHANGES)
    complaint = F.concat(F.lit("no normalizer for exchange "), F.col("exchange"))
    return raw.where(F.when(known, True).otherwise(F.raise_error(complaint).cast("boolean")))


def _sub_texts(events: Column, name: str) -> Column:
    """Texts of all sub-records of a message, across its events, in order."""
    return F.flatten(
        F.transform(events, lambda e: F.coalesce(e[name], F.array().cast("array<string>")))
    )


def _absent(text: Column, holder: str, key: Column) -> Column:
    """True if the JSON object has no such key at all (a null value does not count)."""
    keys = F.json_object_keys(holder)
    return text.isNull() & ~F.coalesce(F.array_contains(keys, key), F.lit(False))


def _why_unreadable(
    text: Column, holder: str, key: Column, null_reason: str, bad_reason: Column
) -> Column:
    """Reason for a required field that could not be read: missing, null or garbage."""
    return (
        F.when(_absent(text, holder, key), F.concat(F.lit("'"), key, F.lit("'")))
        .when(text.isNull(), F.lit(null_reason))
        .otherwise(bad_reason)
    )


def _quoted(before: str, text: Column) -> Column:
    return F.concat(F.lit(f"{before}: '"), text, F.lit("'"))


def _why_no_timestamp(text: Column, holder: str, key: str) -> Column:
    return _why_unreadable(
        text,
        holder,
        F.lit(key),
        "'NoneType' object has no attribute 'strip'",
        _quoted("Invalid isoformat string", text),
    )


def _why_no_time() -> Column:
    unread = F.col("ts_event").isNull()
    return F.when(unread, _why_no_timestamp(F.col("time_text"), _RECORD, "time"))


def _why_no_millis() -> Column:
    text = F.col("time_text")
    why = _why_unreadable(
        text,
        _RECORD,
        F.lit("T"),
        "int() argument must be a string, a bytes-like object or a real number, not 'NoneType'",
        _quoted("invalid literal for int() with base 10", text),
    )
    return F.when(F.col("ts_event").isNull(), why)


def _not_a_float(text: Column) -> Column:
    return _quoted("could not convert string to float", text)


def _why_no_number(name: str, key: Column) -> Column:
    text = F.col(f"{name}_text")
    why = _why_unreadable(
        text,
        _RECORD,
        key,
        "float() argument must be a string or a real number, not 'NoneType'",
        _not_a_float(text),
    )
    return F.when(F.col(name).isNull(), why)


def _why_bad_option(name: str) -> Column:
    """An optional number may be missing, null or empty, but not garbage."""
    text = F.col(f"{name}_text")
    return F.when(is_given(text) & F.col(name).isNull(), _not_a_float(text))


def sub_records(raw: DataFrame, ts_ingest: Column | None = None) -> DataFrame:
    """Messages opened into sub-records, their text kept for the quarantine.

    Elements are opened as text first and then one by one, so an element of the
    wrong shape cannot take its siblings with it. ``snapshot`` events (a backfill
    of old trades on subscribing) are skipped for trades only.
    """
    ingest = ts_ingest if ts_ingest is not None else F.current_timestamp()
    is_coinbase = F.col("exchange") == "coinbase"
    opened = _gate_exchanges(raw).select(
        "seq",
        "exchange",
        ingest.cast("timestamp").alias("ts_ingest"),
        "payload",
        F.when(is_coinbase, F.from_json("payload", _COINBASE_PAYLOAD)).alias("c"),
    )
    is_ticker = F.col("c.channel") == "ticker"
    timed = opened.withColumn("envelope_ts", F.when(is_ticker, parse_ts(F.col("c.timestamp"))))
    kinds = timed.withColumn(
        "kind",
        F.when(~is_coinbase, BINANCE)
        .when(F.col("c.channel") == "market_trades", COINBASE_TRADE)
        .when(is_ticker & F.col("envelope_ts").isNull(), BAD_ENVELOPE)
        .when(is_ticker, COINBASE_TICKER),
    )
    kind, events = F.col("kind"), F.col("c.events")
    live = F.filter(events, lambda e: ~e["type"].eqNullSafe("snapshot"))
    binance_data = F.coalesce(F.get_json_object("payload", "$.data"), F.col("payload"))
    why_bad = F.concat(
        F.lit("bad envelope timestamp: "),
        _why_no_timestamp(F.col("c.timestamp"), "payload", "timestamp"),
    )
    texts = (
        F.when(kind == COINBASE_TRADE, _sub_texts(live, "trades"))
        .when(kind == COINBASE_TICKER, _sub_texts(events, "tickers"))
        .when(kind == BINANCE, F.array(binance_data))
        .when(kind == BAD_ENVELOPE, F.array("payload"))
    )
    # What the message itself says is worked out before its records part: a column read
    # from the payload afterwards would make every record carry the whole message.
    head = kinds.select(
        "seq",
        "exchange",
        "ts_ingest",
        "envelope_ts",
        "kind",
        F.when(kind == BAD_ENVELOPE, why_bad).alias("envelope_reason"),
        texts.alias("texts"),
    )
    kept = [name for name in head.columns if name != "texts"]
    # The outer form, since the plain one has the messages opened once more by a filter on
    # the size of what it parts.
    parted = head.select(*kept, F.posexplode_outer("texts").alias("ordinal", "record"))
    return parted.where(F.col("ordinal").isNotNull())


def _with_fields(subs: DataFrame) -> DataFrame:
    """Open the fields of each sub-record, and tell Binance trades from book tickers.

    A trade is what says so or has all four trade keys; a book ticker has both
    prices. Keys are only listed where a value is null, since a null still counts
    as having the key.
    """
    fields = subs.select("*", F.json_tuple("record", *_FIELDS).alias(*_FIELDS.values()))

    def has(*keys: str) -> Column:
        given = [F.col(_FIELDS[key]).isNotNull() for key in keys]
        all_given = given[0]
        for one in given[1:]:
            all_given = all_given & one
        listed = F.array_except(F.array(*[F.lit(k) for k in keys]), F.json_object_keys("record"))
        return F.when(all_given, True).otherwise(F.coalesce(F.size(listed) == 0, F.lit(False)))

    is_trade = (F.col("bn_event") == "trade") | has("p", "q", "t", "T")
    binance_kind = F.when(is_trade, BINANCE_TRADE).when(has("b", "a"), BINANCE_BOOK)
    return fields.withColumn(
        "kind", F.when(F.col("kind") == BINANCE, binance_kind).otherwise(F.col("kind"))
    ).where(F.col("kind").isNotNull())


def resolve_symbol(fields: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Native symbol to canonical ``symbol``, dropping symbols nobody follows.

    Runs before any check: a record of an unknown symbol is dropped whatever else
    is wrong with it. A Coinbase record with no product id at all cannot be told
    apart from one that matters, so it stays and is rejected. Without a dimension
    Coinbase symbols are taken as they are and Binance ones are all unknown.

    The dimension comes from the feed declaration; its join is left to the
    optimizer, which broadcasts it by its known size.
    """
    is_binance = F.col("kind").isin(BINANCE_TRADE, BINANCE_BOOK)
    native = F.when(is_binance, F.col("bn_symbol")).otherwise(F.col("product_id"))
    fields = fields.withColumn("native_symbol", native)
    must_stay = (F.col("kind") == BAD_ENVELOPE) | (
        ~is_binance & _absent(F.col("product_id"), _RECORD, F.lit("product_id"))
    )
    if dim is None:
        return fields.withColumn("symbol", F.when(~is_binance, native)).where(~is_binance)
    joined = fields.join(dim, ["exchange", "native_symbol"], "left")
    return joined.where(F.col("symbol").isNotNull() | must_stay)


def _by_kind(fields: DataFrame) -> DataFrame:
    """The same text columns for every kind of sub-record, null where a kind has none."""
    kind = F.col("kind")
    is_binance = kind.startswith("binance")

    def pick(applies: Column, coinbase: str, binance: str) -> Column:
        return F.when(applies & is_binance, F.col(binance)).when(applies, F.col(coinbase))

    is_trade = kind.isin(COINBASE_TRADE, BINANCE_TRADE)
    has_book = kind.isin(COINBASE_TICKER, BINANCE_BOOK)
    texts = {
        "price": F.when(kind == BINANCE_TRADE, F.col("bn_price")).when(
            kind.isin(COINBASE_TRADE, COINBASE_TICKER), F.col("price")
        ),
        "size": pick(is_trade, "size", "bn_quantity"),
        "best_bid": pick(has_book, "best_bid", "bn_bid"),
        "best_ask": pick(has_book, "best_ask", "bn_ask"),
        "best_bid_size": pick(has_book, "best_bid_quantity", "bn_bid_quantity"),
        "best_ask_size": pick(has_book, "best_ask_quantity", "bn_ask_quantity"),
    }
    return fields.select(
        "seq",
        "ordinal",
        "exchange",
        "symbol",
        "kind",
        is_trade.alias("is_trade"),
        has_book.alias("has_book"),
        "product_id",
        *[text.alias(f"{name}_text") for name, text in texts.items()],
        F.when(kind == COINBASE_TRADE, aggressor_side(F.col("side")))
        .when(kind == BINANCE_TRADE, side_from_maker(F.col("bn_maker")))
        .alias("side"),
        F.when(kind == COINBASE_TRADE, coinbase_trade_id(F.col("trade_id")))
        .when(kind == BINANCE_TRADE, binance_trade_id(F.col("bn_trade_id")))
        .alias("trade_id"),
        F.when(kind == COINBASE_TRADE, F.col("time"))
        .when(kind == BINANCE_TRADE, F.col("bn_time"))
        .alias("time_text"),
        "envelope_ts",
        "envelope_reason",
        "ts_ingest",
        "record",
    )


def tag_records(fields: DataFrame) -> DataFrame:
    """Type every field and work out the reason, if any, to reject the sub-record.

    Values are typed in a step of their own, so that a text is read once and the
    reasons only look at what came of it. The step is a generator of one row: a
    later filter on the reason would otherwise be moved in front of a plain
    projection, together with a copy of all the typing it depends on.
    """
    kind = F.col("kind")
    texts = _by_kind(fields)
    values = F.struct(
        *[strict_double(F.col(f"{name}_text")).alias(name) for name in NUMBERS],
        F.when(kind == COINBASE_TRADE, parse_ts(F.col("time_text")))
        .when(kind == COINBASE_TICKER, F.col("envelope_ts"))
        .when(kind == BINANCE_TRADE, ts_from_millis(F.col("time_text")))
        .when(kind == BINANCE_BOOK, F.col("ts_ingest"))
        .alias("ts_event"),
    )
    typed = texts.select("*", F.inline(F.array(values)))
    is_trade, has_book = F.col("is_trade"), F.col("has_book")
    price_key = F.when(kind == BINANCE_TRADE, "p").otherwise("price")
    size_key = F.when(kind == BINANCE_TRADE, "q").otherwise("size")
    reason = F.coalesce(
        F.col("envelope_reason"),
        _why_no_symbol(),
        F.when(is_trade, _why_no_number("price", price_key)),
        F.when(is_trade, _why_no_number("size", size_key)),
        F.when(kind == COINBASE_TRADE, _why_no_time()),
        F.when(kind == BINANCE_TRADE, _why_no_millis()),
        *[F.when(has_book, _why_bad_option(name)) for name in NUMBERS],
        ingest_check({name: F.col(name) for name in NUMBERS}),
    )
    checked = typed.withColumn("reason", reason)
    event = {
        **{name: finite(F.col(name)) for name in NUMBERS},
        "event_type": F.when(is_trade, "trade").when(has_book, "ticker"),
    }
    return checked.select(
        "seq",
        F.col("seq").alias(ARRIVAL),
        F.col("ordinal").cast("bigint").alias(POSITION),
        *[event.get(name, F.col(name)).alias(name) for name in EVENT_COLUMNS],
        "reason",
        "record",
    )


def _why_no_symbol() -> Column:
    """Only Coinbase records get this far without a symbol; see :func:`resolve_symbol`."""
    product_id = F.col("product_id")
    no_id = _absent(product_id, _RECORD, F.lit("product_id"))
    return F.when(
        F.col("symbol").isNull(),
        F.when(F.json_object_keys("record").isNull(), F.lit("record is not an object"))
        .when(no_id, F.lit("'product_id'"))
        .otherwise(F.lit("symbol must be a string")),
    )


def normalize_tagged(
    raw: DataFrame,
    dim: DataFrame | None = None,
    ts_ingest: Column | None = None,
    kinds: tuple[str, ...] | None = None,
) -> DataFrame:
    """Events and rejects in one table: event columns, ``reason`` and the raw ``record``.

    Works on batches and streams alike. An exchange without a normalizer stops the
    job; channels and shapes nobody asked for produce nothing.
    """
    fields = _with_fields(sub_records(raw, ts_ingest))
    if kinds is not None:
        fields = fields.where(F.col("kind").isin(*kinds))
    return tag_records(resolve_symbol(fields, dim))


def events_of(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNull()).select(*EVENT_COLUMNS, ARRIVAL, POSITION)


def rejects_of(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNotNull()).select("exchange", "seq", "reason", "record")


def normalize(
    raw: DataFrame, dim: DataFrame | None = None, ts_ingest: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of all exchanges."""
    tagged = normalize_tagged(raw, dim, ts_ingest)
    return events_of(tagged), rejects_of(tagged)


def _only(raw: DataFrame, dim, ts_ingest, *kinds: str) -> tuple[DataFrame, DataFrame]:
    tagged = normalize_tagged(raw, dim, ts_ingest, kinds)
    return events_of(tagged), rejects_of(tagged)


def normalize_coinbase_trades(
    raw: DataFrame, dim: DataFrame | None = None, ts_ingest: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``market_trades`` messages only; event time is each trade's own."""
    return _only(raw, dim, ts_ingest, COINBASE_TRADE)


def normalize_coinbase_ticker(
    raw: DataFrame, dim: DataFrame | None = None, ts_ingest: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``ticker`` messages only; event time is the envelope's, which must be readable."""
    return _only(raw, dim, ts_ingest, COINBASE_TICKER, BAD_ENVELOPE)


def reject_bad_envelope(raw: DataFrame) -> DataFrame:
    """One reject for each ticker message whose envelope timestamp cannot be read."""
    return _only(raw, None, None, BAD_ENVELOPE)[1]


def normalize_binance_trades(
    raw: DataFrame, dim: DataFrame, ts_ingest: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Binance trades; event time is ``T`` in epoch milliseconds."""
    return _only(raw, dim, ts_ingest, BINANCE_TRADE)


def normalize_binance_book(
    raw: DataFrame, dim: DataFrame, ts_ingest: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Binance book tickers; they carry no event time, so it is the time of ingest."""
    return _only(raw, dim, ts_ingest, BINANCE_BOOK)


def to_quarantine(rejects: DataFrame, now: Column | None = None) -> DataFrame:
    """Rejects as quarantine rows; the payload is the raw sub-record as JSON text.

    Live feeds have no capture number, which is recorded as 0.
    """
    return rejects.select(
        "exchange",
        F.coalesce(F.col("seq"), F.lit(0)).cast("bigint").alias("seq"),
        "reason",
        F.coalesce(F.col("record"), F.lit("null")).alias("payload"),
        (now if now is not None else F.current_timestamp()).cast("timestamp").alias(
            "ts_quarantined"
        ),
    )


def normalization_summary(raw: DataFrame, tagged: DataFrame) -> DataFrame:
    """One row: messages, events, trades, tickers, quarantined and events by symbol.

    The table is first reduced to a row per symbol, so the map that is gathered at
    the end holds one entry per followed symbol whatever the volume.
    """
    ok = F.col("reason").isNull()
    is_ticker = F.col("event_type") == "ticker"
    per_symbol = tagged.groupBy(F.when(ok, F.col("symbol")).alias("symbol")).agg(
        F.lit(0).cast("bigint").alias("messages"),
        F.count_if(ok & ~is_ticker).alias("trades"),
        F.count_if(ok & is_ticker).alias("tickers"),
        F.count_if(~ok).alias("quarantined"),
    )
    zero = F.lit(0).cast("bigint")
    messages = raw.agg(F.count("*").alias("messages")).select(
        F.lit(None).cast("string").alias("symbol"),
        "messages",
        zero.alias("trades"),
        zero.alias("tickers"),
        zero.alias("quarantined"),
    )
    total = F.col("trades") + F.col("tickers")
    return (
        per_symbol.unionByName(messages)
        .agg(
            F.sum("messages").alias("messages"),
            F.coalesce(F.sum(total), zero).alias("events"),
            F.coalesce(F.sum("trades"), zero).alias("trades"),
            F.coalesce(F.sum("tickers"), zero).alias("tickers"),
            F.coalesce(F.sum("quarantined"), zero).alias("quarantined"),
            F.map_from_entries(
                F.array_sort(
                    F.collect_list(
                        F.when(
                            F.col("symbol").isNotNull(),
                            F.struct(F.col("symbol"), total.alias("events")),
                        )
                    )
                )
            ).alias("by_symbol"),
        )
    )
