"""Table schemas. Always passed explicitly, so one-sided data keeps its types."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from "name type, name type"; needs no running session, unlike ``fromDDL``."""
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# One raw exchange message per line; the payload stays text until it is normalized.
RAW_SCHEMA = _struct(
    "seq long, ts_recorded timestamp, exchange string, channel string, payload string"
)

EVENT_SCHEMA = _struct(
    "exchange string, symbol string, event_type string, price double, size double, "
    "side string, trade_id string, best_bid double, best_ask double, "
    "best_bid_size double, best_ask_size double, ts_event timestamp, ts_ingest timestamp"
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()
FLOAT_COLUMNS = [f.name for f in EVENT_SCHEMA if isinstance(f.dataType, T.DoubleType)]

# Bronze also keeps the order of arrival, which a partitioned table cannot carry otherwise:
# the number of the message, then the position in it.
ARRIVAL = "arrival_seq"
POSITION = "arrival_pos"
BRONZE_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField(ARRIVAL, T.LongType()),
        T.StructField(POSITION, T.LongType()),
    ]
)

WINDOW_SCHEMA = _struct(
    "symbol string, window_size string, window_start timestamp, window_end timestamp, "
    "source string, vwap double, trade_volume double, trade_count long, "
    "avg_spread double, avg_mid double, ticker_count long, event_count long"
)

GOLD_SCHEMA = _struct(
    "symbol string, window_size string, window_start timestamp, window_end timestamp, "
    "vwap double, trade_volume double, trade_count long, avg_spread double, avg_mid double, "
    "ticker_count long, event_count long, window_key string"
)

QUARANTINE_SCHEMA = _struct(
    "exchange string, seq long, reason string, payload string, ts_quarantined timestamp"
)

LATE_SCHEMA = _struct(
    "symbol string, source string, event_ts timestamp, window_size string, "
    "window_start timestamp, window_end timestamp"
)

SNAPSHOT_LOG_SCHEMA = _struct("snapshot_id long, seq long, generation long, rows long")
