"""Events as JSON text: the form they travel in between jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewell.functions.checks import ingest_check
from tapewell.functions.windows import iso_utc
from tapewell.schemas import EVENT_COLUMNS, EVENT_SCHEMA, FLOAT_COLUMNS

TIMESTAMPS = ("ts_event", "ts_ingest")
REQUIRED = ("exchange", "symbol", "event_type", *TIMESTAMPS)
# The kinds of event and the sides of a trade.
ALLOWED = {"event_type": ("trade", "ticker"), "side": ("buy", "sell")}


def encode_event() -> Column:
    """The event columns of the current row as compact JSON, nulls kept as keys."""
    values = [
        (iso_utc(F.col(name)) if name in TIMESTAMPS else F.col(name)).alias(name)
        for name in EVENT_COLUMNS
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def form_problem(text: Column, event: Column) -> Column:
    """Why ``text``, read as ``event``, does not have the form of an event; null if it has.

    In this order: not a JSON object, unknown fields, a required field without a value, a
    value that cannot be read as its type.
    """
    keys = F.json_object_keys(text)
    names = F.array(*[F.lit(name) for name in EVENT_COLUMNS])
    unknown = F.array_except(keys, names)
    given = {name: F.get_json_object(text, f"$.{name}") for name in EVENT_COLUMNS}
    rules = [
        F.when(keys.isNull(), F.lit("not a JSON object")),
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", "))),
        *[F.when(given[name].isNull(), F.lit(f"missing field: {name}")) for name in REQUIRED],
        *[
            F.when(given[name].isNotNull() & event[name].isNull(), F.lit(f"unreadable field: {name}"))
            for name in EVENT_COLUMNS
        ],
    ]
    return F.coalesce(*rules)


def _content_problem(event: Column) -> Column:
    """Why an event of the right form is not valid: its words, its numbers."""
    words = [
        F.when(~event[name].isin(*allowed), F.concat(F.lit(f"unknown {name}: "), event[name]))
        for name, allowed in ALLOWED.items()
    ]
    return F.coalesce(*words, ingest_check({name: event[name] for name in FLOAT_COLUMNS}))


_BROKEN = "_broken"
_OPENED = T.StructType([*EVENT_SCHEMA.fields, T.StructField(_BROKEN, T.StringType())])


def _opened(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the text opened once as ``_event``, and ``_formed``: whether it has an event's form.

    Reading tells values of the wrong type by itself; what it passes over are unknown fields,
    so the names are listed once more. Why a text is refused is worked out for refused ones only.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    read = df.withColumn("_event", F.from_json(F.col(text), _OPENED, options))
    event, keys = F.col("_event"), F.json_object_keys(F.col(text))
    known = F.size(F.array_except(keys, F.array(*[F.lit(name) for name in EVENT_COLUMNS]))) == 0
    formed = event[_BROKEN].isNull() & known
    for name in REQUIRED:
        formed &= event[name].isNotNull()
    return read.withColumn("_formed", F.coalesce(formed, F.lit(False)))


def decode_events(
    df: DataFrame, text: str = "value", content: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of a column of event JSON: one bad text does not stop the others.

    Events have the event columns in place of the text, rejects the text and a ``reason``.
    Without ``content`` only the form is judged, and events that break the contract travel on
    for the contract to sort out.
    """
    rest = [name for name in df.columns if name != text]
    event = F.col("_event")
    inner = _content_problem(event) if content else F.lit(None).cast("string")
    checked = _opened(df, text).withColumn(
        "reason",
        F.when(F.col("_formed"), inner).otherwise(
            F.coalesce(form_problem(F.coalesce(F.col(text), F.lit("")), event), F.lit("not a JSON object"))
        ),
    )
    fields = [event[name].alias(name) for name in EVENT_COLUMNS]
    events = checked.where(F.col("reason").isNull()).select(*rest, *fields)
    return events, checked.where(F.col("reason").isNotNull()).select(*rest, text, "reason")


def with_event_columns(df: DataFrame, text: str = "value") -> DataFrame:
    """Decode a column of event JSON into the event columns; fails on a text without their form.

    Events that break the contract travel like others, for the contract to sort out;
    :func:`decode_events` refuses those too.
    """
    rest = [name for name in df.columns if name != text]
    event = F.col("_event")
    refused = F.concat(
        F.lit("not a market event, "),
        F.coalesce(form_problem(F.coalesce(F.col(text), F.lit("")), event), F.lit("not a JSON object")),
    )
    gated = F.when(F.col("_formed"), event).otherwise(F.raise_error(refused).cast(_OPENED))
    decoded = _opened(df, text).select(*rest, gated.alias("_event"))
    return decoded.select(*rest, *[event[name].alias(name) for name in EVENT_COLUMNS])
