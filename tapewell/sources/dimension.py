"""Symbol dimension: how each exchange spells the symbols the lake follows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewell.config import SYMBOL_STYLES, FeedConfig


def symbol_dimension(
    spark: SparkSession, config: FeedConfig, exchange: str | None = None
) -> DataFrame:
    """Rows (exchange, native_symbol, symbol); all exchanges unless one is named.

    Built from the declaration, so its size is known to the optimizer, which
    broadcasts it in joins for as long as it is below the broadcast threshold.
    """
    names = [exchange] if exchange else sorted(config.exchanges)
    rows = []
    for name in names:
        style = config.exchanges[name].symbol_style
        if style not in SYMBOL_STYLES:
            raise ValueError(f"unknown symbol style {style!r} for {name}")
        rows += [(name, style, symbol) for symbol in config.symbols]
    columns = [pa.array(values, pa.string()) for values in zip(*rows, strict=True)]
    listed = spark.createDataFrame(pa.table(columns, names=["exchange", "style", "symbol"]))
    native = F.when(F.col("style") == "concat", F.replace("symbol", F.lit("-"), F.lit("")))
    return listed.select(
        "exchange", native.otherwise(F.col("symbol")).alias("native_symbol"), "symbol"
    )
