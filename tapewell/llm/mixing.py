"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source, document after document, are cut into blocks of ``BLOCK_WORDS``. Every
output shard of ``SHARD_SLOTS`` slots draws how many blocks of each source it takes, by a
multinomial over what is left of the sources' quotas. Slot ``i`` of a source takes the block
at place ``i mod n`` of pseudorandom permutation ``i div n`` of its n blocks, so that every
block is taken equally often, to one. Slots and blocks are joined by that index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .rows import ROW, number_rows
from .text import chunks, mix, raw, strings, word_spans

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
# Rows of one source that are numbered together; a source of any size is cut into such parts.
PART_ROWS = 5_000
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 20_011


@dataclass(frozen=True)
class Source:
    """Of one source: its words, its target, blocks, and blocks to take."""

    number: int
    size: int
    target: float
    blocks: int
    quota: int


def share_out(sizes: list[int], weights: list[float], most: float = MOST_COPIES) -> list[float]:
    """Targets by weight that sum to the sum of sizes, none above ``most`` times its size.

    What a target has too much goes to the others by weight until none is above; sources
    of no size get none.
    """
    targets = [0.0] * len(sizes)
    open_ones = [k for k, size in enumerate(sizes) if size > 0]
    left = float(sum(sizes))
    while open_ones:
        unit = left / sum(weights[k] for k in open_ones)
        full = [k for k in open_ones if unit * weights[k] > most * sizes[k]]
        if not full:
            for k in open_ones:
                targets[k] = unit * weights[k]
            break
        for k in full:
            targets[k] = float(most * sizes[k])
            left -= targets[k]
        open_ones = [k for k in open_ones if k not in set(full)]
    return targets


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 by ``key``: a Feistel network, walked until inside."""
    half = np.maximum(1, np.ceil(np.ceil(np.log2(np.maximum(n, 2))) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, out = index.astype(np.uint64), index.astype(np.uint64)
    todo = np.arange(len(index))
    while len(todo):
        h, m, x, k = half[todo], mask[todo], value[todo], key[todo]
        left, right = x >> h, x & m
        with np.errstate(over="ignore"):
            for turn in range(4):
                left, right = right, left ^ (mix(right + k * np.uint64(2 * turn + 3) + np.uint64(turn)) & m)
        x = left << h | right
        value[todo] = x
        inside = x < n[todo].astype(np.uint64)
        out[todo[inside]] = x[inside]
        todo = todo[~inside]
    return out.astype(np.int64)


def draw_shards(quotas: np.ndarray, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """Blocks of each source per shard: multinomial draws by what is left of the quotas.

    A draw above what a source has left is cut and drawn again among the others, so that
    the columns sum to the quotas.
    """
    rng = np.random.default_rng(SEED)
    left = quotas.astype(np.int64).copy()
    shards = []
    while left.sum():
        wanted = int(min(shard_slots, left.sum()))
        drawn = np.zeros_like(left)
        while wanted:
            some = np.minimum(rng.multinomial(wanted, left / left.sum()), left)
            drawn += some
            left -= some
            wanted -= int(some.sum())
        shards.append(drawn)
    return np.array(shards, np.int64).reshape(len(shards), len(quotas))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = strings(batch.column("text"))
        sizes = [np.zeros(0, np.int64)]
        for low, high in chunks(column):
            body, bounds = raw(column[low:high])
            sizes.append(np.diff(np.searchsorted(word_spans(body, bounds)[0], bounds)))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(np.concatenate(sizes).astype(np.int64))], [*kept, "size"]
        )


def lay_out(docs: DataFrame) -> tuple[DataFrame, list[tuple[str | None, Source]]]:
    """(doc_id, source, number, size, begin) per row, and ``row`` if ``docs`` has it, and the sources.

    ``begin`` counts the words of the source before the row. Rows of a source are numbered
    in parts by a hash of the id, or of the size without one; the sums of the parts put the
    parts one after the other.
    """
    spark = docs.sparkSession
    keys = [ROW] if ROW in docs.columns else []
    read = docs.select("doc_id", "source", *keys, "text")
    sized = stage(read.mapInArrow(_measure, read.drop("text").schema.add("size", "long")), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    # Bounded by the number of sources; code point order is the order of UTF-8 bytes.
    rows = sorted(totals.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    weights = [float(WEIGHTS[k % len(WEIGHTS)]) for k in range(len(rows))]
    targets = share_out([r["size"] for r in rows], weights)
    sources = []
    for k, (row, target) in enumerate(zip(rows, targets, strict=True)):
        blocks = -(-row["size"] // BLOCK_WORDS)
        quota = min(MOST_COPIES * blocks, round(target / row["size"] * blocks)) if blocks else 0
        sources.append((row["source"], Source(k, row["size"], target, blocks, quota)))
    numbers = spark.createDataFrame(
        [(name, x.number, -(-r["n"] // PART_ROWS)) for (name, x), r in zip(sources, rows, strict=True)],
        "source string, number int, parts long",
    )
    named = sized.join(F.broadcast(numbers), sized["source"].eqNullSafe(numbers["source"])).select(
        "doc_id",
        sized["source"],
        *keys,
        "number",
        "size",
        F.pmod(F.xxhash64(F.coalesce("doc_id", "size")), F.col("parts")).alias("part"),
    )
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        named.groupBy("number", "part")
        .agg(F.sum("size").alias("part_size"))
        .select("number", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_begin"))
    )
    inside = (
        Window.partitionBy("number", "part").orderBy("doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        named.withColumn("begin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(parts, ["number", "part"])
        .select("doc_id", "source", *keys, "number", "size", (F.col("begin") + F.col("part_begin")).alias("begin"))
    )
    return stage(placed, "laid"), sources


_SLOTS = "shard long, slot long, number int, block long"


def _fill_slots(facts):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn, begins, blocks = facts.value
        for frame in frames:
            for shard in frame["id"]:
                counts = drawn[shard]
                number = np.repeat(np.arange(len(counts)), counts)
                within = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
                index = begins[shard][number] + within
                n = blocks[number]
                turn = index // n
                with np.errstate(over="ignore"):
                    key = mix(number.astype(np.uint64) * np.uint64(1_000_003) + turn.astype(np.uint64) + np.uint64(SEED))
                yield pd.DataFrame(
                    {
                        "shard": np.full(len(number), shard),
                        "slot": permute(
                            np.arange(len(number)),
                            np.full(len(number), len(number)),
                            np.full(len(number), np.uint64(shard + 1)),
                        ),
                        "number": number.astype(np.int32),
                        "block": permute(index % n, n, key),
                    }
                )

    return run


def slots_of(spark: SparkSession, sources: list[tuple[str | None, Source]]) -> DataFrame:
    """(shard, slot, number, block): which block of which source fills each slot of each shard."""
    facts = [x for _, x in sources]
    drawn = draw_shards(np.array([x.quota for x in facts], np.int64))
    begins = np.cumsum(drawn, axis=0) - drawn
    # Bounded by shards times sources: 24 bytes for each 262,144 words and source.
    shared = spark.sparkContext.broadcast((drawn, begins, np.maximum(1, np.array([x.blocks for x in facts], np.int64))))
    tasks = max(1, min(len(drawn), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, len(drawn), 1, tasks).mapInPandas(_fill_slots(shared), _SLOTS)


def _pieces(laid: DataFrame) -> DataFrame:
    """(number, size, begin, block, words) and ``row`` if ``laid`` has it: one row per block that a row's words lie in."""
    first = F.floor(F.col("begin") / BLOCK_WORDS)
    last = F.floor((F.col("begin") + F.col("size") - 1) / BLOCK_WORDS)
    end = F.col("begin") + F.col("size")
    low = F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS)
    return (
        laid.filter("size > 0")
        .select(*[c for c in laid.columns if c not in ("doc_id", "source")], F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("words", F.least(end, (F.col("block") + 1) * BLOCK_WORDS) - low)
    )


def _taken_pieces(laid: DataFrame, sources: list[tuple[str | None, Source]]) -> DataFrame:
    """Pieces with ``times``, how often their block is taken; blocks meet slots by index.

    Both sides grow with the corpus, so they are merged, never sent whole to a task.
    """
    times = slots_of(laid.sparkSession, sources).groupBy("number", "block").agg(F.count("*").alias("times"))
    return _pieces(laid).join(times.hint("merge"), ["number", "block"])


def _slot_pieces(laid: DataFrame, sources: list[tuple[str | None, Source]]) -> DataFrame:
    """Pieces with the (shard, slot) they fill: the packed blocks without their texts."""
    return slots_of(laid.sparkSession, sources).join(_pieces(laid).hint("merge"), ["number", "block"])


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        cuts = batch.column("cuts").to_pylist()
        out: list = [[], [], [], [], [], []]
        for k, pieces in enumerate(cuts):
            raw_text = texts[k].as_py().encode()
            begins, ends = word_spans(np.frombuffer(raw_text, np.uint8), np.array([0, len(raw_text)]))
            for x in pieces:
                low = x["low"]
                piece = raw_text[begins[low] : ends[low + x["words"] - 1]].decode()
                for column, value in zip(
                    out, (x["shard"], x["slot"], x["number"], x["begin"], x["words"], piece), strict=True
                ):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, types, strict=True)],
            ["shard", "slot", "number", "begin", "words", "piece"],
        )


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mixture packed: (shard, slot, number, n_words, text), one row per slot of every output shard.

    ``text`` holds the ``BLOCK_WORDS`` words of the slot's block, the last block of a source
    what is left; pieces of neighbouring documents are parted by a line feed. ``number`` is
    the source's place in code point order. Sort a shard by ``slot`` for its order.
    """
    docs = number_rows(docs.select("doc_id", "text", "source"))
    laid, sources = lay_out(docs)
    low = F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS)
    # A row's pieces grow with its words and with the times a block is taken, at most MOST_COPIES and one.
    cuts = (
        _slot_pieces(laid, sources)
        .select(ROW, F.struct("shard", "slot", "number", low.alias("begin"), (low - F.col("begin")).alias("low"), "words").alias("cut"))
        .groupBy(ROW)
        .agg(F.collect_list("cut").alias("cuts"))
    )
    pieces = (
        docs.join(cuts.hint("merge"), ROW)
        .select("text", "cuts")
        .mapInArrow(_cut_pieces, "shard long, slot long, number int, begin long, words long, piece string")
    )
    return (
        pieces.groupBy("shard", "slot", "number")
        .agg(F.sum("words").alias("n_words"), F.sort_array(F.collect_list(F.struct("begin", "piece"))).alias("pieces"))
        .select("shard", "slot", "number", "n_words", F.concat_ws("\n", F.col("pieces.piece")).alias("text"))
    )


def mixture_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs`` (doc_id, text, source).

    A null or wordless text has size 0 and nothing taken. Null sources are one source, the
    last. Rows that repeat an id are rows of their own, as are rows without one. No
    document is taken more than ``MOST_COPIES`` times its size. Reruns agree.
    """
    laid, sources = lay_out(docs)
    facts = docs.sparkSession.createDataFrame(
        [(x.number, x.size, x.target) for _, x in sources], "number int, source_size long, target double"
    )
    taken = _slot_pieces(laid, sources).groupBy("number", "begin").agg(F.sum("words").alias("taken"))
    with_words = laid.filter("size > 0").join(taken, ["number", "begin"], "left")
    without = laid.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        with_words.unionByName(without)
        .join(F.broadcast(facts), "number")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts = [], []
        column = batch.column("text")
        for k, (runs, copies) in enumerate(
            zip(batch.column("runs").to_pylist(), batch.column("copies").to_pylist(), strict=True)
        ):
            text = column[k].as_py()
            rows += [k] * copies
            texts += [text] * copies
            if runs:
                raw_text = text.encode()
                body = np.frombuffer(raw_text, np.uint8)
                begins, ends = word_spans(body, np.array([0, len(body)]))
                for run in runs:
                    rows.append(k)
                    texts.append(raw_text[begins[run["low"]] : ends[run["high"] - 1]].decode())
        kept = batch.select([c for c in batch.schema.names if c not in ("runs", "copies")]).take(
            pa.array(rows, pa.int64())
        )
        out = {name: kept.column(name) for name in kept.schema.names}
        out["text"] = pa.array(texts, pa.string())
        out["n_chars"] = pa.array([len(x) for x in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def mix_rows(docs: DataFrame) -> DataFrame:
    """The mixture as rows of (doc_id, text, lang, source, n_chars).

    Blocks of a source are taken q or q + 1 times. A row comes out q times whole, and once
    more for every run of its words in blocks taken q + 1 times; its words add up to its
    ``taken`` of :func:`mixture_counts`. As there, rows that repeat an id are rows of their
    own, as are rows without one; a row without words is not taken.
    """
    docs = number_rows(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    laid, sources = lay_out(docs)
    whole = docs.sparkSession.createDataFrame(
        [(x.number, x.quota // x.blocks if x.blocks else 0) for _, x in sources], "number int, copies int"
    )
    extra = (
        _taken_pieces(laid, sources)
        .join(F.broadcast(whole), "number")
        .filter("times > copies")
        .select(
            "number",
            "begin",
            (F.greatest(F.col("begin"), F.col("block") * BLOCK_WORDS) - F.col("begin")).alias("low"),
            "words",
        )
    )
    gathered = extra.groupBy("number", "begin").agg(
        F.sort_array(F.collect_list(F.struct("low", (F.col("low") + F.col("words")).alias("high")))).alias("pieces")
    )
    # Neighbouring pieces become one run: a run starts where a piece does not continue the last.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("pieces") - 1),
        lambda k: (k == 0) | (F.get(F.col("pieces"), k)["low"] != F.get(F.col("pieces"), k - 1)["high"]),
    )
    runs = gathered.withColumn("starts", starts).select(
        "number",
        "begin",
        F.transform(
            "starts",
            lambda s, k: F.struct(
                F.get(F.col("pieces"), s)["low"].alias("low"),
                F.get(F.col("pieces"), F.coalesce(F.get(F.col("starts"), k + 1), F.size("pieces")) - 1)["high"].alias(
                    "high"
                ),
            ),
        ).alias("runs"),
    )
    keyed = (
        laid.filter("size > 0")
        .join(F.broadcast(whole), "number")
        .join(runs, ["number", "begin"], "left")
        .filter("copies > 0 or runs is not null")
        .select(ROW, "copies", "runs")
    )
    return docs.join(keyed, ROW).drop(ROW).mapInArrow(_cut_runs, docs.drop(ROW).schema)
