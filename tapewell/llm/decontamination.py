"""Benchmark passages in documents, found by spaced seeds and verified word by word.

A seed mask reads some positions of a run of words and ignores the others, so that a
changed word under an ignored position does not break the match. Hashes of all masked
runs of the benchmark meet those of all documents; each hit fixes how passage and document
lie against each other, and along that line the words are compared, changed words allowed.

Spark expressions only: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .native import let, sent_if_small
from .rows import ROW, has_own_ids, number_rows

# Each mask reads five words. From 12 words on every passage that agrees in 80 % holds one of them.
MASKS = ("11111", "111101", "1101011")
# Masks of four words, for passages of up to 11 words; with them every change the rule allows leaves a seed.
SHORT_MASKS = ("1111", "10111", "11011", "11101")
SHORT_WORDS = 11
LEAST_WORDS = 5
WINDOW = 13
SIMILAR_PERCENT = 80
# Rows up to which seeds of a benchmark, or ids of hit documents, are sent to all tasks (16 to 32 bytes each).
BROADCAST_SEEDS = 1_000_000
BROADCAST_IDS = 1_000_000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits; empty for a null text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds_of(hashes: Column, masks: tuple[str, ...], first: int) -> Column:
    """All (place, seed) of an array of word hashes; a mask that would pass the end gives none.

    ``first`` numbers the masks, so that seeds of different masks never meet.
    """

    def of_mask(number: int, mask: str) -> Column:
        reads = [k for k, c in enumerate(mask) if c == "1"]
        return F.when(
            F.size(hashes) >= len(mask),
            F.transform(
                F.sequence(F.lit(0), F.size(hashes) - len(mask)),
                lambda i: F.struct(
                    i.alias("place"),
                    F.xxhash64(F.lit(number), *[F.get(hashes, i + k) for k in reads]).alias("seed"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<place:int,seed:bigint>>"))

    return F.concat(*[of_mask(number, mask) for number, mask in enumerate(masks, first)])


def _seeds(hashes: Column) -> Column:
    return _seeds_of(hashes, MASKS, 0)


def _all_seeds(hashes: Column) -> Column:
    return F.concat(_seeds(hashes), _seeds_of(hashes, SHORT_MASKS, len(MASKS)))


def _item_seeds(hashes: Column) -> Column:
    short = F.size(hashes) <= SHORT_WORDS
    return F.when(short, _all_seeds(hashes)).otherwise(_seeds(hashes))


def _seed_rows(table: DataFrame, key: str, place: str, seeds: Callable[[Column], Column]) -> DataFrame:
    rows = table.select(key, F.explode(let(word_hashes(F.col("text")), seeds)).alias("s"))
    return rows.select(key, F.col("s.place").alias(place), F.col("s.seed").alias("seed"))


def seed_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift): where a seed of a passage meets one of a document.

    Documents give the seeds of the short masks only if a passage is short; no other meets them.
    """
    short = benchmark.filter(F.size(word_hashes(F.col("text"))).between(LEAST_WORDS, SHORT_WORDS))
    doc_seeds = _seeds if short.isEmpty() else _all_seeds
    seeds = stage(_seed_rows(benchmark, "item_id", "item_place", _item_seeds).distinct(), "seeds")
    return (
        _seed_rows(docs, "doc_id", "doc_place", doc_seeds)
        .join(sent_if_small(seeds, BROADCAST_SEEDS), "seed")
        .select("doc_id", "item_id", (F.col("doc_place") - F.col("item_place")).alias("shift"))
        .distinct()
    )


def _aligned(doc: Column, item: Column, shift: Column) -> Column:
    """For every place of the passage that lies in the document, 1 if the words agree, else 0."""
    low = F.greatest(-shift, F.lit(0))
    high = F.least(F.size(item), F.size(doc) - shift)
    return F.transform(
        F.sequence(low, high - 1), lambda k: (F.get(item, k) == F.get(doc, k + shift)).cast("int")
    )


def _best_window(same: Column, words: Column) -> Column:
    """Most agreeing words in any run of ``words`` places; all places if there are fewer."""
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(same) - words + 1, F.lit(1))),
            lambda at: F.aggregate(F.slice(same, at, words), F.lit(0), lambda total, x: total + x),
        )
    )


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, words, matched, best) for documents that hold a passage.

    ``docs`` (doc_id, text) against ``benchmark`` (item_id, text). A document holds a
    passage if, laid along a hit, some run of 13 places (the whole passage if it has fewer)
    agrees in 80 % of the words or more. ``words`` is the passage's length, ``matched``
    its words that agree along the best line, ``best`` those of its best run. Passages of
    fewer than five words or without an id match nothing; null and empty texts neither. Rows
    without an id or with a repeated one are searched each; what they hold is reported once
    an id, and once for all rows without one.
    """
    numbered = number_rows(docs.select("doc_id", "text"))
    found = contaminated_rows(numbered, benchmark)
    if has_own_ids(numbered):
        return found.withColumnRenamed(ROW, "doc_id")
    found = stage(found, "contaminated-rows")
    names = numbered.select(ROW, "doc_id").join(sent_if_small(found, BROADCAST_IDS), ROW)
    return (
        names.groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("matched", "best", "words")).alias("top"))
        .select("doc_id", "item_id", "top.words", "top.matched", "top.best")
    )


def contaminated_rows(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """:func:`contaminated_pairs` of (row, text), by ``row``, which is never null and never repeats."""
    items = stage(
        benchmark.select("item_id", "text")
        .filter("item_id is not null and text is not null")
        .select("item_id", "text", word_hashes(F.col("text")).alias("item"))
        .filter(F.size("item") >= LEAST_WORDS),
        "items",
    )
    read = rows.select(F.col(ROW).alias("doc_id"), "text").filter("text is not null")
    hits = stage(seed_hits(read, items), "hits")
    ids = stage(hits.select("doc_id").distinct(), "hit-ids")
    found = (
        read.join(sent_if_small(ids, BROADCAST_IDS), "doc_id")
        .select("doc_id", word_hashes(F.col("text")).alias("doc"))
        .hint("merge")
        # One row a pair, so that a text is copied once however many lines it meets a passage on.
        .join(hits.groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts")), "doc_id")
        .join(items.select("item_id", "item").distinct(), "item_id")
    )
    window = F.least(F.size("item"), F.lit(WINDOW))

    def line(shift: Column) -> Column:
        return let(
            _aligned(F.col("doc"), F.col("item"), shift),
            lambda same: F.struct(
                _best_window(same, window).alias("best"),
                F.aggregate(same, F.lit(0), lambda total, x: total + x).alias("matched"),
            ),
        )

    fits = F.filter(F.transform("shifts", line), lambda x: 100 * x["best"] >= SIMILAR_PERCENT * window)
    scored = found.select(
        F.col("doc_id").alias(ROW),
        "item_id",
        F.size("item").alias("words"),
        F.array_max(F.transform(fits, lambda x: F.struct(x["matched"], x["best"]))).alias("top"),
    )
    # An item_id may name several passages.
    return (
        scored.filter("top is not null")
        .groupBy(ROW, "item_id")
        .agg(F.max(F.struct("top.matched", "top.best", "words")).alias("top"))
        .select(ROW, "item_id", "top.words", "top.matched", "top.best")
    )


def decontaminate_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``benchmark``, each judged by its own text, with or without an id."""
    numbered = number_rows(docs)
    rows = stage(contaminated_rows(numbered, benchmark).select(ROW).distinct(), "contaminated")
    return numbered.join(sent_if_small(rows, BROADCAST_IDS), ROW, "left_anti").select(*docs.columns)
