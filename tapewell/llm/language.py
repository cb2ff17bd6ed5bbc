"""Language of a text by bit-sliced Bloom filters of byte n-grams.

Each slot of the filter holds one bit per language, so that one look-up (the AND of a
few slots) tells every language that knows an n-gram. Per text, the hits of a language
are counted over all n-grams; the hits its filter gives by chance, known from how full
the filter is, are taken off; the language with most hits left wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import chunks, held_out, strings

NO_LANGUAGE = "und"
GRAM = 4
CHUNK_BYTES = 1 << 20
SLOT_BITS = 20
SEEDS = (0x9E3779B1, 0x85EBCA77)
# Fitting: texts per language, n-grams per language, fewest sightings of an n-gram, and how
# frequent it must be in a language against the language where it is most frequent.
SAMPLE_TEXTS = 3000
SAMPLE_GRAMS = 50_000
LEAST_SEEN = 3
LEAST_RATIO = 0.2

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c if 97 <= c <= 122 else 32 for c in range(128)]


@dataclass(frozen=True)
class Filters:
    """``planes[p][slot]``: bits of languages 8p to 8p+7; ``chance[l]``: false hits per n-gram."""

    languages: tuple[str, ...]
    planes: np.ndarray
    chance: np.ndarray


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of lower-cased texts, runs of non-letters read as blanks, and their text's number.

    A text is framed by blanks; n-grams of three blanks or more are left out.
    """
    framed = [f" {text.lower()}  ".encode("utf-8", "replace") for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in framed])])
    body = _FOLD[np.frombuffer(b"".join(framed), np.uint8)]
    if len(body) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    n = len(body) - GRAM + 1
    wide = body.astype(np.uint32)
    found = wide[:n] | wide[1 : n + 1] << 8 | wide[2 : n + 2] << 16 | wide[3 : n + 3] << 24
    blank = (body == 32).astype(np.uint8)
    keep = blank[:n] + blank[1 : n + 1] + blank[2 : n + 2] + blank[3 : n + 3] < 3
    for cut in range(1, GRAM):
        at = bounds[1:-1] - cut
        keep[at[at < n]] = False
    places = np.flatnonzero(keep)
    return found[places], np.searchsorted(bounds, places, "right") - 1


def slots(found: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        found = found ^ (found >> np.uint32(15))
        return (found * np.uint32(seed)) >> np.uint32(32 - SLOT_BITS)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = strings(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for low, high in chunks(column, CHUNK_BYTES):
            found, owner = grams(column[low:high].to_pylist())
            names = sorted(set(langs[low:high]))
            codes = np.array([names.index(x) for x in langs[low:high]], np.uint64)
            keys, seen = np.unique(codes[owner] << np.uint64(32) | found, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[k] for k in (keys >> np.uint64(32)).tolist()], pa.string()),
                    pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    pa.array(seen.astype(np.int64)),
                ],
                ["lang", "gram", "seen"],
            )


def fit_filters(docs: DataFrame, texts_per_language: int = SAMPLE_TEXTS) -> Filters:
    """Filters from (doc_id, text, lang), rows without text or lang left out.

    Fitted on at most ``texts_per_language`` texts a language, those with the smallest
    hash of the id, and on the ``SAMPLE_GRAMS`` most frequent n-grams of each.
    """
    known = docs.filter("text is not null and lang is not null and doc_id is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= texts_per_language)
        .select("doc_id", "lang")
        .distinct()
    )
    # Bounded: languages times texts_per_language ids.
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    counted = (
        sample.select("lang", "text")
        .mapInArrow(_count_grams, "lang string, gram long, seen long")
        .groupBy("lang", "gram")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") >= LEAST_SEEN)
    )
    best = Window.partitionBy("lang").orderBy(F.desc("seen"), "gram")
    table = counted.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= SAMPLE_GRAMS)
    rows = table.select("lang", "gram", "seen").toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    planes = np.zeros((max(1, (len(languages) + 7) // 8), 1 << SLOT_BITS), np.uint8)
    if not languages:
        return Filters((), planes, np.zeros(0))
    rows["share"] = rows["seen"] / rows.groupby("lang")["seen"].transform("sum")
    rows = rows[rows["share"] >= LEAST_RATIO * rows.groupby("gram")["share"].transform("max")]
    chance = []
    for number, language in enumerate(languages):
        own = rows.loc[rows["lang"] == language, "gram"].to_numpy(np.int64).astype(np.uint32)
        for seed in SEEDS:
            planes[number // 8][slots(own, seed)] |= np.uint8(1 << number % 8)
        full = np.count_nonzero(planes[number // 8] & np.uint8(1 << number % 8)) / (1 << SLOT_BITS)
        chance.append(full ** len(SEEDS))
    return Filters(languages, planes, np.array(chance))


def count_hits(texts: list[str], filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of each text, and how many of them each language's filter holds."""
    found, owner = grams(texts)
    total = np.bincount(owner, minlength=len(texts))
    where = [slots(found, seed) for seed in SEEDS]
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    hits = []
    for plane in filters.planes:
        mask = plane[where[0]]
        for more in where[1:]:
            mask = mask & plane[more]
        by_mask = np.bincount(owner * 256 + mask, minlength=len(texts) * 256).reshape(len(texts), 256)
        hits.append(by_mask @ bits)
    return total, np.hstack(hits)[:, : len(filters.languages)]


def decide(texts: list[str], filters: Filters) -> tuple[list[str], np.ndarray]:
    """Language and score (its share of all corrected hits) of each text."""
    if not filters.languages:
        return [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
    total, hits = count_hits(texts, filters)
    left = np.maximum((hits - total[:, None] * filters.chance) / (1 - filters.chance), 0.0)
    best = left.argmax(axis=1)
    score = left[np.arange(len(texts)), best] / np.maximum(left.sum(axis=1), 1e-9)
    named = [
        filters.languages[k] if any(map(str.isalpha, text)) else NO_LANGUAGE
        for k, text in zip(best.tolist(), texts, strict=True)
    ]
    score[[k for k, name in enumerate(named) if name == NO_LANGUAGE]] = 0.0
    return named, np.clip(score, 0.0, 1.0)


def identify_language(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score in place of columns of these names.

    A null text or one without a letter is ``und`` with score 0; so is every text when no
    language was learned. Equal texts get equal answers; ties go to the language first in
    code point order. Other columns pass through unread.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column(text))
            named, scores = [], []
            for low, high in chunks(column, CHUNK_BYTES):
                some, score = decide(column[low:high].to_pylist(), shared.value)
                named += some
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(named, pa.string()),
                    pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64()),
                ],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return docs.select(*kept).mapInArrow(run, schema)


def language_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned outside the held-out third."""
    out = held_out(F.col("doc_id"), 3, 1)
    filters = fit_filters(docs.filter(~out))
    return identify_language(docs.select("doc_id", "text", out.alias("held_out")), filters).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
