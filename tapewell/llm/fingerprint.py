"""Order MinHash fingerprints: sketches that feel edits and changes of order.

The k-mers of a text are its runs of ``KMER`` words, each numbered by its occurrence in the
text, so that repeats count. A coordinate takes the ``PICKED`` k-mers that are least in a
pseudorandom order, puts them back in text order and hashes the tuple. All coordinates read
one hash circle, each from a point of its own, which is a random order for each.

Spark expressions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .native import let, sent_if_small

KMER = 3
COORDINATE_BITS = 6
COORDINATES = 1 << COORDINATE_BITS
PICKED = 2
DIGITS = 4  # hexadecimal digits a coordinate keeps
# A position takes the low 31 bits of a packed k-mer (no string is longer), its hash the rest.
_HASH = ~((1 << 31) - 1)
_PLACE = (1 << 31) - 1
# Ids that share all but these low bits are ordered together: at most 512 ids.
CELL_BITS = 9
BROADCAST_ROWS = 20_000


def _text_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _kmers(words: Column) -> Column:
    """Hash of every k-mer by position; of all words together if there are fewer."""
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(
            F.size(h) >= KMER,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - KMER),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(KMER)]),
            ),
        ).otherwise(F.array(F.xxhash64(h))),
    )


def _high(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_HASH))


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACE))


def _packed(hashed: Column, place: Column) -> Column:
    return _high(hashed).bitwiseOR(place.cast("long"))


def _numbered(kmers: Column) -> Column:
    """Packed (hash of k-mer and occurrence number, position), ascending."""

    def with_repeats(packed: Column) -> Column:
        def by_run(starts: Column) -> Column:
            return F.flatten(
                F.transform(
                    starts,
                    lambda s, r: F.transform(
                        F.sequence(s, F.coalesce(F.get(starts, r + 1), F.size(packed)) - 1),
                        lambda j: _packed(F.xxhash64(_high(F.get(packed, j)), j - s), _low(F.get(packed, j))),
                    ),
                )
            )

        return let(
            F.filter(
                F.sequence(F.lit(0), F.size(packed) - 1),
                lambda i: (i == 0) | (_high(F.get(packed, i)) != _high(F.get(packed, i - 1))),
            ),
            by_run,
        )

    return let(
        F.transform(kmers, lambda h, i: _packed(h, i)),
        lambda packed: F.sort_array(
            F.when(
                F.size(F.array_distinct(F.transform(packed, _high))) == F.size(packed),
                F.transform(packed, lambda p: _packed(F.xxhash64(_high(p), F.lit(0)), _low(p))),
            ).otherwise(let(F.sort_array(packed), with_repeats))
        ),
    )


def _section(x: Column) -> Column:
    """Which of the circle's equal sections a packed hash lies in, in ascending order."""
    return F.shiftright(x, 64 - COORDINATE_BITS).cast("int") + COORDINATES // 2


def _first_of_each(circle: Column) -> Column:
    """For each coordinate, the index of the first element at or after its point, 0 past the last."""

    def spread(firsts: Column) -> Column:
        known = F.flatten(
            F.transform(
                firsts,
                lambda i, r: F.array_repeat(
                    i,
                    _section(F.get(circle, i))
                    - F.when(r == 0, F.lit(-1)).otherwise(_section(F.get(circle, F.get(firsts, r - 1)))),
                ),
            )
        )
        return F.concat(known, F.array_repeat(F.lit(0), COORDINATES - F.size(known)))

    return let(
        F.filter(
            F.sequence(F.lit(0), F.size(circle) - 1),
            lambda i: (i == 0) | (_section(F.get(circle, i)) != _section(F.get(circle, i - 1))),
        ),
        lambda firsts: spread(firsts),
    )


def order_minhash(text: Column) -> Column:
    """Fingerprint of a text: ``DIGITS`` hexadecimal digits a coordinate; empty without words."""

    def picked(kmers: Column, circle: Column) -> Column:
        def coordinate(first: Column) -> Column:
            places = F.array_sort(
                F.array(*[_low(F.get(circle, (first + k) % F.size(circle))).cast("int") for k in range(PICKED)])
            )
            tuple_hash = let(places, lambda p: F.xxhash64(*[F.get(kmers, F.get(p, F.lit(k))) for k in range(PICKED)]))
            return F.lpad(F.hex(tuple_hash.bitwiseAND(F.lit(16**DIGITS - 1))), DIGITS, "0")

        return F.array_join(F.transform(_first_of_each(circle), coordinate), "")

    return let(
        _text_words(F.coalesce(text, F.lit(""))),
        lambda words: F.when(F.size(words) == 0, F.lit("")).otherwise(
            let(_kmers(words), lambda kmers: let(_numbered(kmers), lambda circle: picked(kmers, circle)))
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal coordinates; two empty fingerprints are alike, an empty and another are not."""
    same = F.size(
        F.filter(
            F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
            lambda i: F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS)),
        )
    ) / F.lit(float(COORDINATES))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(same)


def _cell(doc_id: Column) -> Column:
    """Number of the range of ids, from 0 for the smallest a long can hold."""
    return F.shiftrightunsigned(doc_id.bitwiseXOR(F.lit(-(1 << 63))), CELL_BITS)


def _before(keys: DataFrame) -> DataFrame:
    """(key, before) for distinct keys from 0 on: the next smaller key, the largest for the smallest.

    Keys are ordered within ranges of 512, the ranges by the same means, until one is left.
    """
    group = F.shiftright("key", CELL_BITS)
    groups = keys.select(group.alias("key")).distinct()
    own = Window.partitionBy(group).orderBy("key")
    near = keys.withColumn("before", F.lag("key").over(own)).withColumn("group", group)
    last = keys.groupBy(group.alias("group")).agg(F.max("key").alias("last"))
    if groups.limit(2).count() < 2:
        return near.join(last, "group").select("key", F.coalesce("before", "last").alias("before"))
    far = _before(stage(groups, "groups")).select(F.col("key").alias("group"), F.col("before").alias("other"))
    reach = far.join(last.withColumnRenamed("group", "other").withColumnRenamed("last", "reach"), "other")
    return near.join(reach.select("group", "reach"), "group").select("key", F.coalesce("before", "reach").alias("before"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint) by ascending doc_id, the first after the last.

    Documents are ordered in cells of 512 neighbouring ids; each cell also gets the first
    document of the next one. ``doc_id`` must not be null; equal ids are ordered by text.
    """
    cell = _cell(F.col("doc_id"))
    firsts = stage(
        docs.groupBy(cell.alias("key")).agg(F.min(F.struct("doc_id")).alias("head")).select("key", "head.doc_id"), "firsts"
    )
    goes_to = stage(_before(firsts.select("key")), "cells")
    ends = (
        docs.join(sent_if_small(firsts, BROADCAST_ROWS), "doc_id")
        .groupBy("key")
        .agg(F.min("text").alias("text"))
        .join(goes_to, "key")
        .select(F.col("before").alias("cell"), F.lit(True).alias("end"), F.lit(None).cast("long").alias("doc_id"), "text")
    )
    rows = docs.select(cell.alias("cell"), F.lit(False).alias("end"), "doc_id", "text").unionByName(ends)
    order = Window.partitionBy("cell").orderBy("end", "doc_id", "text")
    return (
        rows.withColumn("fingerprint", order_minhash(F.col("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .filter("not end")
        .drop("cell", "end")
    )


def fingerprints_of_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text ends in as many characters of the next document as half of its own. A
    null text is empty. A row without an id has no next document: its edit only drops the
    half, and near_next is null.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lone = (
        read.filter("doc_id is null")
        .withColumn("fingerprint", order_minhash(F.col("text")))
        .withColumn("next_text", F.lit(""))
        .withColumn("next_fingerprint", F.lit(None).cast("string"))
    )
    size = F.char_length("text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return (
        with_next(read.filter("doc_id is not null"))
        .unionByName(lone)
        .withColumn("n_chars", size.cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                F.substring("next_text", F.lit(1), half),
            ),
        )
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "fingerprint",
            order_minhash(F.col("edited")).alias("edited_fingerprint"),
            "next_fingerprint",
        )
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            F.when(
                F.col("next_fingerprint").isNotNull(), likeness(F.col("fingerprint"), F.col("next_fingerprint"))
            ).alias("near_next"),
        )
    )
