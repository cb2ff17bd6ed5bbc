"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: ``COORDINATES`` bins; in each round every element of the set is hashed to one bin
with a value that any earlier round beats; the least value of a bin stays. After as many
rounds as bins, round ``COORDINATES + i`` sends every element to bin ``i``, so that every
coordinate fills whatever the size of the set. One round does for most texts.

Documents with the same shingle set form a class, told by a digest of the sorted set; only
its smallest id goes on. Classes that agree on a band of coordinates meet in a bucket. Each
bucket first proposes its members' pairs with its smallest member, so that a bucket of n
costs n pairs; pairs are confirmed on full shingle sets; buckets that are still in several
components then propose their pairs across components, until none is left to confirm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .rows import ROW, has_own_ids, number_rows
from .text import chunks, distinct, mix, span_hashes, strings, words

SHINGLE = 4
SIMILAR_PERCENT = 80
# A pair at similarity 0.8 shares none of 32 bands of 5 with probability 3e-6.
BANDS = 32
ROWS = 5
COORDINATES = BANDS * ROWS
# Numbers of confirmed pairs and buckets up to which a table is sent to all tasks (about 16 MB).
BROADCAST_ROWS = 500_000

_VALUE = np.uint64((1 << 52) - 1)


def shingles(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``size``-word runs; all words as one run if fewer."""
    out = []
    for low, high in chunks(column):
        body, _, begins, ends, before = words(column[low:high])
        hashes = span_hashes(body, begins, ends)
        runs = _runs(hashes, size)
        for first, last in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if last - first >= size:
                out.append(distinct(runs[first : last - size + 1]))
            elif last > first:
                out.append(_runs(np.pad(hashes[first:last], (0, size - last + first)), size)[:1])
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = mix(total + hashes[k : k + n] + np.uint64(k + 1))
    return total


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES values per set; sets must not be empty."""
    n = len(sets)
    out = np.full((n, COORDINATES), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    with np.errstate(over="ignore"):
        for turn in range(2 * COORDINATES):
            if not len(elements):
                break
            hashed = mix(elements + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15))
            value = np.uint64(turn) << np.uint64(52) | hashed & _VALUE
            if turn < COORDINATES:
                place = ((hashed >> np.uint64(32)) * np.uint64(COORDINATES) >> np.uint64(32)).astype(np.int64)
            else:
                place = np.full(len(elements), turn - COORDINATES)
            np.minimum.at(flat, owner * COORDINATES + place, value)
            open_sets = (out == np.iinfo(np.uint64).max).any(axis=1)
            left = open_sets[owner]
            elements, owner = elements[left], owner[left]
    return out


def band_hashes(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, the band's number in it."""
    banded = sketch.reshape(len(sketch), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), banded.shape[:2])
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            total = mix(total + banded[:, :, k] * np.uint64(0xD1B54A32D192ED03))
    return total.view(np.int64)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                sets = shingles(column[low:high], size)
                full = [k for k, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if full:
                    hashed = band_hashes(sketches([sets[k] for k in full]))
                    for k, row in zip(full, hashed, strict=True):
                        bands[k] = row
                        keys[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[low:high],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    return sign


def sign_documents(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands); key and bands are null for an empty set."""
    return docs.select("doc_id", "text").mapInArrow(
        _signer(size), "doc_id long, n_shingles long, set_key binary, bands array<long>"
    )


def _verifier(size: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last_set = None, None
        for batch in batches:
            left, right = strings(batch.column("text_a")), strings(batch.column("text_b"))
            ids = batch.column("a").to_pylist()
            own: list = []
            heads = [k for k, x in enumerate(ids) if x != (ids[k - 1] if k else last_id)]
            fresh = iter(shingles(left.take(pa.array(heads, pa.int64())), size)) if heads else iter(())
            for x in ids:
                if x != last_id:
                    last_id, last_set = x, next(fresh)
                own.append(last_set)
            linked = []
            for first, second in zip(own, shingles(right, size), strict=True):
                shared = len(np.intersect1d(first, second, assume_unique=True))
                linked.append(shared > 0 and 100 * shared >= percent * (len(first) + len(second) - shared))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"]
            )

    return verify


def _small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def confirm_pairs(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap by ``percent`` or more.

    ``docs`` has one row per id. Only texts that occur in a pair are shuffled: their ids go
    to all tasks while they are few, else the texts are joined to them by id.
    """
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")
    needed = docs.select("doc_id", "text").join(F.broadcast(ids) if _small(ids) else ids, "doc_id")
    second = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    first = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    # Merge joins by hint: neither side of texts is ever sent whole to a task.
    both = pairs.join(second.hint("merge"), "b").select("a", "b", "text_b").join(first.hint("merge"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(size, percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of every id in a link (a, b): the smallest id it can reach.

    Each round sends every id to the smallest id among its neighbours and their roots, then
    follows roots to their roots, so that long chains shrink by halves.
    """
    edges = stage(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges"
    )
    roots = stage(
        edges.select(F.explode(F.array("a", "b")).alias("doc_id"), F.col("a").alias("component"))
        .groupBy("doc_id")
        .agg(F.min("component").alias("component")),
        "roots",
    )
    while True:
        at_a = roots.select(F.col("doc_id").alias("a"), F.col("component").alias("ra"))
        at_b = roots.select(F.col("doc_id").alias("b"), F.col("component").alias("rb"))
        crossing = edges.join(at_a, "a").join(at_b, "b").filter("ra != rb")
        # Hang the larger root under the smallest root any of its members touches.
        hang = stage(
            crossing.select(F.greatest("ra", "rb").alias("doc_id"), F.least("ra", "rb").alias("under"))
            .groupBy("doc_id")
            .agg(F.min("under").alias("under")),
            "hang",
        )
        if hang.isEmpty():
            return roots
        hang = _to_the_top(hang)
        roots = stage(
            roots.join(hang.select(F.col("doc_id").alias("component"), "under"), "component", "left").select(
                "doc_id", F.coalesce("under", "component").alias("component")
            ),
            "roots",
        )


def _to_the_top(hang: DataFrame) -> DataFrame:
    """(doc_id, under) with every ``under`` replaced by the end of its chain, by pointer jumping."""
    while True:
        above = hang.select(F.col("doc_id").alias("under"), F.col("under").alias("higher"))
        jumped = stage(hang.join(above, "under", "left").select("doc_id", "under", "higher"), "jump")
        if jumped.filter("higher is not null").isEmpty():
            return hang
        hang = jumped.select("doc_id", F.coalesce("higher", "under").alias("under"))


def near_duplicate_links(signed: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = SIMILAR_PERCENT):
    """(components of class representatives, confirmed links between them).

    The links span the components; pairs already in one component are not all confirmed.
    ``signed`` is a written table of :func:`sign_documents`; ids must be distinct.
    """
    classes = stage(
        signed.filter("set_key is not null")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("head"))
        .select("head.*"),
        "classes",
    )
    members = classes.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = stage(
        members.groupBy("bucket")
        .agg(F.min("doc_id").alias("head"), F.count("*").alias("n"))
        .filter("n > 1"),
        "buckets",
    )
    met = stage(
        members.join(buckets, "bucket").select("bucket", "doc_id", "n_shingles", "head", "n"),
        "met",
    )
    sizes = met.select(F.col("doc_id").alias("head"), F.col("n_shingles").alias("head_size")).distinct()
    stars = met.filter("doc_id != head").select(F.col("head"), "doc_id", "n_shingles").distinct()
    tried = stage(
        stars.join(sizes, "head")
        .filter(_sizes_allow(F.col("n_shingles"), F.col("head_size"), percent))
        .select(F.col("head").alias("a"), F.col("doc_id").alias("b")),
        "pairs",
    )
    links = stage(confirm_pairs(tried, docs, size, percent), "links")
    found = components(links)
    rest = stage(_open_pairs(met, found, docs, size, percent).join(tried, ["a", "b"], "left_anti"), "rest")
    if rest.isEmpty():
        return found, links
    links = stage(links.unionByName(confirm_pairs(rest, docs, size, percent)), "links")
    return components(links), links


def _sizes_allow(x: Column, y: Column, percent: int) -> Column:
    """Sets of these sizes can overlap by ``percent``."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _tokens(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                sets = shingles(column[low:high], size)
                counts = np.array([len(s) for s in sets])
                ids = batch.column("doc_id").to_numpy()[low:high]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, counts)),
                        pa.array(np.repeat(counts, counts).astype(np.int64)),
                        pa.array(np.concatenate(sets).view(np.int64)),
                    ],
                    ["doc_id", "n_shingles", "token"],
                )

    return run


def _open_pairs(met: DataFrame, found: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Every pair that may still be a link across components: (a, b), few of them in vain.

    Any such pair lies in a bucket of three or more that spans components. Of the members
    of those buckets, only pairs that share one of their rarest shingles can be links: a
    set of n that overlaps another by 80 % misses at most a fifth of its shingles, so the
    first n - ceil(0.8 n) + 1 in order of frequency hold a common one. Passages that many
    documents share are frequent and bring nobody together.
    """
    labelled = (
        met.filter("n > 2")
        .join(found, "doc_id", "left")
        .select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    )
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low != high")
        .select("bucket")
    )
    open_ids = stage(
        labelled.join(mixed, "bucket", "left_semi").select("doc_id", "component").distinct(), "open"
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(open_ids) if _small(open_ids) else open_ids, "doc_id")
    tokens = stage(
        texts.select("doc_id", "text").mapInArrow(_tokens(size), "doc_id long, n_shingles long, token long"), "tokens"
    )
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    order = Window.partitionBy("doc_id").orderBy("often", "token")
    first = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    prefix = stage(
        tokens.join(often, "token")
        .withColumn("place", F.row_number().over(order))
        .filter((F.col("place") <= first) & (F.col("often") > 1))
        .join(open_ids, "doc_id")
        .select("token", "place", "doc_id", "n_shingles", "component"),
        "prefix",
    )
    # What decides on a pair is the same for all sets of a size that hold the token at a place:
    # such groups meet first, and only groups that may hold links bring their members together.
    key = ["token", "place", "n_shingles"]
    groups = prefix.groupBy(*key).agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    renamed = ["token", "place_b", "size_b"]
    other = groups.toDF(*renamed, "members_b", "low_b", "high_b")
    # At the first shingle a linked pair shares, all before it are missed on either side.
    most = F.least(F.col("n_shingles") - F.col("place"), F.col("size_b") - F.col("place_b")) + 1
    needed = percent * (F.col("n_shingles") + F.col("size_b"))
    meeting = stage(
        groups.join(other, "token")
        .filter(_sizes_allow(F.col("n_shingles"), F.col("size_b"), percent))
        .filter((100 + percent) * most >= needed)
        .filter("low != high or low_b != high_b or low != low_b")
        .select(*key, "place_b", "size_b"),
        "meeting",
    )
    left = prefix.select(*key, F.col("doc_id").alias("a"), "component")
    right = prefix.select(*key, "doc_id", "component").toDF(*renamed, "b", "component_b")
    return (
        left.join(meeting, key)
        .join(right, renamed)
        .filter("a < b and component != component_b")
        .select("a", "b")
        .distinct()
    )


def near_duplicate_rows(rows: DataFrame, size: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(row, n_shingles, component, spanning_links) of (row, text), where no ``row`` is null or repeats.

    ``component`` is the smallest row of those linked; see :func:`near_duplicates`.
    """
    one = rows.select(F.col(ROW).alias("doc_id"), "text")
    signed = stage(sign_documents(one, size), "signed")
    found, links = near_duplicate_links(signed, one, size, percent)
    heads = signed.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("head"))
    degree = (
        links.select(F.explode(F.array("a", "b")).alias("head"))
        .groupBy("head")
        .agg(F.count("*").alias("spanning_links"))
    )
    by_class = (
        heads.join(found.withColumnRenamed("doc_id", "head"), "head", "left")
        .join(degree, "head", "left")
        .select("set_key", F.coalesce("component", "head").alias("component"), "spanning_links")
    )
    return (
        signed.select("doc_id", "n_shingles", "set_key")
        .join(by_class, "set_key", "left")
        .select(
            F.col("doc_id").alias(ROW),
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component"),
            F.coalesce("spanning_links", F.lit(0).cast("long")).alias("spanning_links"),
        )
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, spanning_links) per row of ``docs`` (doc_id, text).

    A null or wordless text has an empty set, links with nothing and is kept. Rows without an
    id or with a repeated one are compared each by its own text; ``component_id`` is the
    smallest id of the rows linked, null only if none of them has one. Kept are the rows with
    that id; of rows without any, the one numbered first. An empty table gives an empty
    table. ``spanning_links`` counts the confirmed pairs of a row's class, a subset that
    spans each component, not all its links.
    """
    numbered = number_rows(docs.select("doc_id", "text"))
    found = near_duplicate_rows(numbered, size, percent)
    if has_own_ids(numbered):
        return found.select(
            F.col(ROW).alias("doc_id"),
            "n_shingles",
            F.col("component").alias("component_id"),
            (F.col(ROW) == F.col("component")).alias("kept"),
            "spanning_links",
        )
    named = stage(found.join(numbered.select(ROW, "doc_id"), ROW), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.when(F.col("component_id").isNull(), F.col(ROW) == F.col("component"))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .alias("kept"),
        "spanning_links",
    )


def drop_near_duplicate_rows(docs: DataFrame, size: int = 5, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """One row of every component of ``docs``: rows without an id or with a repeated one are compared each.

    The smallest id stays, a missing one only where no other is there; of rows with the same
    id the one whose text has the smallest hash.
    """
    numbered = number_rows(docs)
    found = near_duplicate_rows(numbered, size, percent)
    named = numbered.select(ROW, "doc_id", F.xxhash64("text").alias("hash"))
    kept = (
        found.select(ROW, "component")
        .join(named, ROW)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("lone"), "doc_id", "hash", ROW)).alias("first"))
        .select(F.col("first")[ROW].alias(ROW))
    )
    return numbered.join(kept, ROW, "left_semi").select(*docs.columns)
