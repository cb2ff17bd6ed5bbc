"""Passages that many documents share, taken out of all but their first occurrence.

0. Of documents with the same text only the first is searched; the others lose all words
   if they have a window at all.
1. Every window of WINDOW words has a seed: its leftmost least hash among its runs of eight
   (of twenty) words. Equal windows have equal seeds at equal places, so only windows with a
   seed that occurs twice can repeat. Such seeds are counted over all documents.
2. The windows of one seed side by side (a few words' worth) form an occurrence.
   Occurrences with the same window hashes count once; their windows are then grouped, and
   those seen twice are confirmed, each with its first place (smallest row, then start).
3. Confirmed windows side by side in one document form a passage. It is cut into blocks of
   half a window; any window of the passage holds a whole block. Blocks are compiled into
   Aho-Corasick automata, one per shard of passages. Documents that hold a confirmed window
   again are streamed through the automata of the shards where those windows came first;
   around each hit, words (not hashes) are compared, so that what is covered is exact.

A hot shard is dealt to several groups, each with the shard's patterns and some documents.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .native import sent_if_small, small
from .neardup import _runs
from .text import CHUNK_BYTES, chunks, mix, raw, span_hashes, strings, words

WINDOW = 20
# Confirmed windows a shard's automaton is compiled from, and text it is fed at a time.
SHARD_WINDOWS = 100_000
GROUP_BYTES = 4 << 20
# Rows of ids, and seeds as numbers, up to which they are sent to all tasks (8 bytes each).
SENT_ROWS = 1_000_000
SENT_SEEDS = 4_000_000


def ordered_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): ``row`` is the id where all ids differ, else a written number in id order.

    Rows without an id come last; rows that repeat an id come in the order of their texts.
    """
    docs = docs.select("doc_id", "text")
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if unclear.isEmpty():
        return docs.withColumn("row", F.col("doc_id"))
    # The last key tells copies apart, so that they don't all fall to one task.
    tell = docs.withColumn("tell", F.monotonically_increasing_id())
    ordered = tell.orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first(), "tell").drop("tell")
    return stage(ordered.withColumn("row", F.monotonically_increasing_id()), "ordered")


class _Words:
    """Word hashes of some texts, and for every window of ``size`` words its hash and its seed."""

    def __init__(self, column: pa.Array, size: int):
        body, _, begins, ends, self.before = words(column, lower=False)
        hashes = span_hashes(body, begins, ends)
        gram, n = max(1, 2 * size // 5), max(0, len(hashes) - size + 1)
        grams = _runs(hashes, gram)
        reach = size - gram + 1
        least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        for k in range(reach):
            np.minimum(least, grams[k : k + n], out=least)
        at = np.zeros(n, np.int64)
        for k in reversed(range(reach)):
            here = grams[k : k + n] == least
            at[here] = np.flatnonzero(here) + k
        owner = np.repeat(np.arange(len(column)), np.diff(self.before))
        inside = np.flatnonzero(owner[:n] == owner[size - 1 : size - 1 + n]) if n else np.zeros(0, np.int64)
        # Windows within one text: place, text, seed's place, seed.
        self.at, self.owner, self.seed_at = inside, owner[inside], at[inside]
        self.seeds = least[inside]
        self.hashes = hashes

    def opens(self) -> np.ndarray:
        """Where a run of windows of one text with one seed place opens."""
        if not len(self.at):
            return np.zeros(0, bool)
        new = np.ones(len(self.at), bool)
        new[1:] = (self.seed_at[1:] != self.seed_at[:-1]) | (self.owner[1:] != self.owner[:-1])
        return new


def _seeds(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                found = _Words(column[low:high], size)
                first = np.flatnonzero(found.opens())
                owner, seeds = found.owner[first], found.seeds[first].view(np.int64)
                order = np.lexsort((seeds, owner))
                owner, seeds = owner[order], seeds[order]
                new = np.ones(len(seeds), bool)
                new[1:] = (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])
                starts = np.flatnonzero(new)
                rows = batch.column("row")[low:high].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[owner[starts]], pa.int64()),
                        pa.array(seeds[starts]),
                        pa.array(np.diff(np.append(starts, len(seeds))), pa.int64()),
                    ],
                    ["row", "seed", "times"],
                )

    return run


def _occurrences(size: int, sent=None):
    """Runs of windows whose seed is in ``sent``, or in the list that comes with the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                found = _Words(column[low:high], size)
                if sent is not None:
                    known, asked = sent.value, found.seeds
                else:
                    wanted = batch.column("seeds")[low:high]
                    flat = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    sizes = pc.list_value_length(wanted).to_numpy(zero_copy_only=False)
                    # Seeds of a text, told by one number for both; a mistaken match only adds a candidate.
                    with np.errstate(over="ignore"):
                        holder = np.repeat(np.arange(high - low), sizes).astype(np.uint64)
                        known = np.sort(mix(flat + holder * spread))
                        asked = mix(found.seeds + found.owner.astype(np.uint64) * spread)
                place = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
                keep = known[place] == asked if len(known) else np.zeros(len(asked), bool)
                starts = np.flatnonzero(found.opens() & keep)
                kept = np.flatnonzero(keep)
                hashes = _runs(found.hashes, size)[found.at[kept]]
                cuts = np.append(np.searchsorted(kept, starts), len(kept))
                # All windows of a run share their seed, so they are kept or left together.
                owner = found.owner[starts]
                lengths = np.diff(cuts)
                with np.errstate(over="ignore"):
                    inner = np.arange(len(kept)) - np.repeat(cuts[:-1], lengths)
                    salted = mix(hashes + (inner.astype(np.uint64) + np.uint64(1)) * spread)
                    whole = np.add.reduceat(salted, cuts[:-1]) if len(starts) else np.zeros(0, np.uint64)
                rows = batch.column("row")[low:high].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[owner], pa.int64()),
                        pa.array(found.at[starts] - found.before[owner], pa.int64()),
                        pa.array(found.seeds[starts].view(np.int64)),
                        pa.array((whole + lengths.astype(np.uint64)).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64))),
                    ],
                    ["row", "start", "seed", "kind", "windows"],
                )

    return run


def recurring_windows(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """(row, start, seed, kind, windows): runs of windows whose seed occurs twice in the corpus.

    Up to ``SENT_SEEDS`` such seeds they go to all tasks; beyond that each text is joined
    with the list of its own.
    """
    rows = rows.select("row", "text")
    seeds = rows.mapInArrow(_seeds(size), "row long, seed long, times long")
    twice = stage(
        seeds.groupBy("seed").agg(F.sum("times").alias("n")).filter("n > 1").select("seed"), "recurring-seeds"
    )
    schema = "row long, start long, seed long, kind long, windows array<long>"
    if small(twice, SENT_SEEDS):
        known = np.sort(twice.toArrow().column("seed").to_numpy().view(np.uint64))
        sent = rows.sparkSession.sparkContext.broadcast(known)
        return stage(rows.mapInArrow(_occurrences(size, sent), schema), "occurrences")
    lists = (
        seeds.select("row", "seed")
        .join(twice.hint("merge"), "seed")
        .groupBy("row")
        .agg(F.collect_list("seed").alias("seeds"))
    )
    return stage(rows.join(lists.hint("merge"), "row").mapInArrow(_occurrences(size), schema), "occurrences")


def confirm_windows(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(firsts, again): first place of every window seen twice, and which row holds which other's windows.

    ``firsts``: first_row, first_start. ``again``: row, first_row, each pair once; a row that
    repeats a window of its own is in it with itself.
    """
    kinds = stage(
        found.groupBy("seed", "kind").agg(
            F.min(F.struct("row", "start")).alias("head"),
            F.count("*").alias("n"),
            F.first("windows").alias("windows"),
        ),
        "kinds",
    )
    single = kinds.select("seed", "kind", "n", "head", F.posexplode("windows").alias("place", "window"))
    firsts = stage(
        single.groupBy("seed", "window")
        .agg(
            F.min(F.struct("head.row", F.expr("head.start + place").alias("start"))).alias("first"),
            F.sum("n").alias("n"),
        )
        .filter("n > 1")
        .select("seed", "window", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")),
        "firsts",
    )
    # Written, so that the join below can split a kind that very many rows hold.
    claims = stage(
        single.select("seed", "kind", "place", "window")
        .join(firsts, ["seed", "window"])
        .groupBy("seed", "kind")
        .agg(F.collect_list(F.struct("place", "first_row", "first_start")).alias("claims")),
        "claims",
    )
    again = (
        found.select("row", "start", "seed", "kind")
        .join(claims, ["seed", "kind"])
        .select(
            "row",
            F.explode(
                F.expr(
                    "array_distinct(transform(filter(claims, "
                    "x -> x.first_row != row or x.first_start != start + x.place), x -> x.first_row))"
                )
            ).alias("first_row"),
        )
        .distinct()
    )
    return firsts.select("first_row", "first_start"), stage(again, "again")


def _cut_passages(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            places = batch.column("places")
            for low, high in chunks(column):
                body, _, begins, ends, before = words(column[low:high], lower=False)
                shards, rows, starts, texts = [], [], [], []
                for k in range(high - low):
                    at = np.unique(places[low + k].values.to_numpy(zero_copy_only=False))
                    cut = np.flatnonzero(np.diff(at) > 1) + 1
                    for run_ in np.split(at, cut):
                        first, last = before[k] + run_[0], before[k] + run_[-1] + size
                        spans = zip(begins[first:last].tolist(), ends[first:last].tolist(), strict=True)
                        shards.append(batch.column("shard")[low + k].as_py())
                        rows.append(batch.column("row")[low + k].as_py())
                        starts.append(int(run_[0]))
                        texts.append(b" ".join([body[x:y].tobytes() for x, y in spans]).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shards, pa.int64()),
                        pa.array(rows, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    ["shard", "first_row", "first_start", "passage"],
                )

    return run


class Automaton:
    """Blocks of the passages of a shard, compiled; finds what a document repeats of them.

    ``vocabulary`` of all words of the group makes word numbers, so that equal numbers are
    equal words.
    """

    def __init__(self, texts: list[list[int]], names: list[str], rows: list[int], starts: list[int], size: int):
        self.half, self.size = size // 2, size
        self.rows, self.starts = rows, starts
        self.flat = np.array([x for own in texts for x in own], np.int64)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.machine = ahocorasick.Automaton()
        # Of each block the places that hold it: first document, passage, words before it.
        self.places: list[dict[int, list[tuple[int, int]]]] = []
        known: dict[str, int] = {}
        for number, own in enumerate(texts):
            for block in range(0, len(own) - self.half + 1, self.half):
                pattern = " " + " ".join([names[x] for x in own[block : block + self.half]]) + " "
                if pattern not in known:
                    known[pattern] = len(self.places)
                    self.places.append(defaultdict(list))
                    self.machine.add_word(pattern, (known[pattern], len(pattern) - 1))
                self.places[known[pattern]][rows[number]].append((number, block))
        self.machine.make_automaton()

    def covered(self, row: int, numbers: np.ndarray, text: str, firsts: set[int]) -> list[tuple[int, int]]:
        """Spans of words of a document covered by windows that came first in ``firsts``, elsewhere.

        ``text`` is the document's words with one blank before, between and after them.
        """
        blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        ends, blocks = [], []
        for end, (block, back) in self.machine.iter(text):
            ends.append(end - back)
            blocks.append(block)
        hits = np.searchsorted(blanks, np.array(ends, np.int64)).tolist()
        wanted: dict[int, list[tuple[int, int]]] = {}
        at, number, inner = [], [], []
        for hit, block in zip(hits, blocks, strict=True):
            if block not in wanted:
                places = self.places[block]
                chosen = places.keys() & firsts if len(firsts) < len(places) else [x for x in places if x in firsts]
                wanted[block] = [x for first in chosen for x in places[first]]
            for passage, before in wanted[block]:
                if self.rows[passage] != row or self.starts[passage] + before != hit:
                    at.append(hit)
                    number.append(passage)
                    inner.append(before)
        if not at:
            return []
        here, passage, before = np.array(at), np.array(number), np.array(inner)
        there = self.offsets[passage] + before
        left = self._reach(numbers, here - 1, there - 1, np.minimum(here, before), -1)
        room = np.minimum(len(numbers) - here, self.lengths[passage] - before) - self.half
        right = self._reach(numbers, here + self.half, there + self.half, room, 1)
        whole = left + self.half + right >= self.size
        marks = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(marks, (here - left)[whole], 1)
        np.add.at(marks, (here + self.half + right)[whole], -1)
        inside = np.concatenate([[0], np.cumsum(marks[:-1]) > 0, [0]])
        turns = np.flatnonzero(np.diff(inside))
        return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))

    def _reach(self, numbers, here, there, room, step) -> np.ndarray:
        """How many words from a place on are equal, half a window at most."""
        reach = np.zeros(len(here), np.int64)
        alive = np.ones(len(here), bool)
        for k in range(self.half):
            alive &= room > k
            some = np.flatnonzero(alive)
            alive[some] = numbers[here[some] + step * k] == self.flat[there[some] + step * k]
            reach += alive
        return reach


def _spaced(column: pa.Array) -> tuple[list[str], list[np.ndarray], list[str]]:
    """(words with single blanks around, as one character a byte; word numbers) per text, and the words."""
    body, _, begins, ends, before = words(column, lower=False)
    sizes = ends - begins
    upto = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(begins - upto[:-1], sizes) + np.arange(upto[-1])
    plain = body[places].tobytes()
    offsets = pa.py_buffer(upto.astype(np.int64).tobytes())
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(plain)]
    ).dictionary_encode()
    names = [x.decode("latin-1") for x in coded.dictionary.to_pylist()]
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts, own = [], []
    for low, high in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        own.append(numbers[low:high])
        texts.append(" " + " ".join([names[x] for x in numbers[low:high].tolist()]) + " ")
    return texts, own, names


def _locate(size: int):
    def run(passages: pa.Table, docs: pa.Table) -> pa.Table:
        rows, spans = [], []
        if docs.num_rows and passages.num_rows:
            left = strings(passages.column("passage").combine_chunks())
            right = strings(docs.column("text").combine_chunks())
            texts, numbers, names = _spaced(pa.concat_arrays([left, right]))
            machine = Automaton(
                [x.tolist() for x in numbers[: len(left)]],
                names,
                passages.column("first_row").to_pylist(),
                passages.column("first_start").to_pylist(),
                size,
            )
            for k, (row, firsts) in enumerate(
                zip(docs.column("row").to_pylist(), docs.column("firsts").to_pylist(), strict=True), len(left)
            ):
                rows.append(row)
                spans.append([{"begin": x, "end": y} for x, y in machine.covered(row, numbers[k], texts[k], set(firsts))])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({"row": pa.array(rows, pa.int64()), "spans": pa.array(spans, kind)})

    return run


def locate_passages(involved: DataFrame, firsts: DataFrame, again: DataFrame, size: int = WINDOW) -> DataFrame:
    """(row, spans): words [begin, end) covered by a window that came first elsewhere; spans may overlap.

    A row has one list per shard of passages it was streamed through.
    """
    shards = max(1, -(-firsts.count() // SHARD_WINDOWS))
    shard = F.expr(f"pmod(xxhash64(first_row), {shards}L)")
    places = firsts.groupBy("first_row").agg(F.collect_list("first_start").alias("places"))
    passages = (
        involved.join(
            places.select(F.col("first_row").alias("row"), "places", shard.alias("shard")).hint("merge"), "row"
        )
        .select("shard", "row", "text", "places")
        .mapInArrow(_cut_passages(size), "shard long, first_row long, first_start long, passage string")
    )
    routes = again.groupBy("row", shard.alias("shard")).agg(F.collect_list("first_row").alias("firsts"))
    routed = stage(involved.join(routes.hint("merge"), "row").select("shard", "row", "text", "firsts"), "routed")
    groups = routed.groupBy("shard").agg(
        F.ceil(F.sum(F.octet_length("text")) / GROUP_BYTES).cast("long").alias("groups")
    )
    one = F.greatest("groups", F.lit(1))
    left = passages.join(groups, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), one - 1)))
    right = routed.join(groups, "shard").withColumn("part", F.pmod(F.xxhash64("row"), one)).drop("groups")
    return (
        left.drop("groups")
        .groupBy("shard", "part")
        .cogroup(right.groupBy("shard", "part"))
        .applyInArrow(_locate(size), "row long, spans array<struct<begin: long, end: long>>")
    )


def _keep(size: int):
    """The words left of each text: those outside its spans, and none of a copy with a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            copy = batch.column("copy").to_pylist()
            for low, high in chunks(column):
                lists = batch.column("spans")[low:high].to_pylist()
                body, _, begins, ends, before = words(column[low:high], lower=False)
                kept = np.ones(len(begins) + 1, bool)
                for k, own in enumerate(lists):
                    if copy[low + k] and before[k + 1] - before[k] >= size:
                        kept[before[k] : before[k + 1]] = False
                    for span in own or ():
                        kept[before[k] + span["begin"] : before[k] + span["end"]] = False
                alive = np.flatnonzero(kept[:-1])
                first = np.searchsorted(alive, before)
                # A kept word and the blank after it, unless it is the last kept one of its text.
                more = np.ones(len(alive), np.int64)
                more[first[1:][first[1:] > first[:-1]] - 1] = 0
                sizes = ends[alive] - begins[alive]
                upto = np.concatenate([[0], np.cumsum(sizes + more)])
                places = np.repeat(begins[alive] - upto[:-1], sizes + more) + np.arange(upto[-1])
                out = np.append(body, np.uint8(32))[places]
                out[(upto[1:] - 1)[more == 1]] = 32
                text, cuts = out.tobytes(), upto[first].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[low:high],
                        batch.column("doc_id")[low:high],
                        pa.array(np.diff(before), pa.int64()),
                        pa.array(np.diff(before) - np.diff(first), pa.int64()),
                        pa.array([text[x:y].decode() for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()),
                    ],
                    ["row", "doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def drop_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """row, doc_id, n_words, n_removed and ``kept``, the words left, with one blank between them.

    A word goes if a window of ``size`` words covers it whose words also start earlier: in a
    smaller doc_id, or before in the same text. Windows are judged on the input. Null and
    empty texts have no words; texts shorter than a window keep theirs. Rows without an id
    come after all others, rows with the same id in the order of their texts. Other columns
    are not read; an empty table gives no row. Texts are read whole, long ones by themselves.
    """
    rows = ordered_rows(docs)
    digests = rows.filter("text != ''").select("row", F.sha2("text", 256).alias("digest"))
    heads = digests.groupBy("digest").agg(F.min("row").alias("head"), F.count("*").alias("n")).filter("n > 1")
    copies = stage(digests.join(heads, "digest").filter("row != head").select("row"), "copies")
    own = rows.join(sent_if_small(copies, SENT_ROWS), "row", "left_anti")
    found = recurring_windows(own, size)
    ids = sent_if_small(stage(found.select("row").distinct(), "involved-ids"), SENT_ROWS)
    involved = stage(own.join(ids, "row", "left_semi"), "involved")
    firsts, again = confirm_windows(found)
    spans = (
        locate_passages(involved.select("row", "text"), firsts, again, size)
        .groupBy("row")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    none, kind = F.lit(None), "array<struct<begin: long, end: long>>"
    parts = [
        involved.join(stage(spans, "spans").hint("merge"), "row", "left").withColumn("copy", F.lit(False)),
        own.join(ids, "row", "left_anti").withColumn("spans", none.cast(kind)).withColumn("copy", F.lit(False)),
        rows.join(sent_if_small(copies, SENT_ROWS), "row", "left_semi")
        .withColumn("spans", none.cast(kind))
        .withColumn("copy", F.lit(True)),
    ]
    columns = ["row", "doc_id", "text", "spans", "copy"]
    every = parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns))
    return every.mapInArrow(_keep(size), "row long, doc_id long, n_words long, n_removed long, kept string")


def repeats_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``."""
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
