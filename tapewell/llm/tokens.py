"""Token ids in a binary format: range asymmetric numeral system (rANS), static tables.

A written corpus is a folder of three Parquet tables:

``table``   token, frequency: one table for the whole corpus, scaled to a power of two (SCALE_BITS,
            or more for very many tokens), at least 1 for every token that occurs.
``blocks``  shard, block, first (ids of the shard before it), n_tokens, doc_ids, doc_lengths,
            ``words`` (the coded stream, 32-bit words), ``states`` and ``cuts``: the decoder's
            lane states and place in ``words`` at every checkpoint, and ``crc32`` of the ids.
``shards``  shard, n_tokens.

Shards are ranges of doc_id, in order. A block holds whole documents and decodes by itself;
so does each checkpoint's stretch of it, and stretches are decoded side by side. Token ``t``
of a block is coded in lane ``t % LANES``; lanes share one stream.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, work_dir
from .text import chunks, span_hashes, strings
from .text import raw as text_bytes

END_ID = 2
SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 19
STRETCH = 128  # steps between checkpoints
CACHE_PIECES = 250_000
SHARD_TOKENS = 16_000_000

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


# How byte-level BPE writes each byte as one printable character, and how it
# cuts plain Latin text (contractions, words, numbers, other marks, blanks) before merging.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_NAMES = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_LETTERS}0-9\s]+|\s+(?!\S)|\s+"
)


class PieceEncoder:
    """Ids of texts by the tokenizers library, which sees each different piece of text once.

    A byte-level BPE never joins a blank to what stands before it, so a text cut before
    each blank that follows a non-blank character encodes piece by piece to the same ids.
    Pieces are told apart by 64-bit hashes. Those of plain Latin text are cut further into
    the parts that the tokenizer merges within, many at a time; the library's model then
    merges each part that is new. All other pieces (other scripts, odd white space, added
    tokens) go through the library whole; so do whole texts where the tokenizer is of another
    kind. Full caches keep what was met most since they were last full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.added = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.merges = Tokenizer.from_file(path)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)
        self.id_bytes = 2 if len(self.token_bytes) <= 1 << 16 else 4
        self.cuts_texts = _is_plain_byte_level(json.loads(self.whole.to_str()))
        self.pieces_known = np.zeros(0, np.uint64)
        self.piece_numbers = np.zeros(0, np.int64)
        self.parts_known: dict[str, int] = {}
        self.pieces_held, self.parts_held = _Ragged(), _Ragged()

    def _make_room(self) -> None:
        if len(self.parts_known) > CACHE_PIECES:
            parts, numbers = list(self.parts_known), np.fromiter(self.parts_known.values(), np.int64)
            kept = np.flatnonzero(self.parts_held.most_met(numbers))
            self.parts_held = self.parts_held.only(numbers[kept])
            self.parts_known = {parts[k]: number for number, k in enumerate(kept.tolist())}
        if len(self.pieces_known) > CACHE_PIECES:
            kept = self.pieces_held.most_met(self.piece_numbers)
            self.pieces_held = self.pieces_held.only(self.piece_numbers[kept])
            self.pieces_known = self.pieces_known[kept]
            self.piece_numbers = np.arange(len(self.pieces_known))

    def _learn_parts(self, parts: list[str]) -> None:
        named = "\0".join(parts).encode().decode("latin-1").translate(_BYTE_NAMES | {0: " "}).split(" ")
        groups = [" ".join(named[k : k + 16]) for k in range(0, len(named), 16)]
        found = [x.ids for x in self.merges.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, named), np.int64, len(named)))
        upto = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
        first = self.parts_held.count - 1
        self.parts_known.update(zip(parts, range(first, first + len(parts)), strict=True))
        self.parts_held.extend(ids, np.diff(upto, prepend=0))

    def _learn_pieces(self, raw: bytes, begins: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """Numbers of new pieces, told by their place in ``raw``."""
        numbers = np.empty(len(begins), np.int64)
        simple, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        first = self.pieces_held.count - 1
        numbers[simple] = first + np.arange(len(simple))
        numbers[other] = first + len(simple) + np.arange(len(other))
        if len(simple):
            spans = zip(begins[simple].tolist(), ends[simple].tolist(), strict=True)
            parts = _PARTS.findall(b"".join([raw[x:y] for x, y in spans]).decode())
            new = [x for x in dict.fromkeys(parts) if x not in self.parts_known]
            if new:
                self._learn_parts(new)
            codes = np.fromiter(map(self.parts_known.__getitem__, parts), np.int64, len(parts))
            heads = np.flatnonzero(np.fromiter((x[0] == " " for x in parts), bool, len(parts)))
            self.parts_held.met(codes)
            ids, sizes = self.parts_held.take(codes)
            self.pieces_held.extend(ids, np.add.reduceat(sizes, heads))
        if len(other):
            spans = zip(begins[other].tolist(), ends[other].tolist(), strict=True)
            found = [
                x.ids
                for x in self.whole.encode_batch_fast([raw[x:y].decode() for x, y in spans], add_special_tokens=False)
            ]
            self.pieces_held.extend(
                np.fromiter(itertools.chain.from_iterable(found), np.uint32),
                np.fromiter(map(len, found), np.int64, len(found)),
            )
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text) of texts without nulls."""
        if not self.cuts_texts:
            found = [x.ids for x in self.whole.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes
        self._make_room()
        body, bounds = text_bytes(column)
        if not len(body):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        begins = _cuts(body, bounds)
        ends = np.append(begins[1:], len(body))
        unique, at, back = _grouped(span_hashes(body, begins, ends))
        place = np.minimum(np.searchsorted(self.pieces_known, unique), max(len(self.pieces_known) - 1, 0))
        known = self.pieces_known[place] == unique if len(self.pieces_known) else np.zeros(len(unique), bool)
        numbers = np.empty(len(unique), np.int64)
        numbers[known] = self.piece_numbers[place[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            raw = body.tobytes()
            first, last = begins[at[fresh]], ends[at[fresh]]
            numbers[fresh] = self._learn_pieces(raw, first, last, _plain(body, raw, first, last, self.added))
            gaps = np.searchsorted(self.pieces_known, unique[fresh])
            self.pieces_known = np.insert(self.pieces_known, gaps, unique[fresh])
            self.piece_numbers = np.insert(self.piece_numbers, gaps, numbers[fresh])
        self.pieces_held.met(numbers)
        ids, sizes = self.pieces_held.take(numbers[back])
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(upto[np.searchsorted(begins, bounds)])


def _is_plain_byte_level(file: dict) -> bool:
    """Whether a tokenizer file merges bytes within the parts that ``_PARTS`` cuts."""
    first, model = file.get("pre_tokenizer") or {}, file["model"]
    return (
        not file.get("normalizer")
        and first.get("type") == "ByteLevel"
        and not first.get("add_prefix_space")
        and first.get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different values in order, a place of each, each value's number among them)."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    back = np.empty(len(values), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


def _cuts(body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of pieces: of every non-empty text, and blanks after what cannot be white space.

    That is a printable ASCII character, one of two bytes from U+00C0 on, or one of three
    bytes from U+4000 on; not to cut elsewhere is always right.
    """
    blank = np.flatnonzero(body == 32)
    blank = blank[blank > 0]
    last = body[blank - 1]
    tail = last & 0xC0 == 0x80
    lead2 = body[np.maximum(blank - 2, 0)]
    lead3 = body[np.maximum(blank - 3, 0)]
    solid = (last > 32) & (last < 127) | tail & (lead2 >= 0xC3) & (lead2 < 0xE0) | tail & (lead3 >= 0xE4)
    cut = np.zeros(len(body), bool)
    cut[blank[solid]] = True
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


def _plain(body: np.ndarray, raw: bytes, begins: np.ndarray, ends: np.ndarray, added: list[str]) -> np.ndarray:
    """Whether a piece is a blank and then Latin text without a blank or an added token."""
    fit = _PLAIN_BYTES[body]
    second = np.flatnonzero(body == 0xC3) + 1
    second = second[second < len(body)]
    fit[second] = (body[second] != 0x97) & (body[second] != 0xB7)
    for token in added:
        for hit in re.finditer(re.escape(token.encode()), raw):
            fit[hit.start()] = False
    fit &= body != 32
    fit[begins] |= body[begins] == 32
    unfit = np.flatnonzero(~fit)
    return (body[begins] == 32) & (np.searchsorted(unfit, begins) == np.searchsorted(unfit, ends))


_PLAIN_BYTES = np.zeros(256, bool)
_PLAIN_BYTES[[9, 10, 13, *range(32, 127), 0xC3]] = True


class _Ragged:
    """Growing lists of ids, by number, and how often each was met."""

    def __init__(self, kind=np.uint32):
        self.ids, self.used = np.zeros(1 << 16, kind), 0
        self.ends, self.count = np.zeros(1 << 16, np.int64), 1
        self.times = np.zeros(1 << 16, np.int32)

    def met(self, numbers: np.ndarray) -> None:
        seen = np.bincount(numbers)
        self.times[: len(seen)] += seen.astype(np.int32)

    def most_met(self, numbers: np.ndarray) -> np.ndarray:
        """Which of ``numbers`` were met more often than half of them."""
        times = self.times[numbers]
        return times > np.partition(times, len(times) // 2)[len(times) // 2]

    def only(self, numbers: np.ndarray) -> _Ragged:
        out = _Ragged(self.ids.dtype)
        out.extend(*self.take(numbers))
        return out

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(sizes) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.times = np.concatenate([self.times, np.zeros_like(self.times)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.ends[self.count : self.count + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.count += len(sizes)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(their ids, one list after the other, and how many each has)."""
        starts = self.ends[numbers]
        sizes = self.ends[numbers + 1] - starts
        ends = np.cumsum(sizes)
        places = np.repeat(starts - ends + sizes, sizes)
        places += np.arange(len(places))
        return self.ids[places], sizes


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One per Python worker, so that later tasks find its pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                ids, sizes = encoder.encode(column[low:high])
                ends = np.cumsum(sizes)
                body = np.insert(ids, ends, end_id).astype(f"<u{encoder.id_bytes}")
                bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * body.itemsize
                raw = body.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[low:high],
                        pa.array(sizes + 1, pa.int64()),
                        pa.array([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    return run


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of the whole text and ``end_id``, packed little-endian.

    ``ids`` takes 2 bytes an id where the vocabulary allows, else 4. A null text is empty.
    ``path`` names the tokenizer's file where the executors find it.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _tokenize(path, end_id), "doc_id long, n_tokens long, ids binary"
    )


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32)


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        body, bounds = text_bytes(batch.column("ids").cast(pa.large_binary()))
        own = np.bincount(_unpack(body, int(pc.sum(batch.column("n_tokens")).as_py() or 0)))
        if len(own) > len(counts):
            counts = np.pad(counts, (0, len(own) - len(counts)))
        counts[: len(own)] += own
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["token", "seen"])


def scale_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to a power of two, at least 1 where ``counts`` is.

    That is 2**SCALE_BITS, or the least power that leaves each token two shares.
    """
    total = counts.sum()
    if not total:
        return np.zeros(len(counts), np.int64)
    goal = 1 << max(SCALE_BITS, int(2 * np.count_nonzero(counts) - 1).bit_length())
    scaled = np.where(counts > 0, np.maximum(1, counts * (goal / total)).astype(np.int64), 0)
    over = int(scaled.sum()) - goal
    for place in np.argsort(-scaled, kind="stable"):
        if over <= 0:
            break
        cut = min(over, int(scaled[place]) - 1)
        scaled[place] -= cut
        over -= cut
    scaled[np.argmax(scaled)] -= min(over, 0)
    return scaled


def _bits(freq: np.ndarray) -> np.uint64:
    """The power of two that frequencies sum to."""
    return np.uint64(int(freq.sum()).bit_length() - 1)


def encode_block(ids: np.ndarray, freq: np.ndarray, below: np.ndarray) -> tuple[bytes, bytes, list[int]]:
    """(words, states, cuts) of one block; the last step is filled up with its own last id."""
    steps = -(-len(ids) // LANES)
    grid = np.pad(ids, (0, steps * LANES - len(ids)), mode="edge").reshape(steps, LANES)
    f_all = freq[grid].astype(np.uint64)
    c_all = below[grid].astype(np.uint64)
    scale = _bits(freq)
    limit_all = f_all << (np.uint64(63) - scale)
    x = np.full(LANES, _LOW, np.uint64)
    out: list[np.ndarray] = []
    states, emitted, at = [], [], 0
    for step in range(steps - 1, -1, -1):
        f = f_all[step]
        full = x >= limit_all[step]
        if full.any():
            words = x[full].astype(np.uint32)
            out.append(words[::-1])
            at += len(words)
            x[full] >>= _WORD
        q = x // f
        x = (q << scale) + (x - q * f) + c_all[step]
        if step % STRETCH == 0:
            states.append(x.copy())
            emitted.append(at)
    stream = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
    cuts = [at - x for x in reversed(emitted)]
    return stream.astype("<u4").tobytes(), np.concatenate(states[::-1]).astype("<u8").tobytes(), cuts


def decode_block(
    words: bytes, states: bytes, cuts: list[int], n_tokens: int, freq: np.ndarray, below: np.ndarray, symbol: np.ndarray
) -> np.ndarray:
    """Ids of a block; all stretches between checkpoints advance together."""
    stream = np.frombuffer(words, "<u4").astype(np.uint64)
    stream = np.append(stream, np.uint64(0))
    x = np.frombuffer(states, "<u8").reshape(len(cuts), LANES).copy()
    at = np.array(cuts, np.int64)
    steps = -(-n_tokens // LANES)
    scale = _bits(freq)
    mask = (np.uint64(1) << scale) - np.uint64(1)
    out = np.zeros((len(cuts), STRETCH, LANES), np.uint32)
    for step in range(min(STRETCH, steps)):
        live = len(cuts) if (len(cuts) - 1) * STRETCH + step < steps else len(cuts) - 1
        y = x[:live]
        slot = y & mask
        found = symbol[slot]
        out[:live, step] = found
        y = freq[found] * (y >> scale) + slot - below[found]
        short = y < _LOW
        order = np.cumsum(short, axis=1)
        if short.any():
            rows, lanes = np.nonzero(short)
            y[rows, lanes] = y[rows, lanes] << _WORD | stream[at[rows] + order[rows, lanes] - 1]
        at[:live] += order[:, -1]
        x[:live] = y
    return out.reshape(-1)[:n_tokens]


def _block_writer(freq_of, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        freq = freq_of.value
        below = np.concatenate([[0], np.cumsum(freq)[:-1]])
        first, number, waiting = 0, 0, 0
        held: list[np.ndarray] = []
        ids: list[int] = []
        sizes: list[int] = []

        def flush():
            nonlocal first, number, waiting, held, ids, sizes
            body = np.concatenate(held)
            words, states, cuts = encode_block(body, freq, below)
            row = {
                "shard": shard,
                "block": number,
                "first": first,
                "n_tokens": len(body),
                "doc_ids": ids,
                "doc_lengths": sizes,
                "words": words,
                "states": states,
                "cuts": cuts,
                "crc32": zlib.crc32(body.astype("<u4")),
            }
            first, number, waiting, held, ids, sizes = first + len(body), number + 1, 0, [], [], []
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for batch in batches:
            for doc, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids")), strict=True):
                held.append(_unpack(raw, n))
                ids.append(doc)
                sizes.append(n)
                waiting += n
                if waiting >= block_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_lengths", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("states", pa.binary()),
        ("cuts", pa.list_(pa.int64())),
        ("crc32", pa.int64()),
    ]
)
_BLOCKS_SQL = (
    "shard int, block int, first long, n_tokens long, doc_ids array<long>, doc_lengths array<long>, "
    "words binary, states binary, cuts array<long>, crc32 long"
)


def write_corpus(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Tokenize ``docs`` (doc_id, text) and write them to ``folder``, in ascending doc_id order.

    Rows without an id come first; rows that repeat an id are all written, shorter first.
    """
    spark = docs.sparkSession
    encoded = stage(tokenize(docs, path, end_id), "ids")
    seen = (
        encoded.select("n_tokens", "ids")
        .mapInArrow(_count_ids, "token long, seen long")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
    )
    # Bounded by the vocabulary.
    pairs = seen.toPandas()
    counts = np.zeros(int(pairs["token"].max()) + 1 if len(pairs) else 1, np.int64)
    counts[pairs["token"].to_numpy(np.int64)] = pairs["seen"]
    freq = scale_table(counts)
    spark.createDataFrame(
        [(int(t), int(freq[t])) for t in np.flatnonzero(freq)], "token long, frequency long"
    ).coalesce(1).write.parquet(f"{folder}/table")
    shards = max(1, -(-int(counts.sum()) // SHARD_TOKENS), min(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    (
        encoded.repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "n_tokens", "ids")
        .mapInArrow(_block_writer(spark.sparkContext.broadcast(freq), block_tokens), _BLOCKS_SQL)
        .write.option("compression", "uncompressed")
        .parquet(f"{folder}/blocks")
    )
    blocks = spark.read.parquet(f"{folder}/blocks")
    blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).coalesce(1).write.parquet(f"{folder}/shards")


def _table(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.schema("token long, frequency long").parquet(f"{folder}/table").toPandas()
    freq = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 1, np.int64)
    freq[rows["token"].to_numpy(np.int64)] = rows["frequency"]
    return freq


def _shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each shard; one row a shard, so the one task it takes stays small."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        spark.read.schema("shard int, n_tokens long")
        .parquet(f"{folder}/shards")
        .select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"))
    )


def _decoder(freq_of, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = freq_of.value
        below = np.concatenate([[0], np.cumsum(freq)[:-1]])
        symbol = np.repeat(np.arange(len(freq)), freq).astype(np.int64)
        wide, low = freq.astype(np.uint64), below.astype(np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(row["words"], row["states"], row["cuts"], row["n_tokens"], wide, low, symbol)
                body = ids.astype("<u4")
                if zlib.crc32(body) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of shard {row['shard']} does not match its checksum")
                sizes = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(sizes)
                parts = [body[a:b] for a, b in zip(ends - sizes, ends, strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["shard_start"] + row["first"] + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_corpus(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of a written corpus; fails on a damaged block."""
    freq = _table(spark, folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    blocks = (
        spark.read.schema(_BLOCKS_SQL).parquet(f"{folder}/blocks").join(_shard_starts(spark, folder), "shard")
    )
    return blocks.mapInArrow(_decoder(spark.sparkContext.broadcast(freq), with_ids), schema)


def tokens_of_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` as a corpus under the shared folder and read it back."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    folder = work_dir(docs.sparkSession, "tokens")
    write_corpus(docs, folder, path)
    return read_corpus(docs.sparkSession, folder)
