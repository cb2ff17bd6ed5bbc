"""Alignment of two tokenizers over the same bytes.

Both tokenizers encode a whole text first. Byte offsets where a token of each side ends are
shared ends; a shared end before a token that opens with a blank on both sides is an anchor.
Anchors, verified on the offsets, cut a text into windows of ids (mostly one word each). A
window's alignment depends on its ids alone, so it is worked out once and kept under the pair
of id tuples. Inside a window, shared ends cut groups; tokens link where their bytes overlap.

Side A is a byte-level BPE of the tokenizers library over a blank and the text, side B a
sentencepiece model over the text, which puts that blank there itself.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .text import chunks, raw, strings
from .tokens import _BYTE_NAMES, PieceEncoder, _Ragged

CHUNK_BYTES = 1 << 20
# Window alignments a Python worker keeps.
MEMO_WINDOWS = 200_000
# Different pairs a task counts before it passes them on.
COUNTED_PAIRS = 1_000_000
# Linked id pairs up to which their counts go to all tasks (16 bytes each).
TABLE_PAIRS = 1_000_000

_KEPT = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_KEPT_SQL = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class ByteTable:
    """The bytes each id stands for."""

    def __init__(self, entries: list[bytes]):
        self.body = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.spaced = np.fromiter((x[:1] == b" " for x in entries), bool, len(entries))

    def join(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        places = np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes)
        return self.body[places + np.arange(len(places))]


class ByteLevel:
    """Side A: a byte-level BPE file; strings of its special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path)
        self.encoder.whole.encode_special_tokens = True
        byte_of = {name: byte for byte, name in _BYTE_NAMES.items()}
        vocabulary = self.encoder.whole.get_vocab()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in byte_of for c in token)
            entries[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.bytes = ByteTable(entries)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        ids, sizes = self.encoder.encode(pa.array(texts, pa.large_string()))
        return ids.astype(np.int64), sizes


class Pieces:
    """Side B: a sentencepiece model; ``<0xHH>`` is one byte, U+2581 a blank."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        entries = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            own = bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()
            entries.append(own)
        self.bytes = ByteTable(entries)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum())), sizes


class Aligner:
    """Aligns texts and keeps the alignments of windows, by their id tuples."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.width = len(b.bytes.sizes)
        # How an id is written: on side A before "," or "|", on side B before "," or ";".
        n_a = len(a.bytes.sizes)
        marks = [(n_a, b","), (n_a, b"|"), (self.width, b","), (self.width, b";")]
        self.written = ByteTable([b"%d%s" % (k, mark) for n, mark in marks for k in range(n)])
        self._clear()

    def _clear(self) -> None:
        self.known: dict[tuple[bytes, bytes], int] = {}
        self.names: list[bytes] = []
        self.group_counts: list[int] = []
        self.codes = _Ragged(np.uint64)

    def _learn(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Align new windows, many at a time; each ends with a shared end."""
        a = np.frombuffer(b"".join([x for x, _ in keys]), np.uint32).astype(np.int64)
        b = np.frombuffer(b"".join([x for _, x in keys]), np.uint32).astype(np.int64)
        upto_a = np.cumsum([len(x) // 4 for x, _ in keys])
        upto_b = np.cumsum([len(x) // 4 for _, x in keys])
        ends_a, ends_b = np.cumsum(self.a.bytes.sizes[a]), np.cumsum(self.b.bytes.sizes[b])
        windows = ends_a[upto_a - 1]
        # Between two ends of either side lies one pair of tokens.
        ends = np.union1d(ends_a, ends_b)
        begins = np.concatenate([[0], ends[:-1]])
        first, second = np.searchsorted(ends_a, begins, "right"), np.searchsorted(ends_b, begins, "right")
        self.codes.extend(
            (a[first] * self.width + b[second]).astype(np.uint64),
            np.diff(np.searchsorted(ends, windows) + 1, prepend=0),
        )
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        n_a = len(self.a.bytes.sizes)
        names = np.concatenate(
            [a + n_a * (shared[group_a] == ends_a), 2 * n_a + b + self.width * (shared[group_b] == ends_b)]
        )
        names = names[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        cuts = np.concatenate([[0], np.cumsum(self.written.sizes[names])[upto_a + upto_b - 1]]).tolist()
        text = self.written.join(names).tobytes()
        self.known.update(zip(keys, range(len(self.names), len(self.names) + len(keys)), strict=True))
        self.names += [text[x : y - 1] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        self.group_counts += np.diff(np.searchsorted(shared, windows) + 1, prepend=0).tolist()

    def align(self, texts: list[str]) -> dict[str, list]:
        """Columns n_a, n_b, n_groups, n_links, groups_sha256, codes, times, one entry a text.

        ``codes`` holds the different linked pairs as ``a * width + b``, ``times`` how often
        each occurs. A text with other bytes after either tokenizer has no tokens.
        """
        if len(self.known) > MEMO_WINDOWS:
            self._clear()
        out = {k: [0] * len(texts) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out["groups_sha256"] = [""] * len(texts)
        out["codes"], out["times"] = [b""] * len(texts), [b""] * len(texts)
        some = [k for k, x in enumerate(texts) if x]
        if not some:
            return out
        framed = [" " + texts[k] for k in some]
        a, n_a = self.a.encode(framed)
        b, n_b = self.b.encode([texts[k] for k in some])
        same = self._same_bytes(framed, a, n_a, b, n_b)
        some = [k for k, x in zip(some, same.tolist(), strict=True) if x]
        if not some:
            return out
        a, n_a = a[np.repeat(same, n_a)], n_a[same]
        b, n_b = b[np.repeat(same, n_b)], n_b[same]
        from_a, from_b, first = self._windows(a, n_a, b, n_b)
        narrow_a, narrow_b = a.astype(np.uint32).tobytes(), b.astype(np.uint32).tobytes()
        cuts_a, cuts_b = (4 * from_a).tolist(), (4 * from_b).tolist()
        keys = [
            (narrow_a[x:y], narrow_b[u:v])
            for x, y, u, v in zip(cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:], strict=True)
        ]
        fresh = [x for x in dict.fromkeys(keys) if x not in self.known]
        if fresh:
            self._learn(fresh)
        numbers = [self.known[x] for x in keys]
        codes, sizes = self.codes.take(np.array(numbers, np.int64))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        groups = np.concatenate([[0], np.cumsum([self.group_counts[x] for x in numbers])])
        names = [self.names[x] for x in numbers]
        ends = first.tolist()
        for place, (k, x, y) in enumerate(zip(some, ends[:-1], ends[1:], strict=True)):
            pairs, times = np.unique(codes[upto[x] : upto[y]], return_counts=True)
            out["n_a"][k], out["n_b"][k] = int(n_a[place]), int(n_b[place])
            out["n_groups"][k], out["n_links"][k] = int(groups[y] - groups[x]), int(upto[y] - upto[x])
            out["groups_sha256"][k] = hashlib.sha256(b";".join(names[x:y])).hexdigest()
            out["codes"][k], out["times"][k] = self.pack(pairs), times.astype("<u4").tobytes()
        return out

    def pack(self, codes: np.ndarray) -> bytes:
        return codes.astype("<u4" if self.width * len(self.a.bytes.sizes) <= 1 << 32 else "<u8").tobytes()

    def _same_bytes(self, framed: list[str], a, n_a, b, n_b) -> np.ndarray:
        whole = [x.encode() for x in framed]
        same = np.ones(len(framed), bool)
        for table, ids, counts in ((self.a.bytes, a, n_a), (self.b.bytes, b, n_b)):
            upto = np.concatenate([[0], np.cumsum(table.sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
            body = table.join(ids).tobytes()
            cuts = upto.tolist()
            same &= [body[x:y] == z for x, y, z in zip(cuts[:-1], cuts[1:], whole, strict=True)]
        return same

    def _windows(self, a, n_a, b, n_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first a of each window and of none after, likewise b, windows before each text)."""
        ends_a, ends_b = np.cumsum(self.a.bytes.sizes[a]), np.cumsum(self.b.bytes.sizes[b])
        at = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_b[at] == ends_a)
        next_a, next_b = shared + 1, at[shared] + 1
        anchor = np.zeros(len(shared), bool)
        inner = next_a < len(a)
        anchor[inner] = self.a.bytes.spaced[a[next_a[inner]]] & self.b.bytes.spaced[b[next_b[inner]]]
        texts_end = np.searchsorted(next_a, np.cumsum(n_a))
        anchor[texts_end] = True
        from_a = np.concatenate([[0], next_a[anchor]])
        first = np.concatenate([[0], np.cumsum(anchor)[texts_end]])
        return from_a, np.concatenate([[0], next_b[anchor]]), first


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker, so that later tasks find its windows."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(ByteLevel(path_a), Pieces(path_b))
    return _ALIGNERS[path_a, path_b]


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column, CHUNK_BYTES):
                found = aligner.align(column[low:high].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row")[low:high],
                        batch.column("doc_id")[low:high],
                        *(pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")),
                        pa.array(found["groups_sha256"], pa.string()),
                        pa.array(found["codes"], pa.binary()),
                        pa.array(found["times"], pa.binary()),
                    ],
                    [*_KEPT, "codes", "times"],
                )

    return run


def align_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Written rows of ``docs`` with a number of their own and the columns of ``Aligner.align``."""
    aligned = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _align(path_a, path_b), f"{_KEPT_SQL}, codes binary, times binary"
    )
    return stage(aligned, "aligned")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, times, pairs per row) of a batch of packed pairs."""
    times_raw, bounds = raw(batch.column("times").cast(pa.large_binary()))
    codes_raw, own = raw(batch.column("codes").cast(pa.large_binary()))
    counts = np.diff(bounds) // 4
    width = 8 if own[-1] > bounds[-1] else 4
    codes = np.frombuffer(codes_raw.tobytes(), f"<u{width}").astype(np.int64)
    return codes, np.frombuffer(times_raw.tobytes(), "<u4").astype(np.int64), counts


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, seen = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def passed_on():
        return pa.RecordBatch.from_arrays([pa.array(known), pa.array(seen)], ["code", "seen"])

    for batch in batches:
        codes, times, _ = _unpacked(batch)
        both, back = np.unique(np.concatenate([known, codes]), return_inverse=True)
        seen = np.bincount(back, np.concatenate([seen, times]), len(both)).astype(np.int64)
        known = both
        if len(known) > COUNTED_PAIRS:
            yield passed_on()
            known, seen = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield passed_on()


def count_pairs(aligned: DataFrame, width: int) -> DataFrame:
    """(code, seen, best): links of each id pair in the corpus, and whether no pair of its b has more."""
    counted = (
        aligned.select("codes", "times")
        .mapInArrow(_count_pairs, "code long, seen long")
        .groupBy("code")
        .agg(F.sum("seen").alias("seen"))
    )
    # A b has at most as many pairs as there are ids on side A.
    most = F.max("seen").over(Window.partitionBy(F.col("code") % width))
    return counted.withColumn("best", F.col("seen") == most)


def _sum_rows(table_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, best = table_of.value
        for batch in batches:
            codes, times, counts = _unpacked(batch)
            at = np.searchsorted(known, codes)
            ends = np.cumsum(counts)
            sums = []
            for values in (times * best[at], times * seen[at]):
                total = np.concatenate([[0], np.cumsum(values)])
                sums.append(pa.array(total[ends] - total[ends - counts], pa.int64()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, _KEPT), *sums], [*_KEPT, "n_best", "count_sum"])

    return run


def _one_row_a_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, times, counts = _unpacked(batch)
        rows = np.repeat(batch.column("row").to_numpy(zero_copy_only=False), counts)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(codes), pa.array(times)], ["row", "code", "times"])


def sum_counts(aligned: DataFrame, pairs: DataFrame, most: int = TABLE_PAIRS) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of the packed pairs.

    Up to ``most`` pairs their counts go to all tasks, beyond that rows and counts are joined.
    """
    if pairs.limit(most + 1).count() <= most:
        table = pairs.select("code", "seen", F.col("best").cast("long")).toArrow().sort_by("code")
        arrays = tuple(table.column(c).to_numpy() for c in ("code", "seen", "best"))
        shared = aligned.sparkSession.sparkContext.broadcast(arrays)
        return aligned.mapInArrow(_sum_rows(shared), f"{_KEPT_SQL}, n_best long, count_sum long")
    single = aligned.select("row", "codes", "times").mapInArrow(_one_row_a_pair, "row long, code long, times long")
    summed = (
        single.join(pairs.hint("merge"), "code")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
            F.sum(F.col("times") * F.col("seen")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        aligned.select(*_KEPT)
        .join(summed, "row", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
    )


def align_documents(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, table_pairs: int = TABLE_PAIRS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    A text that is null, empty or has other bytes after either tokenizer has zeros and an
    empty digest. Rows without an id or with a repeated one are rows of their own; a repeated
    text counts each time. Other columns are not read; an empty table gives no row. Texts of
    any length are tokenized whole, a long one by itself. Ties for the highest count of a b
    all count as best.
    """
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    aligned = align_rows(docs, path_a, path_b)
    pairs = stage(count_pairs(aligned, len(Pieces(path_b).bytes.sizes)), "pairs")
    return sum_counts(aligned, pairs, table_pairs).select(*COLUMNS)
