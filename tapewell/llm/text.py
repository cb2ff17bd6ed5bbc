"""Texts of an Arrow batch as NumPy arrays: bytes, words, word hashes.

Every helper works on whole texts, a bounded number of bytes at a time. A text that is
longer than the bound is cut between words, so no array grows with more than one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def strings(column: pa.Array) -> pa.Array:
    """Nulls as empty texts, one layout for plain and large strings."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer text."""
    if not len(column):
        return
    _, bounds = raw(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high
        low = high


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values = values ^ (values >> np.uint64(27))
        values = values * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once; sorting beats NumPy's hash table on millions of numbers."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)


_KEPT: dict[str, np.ndarray] = {}


def _kept_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > CHUNK_BYTES + 65536:
        return _powers(_BASE, n), _powers(_INVERSE, n)
    if not _KEPT:
        _KEPT["up"] = _powers(_BASE, CHUNK_BYTES + 65536)
        _KEPT["down"] = _powers(_INVERSE, CHUNK_BYTES + 65536)
    return _KEPT["up"], _KEPT["down"]


def word_spans(body: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run without a byte of ``breaks``; no run crosses a text's end."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~breaks[body]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(body))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(body: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from differences of one running sum over all bytes.

    Long bodies are summed a piece at a time; spans must be in order and not overlap.
    """
    out = np.empty(len(begins), np.uint64)
    done = 0
    while done < len(begins):
        low = int(begins[done])
        upto = max(int(np.searchsorted(ends, low + CHUNK_BYTES, "right")), done + 1)
        high = int(ends[upto - 1])
        up, down = _kept_powers(high - low)
        with np.errstate(over="ignore"):
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((body[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
            first, last = begins[done:upto] - low, ends[done:upto] - low
            part = (sums[last] - sums[first]) * down[first]
            out[done:upto] = mix(part + (last - first).astype(np.uint64) * _BASE)
        done = upto
    return out


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(body, bounds, begins, ends, words before each text) of a column without nulls."""
    body, bounds = raw(column)
    if lower:
        body = LOWER[body]
    begins, ends = word_spans(body, bounds)
    return body, bounds, begins, ends, np.searchsorted(begins, bounds)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id's digits puts a row in the held-out fold; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def bounded_labels(labels: DataFrame, label: str, folds: int, fold: int, per_class: int) -> DataFrame:
    """(doc_id, label, weight): at most ``per_class`` ids of each label, the same on every run.

    Ids of the held-out fold and rows without an id or a label are left out; of an id
    with several labels the larger counts. The weight is how many labelled ids of that
    label one kept id stands for.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counted = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        known.filter(F.col("label") == value)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class)
        .withColumn("weight", F.lit(max(1.0, counted.get(value, 0) / per_class)))
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])
