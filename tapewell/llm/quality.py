"""Quality of a text by a factorization machine.

Features are hashed words, buckets of structure statistics and of the declared length.
Pairs of features interact through low-rank factors; the sum over all pairs is taken in
time linear in the features, as half of (square of sums less sum of squares) per factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bounded_labels, chunks, distinct, held_out, raw, span_hashes, strings, word_spans, words

WORD_SLOTS = 1 << 16
BUCKETS = 16
STATISTICS = 11
SLOTS = WORD_SLOTS + STATISTICS * BUCKETS
FACTORS = 8
# Fitting: labelled texts per label, fewest texts a word slot is seen in, passes, step, decay.
SAMPLE_PER_LABEL = 8000
LEAST_TEXTS = 3
PASSES = 6
BATCH = 256
STEP = 0.1
DECAY = 1e-5
SEED = 7

_OTHER, _LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _BANG, _BAR, _SYMBOL = range(10)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[128:] = _OTHER
_KIND[[9, 11, 12, 13, 32]] = _BLANK
_KIND[10] = _LINE
_KIND[ord("a") : ord("z") + 1] = _LOWER
_KIND[ord("A") : ord("Z") + 1] = _UPPER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord(c) for c in ".,;:'\"-"]] = _STOP
_KIND[[ord(c) for c in "!?"]] = _BANG
_KIND[ord("|")] = _BAR
_ONLY_LINES = np.zeros(256, bool)
_ONLY_LINES[10] = True


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def _log_bucket(values: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(values + 1.0), BUCKETS - 1).astype(np.int64)


def _share_bucket(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Finer towards 0, where most shares lie."""
    share = part / np.maximum(whole, 1)
    return np.minimum(np.sqrt(np.clip(share, 0, 1)) * BUCKETS, BUCKETS - 1).astype(np.int64)


def features(column: pa.Array, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first feature of each text and the end, slots, values) of texts without nulls.

    ``declared`` is the length the metadata names, negative where it names none.
    """
    n = len(column)
    body, bounds, begins, ends, before = words(column)
    hashes = span_hashes(body, begins, ends)
    per_text = np.diff(before)
    owner = np.repeat(np.arange(n), per_text)
    word_keys = distinct(owner.astype(np.uint64) << np.uint64(16) | (hashes & np.uint64(WORD_SLOTS - 1)))
    word_owner = (word_keys >> np.uint64(16)).astype(np.int64)
    word_slot = (word_keys & np.uint64(WORD_SLOTS - 1)).astype(np.int64)
    kinds = np.bincount(
        np.repeat(np.arange(n) * 10, np.diff(bounds)) + _KIND[raw(column)[0]], minlength=n * 10
    ).reshape(n, 10)
    size = np.diff(bounds)
    distinct_words = np.bincount(word_owner, minlength=n)
    line_begins, line_ends = word_spans(body, bounds, _ONLY_LINES)
    line_owner = np.searchsorted(bounds, line_begins, "right") - 1
    lines = np.bincount(line_owner, minlength=n)
    line_keys = distinct(
        line_owner.astype(np.uint64) << np.uint64(44) | span_hashes(body, line_begins, line_ends) >> np.uint64(20)
    )
    distinct_lines = np.bincount((line_keys >> np.uint64(44)).astype(np.int64), minlength=n)
    letters = kinds[:, _LOWER] + kinds[:, _UPPER]
    buckets = [
        _log_bucket(size),
        _log_bucket(per_text),
        np.minimum(size / np.maximum(per_text, 1), BUCKETS - 1).astype(np.int64),
        _share_bucket(kinds[:, _UPPER], letters),
        _share_bucket(kinds[:, _SYMBOL], size),
        _share_bucket(kinds[:, _BANG], size),
        _share_bucket(kinds[:, _BAR], size),
        _share_bucket(kinds[:, _DIGIT], size),
        _share_bucket(per_text - distinct_words, per_text),
        _share_bucket(lines - distinct_lines, lines),
        np.where(declared < 0, BUCKETS - 1, np.minimum(_log_bucket(np.maximum(declared, 0)), BUCKETS - 2)),
    ]
    stat_slot = WORD_SLOTS + np.arange(STATISTICS) * BUCKETS + np.stack(buckets, axis=1)
    all_owner = np.concatenate([word_owner, np.repeat(np.arange(n), STATISTICS)])
    order = np.argsort(all_owner, kind="stable")
    slots = np.concatenate([word_slot, stat_slot.ravel()])[order]
    values = np.concatenate(
        [1 / np.sqrt(np.maximum(distinct_words[word_owner], 1)), np.full(n * STATISTICS, 1 / np.sqrt(STATISTICS))]
    )[order]
    starts = np.concatenate([[0], np.cumsum(distinct_words + STATISTICS)])
    return starts, slots.astype(np.int32), values.astype(np.float32)


def score_features(starts: np.ndarray, slots: np.ndarray, values: np.ndarray, machine: Machine) -> np.ndarray:
    """Log odds of each text; every text has at least its statistics, so no range is empty."""
    at = starts[:-1]
    straight = np.add.reduceat(machine.linear[slots] * values, at)
    weighted = machine.factors[slots] * values[:, None]
    sums = np.add.reduceat(weighted, at, axis=0)
    squares = np.add.reduceat(weighted * weighted, at, axis=0)
    return machine.bias + straight + 0.5 * (sums * sums - squares).sum(axis=1)


def fit_machine(starts, slots, values, labels, weights, passes: int = PASSES) -> Machine:
    """Log loss by Adagrad over small batches, in a fixed random order."""
    rng = np.random.default_rng(SEED)
    n = len(labels)
    base = float(np.clip((labels * weights).sum() / max(weights.sum(), 1e-9), 0.01, 0.99)) if n else 0.5
    bias = float(np.log(base / (1 - base)))
    linear = np.zeros(SLOTS, np.float32)
    factors = (0.05 * rng.standard_normal((SLOTS, FACTORS))).astype(np.float32)
    if not n:
        return Machine(0.0, linear, np.zeros_like(factors))
    seen = np.bincount(slots, minlength=SLOTS)
    known = seen >= LEAST_TEXTS
    factors[~known] = 0
    weights = weights / weights.mean()
    power_linear = np.full(SLOTS, 1e-6, np.float32)
    power_factors = np.full((SLOTS, FACTORS), 1e-6, np.float32)
    power_bias = 1e-6
    counts = np.diff(starts)
    for _ in range(passes):
        order = rng.permutation(n)
        for low in range(0, n, BATCH):
            rows = order[low : low + BATCH]
            sizes = counts[rows]
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            places = np.repeat(starts[rows] - at, sizes) + np.arange(sizes.sum())
            some, x = slots[places], values[places]
            model = Machine(bias, linear, factors)
            odds = score_features(np.append(at, len(some)), some, x, model)
            error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels[rows]) * weights[rows] / len(rows)
            own = factors[some]
            sums = np.add.reduceat(own * x[:, None], at, axis=0)
            each = np.repeat(error, sizes).astype(np.float32) * x
            slope = each[:, None] * (np.repeat(sums, sizes, axis=0) - own * x[:, None])
            by_slot = np.argsort(some, kind="stable")
            ordered = some[by_slot]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            touched = ordered[first]
            g_linear = np.add.reduceat(each[by_slot], first) + DECAY * linear[touched]
            g_factors = np.add.reduceat(slope[by_slot], first, axis=0) + DECAY * factors[touched]
            g_linear *= known[touched]
            g_factors *= known[touched, None]
            power_linear[touched] += g_linear**2
            power_factors[touched] += g_factors**2
            linear[touched] -= STEP * g_linear / np.sqrt(power_linear[touched])
            factors[touched] -= 0.2 * STEP * g_factors / np.sqrt(power_factors[touched])
            g_bias = float(error.sum())
            power_bias += g_bias**2
            bias -= STEP * g_bias / power_bias**0.5
    return Machine(bias, linear, factors)


def _declared(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, declared = strings(batch.column("text")), _declared(batch)
        for low, high in chunks(column):
            starts, slots, values = features(column[low:high], declared[low:high])
            parts = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label")[low:high],
                    batch.column("weight")[low:high],
                    pa.ListArray.from_arrays(parts, pa.array(slots)),
                    pa.ListArray.from_arrays(parts, pa.array(values)),
                ],
                ["label", "weight", "slots", "values"],
            )


def learn_quality(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Machine:
    """A machine from at most ``per_label`` labelled texts of each label outside the held-out third."""
    # Bounded: twice per_label ids.
    chosen = F.broadcast(bounded_labels(labels, "quality", 3, 1, per_label))
    rows = (
        docs.select("doc_id", "text", "n_chars")
        .join(chosen, "doc_id")
        .select("text", "n_chars", "label", "weight")
        .mapInArrow(_featurize, "label int, weight double, slots array<int>, values array<float>")
        .toArrow()
        .combine_chunks()
    )
    starts, slots, values = [0], [], []
    for batch in rows.to_batches():
        lists = batch.column("slots")
        starts += (np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) + starts[-1]).tolist()
        slots.append(lists.flatten().to_numpy())
        values.append(batch.column("values").flatten().to_numpy())
    return fit_machine(
        np.array(starts, np.int64),
        np.concatenate([np.zeros(0, np.int32), *slots]),
        np.concatenate([np.zeros(0, np.float32), *values]),
        rows.column("label").to_numpy().astype(np.float64),
        rows.column("weight").to_numpy().astype(np.float64),
    )


def score_quality(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` (with text and n_chars) plus score and predicted, in place of such columns.

    A null text scores as an empty one, by its statistics alone; a null n_chars is a
    bucket of its own. Equal rows get equal scores. Without labels every score is 0.5.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, declared = strings(batch.column("text")), _declared(batch)
            scores = [np.zeros(0)]
            for low, high in chunks(column):
                odds = score_features(*features(column[low:high], declared[low:high]), shared.value)
                scores.append(1 / (1 + np.exp(-np.clip(odds.astype(np.float64), -30, 30))))
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    return docs.select(*kept).mapInArrow(run, schema)


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    machine = learn_quality(docs, labels)
    rows = docs.select("doc_id", "text", "n_chars", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    return score_quality(rows, machine).select("doc_id", "held_out", "score", "predicted")
