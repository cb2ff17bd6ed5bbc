"""Toxic texts and the sentences that make them so, by multiple-instance learning.

Labels are known for texts only. Each sentence gets a probability from its words and their
beginnings, hashed (an insult's stem takes many endings);
a text is toxic if any of its sentences is, so the text's probability is the noisy-or of
its sentences. The loss of the text's label trains the sentence weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, bounded_labels, chunks, held_out, raw, span_hashes, strings, word_spans

SLOTS = 1 << 20
# A word is hashed whole and by its first so many bytes where it is longer. Slot 0 weighs nothing.
BEGINNINGS = (4, 5, 6, 7, 8)
PARTS = 1 + len(BEGINNINGS)
# Fitting: labelled texts per label, fewest texts a slot is seen in, passes, step, decay.
SAMPLE_PER_LABEL = 6000
LEAST_TEXTS = 5
PASSES = 8
BATCH = 128
STEP = 0.3
DECAY = 1e-4
START_BIAS = -5.0
SEED = 11
THRESHOLD = 0.5

# What ends a sentence; every ASCII byte but letters and digits ends a word.
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?\n"]] = True
_WORD_BREAK = np.zeros(256, bool)
_WORD_BREAK[:128] = True
_WORD_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


@dataclass(frozen=True)
class Sentences:
    """Sentences with at least one word, of a run of texts."""

    owner: np.ndarray  # text of each sentence
    first: np.ndarray  # first of each sentence's slots
    slots: np.ndarray  # PARTS slots of each word
    begin: np.ndarray  # code points before it in its text
    end: np.ndarray


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SLOTS - 1)).astype(np.int32) + 1


def sentences(column: pa.Array) -> Sentences:
    body, bounds = raw(column)
    begins, ends = word_spans(body, bounds, _WORD_BREAK)
    low = LOWER[body]
    slots = np.zeros((len(begins), PARTS), np.int32)
    slots[:, 0] = _slot(span_hashes(low, begins, ends))
    for part, size in enumerate(BEGINNINGS, 1):
        long = np.flatnonzero(ends - begins > size)
        slots[long, part] = _slot(span_hashes(low, begins[long], begins[long] + size) + np.uint64(part))
    text = np.searchsorted(bounds, begins, "right") - 1
    number = np.searchsorted(np.flatnonzero(_SENTENCE_END[body]), begins) + text
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else number
    last = np.append(first[1:], len(begins)) - 1 if len(first) else first
    points = np.concatenate([[0], np.cumsum(body & 0xC0 != 0x80)])
    owner = text[first]
    return Sentences(
        owner,
        first * PARTS,
        slots.ravel(),
        points[begins[first]] - points[bounds[owner]],
        points[ends[last]] - points[bounds[owner]],
    )


def sentence_scores(found: Sentences, model: Model) -> np.ndarray:
    if not len(found.first):
        return np.zeros(0)
    odds = model.bias + np.add.reduceat(model.weights[found.slots].astype(np.float64), found.first)
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def noisy_or(owner: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(owner, weights=np.log1p(-np.minimum(scores, 1 - 1e-12)), minlength=n))


def fit_model(texts: list[tuple[np.ndarray, np.ndarray]], labels, weights, passes: int = PASSES) -> Model:
    """``texts``: (slots, slots per sentence) per text; Adagrad on the text's log loss."""
    table = np.zeros(SLOTS, np.float32)
    if not len(texts) or len(set(labels.tolist())) < 2:
        return Model(START_BIAS, table)
    seen = np.zeros(SLOTS, np.int32)
    for slots, _ in texts:
        seen[np.unique(slots)] += 1
    known = seen >= LEAST_TEXTS
    known[0] = False
    texts = [
        (slots[known[slots]], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[known[slots]], len(sizes))
        for slots, sizes in texts
    ]
    power = np.full(SLOTS, 1e-4, np.float32)
    bias, power_bias = START_BIAS, 1e-4
    weights = weights / weights.mean()
    rng = np.random.default_rng(SEED)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            rows = order[low : low + BATCH]
            sizes = np.array([texts[r][2] for r in rows])
            base = np.concatenate([[0], np.cumsum(sizes)])
            slots = np.concatenate([texts[r][0] for r in rows])
            place = np.concatenate([texts[r][1] + b for r, b in zip(rows, base, strict=False)])
            odds = bias + np.bincount(place, weights=table[slots], minlength=base[-1])
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            owner = np.repeat(np.arange(len(rows)), sizes)
            none = np.exp(np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(rows)))
            y = labels[rows]
            factor = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0) * weights[rows]
            slope = p * factor[owner]
            by_word = np.bincount(slots, weights=slope[place], minlength=SLOTS)
            touched = np.unique(slots)
            g = (by_word[touched] / len(rows) + DECAY * table[touched]).astype(np.float32)
            power[touched] += g * g
            table[touched] -= STEP * g / np.sqrt(power[touched])
            g_bias = float(slope.sum()) / len(rows)
            power_bias += g_bias**2
            bias -= 0.3 * STEP * g_bias / power_bias**0.5
    return Model(bias, table)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = strings(batch.column("text"))
        for low, high in chunks(column):
            found = sentences(column[low:high])
            n = high - low
            used = found.slots != 0
            ends = np.append(found.first, len(found.slots))
            before = np.concatenate([[0], np.cumsum(used)])[ends]
            by_text = np.searchsorted(found.owner, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label")[low:high],
                    batch.column("weight")[low:high],
                    pa.ListArray.from_arrays(pa.array(before[by_text], pa.int32()), pa.array(found.slots[used])),
                    pa.ListArray.from_arrays(
                        pa.array(by_text, pa.int32()), pa.array(np.diff(before).astype(np.int32))
                    ),
                ],
                ["label", "weight", "slots", "sizes"],
            )


def learn_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """A model from at most ``per_label`` labelled texts of each label outside the held-out fifth."""
    # Bounded: twice per_label ids.
    chosen = F.broadcast(bounded_labels(labels, "toxic", 5, 0, per_label))
    rows = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .select("text", "label", "weight")
        .mapInArrow(_bags, "label int, weight double, slots array<int>, sizes array<int>")
        .toArrow()
    )
    texts: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in rows.to_batches():
        columns = []
        for name in ("slots", "sizes"):
            lists = batch.column(name)
            cuts = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1]
            columns.append(np.split(lists.flatten().to_numpy(), cuts))
        texts += zip(*columns, strict=True)
    return fit_model(
        texts, rows.column("label").to_numpy().astype(np.float64), rows.column("weight").to_numpy().astype(np.float64)
    )


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus score, predicted and the sentence that scores highest, in place of such columns.

    ``sentence_begin``, ``sentence_end`` count code points, ``sentence_score`` is its own
    probability; of equal sentences the first. A text that is null or has no word has
    score 0 and null for its sentence. Without labels of both kinds scores rest on the
    starting bias. Equal texts get equal answers.
    """
    new = ("score", "predicted", "sentence_begin", "sentence_end", "sentence_score")
    kept = [c for c in docs.columns if c not in new]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        docs.select(*kept)
        .schema.add("score", "double")
        .add("predicted", "integer")
        .add("sentence_begin", "long")
        .add("sentence_end", "long")
        .add("sentence_score", "double")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                found = sentences(column[low:high])
                n = high - low
                p = sentence_scores(found, shared.value)
                score = noisy_or(found.owner, p, n)
                order = np.lexsort((np.arange(len(p)), -p, found.owner))
                head = order[np.unique(found.owner[order], return_index=True)[1]] if len(p) else order
                worst = np.full(n, -1)
                worst[found.owner[head]] = head
                none = worst < 0
                at = np.maximum(worst, 0)
                pick = (lambda x: pa.array(x[at], mask=none)) if len(p) else (lambda x: pa.nulls(n, pa.from_numpy_dtype(x.dtype)))
                rows = batch.slice(low, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.array(score),
                        pa.array((score >= THRESHOLD).astype(np.int32)),
                        pick(found.begin.astype(np.int64)),
                        pick(found.end.astype(np.int64)),
                        pick(p),
                    ],
                    [*rows.schema.names, *new],
                )

    return docs.select(*kept).mapInArrow(run, schema)


def offending_sentences(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Every sentence of (doc_id, text) scoring ``threshold`` or more: doc_id, begin, end, score, sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = strings(batch.column("text"))
            for low, high in chunks(column):
                found = sentences(column[low:high])
                p = sentence_scores(found, shared.value)
                hit = np.flatnonzero(p >= threshold)
                rows = low + found.owner[hit]
                texts = [
                    column[r].as_py()[b:e]
                    for r, b, e in zip(rows.tolist(), found.begin[hit].tolist(), found.end[hit].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows)),
                        pa.array(found.begin[hit].astype(np.int64)),
                        pa.array(found.end[hit].astype(np.int64)),
                        pa.array(p[hit]),
                        pa.array(texts, pa.string()),
                    ],
                    ["doc_id", "begin", "end", "score", "sentence"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, begin long, end long, score double, sentence string"
    )


def toxicity_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst sentence of every document."""
    model = learn_toxicity(docs, labels)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    return score_toxicity(rows, model).drop("text")
