from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapewell.llm import language, quality, toxicity
from tapewell.llm.text import bounded_labels, chunks, span_hashes, word_spans, words

LABELS = "doc_id long, quality int, toxic int"


def test_words_match_a_plain_split():
    texts = ["", " a  b\tc\x0bd ", "é x", "one", "A b\n", "\n"]
    body, bounds, begins, ends, before = words(pa.array(texts, pa.large_string()))
    raw = body.tobytes()
    own = [raw[b:e] for b, e in zip(begins, ends)]
    assert own == [w.lower() for t in texts for w in t.encode().split()]
    assert np.diff(before).tolist() == [len(t.encode().split()) for t in texts]
    hashes = span_hashes(body, begins, ends)
    assert len(set(hashes.tolist())) == len(set(own))


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr("tapewell.llm.text.CHUNK_BYTES", 16)
    body = np.frombuffer(b"abc abcdefghijklmnopqrstuvwxyz abc x abc", np.uint8)
    begins, ends = word_spans(body, np.array([0, len(body)]))
    hashes = span_hashes(body, begins, ends)
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3


def test_chunks_cover_all_rows_whatever_their_length():
    column = pa.array(["a" * 50, "", "b", "c" * 9], pa.large_string())
    assert [k for low, high in chunks(column, 10) for k in range(low, high)] == [0, 1, 2, 3]
    assert list(chunks(pa.array([], pa.large_string()))) == []


def test_language_edges(docs_of, spark):
    rows = [(k, "der die das und nicht", "de") for k in range(40)] + [
        (100 + k, "the and of that with", "en") for k in range(40)
    ]
    extra = [(900, None), (901, ""), (902, "123 ... 4"), (903, "und nicht die"), (904, "THE OF AND"), (904, "the"), (None, "das")]
    out = language.language_of_documents(docs_of(rows + extra)).collect()
    by = {}
    for row in out:
        by.setdefault(row["doc_id"], []).append(row)
    assert len(out) == len(rows) + len(extra)
    assert [by[k][0]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3
    assert by[903][0]["lang_pred"] == "de" and {r["lang_pred"] for r in by[904]} == {"en"}
    assert all(0 <= r["score"] <= 1 for r in out)
    assert language.language_of_documents(docs_of([])).count() == 0
    unlearned = language.language_of_documents(docs_of([(1, "text")])).first()
    assert (unlearned["lang_pred"], unlearned["score"]) == ("und", 0.0)


def test_language_keeps_columns_and_replaces_clashing_ones(docs_of):
    docs = docs_of([(k, "a b c d", "xx") for k in range(9)]).withColumn("score", F.lit("old"))
    filters = language.fit_filters(docs)
    out = language.identify_language(docs, filters)
    assert out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double"
    assert out.filter("lang_pred = 'xx'").count() == 9


def test_language_filter_counts_match_sets():
    rng = np.random.default_rng(3)
    own = rng.integers(0, 2**32, 3000, dtype=np.uint32)
    planes = np.zeros((1, 1 << language.SLOT_BITS), np.uint8)
    for seed in language.SEEDS:
        planes[0][language.slots(own, seed)] |= np.uint8(1)
    filters = language.Filters(("aa",), planes, np.array([0.0]))
    found, _ = language.grams(["some text"])
    total, hits = language.count_hits(["some text"], filters)
    assert total[0] == len(found) and hits[0, 0] <= total[0]


def test_pair_sums_match_all_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(
        0.3, rng.normal(size=quality.SLOTS).astype(np.float32), rng.normal(size=(quality.SLOTS, 4)).astype(np.float32)
    )
    slots, values = rng.choice(quality.SLOTS, 9, False).astype(np.int32), rng.normal(size=9).astype(np.float32)
    fast = quality.score_features(np.array([0, 9]), slots, values, machine)[0]
    slow = machine.bias + machine.linear[slots] @ values
    for i in range(9):
        for j in range(i):
            slow += machine.factors[slots[i]] @ machine.factors[slots[j]] * values[i] * values[j]
    assert abs(fast - slow) < 1e-3


def test_quality_held_out_and_edges(docs_of, spark):
    good = [(k, "plain words make a calm line here %d" % k, None, None, 20) for k in range(60)]
    bad = [(100 + k, "BUY NOW!! $$$ !!! CLICK!! %d" % k, None, None, None) for k in range(60)]
    labels = spark.createDataFrame(
        [(k, 1, 0) for k in range(60)] + [(100 + k, 0, 0) for k in range(60)] + [(None, 1, 1), (1, 1, None), (5000, 0, 0)],
        LABELS,
    )
    docs = docs_of(good + bad + [(500, None), (501, ""), (500, None), (None, "x")])
    out = quality.quality_of_documents(docs, labels).collect()
    assert len(out) == 124 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] < 200]
    assert held and sum(r["predicted"] == (r["doc_id"] < 100) for r in held) / len(held) > 0.9
    none = quality.quality_of_documents(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_of_documents(docs_of([]), labels).count() == 0


def test_noisy_or_and_offending_sentence(docs_of, spark):
    calm = ["the sea is calm today. birds sing", "a walk in the park. it rains", "we read books. they sleep"]
    docs = [(k, calm[k % 3] + f". number {k % 7}") for k in range(150)]
    docs += [(200 + k, calm[k % 3] + ". you stupid thing! good night") for k in range(60)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(150)] + [(200 + k, 1, 1) for k in range(60)], LABELS)
    frame = docs_of(docs + [(900, None), (901, "..."), (None, "stupid")])
    out = {r["doc_id"]: r for r in toxicity.toxicity_of_documents(frame, labels).collect()}
    assert all(out[k]["predicted"] == 0 for k in range(150)) and all(out[200 + k]["predicted"] == 1 for k in range(60))
    text, row = docs[-1][1], out[259]
    assert text[row["sentence_begin"] : row["sentence_end"]] == "you stupid thing"
    assert out[900]["score"] == 0.0 and out[901]["sentence_begin"] is None
    model = toxicity.learn_toxicity(frame, labels)
    found = toxicity.offending_sentences(frame, model).filter("doc_id >= 200 and doc_id < 260").collect()
    assert len(found) == 60 and {r["sentence"] for r in found} == {"you stupid thing"}
    assert np.isclose(toxicity.noisy_or(np.array([0, 0, 2]), np.array([0.5, 0.5, 1.0]), 3), [0.75, 0, 1]).all()
    assert toxicity.toxicity_of_documents(docs_of([]), labels).count() == 0


def test_sentence_places_count_code_points():
    column = pa.array(["é ü. ab cd", "", "…x"], pa.large_string())
    found = toxicity.sentences(column)
    texts = column.to_pylist()
    assert [texts[o][b:e] for o, b, e in zip(found.owner, found.begin, found.end)] == ["é ü", "ab cd", "…x"]


def test_bounded_labels_take_at_most_so_many(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(100)] + [(1, 0, 0)], LABELS)
    rows = bounded_labels(labels, "quality", 3, 1, 10).collect()
    assert len(rows) == 20 and len({r["doc_id"] for r in rows}) == 20
    assert rows == bounded_labels(labels, "quality", 3, 1, 10).collect()
