"""Every row counts: those without an id, those that repeat one, short passages, packed blocks."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
from tapewell.llm import decontamination, mixing, neardup, toxicity

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi"


def _rows():
    rng = random.Random(5)
    rows = []
    for k in range(90):
        text = " ".join(f"k{k}w{rng.randrange(50)}" for _ in range(rng.randint(0, 200)))
        rows.append((None if k % 3 == 0 else k % 20, text, "en", ["a", "b", None][k % 4 % 3], len(text)))
    return rows


def test_mixed_rows_hold_the_taken_words_of_all_rows(docs_of, spark):
    docs = docs_of(_rows())
    counts = mixing.mixture_counts(docs).collect()
    assert len(counts) == 90
    taken = Counter()
    for row in counts:
        taken[row["doc_id"]] += row["taken"]
    words = Counter()
    texts = [r[1] for r in _rows()]
    for row in corpus_pipeline.mix_sources(spark, docs, "").collect():
        assert any(row["text"] in t for t in texts) and row["n_chars"] == len(row["text"])
        words[row["doc_id"]] += len(row["text"].split())
    assert words[None] > 0 and words == +taken


def test_rows_without_id_and_repeats_are_compared(docs_of, spark):
    one, two = "one two three four five six seven eight", "red green blue black white grey pink brown"
    rows = [(5, one), (None, one), (None, two), (None, two), (7, one), (7, two), (7, two), (9, "other words here")]
    left = sorted(corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), "").select("doc_id", "text").collect())
    assert [tuple(r) for r in left] == [(5, one), (7, two), (9, "other words here")]
    lone = corpus_pipeline.drop_near_duplicates(spark, docs_of([(None, one), (None, one), (None, two)]), "").collect()
    assert sorted(r["text"] for r in lone) == sorted([one, two])
    assert corpus_pipeline.drop_near_duplicates(spark, docs_of([]), "").count() == 0


def test_leaks_go_by_row(docs_of, spark):
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    rows = [(None, f"x {PASSAGE} y"), (None, "clean"), (8, PASSAGE), (8, "clean too"), (9, None)]
    left = decontamination.decontaminate_rows(docs_of(rows), benchmark).collect()
    assert sorted(str(r["text"]) for r in left) == ["None", "clean", "clean too"]


def test_every_allowed_change_of_a_short_passage_is_found(docs_of, spark):
    """All patterns of changed words that leave 80 %, by the rule alone, without regard to seeds."""
    words = PASSAGE.split()
    items, rows, within = [], [], set()
    for n in range(decontamination.LEAST_WORDS, 13):
        own = [f"{w}{n}" for w in words[:n]]
        items.append((n, " ".join(own)))
        for changed in range(n // 5 + 2):
            for places in combinations(range(n), changed):
                text = ["other" if k in places else w for k, w in enumerate(own)]
                rows.append((len(rows), f"before {' '.join(text)} after"))
                if 100 * (n - changed) >= decontamination.SIMILAR_PERCENT * n:
                    within.add((len(rows) - 1, n))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated_pairs(docs_of(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == within


def test_toxicity_learns_from_the_whole_sample():
    assert toxicity.SAMPLE_PER_LABEL == 6000
    assert toxicity.learn_toxicity.__defaults__ == (6000,)


def test_packed_blocks_fill_the_drawn_shards(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "draw_shards", lambda quotas, draw=mixing.draw_shards: draw(quotas, 20))
    docs = docs_of(_rows())
    sources = [x for _, x in mixing.lay_out(docs)[1]]
    drawn = mixing.draw_shards(np.array([x.quota for x in sources]))
    out = mixing.mixed_blocks(docs).collect()
    found = np.zeros_like(drawn)
    for row in out:
        found[row["shard"], row["number"]] += 1
        assert len(row["text"].split()) == row["n_words"] <= mixing.BLOCK_WORDS
    assert len(drawn) > 2 and (found == drawn).all()
    for shard, slots in enumerate(drawn.sum(axis=1)):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(slots))
    own = {w for _, text, *_ in _rows() for w in text.split()}
    words = Counter(w for r in out for w in r["text"].split())
    assert set(words) <= own
    assert sum(words.values()) == sum(r["taken"] for r in mixing.mixture_counts(docs).collect())


def test_links_are_named_as_a_spanning_subset(docs_of):
    columns = neardup.near_duplicates(docs_of([(1, "one two three four five")])).columns
    assert columns[-1] == "spanning_links" and "links" not in columns
