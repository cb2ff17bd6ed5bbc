from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tapewell.llm import chat, decontamination, fingerprint

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau ypsilon".split()


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_fingerprints_of_equal_texts_and_reordered_ones(docs_of):
    text = " ".join(WORDS)
    back = " ".join(WORDS[::-1])
    rows = [(1, text), (2, text), (3, back), (4, None), (5, ""), (6, "one"), (7, "one two"), (9, text + " " + text)]
    out = {r["doc_id"]: r for r in fingerprint.fingerprints_of_documents(docs_of(rows)).collect()}
    assert out[1]["fingerprint"] == out[2]["fingerprint"] and out[1]["near_next"] == 1.0
    assert out[2]["near_next"] < 0.2 and out[4]["fingerprint"] == "" and out[4]["near_next"] == 1.0
    assert out[5]["near_next"] == 0.0 and out[9]["fingerprint"] != out[1]["fingerprint"]
    assert {len(r["fingerprint"]) for r in out.values()} == {0, fingerprint.COORDINATES * fingerprint.DIGITS}
    assert all(0 <= r["near_edited"] <= 1 for r in out.values())


def test_edited_text_takes_from_the_next_document(docs_of):
    texts = {k * 700: f"text {k} ünicode {'x' * (k % 5)}" for k in range(40)} | {-5: "before", 12: "néxt"}
    rows = [(k, v) for k, v in texts.items()] + [(None, "lone words here")]
    out = {r["doc_id"]: r for r in fingerprint.fingerprints_of_documents(docs_of(rows)).collect()}
    order = sorted(texts)
    for here, then in zip(order, order[1:] + order[:1]):
        own, other = texts[here], texts[then]
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        assert out[here]["n_chars"] == len(own)
        assert out[here]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert out[None]["near_next"] is None and len(out) == len(rows)


def test_repeated_ids_and_empty_table(docs_of):
    out = fingerprint.fingerprints_of_documents(docs_of([(1, "b c"), (1, "b c"), (1, "a")])).collect()
    assert len(out) == 3
    assert fingerprint.fingerprints_of_documents(docs_of([])).count() == 0


def test_occurrences_make_repeats_count(spark):
    frame = spark.createDataFrame([("a b c a b c a b c",), ("a b c a b c",), ("a b c d",)], "t string")
    prints = [r[0] for r in frame.select(fingerprint.order_minhash(F.col("t"))).collect()]
    assert len(set(prints)) == 3


def test_picked_tuples_match_a_slow_reading(spark):
    """Numbered k-mers, the two after each point of the circle, in text order."""
    text = " ".join(WORDS + WORDS[3:9] + WORDS[:5] * 2)
    one = spark.createDataFrame([(text,)], "t string")
    kmers = one.select(fingerprint._kmers(fingerprint._text_words(F.col("t"))).alias("k")).first()["k"]
    mask = fingerprint._HASH
    seen: dict = {}
    keys = []
    for place, kmer in enumerate(kmers):
        number = seen[kmer & mask] = seen.get(kmer & mask, -1) + 1
        keys.append((kmer & mask, number, place))
    hashed = spark.createDataFrame(keys, "k long, n int, place int")
    circle = sorted(
        (r["h"] & mask | r["place"], r["place"]) for r in hashed.select("place", F.xxhash64("k", "n").alias("h")).collect()
    )
    picks = []
    for j in range(fingerprint.COORDINATES):
        point = -(1 << 63) + j * ((1 << 64) // fingerprint.COORDINATES)
        first = next((i for i, (h, _) in enumerate(circle) if h >= point), 0)
        lo, hi = sorted(circle[(first + k) % len(circle)][1] for k in range(2))
        picks.append((j, kmers[lo], kmers[hi]))
    slow = spark.createDataFrame(picks, "j int, a long, b long").select("j", F.xxhash64("a", "b").alias("h"))
    expected = "".join(f"{r['h'] & 0xFFFF:04X}" for r in sorted(slow.collect()))
    assert one.select(fingerprint.order_minhash(F.col("t"))).first()[0] == expected


def _brute_pairs(docs, items):
    import re

    cut = lambda s: re.findall(r"[^\W_]+", (s or "").lower())
    found = set()
    for d, text in docs:
        doc = cut(text)
        for i, passage in items:
            item = cut(passage)
            if i is None or len(item) < decontamination.LEAST_WORDS:
                continue
            window = min(len(item), decontamination.WINDOW)
            for shift in range(-len(item), len(doc)):
                same = [doc[k + shift] == item[k] for k in range(len(item)) if 0 <= k + shift < len(doc)]
                if not same:
                    continue
                runs = [sum(same[s : s + window]) for s in range(max(1, len(same) - window + 1))]
                if 100 * max(runs) >= decontamination.SIMILAR_PERCENT * window:
                    found.add((d, i))
    return found


def test_leaks_with_changed_words_against_brute_force(docs_of, spark):
    item = " ".join(WORDS[:16])
    changed = WORDS[:16]
    changed[4], changed[9], changed[14] = "one", "two", "three"
    half = WORDS[:16]
    half[1::2] = ["other"] * 8
    docs = [
        (1, f"start {item} end"),
        (2, f"start {' '.join(changed)} end"),
        (3, f"start {' '.join(half)} end"),
        (4, "nothing to see"),
        (5, None),
        (6, ""),
        (None, item),
        (7, " ".join(WORDS[6:16])),
        (8, item.upper().replace(" ", ", ")),
        (8, "again clean"),
        (9, " ".join(WORDS[:11])),
        (10, "short passage of six words here"),
    ]
    items = [(1, item), (2, "short passage of six words here"), (3, "too short"), (4, None), (None, item), (1, item)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated_pairs(docs_of(docs), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == _brute_pairs(docs, items)
    clean = decontamination.decontaminate_rows(docs_of(docs).withColumn("shift", F.lit(1)), benchmark)
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 6, 7, 8]
    assert clean.columns[-1] == "shift"


def test_leaks_without_broadcast_and_with_empty_tables(docs_of, spark, monkeypatch):
    item = " ".join(WORDS)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(decontamination, "BROADCAST_IDS", 0)
    found = decontamination.contaminated_pairs(docs_of([(k, f"x {item}") for k in range(5)]), benchmark)
    assert found.count() == 5
    assert decontamination.contaminated_pairs(docs_of([]), benchmark).count() == 0
    assert decontamination.contaminated_pairs(docs_of([(1, item)]), benchmark.limit(0)).count() == 0


TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["<|end|>\n<|turn|>user\nhi", "a<|next|>b", "\\", "\\\\<|", "[INST] x [/INST]</s>", "", "ends in <", "<<SYS>>", "|>", "\n"]


def test_chat_reads_back_what_was_written(spark):
    rows = [(1, k, ["user", "assistant", "assistant"][k % 3], t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "user", None), (2, 1, "assistant", "x"), (3, 5, None, "y"), (3, None, "od\nd <|turn|>", "z")]
    rows += [(4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (None, 0, "user", "q"), (5, 0, "user", "u")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, TURNS)).cache()
    out = {r["conv_id"]: r for r in chat.digest_conversations(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        learned = "".join(text for _, role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        row = out[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(learned)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    texts = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    assert all(out[c]["formatted_chars"] == len(t) for c, t in texts.items())
    assert texts[1].count(chat.TURN) == 7 and texts[1].count(chat.NEXT) == 3


def test_chat_empty_table(spark):
    assert chat.digest_conversations(chat.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


@pytest.mark.parametrize("kind", ["fingerprint", "chat", "leaks"])
def test_native_plans_run_no_python(docs_of, spark, kind):
    docs = docs_of([(1, "a b c d e f"), (2, "g")])
    df = {
        "fingerprint": lambda: fingerprint.fingerprints_of_documents(docs),
        "chat": lambda: chat.digest_conversations(chat.format_conversations(chat.control_conversation(spark))),
        "leaks": lambda: decontamination.contaminated_pairs(
            docs, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
        ),
    }[kind]()
    assert not any(x in _plan(df) for x in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def test_one_word_repeated_makes_one_row_a_pair(docs_of, spark):
    benchmark = spark.createDataFrame([(1, "a " * 15), (2, "a " * 12 + "b c d")], "item_id long, text string")
    found = decontamination.contaminated_pairs(docs_of([(1, "a " * 20_000), (2, "b " * 30)]), benchmark)
    assert sorted(map(tuple, found.collect())) == [(1, 1, 15, 15, 13), (1, 2, 15, 12, 12)]
