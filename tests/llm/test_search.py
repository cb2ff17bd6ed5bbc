"""Hard negatives, repeated phrases and tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tapewell.llm import alignment, negatives, phrases

DOCS = "doc_id long, text string, row string, spans int, text_2 string, seeds string, vector int"
VECTORS = "vec_id long, embedding array<float>, label int, q int, cell string, cap long, rank string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None, None, 0) for i, t in rows], DOCS)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, y, 0, "c", 5, None) for i, v, y in rows], VECTORS)


# --- repeated phrases ---------------------------------------------------------------------


def plain_repeats(rows, size=20):
    seen, out = set(), []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for start in range(len(words) - size + 1):
            window = tuple(words[start : start + size])
            if window in seen:
                gone.update(range(start, start + size))
            seen.add(window)
        kept = " ".join(x for k, x in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def made_texts(seed, n, vocabulary=40):
    rng = np.random.default_rng(seed)
    name = [f"w{k}" for k in range(vocabulary)]
    passages = [" ".join(rng.choice(name, int(rng.integers(15, 60)))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            parts.append(passages[rng.integers(6)] if rng.random() < 0.6 else " ".join(rng.choice(name, 12)))
        words = " ".join(parts).split(" ")
        if rng.random() < 0.5:
            words[rng.integers(len(words))] = "changed"
        out.append("  ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_of_made_texts(spark, seed):
    rows = [(7 * k + 3, t) for k, t in enumerate(made_texts(seed, 60))]
    got = phrases.repeats_of_documents(docs_of(spark, rows)).collect()
    assert by_text(got) == by_text(plain_repeats(rows))
    assert sum(r["n_removed"] for r in got) > 0


def test_repeats_of_odd_rows(spark):
    long_text = " ".join(f"n{k % 997}" for k in range(200_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\r\n"),
        (4, "a " * 70),
        (5, "a\n" * 25 + "b"),
        (6, "ab ba " * 30),
        (7, "é ba " + "ba ab " * 14),
        (8, long_text),
        (9, "x " + long_text[:4000]),
        (9, "x " + long_text[:4000]),
        (None, "A " + "a " * 21),
        (None, "A " + "a " * 21),
        (10, " ".join(map(str, range(19)))),
        (11, " ".join(map(str, range(19)))),
        (12, " ".join(map(str, range(20)))),
        (13, " ".join(map(str, range(20)))),
    ]
    got = phrases.repeats_of_documents(docs_of(spark, rows)).collect()
    assert by_text(got) == by_text(plain_repeats(in_order(rows)))
    assert phrases.repeats_of_documents(docs_of(spark, [])).collect() == []


def test_repeats_in_many_shards_and_groups(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WINDOWS", 50)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 2000)
    monkeypatch.setattr(phrases, "SENT_ROWS", 3)
    monkeypatch.setattr(phrases, "SENT_SEEDS", 3)
    rows = [(k, t) for k, t in enumerate(made_texts(5, 80))]
    got = phrases.repeats_of_documents(docs_of(spark, rows)).collect()
    assert by_text(got) == by_text(plain_repeats(rows))


def test_a_passage_shared_by_all_is_kept_once(spark):
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(k, " ".join(f"d{k}x{j}" for j in range(40)) + " " + shared) for k in range(300)]
    got = {r["doc_id"]: r["n_removed"] for r in phrases.repeats_of_documents(docs_of(spark, rows)).collect()}
    assert got == {k: 30 if k else 0 for k in range(300)}


# --- alignment ----------------------------------------------------------------------------


def plain_alignment(rows):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}

    def a_bytes(number):
        return bytes(byte_of[c] for c in a_side.id_to_token(number))

    def b_bytes(number):
        piece = b_side.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    out, all_links = [], []
    for doc_id, text in rows:
        links, groups, n_a, n_b = [], [], 0, 0
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        sides = [[a_bytes(x) for x in a], [b_bytes(x) for x in b]]
        if text and all(b"".join(x) == (" " + text).encode() for x in sides):
            n_a, n_b = len(a), len(b)
            spans = []
            for side in sides:
                ends = np.cumsum([len(x) for x in side]).tolist()
                spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
            shared = sorted({y for _, y in spans[0]} & {y for _, y in spans[1]})
            for low, high in zip([0, *shared[:-1]], shared, strict=True):
                own = [[k for k, (x, y) in enumerate(s) if low <= x and y <= high] for s in spans]
                groups.append("|".join(",".join(str(ids[k]) for k in ks) for ids, ks in zip((a, b), own, strict=True)))
                links += [
                    (a[i], b[j])
                    for i in own[0]
                    for j in own[1]
                    if spans[0][i][0] < spans[1][j][1] and spans[1][j][0] < spans[0][i][1]
                ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append([doc_id, n_a, n_b, len(groups), len(links), digest])
        all_links.append(links)
    count = Counter(x for links in all_links for x in links)
    best: dict[int, int] = {}
    for (_, b_id), n in count.items():
        best[b_id] = max(best.get(b_id, 0), n)
    return [
        (*own[:5], sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), own[5])
        for own, links in zip(out, all_links, strict=True)
    ]


ODD_TEXTS = [
    (0, "plain words, and it's fine; I'll see  two blanks"),
    (1, None),
    (2, ""),
    (3, " lead\n\ttabs\r\n é 中文 🎉 \u0000 z​"),
    (4, "▁marked ▁text"),
    (5, "a <|endoftext|> b <s>hi</s> <unk>"),
    (6, "ab" * 4000),
    (7, "naïve façade Ångström " * 3),
    (8, "plain words, and it's fine; I'll see  two blanks"),
    (8, "other row, same id"),
    (None, "no id"),
    (None, None),
    (9, " "),
    (10, "0x41 <0x41> 12345 3.14"),
]


def test_alignment_of_odd_rows(spark):
    got = alignment.align_documents(docs_of(spark, ODD_TEXTS)).collect()
    want = plain_alignment(ODD_TEXTS)
    assert by_text(got) == by_text(want)
    zeros = {r["doc_id"] for r in got if not r["n_a"]}
    assert {1, 2, 4} <= zeros and 5 not in zeros
    assert alignment.align_documents(docs_of(spark, [])).collect() == []


def test_alignment_joins_counts_beyond_the_bound(spark, monkeypatch):
    rows = [(k, f"item {k % 7} of the list, naïve {k % 3} word{k}") for k in range(120)]
    want = by_text(plain_alignment(rows))
    assert by_text(alignment.align_documents(docs_of(spark, rows)).collect()) == want
    assert by_text(alignment.align_documents(docs_of(spark, rows), table_pairs=5).collect()) == want


def test_alignment_forgets_windows_and_passes_counts_on(monkeypatch):
    import public_tokenizers

    a = alignment.ByteLevel(public_tokenizers.path("byte_bpe_50k.json"))
    b = alignment.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t for _, t in ODD_TEXTS if t]
    whole = alignment.Aligner(a, b).align(texts)
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 2)
    small = alignment.Aligner(a, b)
    assert [small.align([t])["groups_sha256"][0] for t in texts] == whole["groups_sha256"]


# --- hard negatives -----------------------------------------------------------------------


def plain_negatives(rows, percent=80):
    known = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        known.append((vec_id, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)))
    known = list(dict.fromkeys(known))
    order = [(1 << 63) - 1 if x[0] is None else x[0] for x in known]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))  # noqa: B905  the shorter one ends in zeros

    out = []
    for k, (anchor, label, vector) in enumerate(known):
        if anchor is None or anchor % 100:
            continue
        scored = sorted((-score(vector, v), order[j], j) for j, (_, _, v) in enumerate(known) if j != k)
        for s, _, j in [x for x in scored if known[x[2]][1] == label][:5]:
            fits = [x for x in scored if known[x[2]][1] != label and -percent * s <= -100 * x[0] <= -100 * s]
            out += [
                (anchor, known[j][0], rank, known[x[2]][0], -s, -x[0]) for rank, x in enumerate(fits[:5], 1)
            ]
    return out


def made_vectors(seed, n, width=6, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    points = centres[rng.integers(8, size=n)] + spread * rng.normal(size=(n, width))
    return [(int(k), [float(np.float32(x)) for x in p], int(rng.integers(4))) for k, p in enumerate(points)]


@pytest.mark.parametrize(("spread", "visit"), [(1.0, 8192), (0.05, 40)])
def test_negatives_of_made_vectors(spark, monkeypatch, spread, visit):
    monkeypatch.setattr(negatives, "FIRST_VISIT", visit)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(negatives, "BLOCK_QUERIES", 3)
    rows = made_vectors(3, 900, spread=spread)
    got = negatives.negatives_of_embeddings(vectors_of(spark, rows)).collect()
    want = plain_negatives(rows)
    assert want and by_text(got) == by_text(want)


def test_negatives_of_odd_rows(spark):
    rows = [(100 * k, [0.5, 0.25 * k, 0.0], k % 2) for k in range(6)]
    rows += [(k, [0.5, 0.25, 0.0], k % 3) for k in range(1, 60)]  # ties and copies
    rows += [
        (200, [0.5, 0.25, 0.0], 1),  # an id twice
        (200, [0.5, 0.5, 0.0], 0),
        (300, [0.5, 0.75, 0.0], 1),  # a row twice
        (700, None, 1),
        (800, [0.5, None, 0.1], 1),
        (900, [0.5, float("nan"), 0.1], 1),
        (1000, [float("inf"), 0.2, 0.1], 1),
        (1100, [0.5, 0.2, 0.1], None),
        (None, [0.5, 0.3, 0.0], 2),
        (1200, [], 1),
        (1300, [-0.5, -0.1], 1),
        (1400, [0.5], 2),
    ]
    got = negatives.negatives_of_embeddings(vectors_of(spark, rows)).collect()
    assert by_text(got) == by_text(plain_negatives(rows))
    assert negatives.negatives_of_embeddings(vectors_of(spark, [])).collect() == []
    assert negatives.negatives_of_embeddings(vectors_of(spark, [(1, [1.0], 0), (2, [2.0], 1)])).collect() == []


def test_walk_yields_falling_bounds_that_hold(spark):
    rng = np.random.default_rng(1)
    points = rng.integers(-300, 300, size=(400, 6)).astype(np.float64)
    first, second = points[:5, :3].copy(), points[5:12, 3:].copy()
    books = negatives.Codebooks(first, second, 3, 6)
    code_1, code_2 = negatives._nearest(points[:, :3], first), negatives._nearest(points[:, 3:], second)
    radius = [
        np.array([np.linalg.norm(half[code == k] - centre[k], axis=1).max(initial=0) for k in range(len(centre))])
        for half, code, centre in ((points[:, :3], code_1, first), (points[:, 3:], code_2, second))
    ]
    rows = np.zeros((5, 7), np.int64)
    np.add.at(rows, (code_1, code_2), 1)
    cells = negatives.Cells(*radius, rows)
    for query in points[:20]:
        walked = list(negatives.walk_cells(query, books, cells))
        assert len({x[2:] for x in walked}) == 35
        assert all(x[0] >= y[0] for x, y in zip(walked[:-1], walked[1:], strict=True))
        for upper, lower, i, j in walked:
            inside = points[(code_1 == i) & (code_2 == j)] @ query
            assert (inside <= upper).all() and (inside >= lower).all()


def test_products_are_exact_beyond_floating_point():
    queries = np.array([[1 << 30, 1, -(1 << 29)]], np.int64)
    rows = np.array([[1 << 31, 3, 5], [7, 1, 2]], np.int64)
    want = [[sum(int(x) * int(y) for x, y in zip(queries[0], row, strict=True)) for row in rows]]
    assert negatives.products(queries, rows).tolist() == want
