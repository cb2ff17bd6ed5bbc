from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapewell.llm import mixing, neardup, tokens, warc

PATH = __import__("public_tokenizers").path("byte_bpe_50k.json")


def _sets(rows, size):
    out = {}
    for doc, text in rows:
        found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        found = [w.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for w in found]
        runs = {tuple(found[k : k + size]) for k in range(len(found) - size + 1)}
        out[doc] = runs or ({tuple(found)} if found else set())
    return out


def _components(sets, percent=80):
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}


def _corpus(n=260):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for k in range(n):
        kind = k % 5
        if kind == 0 or not rows:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        elif kind == 1:  # a copy with some words changed
            words = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randint(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 2:  # a passage that many documents share
            words = passage + [rng.choice(vocabulary) for _ in range(rng.randint(8, 30))]
        elif kind == 3:
            words = (rng.choice(rows)[1] or "").upper().split()
        else:
            words = passage[: rng.randint(2, 60)]
        rows.append((1000 - 3 * k, "  ".join(words)))
    return rows + [(5000, None), (5001, ""), (5002, " \t"), (5003, "x"), (5004, "X"), (5005, "a b c"), (5006, "A b\nc")]


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_near_duplicates_against_brute_force(docs_of, monkeypatch, broadcast):
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", broadcast)
    rows = _corpus()
    sets = _sets(rows, neardup.SHINGLE)
    root = _components(sets)
    out = {r["doc_id"]: r for r in neardup.near_duplicates(docs_of(rows)).collect()}
    assert {d: r["component_id"] for d, r in out.items()} == root
    assert {d: r["n_shingles"] for d, r in out.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r["kept"] == (root[d] == d) for d, r in out.items())


def test_near_duplicates_edges(docs_of):
    text = "one two three four five six"
    rows = [(1, text), (2, text), (2, text), (3, "other words stand here now"), (3, text), (None, text), (None, None)]
    rows += [(None, "a b c d e f g"), (None, "A b c d e f g"), (9, ""), (9, "x y")]
    out = sorted(map(str, neardup.near_duplicates(docs_of(rows)).drop("spanning_links").collect()))
    want = [
        (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 2, 3, True), (3, 3, 1, False), (None, 3, 1, False),
        (None, 0, None, True), (9, 0, 9, True), (9, 1, 9, True),
    ]
    lone = [(None, 4, None, True), (None, 4, None, False)]
    names = ("doc_id", "n_shingles", "component_id", "kept")
    assert out == sorted(f"Row({', '.join(f'{n}={v}' for n, v in zip(names, r))})" for r in want + lone)
    assert neardup.near_duplicates(docs_of([])).count() == 0


def test_a_template_that_many_share_joins_few_rows(docs_of, monkeypatch):
    template = " ".join(f"t{k}" for k in range(110))
    rows = [(k, f"{template} " + " ".join(f"own{k}x{j}" for j in range(30 + k % 20))) for k in range(400)]
    met = []
    real = neardup.confirm_pairs
    monkeypatch.setattr(neardup, "confirm_pairs", lambda pairs, *a: met.append(pairs.count()) or real(pairs, *a))
    out = neardup.near_duplicates(docs_of(rows)).collect()
    sets = _sets(rows, neardup.SHINGLE)
    assert {r["doc_id"]: r["component_id"] for r in out} == _components(sets)
    assert sum(met) < 40 * len(rows)


def test_every_sketch_coordinate_fills():
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 7, 200, 5000)]
    sketch = neardup.sketches(sets)
    assert (sketch != np.iinfo(np.uint64).max).all()
    one = neardup.sketches([sets[3]])
    assert (one[0] == sketch[3]).all()


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = neardup.sketches([np.concatenate([common, a]), np.concatenate([common, b])])
    assert abs((x == y).mean() - 0.8) < 0.12


def test_chained_links_reach_the_smallest_id(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (50, 41)], "a long, b long")
    found = {r["doc_id"]: r["component"] for r in neardup.components(links).collect()}
    assert all(found[k] == 1 for k in range(1, 41)) and found[101] == 100 and found[50] == 41


WEIRD = ["", "a  b", "x \n y", " lead", "trail ", "  ", "don't we'll", "Ünïcödé ß ñandú", "日本 語 text", "a  b 　c",
         "<|endoftext|> x <|endoftext|>", "tab\t tab", "\x1c \x1d a", "3.14 1e5 ²³", "emoji 😀 ok", "a\n\n  b\r\n c", "¿qué? «oui»"]


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_pieces_encode_like_whole_texts():
    encoder, library = tokens.PieceEncoder(PATH), _library()
    for texts in (WEIRD, WEIRD[::-1], [" ".join(WEIRD)]):
        ids, sizes = encoder.encode(pa.array(texts, pa.large_string()))
        cuts = np.split(ids, np.cumsum(sizes)[:-1])
        assert [x.tolist() for x in cuts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a.Zé×1  "), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_any_text_encodes_like_the_library(texts):
    encoder, library = _ENCODER, _LIBRARY
    ids, sizes = encoder.encode(pa.array(texts, pa.large_string()))
    assert ids.tolist() == [x for t in texts for x in library.encode(t, add_special_tokens=False).ids]
    assert int(sizes.sum()) == len(ids)


_ENCODER, _LIBRARY = tokens.PieceEncoder(PATH), _library()


@pytest.mark.parametrize("n", [1, 255, 256, 257, 40_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.geometric(0.01, n).astype(np.uint32)
    freq = tokens.scale_table(np.bincount(ids))
    assert freq.sum() == 1 << tokens.SCALE_BITS and (freq[ids] > 0).all()
    below = np.concatenate([[0], np.cumsum(freq)[:-1]])
    words, states, cuts = tokens.encode_block(ids, freq, below)
    symbol = np.repeat(np.arange(len(freq)), freq)
    back = tokens.decode_block(words, states, cuts, n, freq.astype(np.uint64), below.astype(np.uint64), symbol)
    assert (back == ids).all()


def test_one_token_corpus_and_scale():
    assert tokens.scale_table(np.array([0, 5])).tolist() == [0, 1 << tokens.SCALE_BITS]
    assert tokens.scale_table(np.zeros(3, np.int64)).sum() == 0
    skewed = tokens.scale_table(np.array([10**15] + [1] * 5000))
    assert skewed.sum() == 1 << tokens.SCALE_BITS and skewed.min() == 1


def test_written_ids_read_back(docs_of, spark, tmp_path):
    rows = [(7 * k, t) for k, t in enumerate(WEIRD)] + [(3, None), (4, "long " * 3000), (4, "again"), (None, "none")]
    folder = str(tmp_path / "corpus")
    tokens.write_corpus(docs_of(rows), folder, PATH, block_tokens=300)
    out = tokens.read_corpus(spark, folder, with_ids=True).orderBy("start").collect()
    library, start = _library(), 0
    assert [r["doc_id"] for r in out] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    expected = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], len(r[1] or "")))
    for row, (doc, text) in zip(out, expected):
        ids = library.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]
        assert (row["doc_id"], row["start"], row["n_tokens"], list(row["ids"])) == (doc, start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    tokens.write_corpus(docs_of([]), str(tmp_path / "empty"), PATH)
    assert tokens.read_corpus(spark, str(tmp_path / "empty")).count() == 0


def test_damaged_block_fails(docs_of, spark, tmp_path):
    tokens.write_corpus(docs_of([(1, "some words"), (2, "more of them")]), str(tmp_path / "c"), PATH)
    blocks = spark.read.parquet(str(tmp_path / "c/blocks")).withColumn("crc32", F.col("crc32") + 1)
    blocks.write.parquet(str(tmp_path / "d/blocks"))
    for part in ("table", "shards"):
        spark.read.parquet(str(tmp_path / "c" / part)).write.parquet(str(tmp_path / "d" / part))
    with pytest.raises(Exception, match="checksum"):
        tokens.read_corpus(spark, str(tmp_path / "d")).collect()


PAGES = "page_id long, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "7k"])
def test_archives_read_back(spark, split):
    html = [None, "", "é" * 50, FAKE, "x" + FAKE * 400, "WARC/1.1\r\n", "WARC/1.WARC/1.1\r\n", FAKE * 200 + "end", "", "é" * 50]
    rows = [(k - 2, f"u{k}\r\n", h) for k, h in enumerate(html)] + [(100 + k, None, f"page {k} " * 40) for k in range(60)]
    pages = spark.createDataFrame(rows + [(None, None, "lone")], PAGES).coalesce(1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        out = {r["page_id"]: r for r in warc.archive_of_pages(pages).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(out) == len(rows) + 1
    first: dict = {}
    for page, _, text in sorted(rows):
        first.setdefault(text or "", page)
    for page, _, text in rows:
        payload = (text or "").encode()
        row, head = out[page], first[text or ""]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (row["record_type"], row["refers_to"]) == (("response", None) if head == page else ("revisit", head))


def test_archives_of_no_pages_and_least_bytes(spark, tmp_path):
    assert warc.archive_of_pages(spark.createDataFrame([], PAGES)).count() == 0
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES)
    warc.write_archives(pages, str(tmp_path / "w"), least_bytes=3)
    out = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert out == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def _record(version, kind, block, **fields):
    lines = [f"WARC/{version}", f"WARC-Type: {kind}", *[f"WARC-{k.replace('_', '-')}: {v}" for k, v in fields.items()]]
    if kind in ("request", "response"):
        lines.append("Content-Type: application/http; msgtype=" + kind)
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_others(spark, tmp_path, packed):
    """Both versions, all types of records, optional digests in both notations, magics in payloads, gzip."""
    inner = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    page = b"HTTP/1.1 200 OK\r\n\r\n<p>" + inner * 3
    records = [
        ("warcinfo", _record("1.0", "warcinfo", b"software: x\r\n", Record_ID="<urn:uuid:1>"), None),
        ("request", _record("1.1", "request", b"GET / HTTP/1.1\r\n\r\n"), None),
        # The payload digest is that of the body, the block digest that of all.
        ("response", _record("1.1", "response", page, Payload_Digest="sha1:" + _sha1(page[19:]),
                             Block_Digest="sha1:" + hashlib.sha1(page).hexdigest()), _sha1(page[19:])),
        ("resource", _record("1.0", "resource", inner), _sha1(inner)),
        ("metadata", _record("1.0", "metadata", b"", Payload_Digest="md5:00"), _sha1(b"")),
        ("revisit", _record("1.1", "revisit", b""), None),
    ]
    whole = b"".join(gzip.compress(x) for _, x, _ in records) if packed else b"".join(x for _, x, _ in records)
    folder = tmp_path / "other"
    folder.mkdir()
    (folder / ("a.warc.gz" if packed else "a.warc")).write_bytes(whole)
    out = {r["record_type"]: r for r in warc.read_archives(spark, str(folder)).collect()}
    assert sorted(out) == sorted(kind for kind, _, _ in records)
    assert {r["page_id"] for r in out.values()} == {None}
    assert out["response"]["payload_bytes"] == len(page) and out["warcinfo"]["payload_bytes"] == 13
    assert (out["revisit"]["payload_bytes"], out["revisit"]["payload_digest"]) == (None, None)
    for kind, _, digest in records:
        assert digest is None or out[kind]["payload_digest"] == digest


def test_a_wrong_digest_fails(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(_record("1.1", "resource", b"abc", Block_Digest="sha1:" + _sha1(b"abd")))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark, str(tmp_path)).collect()



def test_targets_reshare_what_is_too_much():
    assert mixing.share_out([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    targets = mixing.share_out([1, 100, 100], [3, 1, 1])
    assert targets[0] == 3 and abs(sum(targets) - 201) < 1e-9 and targets[1] == targets[2]
    assert mixing.share_out([0, 5], [1, 2]) == [0, 5] and mixing.share_out([], []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutations_are_whole(n):
    key = np.full(n, np.uint64(12345))
    found = mixing.permute(np.arange(n), np.full(n, n), key)
    assert sorted(found.tolist()) == list(range(n))


def test_draws_use_up_the_quotas():
    quotas = np.array([5, 0, 9000, 1234, 1])
    drawn = mixing.draw_shards(quotas, 1000)
    assert (drawn.sum(axis=0) == quotas).all() and (drawn[:-1].sum(axis=1) == 1000).all()
    assert (drawn == mixing.draw_shards(quotas, 1000)).all()


def _mix_rows():
    rng = random.Random(8)
    rows = []
    for k in range(150):
        source = ["a", "b", "é", None][k % 4] if k % 9 else "tiny"
        rows.append((k, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 300))), "en", source, 1))
    return rows + [(500, None, None, "a", None), (501, "", None, "empty", 0), (7, "twice here", "en", "b", 1), (None, "no id", "en", "b", 1)]


def test_mixture_counts(docs_of):
    rows = _mix_rows()
    out = mixing.mixture_counts(docs_of(rows)).collect()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mixing.mixture_counts(docs_of(rows)).collect()))
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing.share_out([sizes[s] for s in names], [[1, 2, 3][k % 3] for k in range(len(names))])))
    by_target: dict = {}
    for row in out:
        assert row["taken"] <= 3 * row["size"]
        key = (row["target"], row["source_size"])
        by_target[key] = by_target.get(key, 0) + row["taken"]
    for source in names:
        taken = by_target[targets[source], sizes[source]]
        assert abs(taken - targets[source]) <= 0.1 * targets[source] + 2 * mixing.BLOCK_WORDS
    assert mixing.mixture_counts(docs_of([])).count() == 0


def test_mixed_documents_hold_the_taken_words(docs_of):
    rows = [r for r in _mix_rows() if r[0] not in (None, 7)]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture_counts(docs_of(rows)).collect()}
    words: dict = {}
    texts = {r[0]: r[1] or "" for r in rows}
    for row in mixing.mix_rows(docs_of(rows)).collect():
        assert row["text"] in texts[row["doc_id"]] and row["n_chars"] == len(row["text"])
        words[row["doc_id"]] = words.get(row["doc_id"], 0) + len(row["text"].split())
    assert {d: n for d, n in taken.items() if n} == words


def test_mixing_keeps_rows_without_id_and_repeats(docs_of):
    rows = _mix_rows()
    taken = sum(r["taken"] for r in mixing.mixture_counts(docs_of(rows)).collect())
    out = mixing.mix_rows(docs_of(rows)).collect()
    assert sum(len(r["text"].split()) for r in out) == taken
    assert {"no id", "twice here"} <= {r["text"] for r in out}
    assert mixing.mix_rows(docs_of([])).count() == 0
