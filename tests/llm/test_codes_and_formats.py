"""Vector codes, byte-level BPE and fill-in-the-middle against brute force and the tokeniser's library, with every edge."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from crimestats.llm import ball_codes, byte_bpe, middle_fill

EDGE = [None, "", " \t\n", "a", "a b", "same words", "same words", "x" * 30_000, "word 12 " * 5_000, " " * 3_000, "a<S>b", "<P>", "<M", "é ß 日本 😀\r\n"]


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# -------------------------------------------------------------- vector codes
def brute_codes(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (codes, error)} and the codebooks, each part compared with every entry, in Python integers."""
    kept = sorted((i, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v in rows)
    w = len(kept[0][1]) // parts
    cut = {i: [tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for i, v in kept}
    books = [[cut[i][p] for i, _ in kept[:entries]] for p in range(parts)]

    def assign():
        return {i: [min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(c)] for i, c in cut.items()}

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut[i][p] for i in cut if found[i][p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    return {i: (bytes(k for _, k in f), sum(d for d, _ in f)) for i, f in assign().items()}, books


VECTORS = "vec_id long, embedding array<float>, label int, code string, error int"


def vector_rows(seed, n, dim=16, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i * 3 + 1, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=dim) * spread)]) for i in range(n)]


@pytest.mark.parametrize("n, grid", [(1, None), (9, None), (400, None), (400, 2)])
def test_ball_codes_equal_brute_force(spark, monkeypatch, n, grid):
    """Few vectors, several tasks and chunks, and coarse grids full of ties and equal entries."""
    monkeypatch.setattr(ball_codes, "CHUNK", 64)
    rows = vector_rows(n, n)
    if grid:
        rows = [(i, [round(x * grid) / grid / 1024 for x in v]) for i, v in rows]
    want, books = brute_codes(rows)
    labels = {i: (None if i % 4 == 0 else i % 3) for i, _ in rows}
    bad = [(2, None, 1), (5, [None] * 16, 1), (8, [float("nan")] + [0.0] * 15, 1), (11, [float("inf")] * 16, None), (14, [], 2)]
    table = spark.createDataFrame([(i, v, labels[i], "c", 0) for i, v in rows] + [(*b, "c", 0) for b in bad], VECTORS).repartition(5)
    coded, got_books = ball_codes.compress(table)
    assert got_books.tolist() == [[list(e) for e in part] for part in books]
    got = {r.vec_id: r for r in ball_codes.with_label_errors(coded).collect()}
    assert {i: (bytes(r.code), r.error) for i, r in got.items()} == want
    for i, r in got.items():
        assert r.label_error == sum(want[j][1] for j in want if labels[j] == labels[i])
    back = {r.vec_id: r.approx for r in ball_codes.decompress(coded, got_books).collect()}
    assert all(back[i] == [x for p, k in enumerate(want[i][0]) for x in books[p][k]] for i in want)


def test_ball_codes_of_repeated_empty_and_odd_vectors(spark):
    assert ball_codes.compress(spark.createDataFrame([], VECTORS))[0].count() == 0
    only_bad = spark.createDataFrame([(1, None, None, "c", 0)], VECTORS)
    assert ball_codes.with_label_errors(ball_codes.compress(only_bad)[0]).count() == 0
    rows = [(7, [1.0, -2.0, 3.5], 1, "c", 0)] * 3 + [(None, [0.0, 0.0, 1e30], None, "c", 0), (8, [1.0], 1, "c", 0)]
    coded, books = ball_codes.compress(spark.createDataFrame(rows, VECTORS))
    got = sorted((r.vec_id or 0, bytes(r.code), r.error) for r in coded.collect())
    assert [x[0] for x in got] == [0, 7, 7, 7] and got[1] == got[2] == got[3] and got[1][2] == 0
    assert books.shape == (8, 4, 1)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 60), st.integers(1, 9), st.sampled_from([1, 3, 1000]))
def test_rings_give_what_all_entries_give(seed, n, entries, size):
    """Also from a poor last assignment, with equal entries and equal distances."""
    rng = np.random.default_rng(seed)
    x, books = rng.integers(-size, size + 1, (n, 2, 3)), rng.integers(-size, size + 1, (2, entries, 3))
    code, error = ball_codes.Balls(books).reassign(x, rng.integers(0, entries, (n, 2)))
    want = ball_codes.nearest(x, books)
    assert (code == want[0]).all() and (error == want[1]).all()


# ------------------------------------------------------------------ byte BPE
@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


PIECES = [*"  '''strevmld aAé日1２ \n\t\r 　!?#😀́.", "'s", "'ll", "'re", "'ve", " '", "  ", "\x1c", "\x85", "Ⅷ", "ꟑ", "՘", "<|endoftext|>", "\0"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), max_size=6))
def test_words_and_merges_equal_the_library(library, texts):
    v = byte_bpe.vocabulary(byte_bpe.RANKS)
    ids, ends, first = v.encode(texts)
    for text, a, b in zip(texts, first, first[1:]):
        assert ids[a:b].tolist() == library(text)
        assert v.decode(ids[a:b]) == v.decode(ids[a:b], ends[a:b]) == text.encode()


def test_long_words_small_groups_and_forgetting(library, monkeypatch):
    for name, value in (("GROUP", 50), ("SLICES", 7), ("REMEMBERED", 5), ("SHORT", 4), ("SPAN", 3)):
        monkeypatch.setattr(byte_bpe, name, value)
    rng = random.Random(3)
    v = byte_bpe.ByteBpe(byte_bpe.RANKS)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 90))) for _ in range(60)] + ["ab" * 4000, "", "x" * 5000 + " '"]
    ids, _, first = v.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [library(t) for t in texts]
    word = "".join(rng.choice("abcde") for _ in range(300)).encode()
    assert v.merged(word) == v.merged_short(word)
    assert [len(x) for x in v.encode([])] == [0, 0, 1]


def test_byte_bpe_documents(make_docs, library):
    docs = make_docs(EDGE).withColumnRenamed("size", "input_ids").withColumnRenamed("host", "token_ends")
    coded = byte_bpe.encode_documents(docs)
    assert coded.columns == [c for c in docs.columns if c not in ("text", "input_ids", "token_ends")] + ["input_ids", "token_ends"]
    for r in coded.collect():
        text = EDGE[r.doc_id - 1] or ""
        assert r.input_ids == library(text)
        for k in range(0, len(r.token_ends), 1000):  # any span of tokens is found in the text
            a = r.token_ends[k - 1] if k else 0
            assert byte_bpe.vocabulary(byte_bpe.RANKS).decode(np.array(r.input_ids[k:k + 5])) == text.encode()[a:r.token_ends[min(k + 4, len(r.token_ends) - 1)]]
    for form in (coded, coded.drop("token_ends")):
        assert {r.doc_id: r.text for r in byte_bpe.decode_documents(form).collect()} == {i: t or "" for i, t in enumerate(EDGE, 1)}
    for r in byte_bpe.round_trip_digests(coded).collect():
        text = EDGE[r.doc_id - 1] or ""
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(library(text)), sha(",".join(map(str, library(text)))), sha(text))
    assert byte_bpe.round_trip_digests(byte_bpe.encode_documents(docs.limit(0))).count() == 0


def test_byte_bpe_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in byte_bpe.query(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library(text)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))


# ---------------------------------------------------------- fill in the middle
def brute_fill(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    d = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not n or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text or ""
    return n, *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


def test_middle_fill_equals_brute_force(make_docs):
    rng = random.Random(9)
    texts = EDGE + ["".join(rng.choice("abC é<>PSM\n1😀") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    ids = [None, -4, *range(3, len(texts) + 1)]
    rows = {(i, t) for i, t in zip(ids, texts)}
    made = middle_fill.fill_in_middle(make_docs(texts, doc_id=ids))
    got = made.withColumn("back", middle_fill.restored("output", "form")).collect()
    assert len(got) == len(texts)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append((*brute_fill(i, t), t or ""))
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) in want[r.doc_id]
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert middle_fill.fill_in_middle(make_docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab<>PSM \né", max_size=30), st.integers(0, 2 ** 32 - 1), st.integers(0, 2 ** 32 - 1))
def test_cuts_fall_between_units(text, h1, h2):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, start, end = middle_fill.cuts(text, h1, h2)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    assert n == len(units) and (text[:start], text[start:end]) == ("".join(units[:a]), "".join(units[a:b]))
