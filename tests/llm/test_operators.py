"""Each operator against brute force or an exact round trip, and on null, empty, long, tied and repeated rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from crimestats.llm import (byte_language, chat_format, common, host_quality, lattice_dedup, license_scan, maxent_lm, ngram_join,
                            sentence_pieces, source_mix, token_counts)

#: Null, empty, blank, tiny, repeated and very long texts.
EDGE = [None, "", " \t\n", "a", "a b", "same words here now", "same words here now", "x" * 20_000, "word " * 5_000, "## * | 12 34\n\n\n", "é ß 日本 😀"]


def words_of(text):
    return (text or "").encode().lower().split()


# ------------------------------------------------------------------ quality
def brute_measure(text):
    raw = (text or "").encode()
    w = raw.split()
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = collections.Counter(tri)
    inside = {i + k for i, t in enumerate(tri) if count[t] > 1 for k in range(3)}
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(w), sum(len(x.decode()) for x in w), sum(raw.count(c.encode()) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_quality_measures_and_base_rule(make_docs):
    rng = random.Random(1)
    texts = EDGE + [" ".join(rng.choice("ab cd ef gh\nij".split(" ")) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    got = {r.doc_id: r for r in host_quality.host_quality(make_docs(texts)).collect()}
    for i, t in enumerate(texts, 1):
        n, chars, symbols, dup, repeat = brute_measure(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)


def test_host_verdicts_reach_documents(make_docs):
    rng = random.Random(2)
    clean = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    texts = [clean() for _ in range(60)] + ["junk"] * 30 + [clean()] + [clean()]
    source = ["good"] * 60 + ["bad"] * 31 + [None]
    docs = make_docs(texts, source=source)
    got = {r.doc_id: r for r in host_quality.host_quality(docs).collect()}
    assert all(got[i].kept for i in range(1, 61)) and got[92].kept
    assert got[91].host_verdict == "reject" and not got[91].kept and not got[91].base_failed
    kept = host_quality.filter_documents(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)
    assert host_quality.host_quality(docs.limit(0)).count() == 0


def test_shrinkage_decides_and_gross_failures_go_everywhere(make_docs):
    """A small host with one mild failure is trusted by its shrunk rate, though its own rate is over the bound."""
    rng = random.Random(3)
    clean = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    mild, gross = (lambda: clean() + " #########"), (lambda: clean() + " " + "#" * 40)
    hosts = {f"h{k}": [mild()] + [clean() for _ in range(19)] for k in range(10)} | {"small": [mild()] + [clean() for _ in range(11)]}

    def verdicts(hosts):
        docs = make_docs([t for ts in hosts.values() for t in ts], source=[h for h, ts in hosts.items() for _ in ts])
        rows = host_quality.host_quality(docs).collect()
        assert sorted(r.doc_id for r in host_quality.filter_documents(docs).collect()) == sorted(r.doc_id for r in rows if r.kept)
        return {r.host: r.host_verdict for r in rows}, {(r.host, r.symbols_failed, r.gross_failed): r.kept for r in rows}

    got, kept = verdicts(hosts)
    assert 1 / 12 > host_quality.STRICT_EXCESS * (10 / 20 + 1 / 12) / 11
    assert set(got.values()) == {"trusted"} and kept["=small", True, False]
    got, kept = verdicts(hosts | {"worse": [mild() for _ in range(9)] + [clean() for _ in range(11)], "h0": [gross()] + hosts["h0"][1:]})
    assert got.pop("=worse") == "strict" and set(got.values()) == {"trusted"}
    assert not kept["=worse", True, False] and kept["=worse", False, False] and kept["=h1", True, False] and not kept["=h0", True, True]


def test_pieces_replace_columns_of_their_names(make_docs):
    docs = make_docs(["ab cd", None, ""]).withColumnRenamed("source", "input_ids")
    coded = sentence_pieces.encode_documents(docs)
    assert coded.columns == [c for c in docs.columns if c not in ("text", "input_ids")] + ["input_ids"]
    back = sentence_pieces.decode_documents(coded.selectExpr("*", "'other' AS text"))
    assert {r.doc_id: r.text for r in back.collect()} == {1: "ab cd", 2: None, 3: ""}


# ----------------------------------------------------------------- language
def test_language_held_out_accuracy_and_edges(make_docs):
    rng = random.Random(3)
    syllables = {"aa": ["ka", "ro", "mi", "tul"], "bb": ["schw", "eng", "ich", "ung"]}
    make = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(60))
    langs = [rng.choice(["aa", "bb"]) for _ in range(300)]
    docs = make_docs([make(x) for x in langs], lang=langs)
    net = byte_language.train(byte_language.training_rows(docs))
    got = {r.doc_id: r for r in byte_language.identify(docs, net).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].lang_pred == langs[i - 1] for i in held]) > 0.97
    edge = {r.doc_id: r for r in byte_language.identify(make_docs(EDGE), net).collect()}
    assert all(0 <= r.score <= 1 for r in edge.values())
    assert [edge[i].lang_pred for i in (1, 2, 3, 10)] == ["und"] * 4
    assert byte_language.filter_documents(docs, net).columns == docs.columns
    empty = byte_language.train(byte_language.training_rows(docs.limit(0)))
    assert {r.lang_pred for r in byte_language.identify(make_docs(EDGE), empty).collect()} == {"und"}


# ------------------------------------------------------------- Jaccard join
def brute_components(sets):
    ids = sorted(sets)
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                label[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("small", [128, 3])
def test_jaccard_join_equals_brute_force(make_docs, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(4)
    texts = list(EDGE)
    for _ in range(8):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(20, 120))]
        for _ in range(9):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = f"n{rng.randint(0, 10 ** 6)}"
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
    docs = make_docs(texts)
    got = {r.doc_id: r for r in ngram_join.similar_documents(docs).collect()}
    sets = {i: shingle_set(t) for i, t in enumerate(texts, 1)}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    want = brute_components(sets)
    assert {i: r.component_id for i, r in got.items()} == want
    if small == 128:
        kept = ngram_join.one_per_group(docs.union(docs.where("doc_id = 9")))
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)
        assert kept.columns == docs.columns
        assert ngram_join.similar_documents(docs.limit(0)).count() == 0


def test_components_of_a_large_group_over_many_tasks(spark, monkeypatch):
    """Rows after the forests and after each round follow the nodes, not the tasks or edges; hubs and forgetting change nothing."""
    rows = []
    keep = common.staged
    monkeypatch.setattr(common, "staged", lambda df: (lambda out: rows.append(out.count()) or out)(keep(df)))
    rng = random.Random(8)
    n = 2000
    edges = [(i, rng.randrange(n)) for i in range(n) for _ in range(20)] + [(i, i + 1) for i in range(n - 1)]
    edges += [(n + 10 * k, n + 10 * k + j) for k in range(50) for j in range(1, 5)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(200)
    want = {i: 0 for i in range(n)} | {n + 10 * k + j: n + 10 * k for k in range(50) for j in range(5)}
    for nodes, hub in ((1 << 19, 64), (30, 3)):
        monkeypatch.setattr(common, "FOREST_NODES", nodes)
        monkeypatch.setattr(common, "HUB_ROWS", hub)
        rows.clear()
        assert dict(map(tuple, common.connected_components(table).collect())) == want
        assert nodes < 1000 or max(rows) <= len(want) + 200


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 140)] + [(100, 100)]
    got = dict(map(tuple, common.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()))
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}}


# --------------------------------------------------------------------- chat
def test_chat_round_trip(spark):
    rng = random.Random(5)
    strings = ["", None, r"\### Assistant: </turn> ok", "####", "</turn></turn>\n", "a\\h\\\\e\n", "plain", "\\", "##", "<</turn>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "x\n###"]), rng.choice(strings), 1) for c in [None, *range(30)] for t in
            rng.sample([None, 0, 1, 2, 2, 3, 4], 5)]
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.examples(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, turns int"))).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ----------------------------------------------------------- SentencePiece
def test_pieces_equal_the_library_and_decode(make_docs, monkeypatch):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    rng = random.Random(6)
    alphabet = "aehint ▁\n\t  é日😀the insgß\x00<s>'-=_"
    texts = [t for t in EDGE if t is not None] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    v = sentence_pieces.Vocabulary(sentence_pieces.MODEL)
    monkeypatch.setattr(sentence_pieces, "GROUP", 1000)
    assert [x.tolist() for x in v.encode(texts)] == [sp.encode(t) for t in texts]
    docs = make_docs(EDGE)
    encoded = sentence_pieces.encode_documents(docs)
    back = {r.doc_id: r.text for r in sentence_pieces.decode_documents(encoded).collect()}
    assert back == {i: t for i, t in enumerate(EDGE, 1)}
    assert all(r.round_trip for r in sentence_pieces.encoding_digests(docs).collect())
    assert sentence_pieces.encoding_digests(docs.limit(0)).count() == 0


# -------------------------------------------------------------- LM scoring
def test_language_model_base_scores_and_gain(make_docs, monkeypatch):
    monkeypatch.setattr(maxent_lm, "HOT", 400)
    rng = random.Random(7)
    texts = list(EDGE)
    for _ in range(300):
        kind = rng.random() < 0.5
        texts.append(" ".join(rng.choice(["the", "of", "cat"] if kind else ["der", "und", "hund"]) if rng.random() < 0.7 else f"z{rng.randint(0, 3000)}" for _ in range(60)))
    got = {r.doc_id: r for r in maxent_lm.score(make_docs(texts)).collect()}
    tokens = {i: words_of(t) + [b"\n"] for i, t in enumerate(texts, 1)}
    count = collections.Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in tokens.items():
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        r = got[i]
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.train_tokens == n
        assert (r.n_tokens, r.n_known, r.held_out) == (len(t), sum(count[w] > 0 for w in t), zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isfinite(r.score) and r.score < 0
    held = [r for i, r in got.items() if r.held_out and i > len(EDGE)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    empty = maxent_lm.score(make_docs(["a b"], doc_id=[next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)])).collect()[0]
    assert empty.train_tokens == 0 and empty.base_score == 0.0


def test_model_probabilities_sum_to_one():
    lex = maxent_lm.Lexicon([(b"\n", 5)] + [(b"w%d" % i, 9) for i in range(40)], 365, 41, {})
    model = maxent_lm.Model(lex)
    symbol = np.array([3, 7, 1])
    rows, one, two = maxent_lm.histories(symbol, np.array([3]))
    z = np.exp(maxent_lm.log_softmax(rows, model.cls_rows))
    assert np.allclose(z.sum(1), 1, atol=1e-5) and z.shape[1] == maxent_lm.CLASSES


def test_words_and_unseen_ones_of_a_history_sum_to_one():
    """P(word | history) over the whole vocabulary and one unseen word of each tail class, at any weights."""
    rng = np.random.default_rng(0)
    words = [b"\n"] + [b"w%d" % i for i in range(900)]
    count = np.sort(rng.integers(1, 500, len(words)))[::-1].tolist()
    tail = {}
    for w, c in list(zip(words, count))[maxent_lm.HEAD:]:
        n, v = tail.get(maxent_lm.tail_class(w), (0, 0))
        tail[maxent_lm.tail_class(w)] = (n + c, v + 1)
    # The last 100 words are known but not hot: their shares come from the join's formula.
    lex = maxent_lm.Lexicon(list(zip(words, count))[:-100], sum(count), len(words), tail)
    model = maxent_lm.Model(lex)
    weights = tuple((x + rng.normal(0, 0.5, x.shape)).astype(np.float32) for x in (model.cls_rows, model.word_rows))
    index, total = lex.index(), 0.0
    for w, c in zip(words, count):
        text = b"w3 zzz" if w == b"\n" else b"w3 zzz " + w  # the end follows by itself
        ids, cls, symbol, sizes, cold, _ = maxent_lm.encode([text], lex, index)
        rows, one, two = maxent_lm.histories(symbol, sizes)
        p = maxent_lm.log10_known(ids, cls, rows, one, two, lex, weights)[2]
        total += 10 ** p * ((c + maxent_lm.ALPHA) / lex.tail_scale(int(cls[2])) if 2 in cold else 1)
    classes = np.exp(maxent_lm.log_softmax(rows[2:3], weights[0]))[0]
    total += sum(classes[k] * maxent_lm.ALPHA / lex.tail_scale(k) for k in range(maxent_lm.HEAD_CLASSES, maxent_lm.CLASSES))
    assert abs(total - 1) < 1e-4


def test_language_model_splits_and_counts_as_bytes_do():
    """Every byte beside words, invalid UTF-8, nulls; counts given out in several pieces or merged."""
    texts = [None, b"", b" \t\n\x0b\x0c\r", b"\xff\xfeA \xc3\x89", *(b"Aa" + bytes([x]) + b"Zb" + bytes([x, x]) for x in range(256)), *(b"w%d W1 " % (i % 40) for i in range(300))]
    flat, sizes = maxent_lm.split(texts)
    brute = [(t or b"").lower().split() for t in texts]
    assert flat.to_pylist() == [w for t in brute for w in t] and sizes.tolist() == [len(t) for t in brute]
    # Arrow's text columns are UTF-8.
    valid = [t if t is None else t.decode("latin-1") for t in texts]
    count = collections.Counter(w for t in valid for w in words_of(t) + [b"\n"])
    batches = [pa.record_batch({"text": pa.array(valid[i:i + 50])}) for i in range(0, len(valid), 50)]
    for held_bytes, held_words in ((1 << 20, 10), (100, 10), (100, 10_000)):
        got = [(w, c) for b in maxent_lm.count_words(batches, held_bytes, held_words) for w, c in zip(*(x.to_pylist() for x in b.columns))]
        total = collections.Counter()
        for w, c in got:
            total[w] += c
        assert total == count
        assert len(got) == len(count) or (held_bytes, held_words) == (100, 10)
    assert not sum(b.num_rows for b in maxent_lm.count_words([]))


def test_language_model_looks_each_word_of_a_batch_up_once():
    """The CPU of a batch goes with its distinct words, not with its tokens; the codes are those of every token by itself."""
    class Index(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    lex = maxent_lm.Lexicon([(b"\n", 5)] + [(b"w%d" % i, 9) for i in range(400)], 3700, 500, {})
    rng = random.Random(3)
    texts = [None, b""] + [b" ".join(b"W%d" % rng.randrange(450) for _ in range(100)) for _ in range(50)]
    index = Index(lex.index())
    ids, cls, symbol, sizes, cold, (distinct, code) = maxent_lm.encode(texts, lex, index)
    tokens = [w for t in texts for w in [*(t or b"").lower().split(), b"\n"]]
    assert index.asked == len(set(tokens))
    assert ids.tolist() == [lex.index().get(w, -1) for w in tokens] and sizes.tolist() == [1, 1] + [101] * 50
    assert cls.tolist() == [maxent_lm.tail_class(w) if i < 0 else int(lex.cls[i]) for w, i in zip(tokens, ids.tolist())]
    assert symbol.tolist() == [i if i >= 0 else maxent_lm.SYMBOLS + k for i, k in zip(ids.tolist(), cls.tolist())]
    assert [tokens[i] for i in cold.tolist()] == [distinct[i] for i in code.tolist()] and (ids[cold] < 0).all() and len(cold) == (ids < 0).sum()


def test_language_model_step_equals_the_plain_formula():
    """Bit for bit: row maxima, running sums, the update and the chosen log probabilities, for shared and separate bias rows."""
    rng = np.random.default_rng(4)
    for shared in (True, False):
        weights, squares = rng.normal(0, 2, (50, 32)).astype(np.float32), rng.random(50).astype(np.float32)
        rows, target = rng.integers(8, 50, (700, 4)), rng.integers(0, 32, 700)
        rows[:, 0] = 0 if shared else rng.integers(0, 8, 700)
        z = weights[rows[:, 1]] + weights[rows[:, 2]] + weights[rows[:, 3]] + weights[rows[:, 0]]
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z) @ np.ones(32, np.float32))[:, None]
        assert np.array_equal(maxent_lm.log_softmax(rows, weights), z)
        assert np.array_equal(maxent_lm.log_chosen(rows, weights, target), z[np.arange(700), target])
        d = np.exp(z)
        d[np.arange(700), target] -= 1
        want, sums = weights.copy(), squares.copy()
        for k, column in enumerate(rows.T):
            order = np.argsort(column, kind="stable")
            used, first = np.unique(column[order], return_index=True)
            g = np.diff(np.cumsum(d[order], axis=0)[np.append(first[1:], 700) - 1], axis=0, prepend=np.zeros((1, 32), np.float32))
            if shared and k == 0:
                g = d.sum(0, keepdims=True)
            sums[used] += np.einsum("ij,ij->i", g, g) / 32
            want[used] -= maxent_lm.RATE * g / np.sqrt(sums[used] + 1.0)[:, None]
        maxent_lm._step(weights, squares, rows, target)
        assert np.array_equal(weights, want) and np.array_equal(squares, sums)


# --------------------------------------------------------- vector duplicates
@pytest.mark.parametrize("dimension", [16, 64, 384])
def test_lattice_recall_at_the_threshold(dimension):
    """Pairs at the smallest cosine that links: some table has the home of one in the home or a probe of the other."""
    rng = np.random.default_rng(dimension)
    a = rng.normal(size=(3000, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = lattice_dedup.THRESHOLD
    b = cosine * a + math.sqrt(1 - cosine ** 2) * b
    met = np.zeros(len(a), bool)
    for t in range(lattice_dedup.TABLES):
        x, y = lattice_dedup.cells(a, 1, t), lattice_dedup.cells(b, 1, t)
        met |= (x[:, :1] == y).any(1) | (y[:, :1] == x).any(1)
    assert met.mean() >= 0.99


def test_lattice_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = []
    for group in range(6):
        base = rng.normal(size=32)
        for k in range(20):
            x = base + rng.normal(size=32) * rng.choice([0.0, 0.05, 0.15, 0.25])
            rows.append((len(rows), [float(np.float32(y)) for y in x * rng.choice([1.0, 1.0, 4.0])], group % 2))
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [1.0, 2.0], [float("inf")] * 32]
    rows += [(1000 + i, x, 0) for i, x in enumerate(odd)] + [(2000, rows[0][1], None), (3000, rows[1][1], rows[1][2])]
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    units = {i: np.array(x, np.float32).astype(float) for i, x, l in rows if (i < 1000 or i == 3000) and l is not None}
    units = {i: x / np.linalg.norm(x) for i, x in units.items()}
    label = {i: l for i, _, l in rows}
    pairs = {(a, b) for a in units for b in units if a < b and label[a] == label[b] and units[a] @ units[b] >= 0.93}
    links = collections.Counter(x for p in pairs for x in p)
    found = sum(r.n_links for r in got.values())
    assert all(r.n_links <= links[i] for i, r in got.items()) and found >= 0.97 * sum(links.values())
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in [*range(1000, 1007), 2000] if i != 1005)
    assert lattice_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_lattice_decoder_finds_the_nearest_point():
    x = np.random.default_rng(9).normal(size=(200, 8)) * 2
    p = lattice_dedup.nearest_points(x)
    near = lattice_dedup.minimal_vectors()
    assert near.shape == (240, 8) and ((near ** 2).sum(1) == 8).all()
    best = ((x - p / 2) ** 2).sum(1)
    assert all((((x[i] - (p[i] + near) / 2) ** 2).sum(1) >= best[i] - 1e-9).all() for i in range(200))


# ------------------------------------------------------------- token counts
def test_length_histogram_answers_every_limit(make_docs):
    docs = make_docs(EDGE + ["one two three " * k for k in range(30)])
    enc = token_counts.encoder(token_counts.VOCABULARY)
    lengths = [len(enc.encode_ordinary(r.text or "")) for r in docs.collect()]
    table = token_counts.suffix_table(token_counts.histogram(token_counts.document_lengths(docs)))
    for r in table.collect():
        assert (r.docs, r.docs_from, r.tokens_from) == (lengths.count(r.length), sum(n >= r.length for n in lengths), sum(n for n in lengths if n >= r.length))
        assert (r.docs_upto, r.truncated_tokens) == (sum(n <= r.length for n in lengths), sum(min(n, r.length) for n in lengths))
    assert token_counts.quantile(table, 0.5) == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]
    assert token_counts.totals_at(table, 37) == (sum(min(n, 37) for n in lengths), sum(n > 37 for n in lengths))
    assert token_counts.quantile(token_counts.suffix_table(token_counts.histogram(token_counts.document_lengths(docs.limit(0)))), 0.5) is None


# -------------------------------------------------------------------- mixing
def test_mix_meets_targets_and_repeats_itself(make_docs, monkeypatch):
    monkeypatch.setattr(source_mix, "BINS", 4)
    rng = random.Random(10)
    texts = EDGE + [" ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 200))) for _ in range(120)] + ["same text"] * 4
    source = [rng.choice(["b", "a", None, "É", "hot", "hot", "hot"]) for _ in texts]
    docs = make_docs(texts, source=source)
    docs = docs.union(docs.where("doc_id = 40"))
    rows = [r.asDict() for r in source_mix.mix(docs).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, (r.asDict() for r in source_mix.mix(docs.repartition(5)).collect())))
    size = lambda t: len(words_of(t))
    by = collections.defaultdict(int)
    for r, s in ((r, source[r["doc_id"] - 1]) for r in rows):
        assert r["size"] == size(texts[r["doc_id"] - 1]) and 0 <= r["taken"] <= 2 * r["size"]
        by[s] += r["taken"]
    order = sorted({s for s in source if s is not None}) + [None]
    total = {s: sum(size(texts[r["doc_id"] - 1]) for r in rows if source[r["doc_id"] - 1] == s) for s in order}
    target, free, left = {}, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(total.values())
    while free:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
            del free[s]
    for r in rows:
        s = source[r["doc_id"] - 1]
        assert abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) and abs(by[s] - target[s]) <= 1
    out = source_mix.mix_documents(docs)
    mixed = collections.Counter()
    for r in out.collect():
        mixed[source[r.doc_id - 1]] += size(r.text)
    assert out.columns == docs.columns and {s: mixed[s] for s in order} == {s: by[s] for s in order}
    assert source_mix.mix(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ licences
def test_license_scan(make_docs):
    rng = random.Random(11)
    noise = lambda n: " ".join("".join(rng.choice("abcdeinot") for _ in range(6)) for _ in range(n))
    cases = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.",
             "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    texts = [f"{noise(50)}\n{line} {noise(k)}\n{noise(30)}" for line in cases.values() for k in (0, 40)] + [noise(100) for _ in range(20)] + EDGE
    docs = make_docs(texts)
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    assert [got[i].license for i in range(1, 9)] == [f for f in cases for _ in range(2)]
    assert {got[i].license for i in range(9, len(texts) + 1)} == {"none"}
    assert license_scan.scan(docs.limit(0), license_scan.train(docs.limit(0))).count() == 0
