"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import random
import textwrap

import numpy as np

from crimestats.llm import byte_language, license_scan, ngram_join


def grams_of(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def smallest_of_groups(texts, rule):
    """Positions (from 1) of the first text of each group, by brute force."""
    sets = [grams_of(t, rule.n) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and rule.denominator * len(sets[a] & sets[b]) >= rule.numerator * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return [i + 1 for i, x in enumerate(label) if i == x]


def test_near_duplicate_stage_equals_brute_force(spark, make_docs, monkeypatch):
    """Also for pairs that link by 5 words and 0.8, but not by 3 words and 0.9, in small and in large buckets."""
    import corpus_pipeline

    rng = random.Random(21)
    texts = ["", None, "a b c d", "A b c  d", "a b c d e"]
    for _ in range(12):
        base = [f"w{rng.randint(0, 9000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(base))
        for share in (0.05, 0.15, 0.22, 0.3):  # an appended block
            texts.append(" ".join(base + [f"n{rng.randint(0, 10 ** 6)}" for _ in range(int(share * len(base)))]))
        for share in (0.01, 0.02, 0.04):  # scattered edits
            texts.append(" ".join(f"n{rng.randint(0, 10 ** 6)}" if rng.random() < share else w for w in base))
    want = smallest_of_groups(texts, ngram_join.Rule(5, 80))
    assert want != smallest_of_groups(texts, ngram_join.Rule(3, 90))
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    for small in (128, 3):
        monkeypatch.setattr(ngram_join, "SMALL", small)
        kept = corpus_pipeline.near_duplicates(spark, make_docs(texts), "")
        assert sorted(r.doc_id for r in kept.collect()) == want


def test_one_row_of_each_group_stays(make_docs):
    """By row: ids with two texts, null ids, repeated rows; rows without a word are linked to none."""
    a, b, c, d, e = ("".join(f"{x}{i} " for i in range(40)) for x in "abcde")
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (None, e), (None, e.upper()), (None, a), (None, None), (None, " "), (7, b), (7, ""), (7, ""), (6, d)]
    docs = make_docs([t for _, t in rows], doc_id=[i for i, _ in rows])
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, (r.text or "").strip().lower()[:1]) for r in kept.collect())
    assert got == [(0, ""), (0, ""), (0, "e"), (1, "a"), (5, "b"), (6, "c"), (6, "d"), (7, ""), (7, "")]


def test_rare_languages_are_learned(make_docs):
    """However many documents the others have, or repeats; without a label the stage keeps every document."""
    rng = random.Random(23)
    syllables = {"aa": ["ka", "ro", "mi", "tul"], "bb": ["schw", "eng", "ich", "ung"], "cc": ["xo", "quv", "zy", "wip"]}
    make = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(60))
    langs = ["aa"] * 900 + ["bb"] * 900 + ["cc"] * 12
    docs = make_docs([make(x) for x in langs], lang=langs)
    rows = byte_language.training_rows(docs)
    assert byte_language.train(rows, 100).languages == ["aa", "bb", "cc"]
    some = rows.where("lang = 'cc'").limit(3)
    for _ in range(6):
        some = some.union(some)
    repeated = byte_language.train(some, 2)
    assert repeated.languages == ["cc"]
    net = byte_language.train(rows.limit(0))
    assert byte_language.filter_documents(docs, net).count() == len(langs)


def test_wrapped_and_commented_notices_of_every_family():
    rng = random.Random(25)
    noise = lambda n: ["".join(rng.choice("abcdeinot") for _ in range(6)).encode() for _ in range(n)]
    model = license_scan.LicenseModel([noise(80) for _ in range(200)])
    wrong = []
    for family, notices in license_scan.TEMPLATES.items():
        for notice in notices:
            for width in (30, 60):
                for mark in ("", "# ", " * ", "// ", "rem "):
                    lines = [mark + x for x in textwrap.wrap(notice, width)]
                    text = "\n".join([" ".join(x.decode() for x in noise(30)), "", *lines, mark.rstrip(), " ".join(x.decode() for x in noise(30))])
                    got = model.document(text.encode())
                    if got[0] != family or got[2] != 1:
                        wrong.append((family, notice, width, mark, got))
    assert not wrong
    assert model.document(b" ".join(noise(300)))[0] == "none"


def test_license_bound_holds_at_any_temperature(monkeypatch):
    """The bound passes over no window whose probability of none could be under a half."""
    def hot(model, x, y):
        model.temperature, model.least = 3.0, 0.5

    monkeypatch.setattr(license_scan.LicenseModel, "_calibrate", hot)
    model = license_scan.LicenseModel([[b"plain", b"words"] * 20] * 50)
    assert model.need <= model.b[-1] - model.b[:-1].max() - 3 * np.log(len(model.families)) + 1e-4
