"""Licence scans by a trained paragraph classifier.

A paragraph (consecutive lines with words, comment marks not counted) is read in windows of WINDOW words.  A softmax regression over sparse word 1- and 2-grams names a licence
family or ``none``; it is trained in numpy on the templates, varied and mixed with words of the corpus, against windows of a
bounded sample of the corpus and templates in shuffled order.  Its temperature and the least probability of a family are fitted on a
held-back part.  A family's prediction counts only if the window holds CONTAINMENT of the 3-grams of one of the family's templates; a
window that looks like a licence without such a template, or without a sure family, is ``unknown``.

Null or empty text: ``none``.  A document with several families reports the one with the highest score (ties: first by name) and
how many paragraphs hold a licence.  Texts that can't reach a family's score by any window are passed over by a bound on the sum of
weights, which changes no result.  An empty corpus trains without background; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import binary_list, bounded_sample, map_batches

#: Production parameters.  SAMPLE documents and SAMPLE_CHARS characters of each serve as background.
WINDOW, STRIDE = 48, 24
SAMPLE, SAMPLE_CHARS = 2000, 600
CONTAINMENT = 0.6
PRECISION = 0.995
NONE, UNKNOWN = "none", "unknown"

#: Licence notices and sentences of the licences' other paragraphs by family (fixed values); UNKNOWN: what several families share.
TEMPLATES = {
    "agpl": ["licensed under the GNU Affero General Public License, version 3",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             "You should have received a copy of the GNU Affero General Public License along with this program"],
    "apache": ["Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
               "See the License for the specific language governing permissions and limitations under the License"],
    "bsd": ["Licensed under the BSD License", "Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES"],
    "cc-by": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["released under CC0 1.0 Universal public domain dedication"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3",
            "You should have received a copy of the GNU General Public License along with this program",
            "modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "provided that the above copyright notice and this permission notice appear in all copies",
            "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"],
    "lgpl": ["licensed under the GNU Lesser General Public License, version 3",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "You should have received a copy of the GNU Lesser General Public License along with this library"],
    "mit": ["Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "mpl": ["subject to the terms of the Mozilla Public License, version 2.0",
            "If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "unlicense": ["This is free and unencumbered software released into the public domain",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"],
    UNKNOWN: ["THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO",
              "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
}
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Comment marks made of letters; all others hold no token.
_MARK = re.compile(rb"\s*(?:rem|dnl|c)(?=\s)")


def tokens(raw: bytes) -> list[bytes]:
    return _TOKEN.findall(raw.lower())


def paragraphs(raw: bytes):
    """Tokens of each run of lines that hold any."""
    held: list[bytes] = []
    for line in raw.lower().split(b"\n"):
        mark = _MARK.match(line)
        words = _TOKEN.findall(line, mark.end() if mark else 0)
        if words:
            held += words
        elif held:
            yield held
            held = []
    if held:
        yield held


def grams(words: list) -> set:
    return {*words, *zip(words, words[1:])}


class LicenseModel:
    """Softmax regression over the n-grams of the templates."""

    def __init__(self, background: list[list[bytes]], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.families = sorted(TEMPLATES) + [NONE]
        self.templates = {f: [tokens(t.encode()) for t in TEMPLATES[f]] for f in TEMPLATES}
        vocabulary = sorted({g for ts in self.templates.values() for t in ts for g in grams(t)}, key=repr)
        self.index = {g: i for i, g in enumerate(vocabulary)}
        windows, labels = self._examples(background, rng)
        x = np.zeros((len(windows), len(vocabulary)), np.float32)
        for row, words in zip(x, windows):
            row[[self.index[g] for g in grams(words) if g in self.index]] = 1
        held = rng.random(len(x)) < 0.25
        self._fit(x[~held], labels[~held])
        self._calibrate(x[held], labels[held])
        gain = np.maximum(0, (self.w[:, :-1] - self.w[:, -1:]).max(1))
        self.gain = dict(zip(vocabulary, gain.tolist()))
        self.pairs = [(g, v) for g, v in self.gain.items() if isinstance(g, tuple) and v > 0]
        self.words = frozenset(g for g in vocabulary if isinstance(g, bytes))
        # What weights must add up to before a family can reach even odds with none.
        self.need = float(self.b[-1] - self.b[:-1].max() - max(1.0, self.temperature) * np.log(len(self.families)))

    def _examples(self, background, rng):
        plain = [w for words in background for w in words] or [b"word"]
        # A word of one family alone is never left out: without it the notice would be another family's.
        kinds = {f: {w for words in ts for w in words} for f, ts in self.templates.items()}
        sole = {w for f, own in kinds.items() for w in own if not any(w in other for g, other in kinds.items() if g != f)}
        windows, labels = [], []
        for k, f in enumerate(self.families[:-1]):
            for words in self.templates[f]:
                for _ in range(60):
                    own = [w for w in words if rng.random() > 0.05 or w in sole]
                    around = [plain[i] for i in rng.integers(0, len(plain), rng.integers(0, WINDOW))]
                    cut = int(rng.integers(0, len(around) + 1)) if rng.random() < 0.5 else 0
                    windows.append((around[:cut] + own + around[cut:])[:WINDOW + len(own)])
                    labels.append(k)
                for _ in range(20):
                    windows.append([words[i] for i in rng.permutation(len(words))])
                    labels.append(len(self.families) - 1)
        for words in background:
            windows.append(words[:WINDOW])
            labels.append(len(self.families) - 1)
        return windows, np.array(labels)

    def _fit(self, x, y, rounds: int = 400, rate: float = 0.5, decay: float = 1e-4):
        self.w = np.zeros((x.shape[1], len(self.families)), np.float32)
        self.b = np.zeros(len(self.families), np.float32)
        self.temperature = 1.0
        target = np.eye(len(self.families), dtype=np.float32)[y]
        weight = (1 / np.bincount(y, minlength=len(self.families)).clip(1))[y].astype(np.float32)
        weight /= weight.sum()
        mw, mb = np.zeros_like(self.w), np.zeros_like(self.b)
        for _ in range(rounds):
            d = (self._softmax(x @ self.w + self.b) - target) * weight[:, None]
            mw, mb = 0.9 * mw + x.T @ d + decay * self.w, 0.9 * mb + d.sum(0)
            self.w -= rate * len(self.families) * mw
            self.b -= rate * len(self.families) * mb

    @staticmethod
    def _softmax(z):
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def _calibrate(self, x, y):
        """Temperature of the smallest held-back loss; least probability at which families are right PRECISION of the time."""
        z = x @ self.w + self.b
        losses = {t: -np.log(self._softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)}
        self.temperature = min(losses, key=losses.get)
        p = self._softmax(z / self.temperature)
        best = p.argmax(1)
        self.least = 0.99
        for t in np.linspace(0.5, 0.99, 50):
            sure = (best < len(self.families) - 1) & (p.max(1) >= t)
            if sure.any() and (best[sure] == y[sure]).mean() >= PRECISION:
                self.least = float(t)
                break

    def reachable(self, words: set) -> bool:
        """Whether any window made of these words could be a licence's."""
        own = self.words & words
        return bool(own) and sum(self.gain[w] for w in own) + sum(v for (a, b), v in self.pairs if a in own and b in own) >= self.need

    def window(self, words: list[bytes]) -> tuple[str, float]:
        at = [self.index[g] for g in grams(words) if g in self.index]
        p = self._softmax((self.w[at].sum(0) + self.b) / self.temperature)
        k = int(p[:-1].argmax())
        if p[-1] >= 0.5:
            return NONE, float(p[-1])
        shown = set(zip(words, words[1:], words[2:]))
        if p[k] >= self.least and any(self._contained(t, shown) for t in self.templates[self.families[k]]):
            return self.families[k], float(p[k])
        return UNKNOWN, float(1 - p[-1])

    @staticmethod
    def _contained(template: list[bytes], shown: set) -> bool:
        own = set(zip(template, template[1:], template[2:]))
        return len(own & shown) >= CONTAINMENT * len(own)

    def document(self, raw: bytes | None) -> tuple[str, float, int]:
        """Family (or unknown, none), score, number of paragraphs with a licence of a whole text."""
        if not raw or not self.reachable(set(tokens(raw))):
            return NONE, 0.0, 0
        found, n = [], 0
        for words in paragraphs(raw):
            if not self.reachable(set(words)):
                continue
            parts = [words[i:i + WINDOW] for i in range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE)]
            hits = [r for r in (self.window(x) for x in parts if self.reachable(set(x))) if r[0] != NONE]
            n += bool(hits)
            found += hits
        if not found:
            return NONE, 0.0, 0
        family, score = min(found, key=lambda r: (r[0] == UNKNOWN, -r[1], r[0]))
        return family, score, n


def train(docs: DataFrame, sample: int = SAMPLE) -> LicenseModel:
    """A model whose background are ``sample`` texts (those with the smallest hashes of doc_id), a piece from the middle of each."""
    text = F.col("text").cast("string")
    piece = F.substr(text, F.lit(1) + F.floor(F.length(text) / 3).cast("int"), F.lit(SAMPLE_CHARS)).alias("piece")
    rows = bounded_sample(docs.where(text.isNotNull()).select("doc_id", piece), "doc_id", sample)
    background = [w for w in (tokens(r["piece"].encode()) for r in rows) if len(w) >= 8 and not {b"license", b"licensed", b"licence"} & set(w)]
    return LicenseModel(background)


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """doc_id, license, score, license_paragraphs of every document."""
    def fn(batch: pa.RecordBatch):
        found = [model.document(x) for x in binary_list(batch.column("text"))]
        return {"doc_id": batch.column("doc_id")} | {c: [r[i] for r in found] for i, c in enumerate(("license", "score", "license_paragraphs"))}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                       "doc_id long, license string, score double, license_paragraphs long")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, train(docs))
