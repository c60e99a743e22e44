"""Language identification by a convolutional network over bytes.

Texts are cut into windows of WINDOW bytes.  A byte's embedding goes through filters of several widths, ReLU, the maximum over
the window, and a softmax over the learned languages.  The network is trained in numpy on a bounded sample of labelled texts;
a document's prediction is the mean of the log-probabilities of all its windows, weighted by their bytes.

Because the input is bytes, a trained filter is a sum of table rows: the window's byte pairs index precomputed
tables (one row of 65,536 per pair, one of 256 for the odd byte of an odd width), so scoring gathers and adds.

Null text or text without a letter: ``und`` with score 0.  Without any labelled row every document is ``und``.  With one label
it is always predicted.  Null labels are not learned from; every other label is, however rare (bounded by label).  Repeated rows are
learned from once and predicted alike; other columns are kept out.
"""

from __future__ import annotations

import re

import regex
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import binary_list, label_sample, map_batches, with_columns

#: Production parameters.  About SAMPLE documents, LEAST of each label at least (or all it has), and WINDOWS windows of each are
#: learned from.
WINDOW = 256
SAMPLE, LEAST = 4000, 50
WINDOWS = 2
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
EPOCHS = 6
BATCH = 64
CHUNK = 2048
FOLDS, HELD_OUT = 5, 0
MIN_SCORE = 0.5
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_ASCII = re.compile(rb"[A-Za-z]")
_tables: dict = {}


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    n = -(-len(raw) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


class ByteNet:
    """Embedding, multi-width filters, max pooling and softmax; trained by Adam on windows."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBEDDING)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
                  "bias": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        e = p["emb"][x]
        pooled, saved = [], []
        for w in WIDTHS:
            cols = np.concatenate([e[:, i:WINDOW - w + 1 + i] for i in range(w)], axis=2)
            z = cols @ p[f"f{w}"]
            at = z.argmax(1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0] + p[f"b{w}"]
            pooled.append(np.maximum(top, 0))
            saved.append((cols, at, top > 0))
        h = np.concatenate(pooled, 1)
        z = h @ p["out"] + p["bias"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g = {"out": h.T @ q, "bias": q.sum(0), "emb": np.zeros_like(p["emb"])}
        dh = q @ p["out"].T
        for k, (w, (cols, at, live)) in enumerate(zip(WIDTHS, saved)):
            d = dh[:, k * FILTERS:(k + 1) * FILTERS] * live
            picked = cols[np.arange(n)[:, None], at]                       # n x FILTERS x (w * EMBEDDING)
            g[f"b{w}"] = d.sum(0)
            g[f"f{w}"] = np.einsum("nfk,nf->kf", picked, d)
            de = d[:, :, None] * p[f"f{w}"].T[None]                        # n x FILTERS x (w * EMBEDDING)
            for i in range(w):
                np.add.at(g["emb"], x[np.arange(n)[:, None], at + i], de[:, :, i * EMBEDDING:(i + 1) * EMBEDDING])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 3e-3, seed: int = 11) -> "ByteNet":
        rng, m, v, t = np.random.default_rng(seed), {}, {}, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                some, t = order[i:i + BATCH], t + 1
                for k, g in self._gradients(x[some], y[some]).items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Per width the filter responses of byte pairs (of a single byte at an odd width's end)."""
        single = {w: [self.p["emb"] @ self.p[f"f{w}"][i * EMBEDDING:(i + 1) * EMBEDDING] for i in range(w)] for w in WIDTHS}
        return {w: [(s[i][:, None] + s[i + 1][None]).reshape(65536, FILTERS) if i + 1 < w else s[i] for i in range(0, w, 2)]
                for w, s in single.items()}

    def scores(self, x: np.ndarray, tables: dict) -> np.ndarray:
        """Log-probabilities of each window."""
        out = []
        for start in range(0, len(x), CHUNK):
            # Position by position over many windows: byte columns and the codes of byte pairs.
            b = np.ascontiguousarray(x[start:start + CHUNK].T).astype(np.intp)
            pair = b[:-1] * 256 + b[1:]
            pooled = []
            for w in WIDTHS:
                best = np.full((b.shape[1], FILTERS), -np.inf, np.float32)
                z, more = np.empty_like(best), np.empty_like(best)
                for i in range(WINDOW - w + 1):
                    np.take(tables[w][0], pair[i], axis=0, out=z, mode="clip")
                    for k, table in enumerate(tables[w][1:], 1):
                        np.take(table, pair[i + 2 * k] if 2 * k + 1 < w else b[i + 2 * k], axis=0, out=more, mode="clip")
                        z += more
                    np.maximum(best, z, out=best)
                pooled.append(np.maximum(best + self.p[f"b{w}"], 0))
            z = np.concatenate(pooled, 1) @ self.p["out"] + self.p["bias"]
            z -= z.max(1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        """Language and score (its share of the windows' mean probability) of whole texts."""
        if id(self.p) not in _tables:
            _tables.clear()
            _tables[id(self.p)] = self.tables()
        lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        live = [i for i, raw in enumerate(texts) if raw and (_ASCII.search(raw) or _LETTER.search(raw.decode()))] if self.languages else []
        total = np.zeros((len(texts), len(self.languages)))
        group, held = [], 0

        def flush():
            x = np.concatenate([w for _, w in group])
            owner = np.repeat([i for i, _ in group], [len(w) for _, w in group])
            weight = np.count_nonzero(x, axis=1)[:, None]
            np.add.at(total, owner, np.exp(self.scores(x, _tables[id(self.p)])) * weight)

        for i in live:
            w = windows(texts[i])
            for part in np.array_split(w, -(-len(w) // (4 * CHUNK))):
                group.append((i, part))
                held += len(part)
                if held >= 2 * CHUNK:
                    flush()
                    group, held = [], 0
        if group:
            flush()
        for i in live:
            best = int(total[i].argmax())
            lang[i], score[i] = self.languages[best], float(total[i, best] / max(total[i].sum(), 1e-12))
        return lang, score


def training_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang of the labelled documents outside the held-out fold."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold != HELD_OUT)).select(
        "doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))


def train(docs: DataFrame, sample: int = SAMPLE) -> ByteNet:
    """A network fitted to about ``sample`` texts, of each label those with the smallest hashes, WINDOWS windows of each."""
    pieces = [F.expr(f"substring(text, 1 + int(length(text) * {k} / {WINDOWS}), {WINDOW})") for k in range(WINDOWS)]
    rows = label_sample(docs.select("doc_id", F.array(*pieces).alias("pieces"), "lang"), "lang", ["doc_id", "pieces"], sample, LEAST)
    languages = sorted({r["lang"] for r in rows})
    net = ByteNet(languages)
    raw = [(p.encode()[:WINDOW], languages.index(r["lang"])) for r in rows for p in r["pieces"] if len(p) >= 16]
    if len(languages) > 1 and raw:
        net.fit(np.concatenate([windows(p) for p, _ in raw]), np.array([y for _, y in raw]))
    return net


def identify(docs: DataFrame, net: ByteNet) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, from its text alone."""
    def fn(batch: pa.RecordBatch):
        lang, score = net.predict(binary_list(batch.column("text")))
        return {"doc_id": batch.column("doc_id"), "lang_pred": lang, "score": score}

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    return map_batches(slim, fn, "doc_id long, lang_pred string, score double").select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def filter_documents(docs: DataFrame, net: ByteNet, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is determined with at least ``min_score``, with all their columns; all rows if no label was learned."""
    if not net.languages:
        return docs
    p = "__llm_"

    def fn(batch: pa.RecordBatch):
        lang, score = net.predict(binary_list(batch.column("text")))
        return {p + "lang": lang, p + "score": score}

    out = with_columns(docs.withColumn("text", F.col("text").cast("string")), fn, f"{p}lang string, {p}score double")
    return out.where((F.col(p + "lang") != UNDETERMINED) & (F.col(p + "score") >= min_score)).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(training_rows(docs)))
