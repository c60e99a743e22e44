"""SentencePiece encoding and decoding by suffix-array matching.

A batch's texts are normalised and cut where no piece can reach across (before a run of word marks, around characters that
occur in no longer piece); the batch's distinct chunks are concatenated into one index text.  Its suffixes are sorted by
their first MAX characters (no piece is longer), every piece of the vocabulary is searched in them by bisection, the ranges
become edges (start, end, piece), and the edges, sorted by position, are relaxed from left to right.

The vocabulary is a BPE one, so relaxation keeps, for each position, the last piece of that prefix's BPE segmentation: an edge may
follow the piece kept at its start only if the two, merged from their characters, come out as these two.  A sequence whose
neighbours all satisfy this is the BPE segmentation of the whole, and there is exactly one for each prefix.
Characters without a piece become their UTF-8 bytes' pieces.

Null text: null ids (0 tokens in the query); empty text: no ids.  Decoding gives the text back, but the word mark itself comes
back as a space (the model reads it as one).  Long texts are indexed in windows of GROUP characters, so memory doesn't follow
a text's length beyond the text and its ids.  Repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import map_batches, with_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of one suffix index; chunks that a worker remembers (twice as many at most) and places of its table of pairs.
GROUP = 1 << 18
REMEMBERED = 300_000
PAIRS = 1 << 20
#: Ids of characters without a piece, inside relaxation: this plus the code point.
RAW = 1 << 24


class Vocabulary:
    """Pieces, merge scores and byte pieces of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes_out = [p.encode() for p in self.pieces]
        self.byte_id = {}
        plain = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_out[i] = bytes([int(p[3:5], 16)])
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes_out[i] = b""
            else:
                plain.append(i)
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.length = {i: len(self.pieces[i]) for i in plain}
        letters = sorted({c for i in plain for c in self.pieces[i]})
        self.single = {p for p in self.score if len(p) == 1}
        self.max = max(map(len, self.score))
        # Characters as dense codes; 0: in no piece.
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1, dtype=np.uint16)
        self.has_piece = np.zeros(0x110000, bool)
        self.has_piece[[ord(c) for c in self.single]] = True
        low, high = (np.zeros((len(plain), self.max, 2), np.uint8) for _ in range(2))
        high += 255
        for k, i in enumerate(plain):
            codes = self.code[[ord(c) for c in self.pieces[i]]]
            low[k, :len(codes)] = high[k, :len(codes)] = _digits(codes)
        self.plain = np.array(plain)
        self.plain_length = np.array([self.length[i] for i in plain])
        self.low, self.high = (x.reshape(len(plain), -1).view(f"S{2 * self.max}").ravel() for x in (low, high))
        joined = "".join(re.escape(c) for c in sorted({c for p in self.score if len(p) > 1 for c in p} - {MARK}))
        marks_lead = not any(MARK in p.lstrip(MARK) for p in self.score)
        self.cut = re.compile(f"{MARK}*[{joined}]+|{MARK}+|." if marks_lead else f"[{MARK}{joined}]+|.", re.S)
        self.pair_keys, self.pair_fits, self.pairs = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool), 0
        # Chunks met since the last turn, and before it.
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """BPE by definition: the best-scored neighbouring pair first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score.get(parts[k] + parts[k + 1], -np.inf), -k) for k in range(len(parts) - 1)))
            if best[0] == -np.inf:
                break
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def piece(self, i: int) -> str:
        return chr(i - RAW) if i >= RAW else self.pieces[i]

    def follows(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may stand after the one before it (-1: it comes first).

        Answers are remembered in an open-addressing table of PAIRS keys, emptied when half full.
        """
        key = (before + 1) * (RAW << 1) + piece
        slot, answer = _slot(key), np.zeros(len(key), bool)
        todo = np.arange(len(key))
        missing = []
        while len(todo):
            found = self.pair_keys[slot]
            hit = found == key[todo]
            answer[todo[hit]] = self.pair_fits[slot[hit]]
            missing.append(todo[found < 0])
            on = ~hit & (found >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (PAIRS - 1)
        missing = np.concatenate(missing) if missing else todo
        if len(missing):
            new, back = np.unique(key[missing], return_inverse=True)
            if 2 * (self.pairs + len(new)) > PAIRS:
                self.pair_keys[:] = -1
                self.pairs = 0
            fits = np.empty(len(new), bool)
            for n, (k, at) in enumerate(zip(new.tolist(), _slot(new).tolist())):
                a, p = k // (RAW << 1) - 1, k % (RAW << 1)
                want = [self.piece(x) for x in (a, p) if x >= 0]
                fits[n] = self.merged("".join(want)) == want
                if 2 * self.pairs < PAIRS:
                    while self.pair_keys[at] >= 0:
                        at = (at + 1) & (PAIRS - 1)
                    self.pair_keys[at], self.pair_fits[at] = k, fits[n]
                    self.pairs += 1
            answer[missing] = fits[back]
        return answer

    def edges(self, points: np.ndarray, start: int, stop: int):
        """(start, end, piece) arrays of all occurrences that start in points[start:stop]."""
        n = stop - start
        codes = np.zeros(n + self.max, np.uint16)
        part = points[start:stop + self.max]
        codes[:len(part)] = self.code[part]
        keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(_digits(codes), self.max, axis=0)[:n].transpose(0, 2, 1))
        keys = keys.reshape(n, -1).view(f"S{2 * self.max}").ravel()
        order = np.argsort(keys)
        keys = keys[order]
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        hit = np.flatnonzero(count)
        first, count = first[hit], count[hit]
        rank = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        begin = order[rank] + start
        piece, length = (np.repeat(x[hit], count) for x in (self.plain, self.plain_length))
        bare = np.flatnonzero(~self.has_piece[points[start:stop]]) + start
        begin = np.concatenate([begin, bare])
        piece = np.concatenate([piece, points[bare].astype(np.int64) + RAW])
        end = begin + np.concatenate([length, np.ones(len(bare), np.int64)])
        return begin, end, piece

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as int32 bytes."""
        # A zero between chunks: no piece holds it.
        points = np.frombuffer("\0".join(chunks).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(c) for c in chunks])
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        place = np.arange(len(points)) - np.repeat(starts, sizes + 1)[:len(points)]
        last = np.full(len(points) + 2, -2, np.int64)
        last[starts] = -1
        for window in range(0, len(points), GROUP):
            begin, end, piece = self.edges(points, window, min(len(points), window + GROUP))
            # In step with each other, all chunks of the window relax their edges by position.
            by = np.argsort(place[begin], kind="stable")
            begin, end, piece = begin[by], end[by], piece[by]
            steps = np.flatnonzero(np.diff(place[begin], prepend=-1))
            for lo, hi in zip(steps, [*steps[1:], len(begin)]):
                open_ = lo + np.flatnonzero((last[end[lo:hi]] == -2) & (last[begin[lo:hi]] > -2))
                good = open_[self.follows(last[begin[open_]], piece[open_])]
                last[end[good]] = piece[good]
        last = last.tolist()
        out = []
        for s, n in zip(starts.tolist(), sizes.tolist()):
            ids, e = [], s + n
            while e > s:
                p = last[e]
                if p >= RAW:
                    ids.extend(self.byte_id[x] for x in reversed(chr(p - RAW).encode()))
                    e -= 1
                else:
                    ids.append(p)
                    e -= self.length[p]
            ids.reverse()
            out.append(array("i", ids).tobytes())
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of every text of a batch."""
        cut = [None if t is None else self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.ids) > REMEMBERED:
            self.old, self.ids = self.ids, {}
        wanted = {c for chunks in cut if chunks for c in chunks if c not in self.ids}
        self.ids.update((c, self.old[c]) for c in wanted if c in self.old)
        held, size = [], 0
        for c in wanted:
            if c not in self.old:
                held.append(c)
                size += len(c) + 1
                if size >= GROUP:
                    self.ids.update(zip(held, self.encode_chunks(held)))
                    held, size = [], 0
        if held:
            self.ids.update(zip(held, self.encode_chunks(held)))
        known = self.ids.__getitem__
        return [None if chunks is None else np.frombuffer(b"".join(map(known, chunks)), np.int32) for chunks in cut]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes_out.__getitem__, ids.tolist())).decode(errors="replace").replace(MARK, " ")
        return text.removeprefix(" ")


def _slot(key: np.ndarray) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - PAIRS.bit_length())).astype(np.int64)


def _digits(codes: np.ndarray) -> np.ndarray:
    """Codes as two bytes that are never 0 nor 255, in the codes' order."""
    return np.stack([codes // 250 + 1, codes % 250 + 1], axis=-1).astype(np.uint8)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """All columns of ``docs`` with input_ids (array<int>) in place of the text and of any column named input_ids."""
    def fn(batch: pa.RecordBatch):
        return {"input_ids": vocabulary(model).encode(batch.column("text").to_pylist())}

    return with_columns(docs.drop("input_ids").withColumn("text", F.col("text").cast("string")), fn, "input_ids array<int>").drop("text")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """All columns of ``encoded`` with the text of input_ids in place of them and of any column named text."""
    def fn(batch: pa.RecordBatch):
        v = vocabulary(model)
        return {"text": [None if x is None else v.decode(np.array(x, np.int32)) for x in batch.column("input_ids").to_pylist()]}

    return with_columns(encoded.drop("text"), fn, "text string").drop("input_ids")


def encoding_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian int32), round_trip (decoding gives the text) of every document."""
    def fn(batch: pa.RecordBatch):
        v, texts = vocabulary(model), batch.column("text").to_pylist()
        ids = v.encode(texts)
        return {"doc_id": batch.column("doc_id"), "n_tokens": [0 if x is None else len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(b"" if x is None else x.tobytes()).hexdigest() for x in ids],
                "round_trip": [x is None or v.decode(x) == t.replace(MARK, " ") for t, x in zip(texts, ids)]}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn,
                       "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean")


def query(spark, sf_dir: str) -> DataFrame:
    return encoding_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
