"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The words of the vocabulary's pattern are located without regular expressions.  A batch's texts are one array of code points; a class
array turns these into symbols (letter, number, other, white space, apostrophe of a contraction, each refined by what follows), and the
pattern is an automaton over symbols that tells before which characters a word begins.  The symbol of a character is a
function from states to states; composition is associative, so the states of all characters come from a scan: blocks of
SPAN characters are composed side by side, their totals are scanned in the same way, and each block is composed with what
precedes it.  The functions that occur form a small monoid, held as a table of compositions.

The words are slices of the UTF-8 bytes.  Byte pairs of a word are merged by rank, lowest first and leftmost among equals, once for each word that
a worker remembers.  Each token keeps the byte offset at which it ends, by which texts are decoded and any token is found in its text.

Null text is treated as empty and has no ids; special tokens don't exist, so their strings are ordinary text.  Decoding gives the exact
bytes; ids outside the vocabulary add none.  Repeated rows are encoded alike; an empty table gives an empty result.  Columns of the
input named like a result are replaced by it.  Texts are worked on GROUP characters at a time, a longer one alone: memory
is about 20 bytes a character of the longest text, and its ids.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import map_batches, with_columns

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Characters worked on at once, words sliced at once, characters of a block of the scan.
GROUP, SLICES, SPAN = 1 << 20, 1 << 17, 64
#: Words that a worker remembers (twice as many at most), and bytes of the longest of them.
REMEMBERED, WORD_BYTES = 1 << 18, 256
#: Bytes up to which a word's lowest rank is looked for anew after each merge; a rank above all.
SHORT, NEVER = 48, 1 << 40

# ------------------------------------------------------------- the automaton
#: Symbols.  CONTRACTION1 and 2: apostrophe before one or two letters of a contraction; SPACE_LAST, WHITE_LAST: before a
#: character that is not white space; WHITE: before white space or the text's end; END: between texts.
END, LETTER, NUMBER, OTHER, CONTRACTION1, CONTRACTION2, SPACE_LAST, WHITE_LAST, WHITE = range(9)
#: States.  NEW: the next character begins a word; the IN_s: within a run; JOIN: behind a space that belongs to the next run;
#: LEFT1, LEFT2: that many letters of a contraction are left.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, JOIN, LEFT1, LEFT2 = STATES = range(8)
_RUNS = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state behind a character, and whether a word begins before it."""
    if symbol == LETTER and state in (LEFT1, LEFT2):
        return (NEW if state == LEFT1 else LEFT1), False
    if symbol in _RUNS:
        return _RUNS[symbol], state not in (JOIN, _RUNS[symbol])
    if symbol in (CONTRACTION1, CONTRACTION2):
        if state in (JOIN, IN_OTHERS):
            return IN_OTHERS, False
        return (LEFT1 if symbol == CONTRACTION1 else LEFT2), True
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    return (JOIN if symbol == SPACE_LAST else NEW), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, compositions of elements, state that each element leads to from NEW, word begins [state, symbol])."""
    functions = [tuple(STATES)] + [tuple(step(s, x)[0] for s in STATES) for x in range(WHITE + 1)]
    place = {}
    for f in functions:
        place.setdefault(f, len(place))
    elements = list(place)
    for f in elements:  # grows: closed under composition
        for g in functions:
            h = tuple(g[s] for s in f)
            if h not in place:
                place[h] = len(place)
                elements.append(h)
    compose = np.array([[place[tuple(g[s] for s in f)] for g in elements] for f in elements], np.uint16)
    return (np.array([place[f] for f in functions[1:]], np.uint16), compose, np.array([f[NEW] for f in elements], np.uint8),
            np.array([[step(s, x)[1] for x in range(WHITE + 1)] for s in STATES]))


def scanned(elements: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Compositions of all prefixes; element 0 is the identity."""
    n, flat, m = len(elements), compose.ravel(), len(compose)
    blocks = -(-n // SPAN)
    x = np.zeros((blocks, SPAN), np.uint16)
    x.ravel()[:n] = elements
    x = np.ascontiguousarray(x.T)
    for k in range(1, SPAN):
        x[k] = flat[x[k - 1].astype(np.intp) * m + x[k]]
    if blocks > 1:
        before = np.zeros(blocks, np.intp)
        before[1:] = scanned(x[-1], compose)[:-1]
        for k in range(SPAN):
            x[k] = flat[before * m + x[k]]
    return x.T.ravel()[:n]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, WHITE or OTHER for every code point, as the pattern's own engine has them."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = np.full(0x110000, OTHER, np.uint8)
    for symbol, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        engine = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        out[[ord(c) for c in engine.decode(engine.encode_ordinary(every))]] = symbol
    return out


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends``: places of the separators behind each text."""
    kind = classes()[points]
    kind[ends] = END
    followed = np.zeros(len(kind), bool)  # by a character other than white space
    followed[:-1] = (kind[1:] != WHITE) & (kind[1:] != END)
    last = (kind == WHITE) & followed
    out = kind.copy()
    out[last] = np.where(points[last] == ord(" "), SPACE_LAST, WHITE_LAST)
    quotes = np.flatnonzero((points == ord("'")) & (kind == OTHER))
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    padded[ends] = 0
    one, two = padded[quotes + 1], padded[quotes + 2]
    out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = CONTRACTION1
    pairs = np.isin(one.astype(np.int64) << 21 | two, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")])
    out[quotes[pairs]] = CONTRACTION2
    return out


def word_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which a word begins, the separators among them."""
    element, compose, state, begins = automaton()
    symbol = symbols(points, ends)
    behind = state[scanned(element[symbol], compose)]
    before = np.full(len(points), NEW, np.uint8)
    before[1:] = behind[:-1]
    return np.flatnonzero(begins[before, symbol] | (symbol == END))


# ------------------------------------------------------------------ merging
class ByteBpe(dict):
    """A rank file's vocabulary; as a dict, the words it remembers with their ids as int32."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values(), default=-1) + 2  # the last one: any id outside
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.older: dict[bytes, bytes] = {}
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.merged(word) if len(word) > SHORT else self.merged_short(word)).tobytes()
        if len(word) <= WORD_BYTES:
            self[word] = ids
        return ids

    def merged_short(self, word: bytes) -> list[int]:
        """Ids of a word by looking for the lowest of the neighbours' ranks after each merge: quickest for a few bytes."""
        rank = self.ranks.get
        whole = rank(word)
        if whole is not None:
            return [whole]
        cuts = list(range(len(word) + 1))
        pairs = [rank(word[i:i + 2], NEVER) for i in range(len(word) - 1)]
        while pairs:
            lowest = min(pairs)
            if lowest == NEVER:
                break
            i = pairs.index(lowest)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(word[cuts[i]:cuts[i + 2]], NEVER)
            if i:
                pairs[i - 1] = rank(word[cuts[i - 1]:cuts[i + 1]], NEVER)
        return [self.ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]

    def merged(self, word: bytes) -> list[int]:
        """The same by a heap of the neighbours' ranks, so that a long word costs n log n."""
        ranks, n = self.ranks, len(word)
        if word in ranks:
            return [ranks[word]]
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(n - 1) if word[i:i + 2] in ranks]
        heapify(heap)

        def offer(i: int, end: int) -> None:
            rank = ranks.get(word[i:end])
            if rank is not None:
                heappush(heap, (rank, i, end))

        while heap:
            _, i, end = heappop(heap)
            middle = after[i]
            if middle is None or middle >= n or after[middle] != end:
                continue  # one of the two has been merged since
            after[i], after[middle], before[end] = end, None, i
            if end < n:
                offer(i, after[end])
            if before[i] >= 0:
                offer(before[i], end)
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:after[i]]])
            i = after[i]
        return out

    # ------------------------------------------------------------- texts
    def _group(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of all words of the texts one after the other (in parts), and the number of UTF-8 bytes of each text."""
        joined = "\n".join(texts) + "\n"
        raw = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        sizes = (1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)).astype(np.uint8)
        offsets = np.zeros(len(points) + 1, np.int64 if len(raw) >> 31 else np.int32)
        np.cumsum(sizes, out=offsets[1:])
        starts = word_starts(points, ends)
        cut = np.append(offsets[starts], len(raw))
        words = np.flatnonzero(~np.isin(starts, ends, assume_unique=True))
        parts = []
        for k in range(0, len(words), SLICES):
            some = words[k:k + SLICES]
            slices = map(raw.__getitem__, map(slice, cut[some].tolist(), cut[some + 1].tolist()))
            parts.append(np.frombuffer(b"".join(map(self.__getitem__, slices)), np.int32))
            if len(self) > REMEMBERED:
                self.older = dict(self)
                self.clear()
        return parts, np.diff(offsets[ends], prepend=-1) - 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, byte offset in its text at which each token ends, where each text's ids begin and the last's end)."""
        ids, sizes, group, n = [], [], [], 0
        for k, text in enumerate(texts):
            group.append(text)
            n += len(text) + 1
            if n >= GROUP or k == len(texts) - 1:
                parts, bytes_ = self._group(group)
                ids += parts
                sizes.append(bytes_)
                group, n = [], 0
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        ends = np.cumsum(self.length[flat])
        text_ends = np.cumsum(np.concatenate([np.empty(0, np.int64), *sizes]))
        last = np.searchsorted(ends, text_ends, side="right")
        first = np.concatenate([[0], last])
        token_ends = ends - np.repeat(np.concatenate([[0], text_ends[:-1]])[:len(last)], np.diff(first))
        return flat, token_ends, first

    def decode(self, ids: np.ndarray, token_ends: np.ndarray | None = None) -> bytes:
        """The bytes of ids, placed by the offsets at which their tokens end if these were kept."""
        known = (ids >= 0) & (ids < len(self.length) - 1)
        ids = np.where(known, ids, len(self.length) - 1)
        length = self.length[ids]
        if token_ends is None:
            token_ends = np.cumsum(length)
        source = np.repeat(self.start[ids] - (token_ends - length), length)
        return self.blob[source + np.arange(len(source))].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


# ---------------------------------------------------------------- documents
def encode_documents(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """The columns of ``docs`` with input_ids and token_ends (byte offset in the text at which each token ends) in place of text."""
    def fn(batch: pa.RecordBatch):
        ids, ends, first = vocabulary(ranks).encode([t or "" for t in batch.column("text").to_pylist()])
        first = pa.array(first, pa.int32())
        return {"input_ids": pa.ListArray.from_arrays(first, pa.array(ids, pa.int32())),
                "token_ends": pa.ListArray.from_arrays(first, pa.array(ends, pa.int32()))}

    rows = docs.drop("input_ids", "token_ends").withColumn("text", F.col("text").cast("string"))
    return with_columns(rows, fn, "input_ids array<int>, token_ends array<int>").drop("text")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of its rows (null: empty)."""
    size = np.array([0 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])


def decode_documents(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """The columns of ``encoded`` with text in place of input_ids and token_ends (which may be missing)."""
    kept = "token_ends" in encoded.columns

    def fn(batch: pa.RecordBatch):
        v = vocabulary(ranks)
        ids, first = _lists(batch.column("input_ids"))
        ends = _lists(batch.column("token_ends"))[0] if kept else None
        return {"text": [v.decode(ids[a:b], None if ends is None else ends[a:b]).decode(errors="replace") for a, b in zip(first, first[1:])]}

    return with_columns(encoded.drop("text"), fn, "text string").drop("input_ids", "token_ends")


def round_trip_digests(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the bytes that the ids decode to)."""
    def fn(batch: pa.RecordBatch):
        v = vocabulary(ranks)
        (ids, first), (ends, _) = _lists(batch.column("input_ids")), _lists(batch.column("token_ends"))
        spans = list(zip(first.tolist(), first[1:].tolist()))
        return {"doc_id": batch.column("doc_id"), "n_tokens": np.diff(first),
                "ids_sha256": [hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest() for a, b in spans],
                "decoded_sha256": [hashlib.sha256(v.decode(ids[a:b], ends[a:b])).hexdigest() for a, b in spans]}

    return map_batches(encoded.select(F.col("doc_id").cast("long"), "input_ids", "token_ends"), fn,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip_digests(encode_documents(docs.select("doc_id", "text")))
