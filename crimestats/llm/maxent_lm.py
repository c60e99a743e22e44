"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The training documents' words are counted over all of them.  The most frequent words form HEAD_CLASSES classes of CLASS_WORDS words;
all others belong to TAIL_CLASSES classes by their last two bytes.  log P(word | history) is log P(class | history), a softmax over
hashed features of the history (bias, previous word, the two before, and the one before the last alone: a skip), plus, in
a head class, a second softmax over its words with features of its own, and in a tail class the smoothed share of the word's count
(each class keeps one share for unseen words).  The history is seen through symbols: frequent words, else the word's class.

Training goes over every training document once, in ROUNDS: each task takes gradient steps on its documents from the last round's
weights, and the tasks' changes are averaged by their tokens, in two levels.  Texts are scored in sparse numpy batches.  Counts of
words beyond the HOT most frequent ones are never broadcast: their occurrences meet their counts in a join.

A text's tokens are its words (A-Z lower-cased) and one end.  Null text counts as empty (the end alone).  A null doc_id is in no
fold 0: its row trains.  Repeated rows count and are scored row by row.  Without training documents N and V are 0.
Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crimestats.llm.common import binary_list, scratch, small_batches, staged

#: Production parameters.
FOLDS, HELD_OUT = 10, 0
END = b"\n"
HEAD_CLASSES, CLASS_WORDS, TAIL_CLASSES = 8, 32, 24
HEAD = HEAD_CLASSES * CLASS_WORDS
CLASSES = HEAD_CLASSES + TAIL_CLASSES
#: Words whose counts are broadcast (of at most HOT_BYTES bytes each) and words that the history shows as themselves.
HOT, HOT_BYTES, SYMBOLS = 1 << 17, 64, 4096
#: Hashed weight rows of the two softmaxes.
ROWS, WORD_ROWS = 1 << 13, 1 << 12
ROUNDS, RATE, BATCH, SLICE = 2, 0.3, 4096, 4096
ALPHA = 0.1
TASK_GROUPS = 32
#: Bytes of split words that a task holds before it counts them, and distinct words beyond which it gives the counts out.
HELD_BYTES, HELD_WORDS = 32 << 20, 200_000


def split(texts: list) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts (bytes or null), one after another, and how many each text has; the ends are left out."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string())))
    flat = lists.flatten().view(pa.large_binary())
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    # Space at a text's start or end leaves an empty piece there.
    full = pc.binary_length(flat).to_numpy() > 0
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        flat = flat.filter(pa.array(full))
    return flat, sizes


def _bytes(column: pa.Array) -> list[bytes]:
    return column.to_numpy(zero_copy_only=False).tolist()


def tail_class(word: bytes) -> int:
    return HEAD_CLASSES + zlib.crc32(word[-2:]) % TAIL_CLASSES


def _docs(docs: DataFrame) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.coalesce(fold, F.lit(1)).alias("fold"), F.col("text").cast("string"))


COUNTS = pa.schema([("word", pa.binary()), ("c", pa.int64())])


def count_words(batches, held_bytes: int = HELD_BYTES, held_words: int = HELD_WORDS):
    """word, c of the tokens of a task's batches; a word occurs again only after more than ``held_words`` were given out."""
    pieces, size, ends, held = [], 0, 0, COUNTS.empty_table()

    def counted() -> pa.Table:
        each = pa.chunked_array(pieces, pa.large_binary()).value_counts()
        new = pa.table([each.field(0), each.field(1)], names=COUNTS.names).cast(COUNTS)
        if not len(held):
            return new
        both = pa.concat_tables([held, new]).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return both.rename_columns(COUNTS.names).cast(COUNTS)

    for batch in batches:
        flat, lengths = split(binary_list(batch.column("text")))
        pieces.append(flat)
        size += flat.nbytes
        ends += len(lengths)
        if size > held_bytes:
            held = counted()
            pieces.clear()
            size = 0
            if len(held) > held_words:
                yield from held.to_batches()
                held = COUNTS.empty_table()
    yield from counted().to_batches()
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends])], schema=COUNTS)


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c: counts of all tokens of the training documents; combined in the tasks before the shuffle."""
    small_batches(docs.sparkSession)
    return _docs(docs).where("NOT held_out").select("text").mapInArrow(count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Lexicon:
    """The hot words in rank order (the end first), their counts and classes, and the tail classes' sums."""

    def __init__(self, hot: list[tuple[bytes, int]], tokens: int, types: int, tail: dict[int, tuple[int, int]]):
        self.key = uuid.uuid4().hex
        self.words = [w for w, _ in hot]
        self.count = np.array([c for _, c in hot] or [0], np.int64)
        self.tokens, self.types = tokens, types
        head = min(HEAD, len(hot))
        self.cls = np.array([i // CLASS_WORDS if i < head else tail_class(w) for i, w in enumerate(self.words)] or [HEAD_CLASSES], np.int64)
        self.base = np.log10((self.count + ALPHA) / (tokens + ALPHA * (types + 1)))
        self.scale = {k: n + ALPHA * (v + 1) for k, (n, v) in tail.items()}
        self.share = np.array([0.0 if i < head else math.log10((c + ALPHA) / self.tail_scale(int(k))) for i, (c, k) in enumerate(zip(self.count.tolist(), self.cls))])
        self.head = head

    def tail_scale(self, k: int) -> float:
        return self.scale.get(k, ALPHA)

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def lexicon(vocabulary: DataFrame) -> Lexicon:
    """From the word counts: the HOT most frequent short words (a bounded collect) and sums of everything else by class."""
    # Words by sixteenths of the count's logarithm: the highest of them that hold fewer than HOT words together are collected.
    step = F.floor(F.log2("c") * 16).cast("int")
    short = vocabulary.where((F.length("word") <= HOT_BYTES) & (F.col("word") != F.lit(END)) & (F.col("c") > 0)).withColumn("step", step)
    room, least = HOT - 1, None
    for r in sorted(short.groupBy("step").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    found = [] if least is None else short.where(F.col("step") >= least).select("word", "c").collect()
    hot = sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))
    total = vocabulary.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))).alias("ends")).first()
    hot = [(END, total["ends"] or 0), *hot]
    kind = (F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(TAIL_CLASSES)) + HEAD_CLASSES).cast("int")
    sums = {r["k"]: [r["n"], r["v"]] for r in vocabulary.groupBy(kind.alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    for w, c in hot[:HEAD]:  # the head is in no tail class
        if c:
            k = tail_class(w)
            sums[k] = [sums[k][0] - c, sums[k][1] - 1]
    return Lexicon(hot, total["n"] or 0, total["v"], {k: tuple(v) for k, v in sums.items()})


class Model:
    """Weights of the two softmaxes."""

    def __init__(self, lex: Lexicon):
        self.cls_rows = np.zeros((ROWS, CLASSES), np.float32)
        self.word_rows = np.zeros((WORD_ROWS, CLASS_WORDS), np.float32)
        # Row 0 and rows 0..HEAD_CLASSES-1 are the biases: they start at the counts' logarithms.
        mass = np.zeros(CLASSES)
        for k in range(HEAD_CLASSES):
            own = lex.count[:lex.head][k * CLASS_WORDS:(k + 1) * CLASS_WORDS]
            mass[k] = own.sum() if len(own) else 0
            self.word_rows[k] = -30
            self.word_rows[k, :len(own)] = np.log(own + ALPHA)
        for k in range(HEAD_CLASSES, CLASSES):
            mass[k] = lex.tail_scale(k)
        self.cls_rows[0] = np.where(mass > 0, np.log(np.maximum(mass, 1e-9)), -30)

    def pack(self) -> bytes:
        return zlib.compress(np.concatenate([self.cls_rows.ravel(), self.word_rows.ravel()]).astype(np.float16).tobytes(), 1)

    def add(self, change: np.ndarray) -> None:
        cut = self.cls_rows.size
        self.cls_rows += change[:cut].reshape(self.cls_rows.shape)
        self.word_rows += change[cut:].reshape(self.word_rows.shape)


def _mix(*parts) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(31))
    return h


def encode(texts: list, lex: Lexicon, index: dict):
    """ids (-1: not hot), classes, symbols, numbers of the texts' tokens, places of those that aren't hot, and their words.

    A word is looked up once however often it occurs; the words that aren't hot are given as all distinct words and indexes in them.
    """
    flat, lengths = split(texts)
    coded = flat.dictionary_encode()
    distinct = [*_bytes(coded.dictionary), END]
    sizes = lengths + 1
    inner = np.ones(sizes.sum(), bool)
    inner[np.cumsum(sizes) - 1] = False
    code = np.full(len(inner), len(distinct) - 1, np.int64)
    code[inner] = coded.indices.to_numpy()
    get = index.get
    ids = np.array([get(w, -1) for w in distinct], np.int64)
    cls = lex.cls[np.maximum(ids, 0)]
    rare = np.flatnonzero(ids < 0)
    cls[rare] = [tail_class(distinct[i]) for i in rare.tolist()]
    symbol = np.where((ids >= 0) & (ids < SYMBOLS), ids, SYMBOLS + cls)
    ids = ids[code]
    cold = np.flatnonzero(ids < 0)
    return ids, cls[code], symbol[code], sizes, cold, (distinct, code[cold])


def histories(symbol: np.ndarray, sizes: np.ndarray):
    """Feature rows of each token's history: class softmax (n x 4) and, without the word class, word softmax parts."""
    start = SYMBOLS + CLASSES
    place = np.arange(len(symbol)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    one = np.where(place >= 1, np.roll(symbol, 1), start)
    two = np.where(place >= 2, np.roll(symbol, 2), start)
    span = np.uint64(ROWS - 1)
    rows = [np.zeros(len(symbol), np.int64), *((_mix(*f) % span + np.uint64(1)).astype(np.int64) for f in ((1, one), (2, one, two), (3, two)))]
    return np.stack(rows, 1), one, two


def word_rows(one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> np.ndarray:
    span = np.uint64(WORD_ROWS - HEAD_CLASSES)
    return np.stack([cls, *((_mix(*f) % span).astype(np.int64) + HEAD_CLASSES for f in ((4, one, cls), (5, two, cls)))], 1)


def _one_row(column: np.ndarray) -> bool:
    """Whether all tokens share a row, as they do the class softmax's bias."""
    return bool((column == column[:1]).all())


def _tops(z: np.ndarray) -> np.ndarray:
    """Each row's maximum, in a column: halves are compared first, then columns, as numpy reduces short rows slowly."""
    while z.shape[1] > 8 and z.shape[1] % 2 == 0:
        half = z.shape[1] // 2
        z = np.maximum(z[:, :half], z[:, half:])
    return np.ascontiguousarray(z.T).max(0)[:, None]


def _scaled(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's summed rows less their maximum, and the logarithm of the sum of their exponentials."""
    z = weights.take(rows[:, 1], axis=0, mode="clip")
    for k in range(2, rows.shape[1]):
        z += weights.take(rows[:, k], axis=0, mode="clip")
    z += weights[rows[:1, 0]] if _one_row(rows[:, 0]) else weights.take(rows[:, 0], axis=0, mode="clip")
    z -= _tops(z)
    return z, np.log(np.exp(z) @ np.ones(z.shape[1], np.float32))


def log_softmax(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z, log_sum = _scaled(rows, weights)
    z -= log_sum[:, None]
    return z


def log_chosen(rows: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``log_softmax`` at one target of each token."""
    z, log_sum = _scaled(rows, weights)
    return z[np.arange(len(z)), target] - log_sum


def _running(d: np.ndarray) -> np.ndarray:
    """Running totals of the rows of d, two columns at a time as the parts of a complex number (the same sums in half the steps)."""
    if d.shape[1] % 2:
        return np.cumsum(d, axis=0)
    return np.cumsum(d.view(np.complex64), axis=0).view(np.float32)


def _step(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One AdaGrad step on a batch: the gradient of each used row, summed over the batch."""
    d = log_softmax(rows, weights)
    np.exp(d, out=d)
    d[np.arange(len(d)), target] -= 1
    # Column 0 is the bias: one row for all tokens, or one per class.
    for column in rows.T.astype(np.uint16):
        if _one_row(column):
            _add(weights, squares, column[:1].astype(np.intp), d.sum(0, keepdims=True))
            continue
        order = np.argsort(column, kind="stable")
        placed = column[order]
        first = np.flatnonzero(np.diff(placed, prepend=placed[0] ^ 1))
        sums = _running(d.take(order, axis=0, mode="clip")).take(np.append(first[1:], len(order)) - 1, axis=0, mode="clip")
        sums[1:] -= sums[:-1].copy()
        _add(weights, squares, placed[first].astype(np.intp), sums)


def _add(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, g: np.ndarray) -> None:
    """Move the used rows (distinct) against their gradients, which are overwritten."""
    square = squares.take(used, mode="clip")
    square += np.einsum("ij,ij->i", g, g) / g.shape[1]
    squares[used] = square
    g *= RATE
    g /= np.sqrt(square + 1.0)[:, None]
    weights[used] = np.subtract(weights.take(used, axis=0, mode="clip"), g, out=g)


def train(docs: DataFrame, lex: Lexicon) -> Model:
    """ROUNDS over disjoint parts of the training documents; every document is used once."""
    spark = docs.sparkSession
    model = Model(lex)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(lex)
    size = model.cls_rows.size + model.word_rows.size

    def add(table: pa.Table) -> pa.Table:
        total, n = np.zeros(size, np.float32), 0
        for blob, k in zip(table.column("change").to_pylist(), table.column("n").to_pylist()):
            total += np.frombuffer(zlib.decompress(blob), np.float16).astype(np.float32) * k
            n += k
        return pa.table({"task": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64()), "change": pa.array([zlib.compress((total / max(n, 1)).astype(np.float16).tobytes(), 1)], pa.binary())})

    for round_ in range(ROUNDS):
        now = spark.sparkContext.broadcast((model.cls_rows, model.word_rows))

        def run(batches):
            lex = shared.value
            index = worker_index(lex)
            a, b = (x.copy() for x in now.value)
            sa, sb = np.zeros(len(a), np.float32), np.zeros(len(b), np.float32)
            n = 0
            for batch in batches:
                ids, cls, symbol, sizes, _, _ = encode(binary_list(batch.column("text")), lex, index)
                rows, one, two = histories(symbol, sizes)
                for i in range(0, len(ids), BATCH):
                    part = slice(i, i + BATCH)
                    _step(a, sa, rows[part], cls[part])
                    head = np.flatnonzero((ids[part] >= 0) & (ids[part] < lex.head)) + i
                    if len(head):
                        _step(b, sb, word_rows(one[head], two[head], cls[head]), ids[head] % CLASS_WORDS)
                n += len(ids)
            if n:
                change = np.concatenate([(a - now.value[0]).ravel(), (b - now.value[1]).ravel()]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % TASK_GROUPS], pa.int32()), pa.array([n], pa.int64()),
                                                  pa.array([zlib.compress(change.tobytes(), 1)], pa.binary())], names=["task", "n", "change"])

        part = _docs(docs).where(f"NOT held_out AND fold % {ROUNDS} = {round_}").select("text")
        changes = part.mapInArrow(run, "task int, n long, change binary")
        kind = "task int, n long, change binary"
        once = changes.groupBy("task").applyInArrow(add, kind).groupBy("task").applyInArrow(add, kind)
        for r in once.collect():
            model.add(np.frombuffer(zlib.decompress(r["change"]), np.float16).astype(np.float32))
    return model


_INDEX: dict = {}


def worker_index(lex: Lexicon) -> dict[bytes, int]:
    if lex.key not in _INDEX:
        _INDEX.clear()
        _INDEX[lex.key] = lex.index()
    return _INDEX[lex.key]


def log10_known(ids, cls, rows, one, two, lex: Lexicon, model) -> np.ndarray:
    """log10 P of each token, but for a token that isn't hot only its class's part."""
    out = np.empty(len(ids))
    for i in range(0, len(ids), SLICE):
        part = slice(i, i + SLICE)
        out[part] = log_chosen(rows[part], model[0], cls[part])
        head = np.flatnonzero((ids[part] >= 0) & (ids[part] < lex.head)) + i
        if len(head):
            out[head] += log_chosen(word_rows(one[head], two[head], cls[head]), model[1], ids[head] % CLASS_WORDS)
    out /= math.log(10)
    return out + np.where(ids >= lex.head, lex.share[np.maximum(ids, 0)], 0)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    with scratch(spark) as tables:
        vocabulary = tables.table(word_counts(docs), "vocabulary")
        lex = lexicon(vocabulary)
        model = train(docs, lex)
        shared, weights = spark.sparkContext.broadcast(lex), spark.sparkContext.broadcast((model.cls_rows, model.word_rows))
        schema = T.StructType.fromDDL("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
                                      "word binary, k int, tf int")
        arrow = to_arrow_schema(schema)

        def run(batches):
            lex, count = shared.value, 0
            index = worker_index(lex)
            first = TaskContext.get().partitionId() << 36
            for batch in batches:
                ids, cls, symbol, sizes, cold, (distinct, code) = encode(binary_list(batch.column("text")), lex, index)
                rows, one, two = histories(symbol, sizes)
                p = log10_known(ids, cls, rows, one, two, lex, weights.value)
                at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                known = (ids >= 0) & (lex.count[np.maximum(ids, 0)] > 0)
                base = np.where(ids >= 0, lex.base[np.maximum(ids, 0)], 0)
                row = first + count + np.arange(len(sizes))
                count += len(sizes)
                columns = {"row": row, "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": sizes,
                           "n_known": np.add.reduceat(known.astype(np.int64), at), "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(p, at)}
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(sizes), f.type) for f in arrow], schema=arrow)
                if len(cold):
                    owner = np.repeat(np.arange(len(sizes)), sizes)[cold]
                    pairs, place, times = np.unique(owner * len(distinct) + code, return_index=True, return_counts=True)
                    columns = {"row": row[owner[place]], "word": [distinct[i] for i in code[place].tolist()], "k": cls[cold[place]], "tf": times}
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(pairs), f.type) for f in arrow], schema=arrow)

        parts = tables.table(_docs(docs).select("doc_id", "held_out", "text").mapInArrow(run, schema), "parts")
        seen = F.coalesce("c", F.lit(0)) + ALPHA
        scale = F.element_at(F.array(*(F.lit(lex.tail_scale(k)) for k in range(HEAD_CLASSES, CLASSES))), F.col("k") - HEAD_CLASSES + 1)
        terms = parts.where("word IS NOT NULL").select("row", "word", "k", "tf").join(vocabulary, "word", "left").select(
            "row", (F.col("tf") * F.log10(seen / F.lit(lex.tokens + ALPHA * (lex.types + 1)))).alias("b"), (F.col("tf") * F.log10(seen / scale)).alias("s"),
            F.when(F.col("c") > 0, F.col("tf")).otherwise(0).alias("n"))
        terms = terms.groupBy("row").agg(*(F.sum(x).alias(x) for x in "bsn"))
        zero = lambda x: F.coalesce(x, F.lit(0))
        out = parts.where("n_tokens IS NOT NULL").join(terms, "row", "left").select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("n")).alias("n_known"), F.lit(lex.tokens).cast("long").alias("train_tokens"),
            (F.col("base_score") + zero("b")).alias("base_score"), (F.col("score") + zero("s")).alias("score"))
        return staged(out)


def query(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
