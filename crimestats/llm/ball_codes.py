"""Vector code compression by exact ball k-means over the vectors' parts.

Components become integers, vectors are cut into equal parts, and each part position has its own small codebook, improved by
Lloyd rounds.  In a round every entry with its parts is a ball around the moved entry, its radius the largest distance of
a part that it had:

* an entry is a neighbour of the ball if it lies within twice the radius: no other can take a part from it;
* parts nearer to their own entry than half the way to the nearest neighbour are the stable core and skip work;
* the others lie in annular rings: a part is compared with the neighbours within twice its own distance, nearest first.

All of it is integer arithmetic on squared distances (4 * own >= between), so ties are met exactly and go to the lower index; the
result is that of comparing with all entries.  A task works on chunks of CHUNK vectors and their balls; it keeps the parts' last entries
beside them, in a table of the shared folder written anew each round, and adds up its parts by entry.  Spark sums these (one row per part,
entry and position from each task); the driver holds the codebooks only, parts * entries * width integers.

Rows whose vector is null, empty or holds null or non-finite components are dropped, as are rows whose length is not that of the first
kept vector (by vec_id, nulls last).  A length that is no multiple of the parts is filled up with zeros.  With fewer kept
vectors than entries the codebooks have as many entries as there are vectors; equal vec_ids are ordered by their vectors.  Components beyond what
64-bit squared distances hold (for parts of 8: 2^28 in magnitude) count as that bound.  Repeated rows are coded alike, an
empty table gives an empty result, other columns than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crimestats.llm.common import join_few, scratch, small_batches, staged


class Shape(NamedTuple):
    """Parts of a vector, entries of a codebook (at most 256), rounds, and the factor before the floor."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


#: Vectors that a task works on at once.
CHUNK = 8192
STATE = "vec_id long, label string, x binary, code binary, error long, slot int, total long"


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text), v: rows whose vector is whole and finite."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), v.alias("v"))
    return rows.where(F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (F.size("v") > 0), F.lit(False)))


def integers(vectors: list, width: int, shape: Shape) -> np.ndarray:
    """Rows x parts x width integers of vectors of one length."""
    x = np.array(vectors, np.float64).reshape(len(vectors), -1)
    most = isqrt((1 << 63) // max(1, width)) // 4
    x = np.clip(np.floor(x * shape.scale), -most, most).astype(np.int64)
    out = np.zeros((len(vectors), shape.parts * width), np.int64)
    out[:, :x.shape[1]] = x
    return out.reshape(len(vectors), shape.parts, width)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part (rows x parts x width) by comparing with every entry: the first round."""
    best = np.zeros(x.shape[:2], np.int64)
    least = ((x - books[:, 0]) ** 2).sum(-1)
    for k in range(1, books.shape[1]):
        d = ((x - books[:, k]) ** 2).sum(-1)
        nearer = d < least
        best[nearer], least[nearer] = k, d[nearer]
    return best, least


class Balls:
    """The moved entries of all codebooks, each with the others by distance."""

    def __init__(self, books: np.ndarray):
        parts, entries, self.width = books.shape
        self.entries, self.flat = entries, books.reshape(parts * entries, self.width)
        between = ((books[:, :, None] - books[:, None]) ** 2).sum(-1)
        between[:, np.arange(entries), np.arange(entries)] = -1
        order = np.argsort(between, axis=-1, kind="stable")[:, :, 1:]
        #: Of each ball: its neighbours, nearest first, and the least own distance from which a part must look at each.
        self.other = order.reshape(parts * entries, entries - 1)
        self.ring = -(-np.take_along_axis(between, order, -1) // 4).reshape(parts * entries, entries - 1)

    def reassign(self, x: np.ndarray, had: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part, given the entry it had."""
        rows, parts = had.shape
        points, first = x.reshape(-1, self.width), np.tile(np.arange(parts) * self.entries, rows)
        ball = had.reshape(-1) + first
        own = ((points - self.flat[ball]) ** 2).sum(-1)
        best, least = had.reshape(-1).copy(), own.copy()
        radius = np.zeros(len(self.flat), np.int64)
        np.maximum.at(radius, ball, own)
        neighbours = (self.ring <= radius[:, None]).sum(1)
        outside = np.arange(len(points))
        for k in range(int(neighbours.max(initial=0))):
            outside = outside[(neighbours[ball[outside]] > k)]
            outside = outside[self.ring[ball[outside], k] <= own[outside]]
            if not len(outside):
                break
            other = self.other[ball[outside], k]
            d = ((points[outside] - self.flat[first[outside] + other]) ** 2).sum(-1)
            wins = (d < least[outside]) | ((d == least[outside]) & (other < best[outside]))
            best[outside[wins]], least[outside[wins]] = other[wins], d[wins]
        return best.reshape(rows, parts), least.reshape(rows, parts)


def _slots(books: np.ndarray) -> int:
    """Sums of a task: per part and entry one for each position and the number of parts."""
    return books.shape[0] * books.shape[1] * (books.shape[2] + 1)


def _chunks(batches, size: int):
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def assigned(rows: DataFrame, books: np.ndarray, shape: Shape) -> DataFrame:
    """STATE rows: of every vector its integers, entries and error; of every task the sums of its parts by slot.

    ``rows``: kept vectors (the first round, columns of ``kept_vectors``) or the last round's vector rows."""
    spark = rows.sparkSession
    small_batches(spark)
    arrow = to_arrow_schema(T.StructType.fromDDL(STATE))
    parts, entries, width = books.shape
    held = spark.sparkContext.broadcast(books)
    first = "v" in rows.columns

    def batch_of(n, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def run(batches):
        books = held.value
        balls = Balls(books)
        totals = np.zeros((parts * entries, width + 1), np.int64)
        for table in _chunks((b for b in batches if b.num_rows), CHUNK):
            if first:
                x = integers(table.column("v").to_pylist(), width, shape)
                code, error = nearest(x, books)
            else:
                x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.int32).astype(np.int64).reshape(-1, parts, width)
                had = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).astype(np.int64).reshape(-1, parts)
                code, error = balls.reassign(x, had)
            ball = (code + np.arange(parts) * entries).ravel()
            order = np.argsort(ball, kind="stable")
            starts = np.flatnonzero(np.diff(ball[order], prepend=-1))
            totals[ball[order[starts]], :width] += np.add.reduceat(x.reshape(-1, width)[order], starts)
            totals[:, width] += np.bincount(ball, minlength=parts * entries)
            yield batch_of(len(x), vec_id=table.column("vec_id").combine_chunks(), label=table.column("label").combine_chunks(),
                           x=[v.tobytes() for v in x.astype(np.int32)], code=[v.tobytes() for v in code.astype(np.uint8)], error=error.sum(1))
        slots = np.flatnonzero(np.repeat(totals[:, width] > 0, width + 1))
        if len(slots):
            yield batch_of(len(slots), slot=slots.astype(np.int32), total=totals.ravel()[slots])

    return rows.mapInArrow(run, STATE)


def moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floors of the parts' means; entries without a part stay."""
    sums = state.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("total").alias("total"))
    flat = [0] * _slots(books)
    for r in sums.collect():  # parts * entries * (width + 1) rows at most
        flat[r["slot"]] = r["total"]
    totals = np.array(flat, np.int64).reshape(*books.shape[:2], -1)
    count = totals[:, :, -1:]
    return np.where(count > 0, totals[:, :, :-1] // np.maximum(count, 1), books)


def first_books(rows: DataFrame, shape: Shape) -> np.ndarray | None:
    """The parts of the vectors of the smallest vec_ids; None if there is no vector."""
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    if not head:
        return None
    length = len(head[0]["v"])
    smallest = rows.where(F.size("v") == length).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(shape.entries).collect()
    return integers([r["v"] for r in smallest], -(-length // shape.parts), shape).transpose(1, 0, 2)


def compress(vectors: DataFrame, shape: Shape = Shape()) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label (as text), code (a byte per part), error (squared distance summed over parts) of every kept vector, and the
    codebooks (parts x entries x width)."""
    spark: SparkSession = vectors.sparkSession
    rows = kept_vectors(vectors)
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    books = first_books(rows, shape)
    if books is None:
        return spark.createDataFrame([], "vec_id long, label string, code binary, error long"), np.zeros((shape.parts, 0, 0), np.int64)
    with scratch(spark) as tables:
        state = rows.where(F.size("v") == len(head[0]["v"]))
        for k in range(shape.rounds):
            state = tables.table(assigned(state, books, shape), f"round{k}")
            if k:
                tables.drop(f"round{k - 1}")
            books, state = moved(state, books), state.where("slot IS NULL").drop("slot", "total")
        coded = staged(assigned(state, books, shape).where("slot IS NULL").select("vec_id", "label", "code", "error"))
    return coded, books


def decompress(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns of ``coded`` and approx: the integers of the entries that code names, in part order."""
    width = books.shape[2]
    entry = F.array(*(F.array(*(F.lit([int(v) for v in e]) for e in part)) for part in books))
    index = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)),
                        lambda k: F.get(F.get(entry, k), F.conv(F.substring(F.hex("code"), k * 2 + 1, F.lit(2)), 16, 10).cast("int")))
    return coded.withColumn("approx", F.flatten(index)) if width else coded.withColumn("approx", F.lit(None).cast("array<long>"))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The columns of ``coded`` and label_error: errors summed over equal labels, nulls together (null beyond 64 bits)."""
    key = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit(""))
    keyed = coded.withColumn("__llm_label", key)
    sums = staged(keyed.groupBy("__llm_label").agg(F.try_sum("error").alias("label_error")))
    return join_few(keyed, sums, "__llm_label", "vec_id").drop("__llm_label")


def query(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_errors(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                                           F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle(shape: Shape = Shape()) -> str:
    """Long tables, every part compared with every entry; floors of negative quotients spelled out."""
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, embedding AS e, len(embedding) // {shape.parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, k // w AS part, k % w AS pos, floor({shape.scale} * e[k + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, e, w, unnest(range(len(e))) AS k FROM v)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {shape.entries}),
b0 AS MATERIALIZED (SELECT part, entry, pos, x AS c FROM x JOIN seed USING (vec_id))"""]
    for k in range(shape.rounds + 1):
        steps.append(f"""
d{k} AS (SELECT vec_id, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN b{k} USING (part, pos) GROUP BY ALL),
a{k} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{k} GROUP BY ALL)""")
        if k < shape.rounds:
            steps.append(f"""
m{k} AS (SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN x USING (vec_id, part) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM b{k} LEFT JOIN m{k} USING (part, entry, pos))""")
    k = shape.rounds
    return ",".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{k} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{k}) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""


ORACLE_SQL = _oracle()
