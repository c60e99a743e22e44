"""Helpers shared by the operators: staging, Arrow batches, word splitting, connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crimestats.session import checkpoint_dir, reliable_checkpoint

#: Rows of one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20
#: Words are maximal runs outside space and \t..\r; ``bytes.split()`` splits at exactly these six bytes.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


#: The folder that holds the package, for workers started elsewhere (local mode; a cluster has the package installed).
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def small_batches(spark: SparkSession) -> None:
    """Cap the Arrow batches sent to Python workers by rows and bytes, and let the workers find this package."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, HOME])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Scratch:
    """Parquet tables in a fresh folder below the session's checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Free a table after its last reader."""
        self._delete(f"{self.root}/{name}")

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables that live until the block ends; what is returned from it must not read them."""
    tables = Scratch(spark)
    try:
        yield tables
    finally:
        tables.close()


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (reliable, so lost executors don't matter)."""
    return reliable_checkpoint(df)


def binary_list(column: pa.Array) -> list:
    """The column's values as UTF-8 bytes (null: None)."""
    return column.cast(pa.binary()).to_pylist()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow with a function from a batch to column lists of ``schema``."""
    small_batches(df.sparkSession)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def with_columns(docs: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], added: str) -> DataFrame:
    """All columns of ``docs`` and the columns of ``added`` (names must not occur in docs), computed by batch."""
    small_batches(docs.sparkSession)
    extra = T.StructType.fromDDL(added)
    arrow = to_arrow_schema(extra)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[f.name], f.type) for f in arrow)],
                                                 names=[*batch.schema.names, *arrow.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra.fields]))


def bounded_sample(rows: DataFrame, key: str, size: int) -> list:
    """At most ``size`` rows, those with the smallest hash of ``key``: about twice as many are ordered, however large the input."""
    space = 1 << 30
    share = min(space, -(-2 * size * space // max(1, rows.count())))
    place = F.pmod(F.xxhash64(key), F.lit(space))
    return rows.withColumn("__llm_place", place).where(F.col("__llm_place") < share).orderBy("__llm_place", key).limit(size).collect()


#: Labels that a sample by label may have.
LABELS = 2000


def label_sample(rows: DataFrame, label: str, keys: list[str], size: int, least: int) -> list:
    """Of each label the distinct ``keys`` with the smallest hashes, once each: all of a label up to a bound, which is the same for all.

    The bound is the largest at which the labels together give ``size`` rows, but no less than ``least``, so that a rare label is
    met whatever the others' number.  About twice as many rows as are taken are ordered.  More than LABELS labels are refused.
    """
    space = 1 << 30
    hashed = rows.withColumn("__llm_hash", F.xxhash64(*keys))
    counts = hashed.groupBy(label).agg(F.approx_count_distinct("__llm_hash", 0.02).alias("n")).limit(LABELS + 1).collect()
    if len(counts) > LABELS:
        raise ValueError(f"more than {LABELS} labels in column {label}")
    if not counts:
        return []
    bound, left, room = size, len(counts), size
    for n in sorted(r["n"] for r in counts):
        if n * left > room:
            bound = room // left
            break
        room, left = room - n, left - 1
    bound = max(bound, least)
    shares = [(r[label], min(space, -(-2 * bound * space // max(1, r["n"])))) for r in counts]
    few = F.broadcast(rows.sparkSession.createDataFrame(shares, T.StructType([rows.schema[label], T.StructField("__llm_share", T.LongType())])))
    near = hashed.join(few, label).where(F.pmod("__llm_hash", F.lit(space)) < F.col("__llm_share")).dropDuplicates([label, "__llm_hash"])
    order = Window.partitionBy(label).orderBy(F.pmod("__llm_hash", F.lit(space)), "__llm_hash")
    taken = near.withColumn("__llm_rank", F.row_number().over(order)).where(F.col("__llm_rank") <= bound)
    return taken.orderBy("__llm_hash", label).select(*rows.columns).collect()


#: Rows up to which a keyed table is broadcast; a larger one is joined on salted keys.
FEW, SALTS = 10_000, 64


def join_few(rows: DataFrame, few: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join of ``rows`` with ``few`` (one row per ``key``, each of a few short columns), safe when a key holds most rows.

    ``few`` is counted: up to FEW rows it is broadcast; beyond that each key's rows are spread over SALTS keys by a hash
    of the column ``spread`` and its row in ``few`` is repeated for each.  The result is the same.
    """
    if few.count() <= FEW:
        return rows.join(F.broadcast(few), key, "left")
    salted = few.withColumn("__llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__llm_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(
        salted, [key, "__llm_salt"], "left").drop("__llm_salt")


#: Nodes of which a task holds the trees before it gives them out, and joins of a hub: a node with more rows than HUB_ROWS and
#: one in MOST_HUBS of all; there are MOST_HUBS hubs at most, whatever the edges.
FOREST_NODES, HUB_ROWS, MOST_HUBS = 1 << 19, 64, 10_000


def with_least(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (a, b; at most ``total`` of them) with m, the least b of its a.

    The rows of hubs meet their minima in a broadcast (at most MOST_HUBS rows, as their counts add up to ``total``), the others in a
    shuffle in which no key has more than HUB_ROWS or a MOST_HUBS-th of the rows.
    """
    least = max(HUB_ROWS, total // MOST_HUBS)
    low = rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    hubs = low.where(F.col("n") > least)
    hot = rows.join(F.broadcast(hubs.select("a", "m")), "a")
    cold = rows.join(F.broadcast(hubs.select("a")), "a", "left_anti").join(low.where(F.col("n") <= least).select("a", "m"), "a")
    return hot.union(cold)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable, for every node of the undirected ``edges`` (columns a, b): (node, component).

    Two forests come first: each task hangs the nodes of its edges on the smallest of their trees, then these rows are dealt by
    their node, so that trees that share nodes in many tasks are joined where the node lies; what is left has about one row a node,
    however many edges or tasks there were.  Large-star and small-star rounds then hang every node on its component's smallest one.
    """
    node = edges.schema["a"].dataType
    pair = T.StructType([T.StructField("a", node), T.StructField("b", node)])
    arrow = to_arrow_schema(pair)

    def forest(batches):
        parent: dict = {}

        def find(x):
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        def hung():
            links = [(x, find(x)) for x in list(parent) if find(x) != x]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], arrow.types[i]) for i in (0, 1)], schema=arrow)

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > FOREST_NODES:
                yield hung()
                parent.clear()
        yield hung()

    def settled(rows):
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    trees = edges.select("a", "b").where("a <> b").mapInArrow(forest, pair).repartition("a")
    state = staged(trees.mapInArrow(forest, pair).distinct())
    mark = settled(state)
    for _ in range(max_rounds if mark[0] else 0):
        total = 2 * mark[0]
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_least(both, total).select("b", F.least("a", "m").alias("m"), (F.col("b") > F.col("a")).alias("up"))
        down = large.where("up AND b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).distinct()
        small = with_least(down, total)
        state, last = staged(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
                             .where("a <> b").distinct()), mark
        mark = settled(state)
        if mark == last:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    hung = state.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return hung.union(state.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))
