"""Similarity self-join of documents on word n-grams by vertical partitioning of the global n-gram order.

A ``Rule`` gives the words of a shingle and the least Jaccard similarity of a link: the registered query has 3 words and 0.9 (RULE),
near-duplicate stages 5 words and 0.8 (NEAR).

1. Every text becomes its set of distinct shingles (64-bit hashes).  Texts with equal sets are one class, named by a 128-bit
   digest of the set; all later work is on classes.
2. The global order: by a count, rarest first, then by hash.  The count is a sketch's: a task counts the shingles of all its classes
   exactly, in runs of RUN_SHINGLES, and adds those met more than once in a run to COUNTERS counters by hash, which are summed
   over the tasks.  A shingle of two in RUN_SHINGLES is counted in most runs, however large the input, and there are
   RUN_SHINGLES / 2 such at most; the others, nearly all, leave the counters empty.  Any one order gives the same result; this
   one keeps the prefixes of different documents apart, as a frequent shingle's counter is high.
3. A pair that links shares a shingle of both sets' prefixes (the first n - ceil(t n) + 1 of n in the order, t the least similarity).  Prefix
   shingles of one class only are dropped; the others are buckets.
4. Buckets of up to SMALL classes give candidate pairs with the number of prefix shingles they share.  Common shingles outside
   the shared prefixes lie behind the prefix of one of the two, which bounds the overlap; pairs that can't link go.  The others'
   sets are cut into FRAGMENTS ranges of the hashes, each fragment's overlaps are counted as separate rows and summed per pair.
5. Classes of larger buckets are dealt to blocks, each class at its largest bucket; each pair of blocks that meet in a bucket is one
   task, however many buckets they share.  It adds up the blocks' partial overlap counts fragment by fragment as matrix products
   and returns only a spanning forest of the pairs that link: linear in the block, whatever the number of pairs.
6. Components of the links between classes, then the smallest doc_id of each component.

Prefix rows name a class by 64 bits of its digest; candidates get all classes of that name and size back, and only whole
sets decide.

Null or blank text: empty set, no link, its own component.  Fewer words than a shingle has: the whole sequence is the one shingle.
Repeated rows are documents of one class, rows of one doc_id with other texts documents of their own; a null doc_id never names a
component unless no other does.  An empty table
gives an empty result.  Other columns are ignored (``one_per_group``: kept).
"""

from __future__ import annotations

import hashlib
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crimestats.llm.common import binary_list, connected_components, map_batches, scratch, small_batches, staged, with_columns

class Rule(NamedTuple):
    """Words of a shingle and, as a fraction, the least Jaccard similarity of a link."""

    n: int
    numerator: int
    denominator: int = 100


#: Production parameters: of the registered query and of near-duplicate stages.
RULE, NEAR = Rule(3, 90), Rule(5, 80)
#: Shingles of a run; counters of the sketch behind the order (a broadcast of 2 to 16 MB, whatever the input), rows that a task sends
#: them in, and groups of tasks whose counters are summed first.
RUN_SHINGLES, COUNTERS, CHUNKS, TASK_GROUPS = 1 << 22, 1 << 21, 16, 32
SMALL = 128
#: Classes that a task remembers, so as to give each once, before it forgets them.
RUN_CLASSES = 1 << 18
#: Ids up to which the documents to read again are broadcast (8 bytes each); more are joined by a shuffle.
FEW_IDS = 500_000
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
FRAGMENTS = 4
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _scramble(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _MIX[1]
    x ^= x >> np.uint64(32)
    x *= _MIX[0]
    return x ^ (x >> np.uint64(29))


def shingles(raw: bytes | None, n: int = RULE.n) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams (A-Z lower-cased)."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(h) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)], np.uint64).view(np.int64)
    last = len(h) - n + 1
    x = _scramble(h[:last] * _MIX[0])
    for k in range(1, n):
        x = _scramble((x + h[k:last + k]) * _MIX[k % len(_MIX)])
    return np.unique(x.view(np.int64))


def signature(sorted_hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(sorted_hashes.tobytes(), digest_size=16).digest()


def name(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def first_pass(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Two kinds of rows from one reading of the texts: doc_id, n_shingles, cls (digest of the set; null if it is empty) and h
    (its short name) of every document, and task, chunk, counts: a task's counters, compressed, in CHUNKS rows.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType.fromDDL("doc_id long, n_shingles long, cls binary, h long, task int, chunk int, counts binary")
    arrow = to_arrow_schema(schema)

    def rows(n, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow],
                                          schema=arrow)

    def run(batches):
        seen: set[bytes] = set()
        counters = np.zeros(COUNTERS, np.uint32)
        held: list[np.ndarray] = []
        size = 0

        def count():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            np.add.at(counters, values[n > 1] & (COUNTERS - 1), n[n > 1].astype(np.uint32))
            held.clear()

        for batch in batches:
            sets = [shingles(x, rule.n) for x in binary_list(batch.column("text"))]
            keys = [signature(x) if len(x) else None for x in sets]
            yield rows(len(sets), doc_id=batch.column("doc_id"), n_shingles=[len(x) for x in sets], cls=keys,
                       h=[None if k is None else name(k) for k in keys])
            new = {k: x for k, x in zip(keys, sets) if k and k not in seen}
            seen.update(new)
            for x in new.values():
                held.append(x)
                size += len(x)
                if size >= RUN_SHINGLES:
                    count()
                    size = 0
            if len(seen) > RUN_CLASSES:
                seen.clear()
        if held:
            count()
        if counters.any():
            parts = np.split(counters, CHUNKS)
            yield rows(CHUNKS, task=[TaskContext.get().partitionId()] * CHUNKS, chunk=list(range(CHUNKS)), counts=[pack(x) for x in parts])

    return _slim(docs).mapInArrow(run, schema)


def pack(counters: np.ndarray) -> bytes:
    small = counters.astype(np.min_scalar_type(int(counters.max(initial=0))))
    return bytes([small.dtype.itemsize]) + zlib.compress(small.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[1:]), f"u{blob[0]}")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def sketch(counts: DataFrame) -> np.ndarray:
    """The counters summed over all tasks, in two levels; ``counts``: task, chunk, counts.  Its size is fixed."""
    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // CHUNKS, np.uint64)
        for blob in table.column("counts").to_pylist():
            total += unpack(blob)
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()), "counts": pa.array([pack(total)], pa.binary())})

    once = counts.withColumn("task", F.pmod("task", F.lit(TASK_GROUPS))).groupBy("chunk", "task").applyInArrow(add, "chunk int, counts binary")
    parts = {r["chunk"]: unpack(r["counts"]) for r in once.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()}
    empty = np.zeros(COUNTERS // CHUNKS, np.uint8)
    return np.concatenate([parts.get(k, empty) for k in range(CHUNKS)])


def prefix(x: np.ndarray, counters: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """The first shingles of a set (sorted by hash) in the global order, as many as its prefix has."""
    return x[np.argsort(counters[x & (COUNTERS - 1)], kind="stable")[:prefix_length(len(x), rule)]]


def prefix_length(n: int, rule: Rule = RULE) -> int:
    return n - -(-rule.numerator * n // rule.denominator) + 1


def postings(docs: DataFrame, counters: np.ndarray, rule: Rule = RULE) -> DataFrame:
    """g, h, n: the prefix shingles of every set, with its name and size; a task gives each class once per RUN_CLASSES."""
    order = docs.sparkSession.sparkContext.broadcast(counters)
    small_batches(docs.sparkSession)

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            g, h, n = [], [], []
            for raw in binary_list(batch.column("text")):
                x = shingles(raw, rule.n)
                key = signature(x)
                if len(x) and key not in seen:
                    seen.add(key)
                    g.append(prefix(x, order.value, rule))
                    h.append(np.full(len(g[-1]), name(key)))
                    n.append(np.full(len(g[-1]), len(x), np.int32))
            if len(seen) > RUN_CLASSES:
                seen.clear()
            if g:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (g, h, n)], names=["g", "h", "n"])

    return _slim(docs).select("text").mapInArrow(run, "g long, h long, n int")


def enough(overlap, n_a, n_b, rule: Rule = RULE):
    """denominator * overlap >= numerator * union, without division (columns, numbers or arrays)."""
    return (rule.denominator + rule.numerator) * overlap >= rule.numerator * (n_a + n_b)


def small_pairs(small: DataFrame, large: DataFrame, rule: Rule = RULE) -> DataFrame:
    """a, b, n_a, n_b: pairs of the small buckets whose shared prefix shingles leave a link possible.

    ``small`` and ``large``: g, h, n.  A pair's common shingles are those its small buckets show, at most as many as either
    has in large buckets, and those behind the prefix of one of the two.
    """
    lists = small.groupBy("g").agg(F.sort_array(F.collect_set(F.struct("h", "n"))).alias("m"))
    first = lists.select(F.posexplode("m").alias("k", "x"), "m").select("x", F.explode(F.expr("slice(m, k + 2, size(m))")).alias("y"))
    pairs = first.where(enough(F.least("x.n", "y.n"), F.col("x.n"), F.col("y.n"), rule)).groupBy(
        F.col("x.h").alias("a"), F.col("y.h").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).agg(F.count("*").alias("shared"))
    hot = large.groupBy("h", "n").agg(F.count("*").alias("hot"))
    for side in "ab":
        pairs = pairs.join(hot.select(F.col("h").alias(side), F.col("n").alias(f"n_{side}"), F.col("hot").alias(f"hot_{side}")),
                           [side, f"n_{side}"], "left")
    behind = [F.col(n) - (F.col(n) - F.ceil(rule.numerator * F.col(n) / rule.denominator) + 1) for n in ("n_a", "n_b")]
    most = F.col("shared") + F.least(F.coalesce("hot_a", F.lit(0)), F.coalesce("hot_b", F.lit(0))) + F.greatest(*behind)
    return pairs.where(enough(most, F.col("n_a"), F.col("n_b"), rule)).select("a", "b", "n_a", "n_b")


def class_sets(docs: DataFrame, wanted: DataFrame, rule: Rule = RULE) -> DataFrame:
    """cls, set (in hash order) of the classes in ``wanted`` (cls, doc_id), from the text of one document of each."""
    ids = wanted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    texts = _slim(docs).join(ids, "doc_id", "left_semi")
    # A class whose documents all have null ids is read among those.
    nameless = _slim(docs).where("doc_id IS NULL")

    def fn(batch):
        sets = [shingles(x, rule.n) for x in binary_list(batch.column("text"))]
        return {"cls": [signature(x) for x in sets], "set": sets}

    sets = map_batches(texts.union(nameless), fn, "cls binary, set array<long>")
    return sets.join(wanted, "cls", "left_semi").dropDuplicates(["cls"])


def pair_links(pairs: DataFrame, sets: DataFrame, rule: Rule = RULE) -> DataFrame:
    """a, b of the candidate pairs that link: partial overlaps by fragment of the order, summed per pair."""
    width = (1 << 64) // FRAGMENTS
    cuts = [-(1 << 63) + k * width for k in range(FRAGMENTS)] + [1 << 63]
    parts = [F.expr(f"filter(set, v -> v BETWEEN {lo}L AND {hi - 1}L)".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))
             for lo, hi in zip(cuts, cuts[1:])]
    cut = sets.select("cls", F.posexplode(F.array(*parts)).alias("fragment", "part")).where(F.size("part") > 0)
    one = cut.select(F.col("cls").alias("a"), "fragment", F.col("part").alias("part_a"))
    two = cut.select(F.col("cls").alias("b"), "fragment", F.col("part").alias("part_b"))
    partial = pairs.join(one, "a").join(two, ["b", "fragment"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).alias("overlap"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return total.where(enough(F.col("overlap"), F.col("n_a"), F.col("n_b"), rule)).select("a", "b")


def _blocks(classes, longest, rule: Rule):
    """Number of blocks for so many classes of at most so many shingles."""
    return F.ceil(classes / F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / longest)))).cast("int")


def _band(n, rule: Rule):
    """Sets whose sizes lie two bands apart can't link: a band is a ratio of the least similarity."""
    return F.floor(F.log(n.cast("double")) / F.lit(-float(np.log(rule.numerator / rule.denominator)))).cast("int")


def home_rows(members: DataFrame, rule: Rule = RULE) -> tuple[DataFrame, DataFrame]:
    """(key, diagonal, side, cls of the members of large buckets that share blocks, g, cls, n of the others).

    Near copies meet in as many buckets as they have common shingles in their prefixes.  Their home is the largest of them, and a
    home's classes form blocks (by size band too if they are more than one).  Two classes of one bucket are in two blocks that both
    occur in it, so each such pair of blocks is one task, whatever the number of its buckets, and gets the classes that
    meet the other block in one.  Buckets whose members come from many more blocks than they would need of their own are left to those.
    """
    size = members.groupBy("g").agg(F.count("*").alias("m"))
    sized = staged(members.join(size, "g"))
    home = sized.groupBy("cls").agg(F.max(F.struct("m", "g")).alias("home"), F.first("n").alias("n"))
    home = home.select("cls", "n", F.col("home.g").alias("home"), _band(F.col("n"), rule).alias("band"))
    whole = home.groupBy("home").agg(_blocks(F.count("*"), F.max("n"), rule).alias("all"))
    part = home.groupBy("home", "band").agg(_blocks(F.count("*"), F.max("n"), rule).alias("blocks"))
    home = home.join(whole, "home").join(part, ["home", "band"])
    band = F.when(F.col("all") > 1, F.col("band")).otherwise(-1)
    place = F.when(F.col("all") > 1, F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).otherwise(0)
    placed = sized.join(home.select("cls", F.struct("home", band.alias("band"), place.alias("k")).alias("block")), "cls")
    placed = staged(placed.select("g", "m", "cls", "n", "block"))
    present = placed.groupBy("g", "block").agg(F.max("m").alias("m"))
    few = present.groupBy("g").agg(F.count("*").alias("here"), F.max("m").alias("m")).where(F.col("here") <= 8 + 8 * F.col("m") / BLOCK).select("g")
    other = present.join(few, "g").select("g", F.col("block").alias("other"))
    apart = F.expr("block.band >= 0 AND other.band >= 0 AND abs(block.band - other.band) > 1")
    met = placed.join(other, "g").where(~apart)
    pair = _key(F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    rows = met.select(pair.alias("key"), (F.col("block") == F.col("other")).alias("diagonal"),
                      F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "cls").distinct()
    return rows, placed.join(few, "g", "left_anti").select("g", "cls", "n")


def _key(*columns):
    return F.to_json(F.struct(*columns))


def block_rows(members: DataFrame, rule: Rule = RULE) -> DataFrame:
    """key, diagonal, side, cls: the members of large buckets dealt to pairs of blocks of each bucket.

    A class of size band k meets bands k and k + 1 (there as ``low``); within a band, blocks of BLOCK classes or BLOCK_SHINGLES
    shingles.  The pairs are home x home (one <= two) and low x home (one: -1 - low block).
    """
    homes = members.withColumn("band", _band(F.col("n"), rule))
    size = homes.groupBy("g", "band").agg(_blocks(F.count("*"), F.max("n"), rule).alias("blocks"))
    below = size.select("g", (F.col("band") + 1).alias("band"), F.col("blocks").alias("low_blocks"))
    above = size.select("g", (F.col("band") - 1).alias("band"), F.col("blocks").alias("high_blocks"))
    per = size.join(below, ["g", "band"], "left").join(above, ["g", "band"], "left")
    homes = homes.join(per, ["g", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    same = homes.select("g", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "block", "cls", "n")
    same = same.select("g", "band", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                       F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "cls", "n")
    high = homes.where("low_blocks IS NOT NULL").select(
        "g", "band", F.explode(F.sequence(F.lit(0), F.col("low_blocks") - 1)).alias("low"), "block", "cls", "n")
    high = high.select("g", "band", (-1 - F.col("low")).alias("one"), F.col("block").alias("two"), F.lit(1).alias("side"), "cls", "n")
    low = homes.where("high_blocks IS NOT NULL").select(
        "g", "band", "block", F.explode(F.sequence(F.lit(0), F.col("high_blocks") - 1)).alias("home"), "cls", "n")
    low = low.select("g", (F.col("band") + 1).alias("band"), (-1 - F.col("block")).alias("one"), F.col("home").alias("two"),
                     F.lit(0).alias("side"), "cls", "n")
    rows = same.union(high).union(low)
    return rows.select(_key("g", "band", "one", "two").alias("key"), (F.col("one") == F.col("two")).alias("diagonal"), "side", "cls")


def _overlaps(left: list, right: list) -> np.ndarray:
    """Counts of shared shingles of each pair, summed over FRAGMENTS ranges of the order."""
    total = np.zeros((len(left), len(right)), np.int32)
    flat = [np.concatenate(x) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    for part in np.array_split(shared, max(FRAGMENTS, -(-len(shared) // 4096))):
        if len(part):
            dense = []
            for values, row, n in zip(flat, rows, (len(left), len(right))):
                at = np.minimum(np.searchsorted(part, values), len(part) - 1)
                hit = part[at] == values
                m = np.zeros((n, len(part)), np.float32)
                m[row[hit], at[hit]] = 1
                dense.append(m)
            total += (dense[0] @ dense[1].T).astype(np.int32)
    return total


def block_links(blocks: DataFrame, sets: DataFrame, rule: Rule = RULE) -> DataFrame:
    """a, b: a spanning forest of the linked pairs of each pair of blocks."""
    def kernel(table: pa.Table) -> pa.Table:
        side, cls = table.column("side").to_numpy(), table.column("cls").to_pylist()
        values = table.column("set").combine_chunks()
        arrays = [values[k].values.to_numpy() for k in range(len(values))]
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if table.column("diagonal")[0].as_py():
            a = b = np.arange(len(side))
        links: list[tuple[bytes, bytes]] = []
        if len(a) and len(b):
            n = np.array([len(x) for x in arrays])
            hit = enough(_overlaps([arrays[k] for k in a], [arrays[k] for k in b]), n[a][:, None], n[b][None], rule)
            parent = list(range(len(side)))

            def find(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for x, y in zip(*np.nonzero(hit)):
                x, y = int(a[x]), int(b[y])
                p, q = find(x), find(y)
                if p != q:
                    parent[p] = q
                    links.append((cls[x], cls[y]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    return blocks.join(sets, "cls").groupBy("key").applyInArrow(kernel, "a binary, b binary")


def _grouped(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, cls, root (the component's smallest class; both null without a shingle) of every document."""
    with scratch(docs.sparkSession) as tables:
        read = tables.table(first_pass(docs, rule), "first")
        classes = staged(read.where("n_shingles IS NOT NULL").select("doc_id", "n_shingles", "cls", "h"))
        entries = tables.table(postings(docs, sketch(read.where("chunk IS NOT NULL").select("task", "chunk", "counts")), rule), "postings")
        tables.drop("first")
        # A class may come from several tasks: a bucket has two of them at least.
        sizes = entries.groupBy("g").agg(F.count("*").alias("m"), F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi")
        shared = tables.table(entries.join(sizes.select("g", "m"), "g"), "shared")
        tables.drop("postings")
        small, large = shared.where(F.col("m") <= SMALL).drop("m"), shared.where(F.col("m") > SMALL).drop("m").distinct()
        found = tables.table(small_pairs(small, large, rule), "pairs")
        named = tables.table(classes.where("cls IS NOT NULL").groupBy("cls").agg(
            F.first("h").alias("h"), F.first("n_shingles").cast("int").alias("n"), F.min("doc_id").alias("doc_id")), "named")
        back = named.select("h", "n", "cls")
        pairs = found.join(back.toDF("a", "n_a", "cls_a"), ["a", "n_a"]).join(back.toDF("b", "n_b", "cls_b"), ["b", "n_b"])
        pairs = tables.table(pairs.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), "n_a", "n_b"), "named_pairs")
        members = tables.table(large.join(back, ["h", "n"]).select("g", "cls", "n"), "members")
        tables.drop("shared")
        tables.drop("pairs")
        wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(members.select("cls")).distinct()
        sets = tables.table(class_sets(docs, named.join(wanted, "cls", "left_semi").select("cls", "doc_id"), rule), "sets")
        shared_blocks, others = home_rows(members, rule)
        blocks = tables.table(shared_blocks.union(block_rows(others, rule)), "blocks")
        links = staged(pair_links(pairs, sets, rule).union(block_links(blocks, sets, rule)))
    components = connected_components(links)
    return classes.join(components, classes.cls == components.node, "left").select(
        "doc_id", "n_shingles", "cls", F.coalesce("component", "cls").alias("root"))


def similar_documents(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    named = _grouped(docs, rule).drop("cls")
    smallest = named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = named.where("root IS NOT NULL").join(smallest, "root").select("doc_id", "n_shingles", "component_id")
    return staged(linked.union(named.where("root IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def one_per_group(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One row of ``docs`` of each component: of its smallest doc_id (nulls last) and that id's smallest class.

    Rows of one id and one class are the same document: one of them stays.  Rows without a shingle are linked to none: all stay.
    Ids that name one row are decided by the id; only rows of null or repeated ids have their classes worked out again.
    """
    found = _grouped(docs, rule)
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "cls")
    linked, alone = found.where("root IS NOT NULL"), found.where("root IS NULL")
    first = linked.groupBy("root").agg(F.min(key).alias("first"))
    linked = linked.join(first, "root").select("doc_id", "cls", (key != F.col("first")).alias("lost"))
    found = staged(linked.union(alone.select("doc_id", "cls", F.lit(False))))
    ids = staged(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("lost").alias("lost")))
    repeated = staged(ids.where("n > 1").select("doc_id"))
    p = "__llm_"
    rows = docs.withColumn(p + "id", F.col("doc_id").cast("long"))
    # Beside the lost ones, repeated ids leave the rows that the id decides.
    gone = ids.where("n > 1 OR lost").select(F.col("doc_id").alias(p + "id"))
    plain = rows.where(f"{p}id IS NOT NULL").join(gone, p + "id", "left_anti").select(*docs.columns)
    several = repeated.count()
    if not several and found.where("doc_id IS NULL").isEmpty():
        return plain
    again = repeated.select(F.col("doc_id").alias(p + "id"))
    again = rows.join(F.broadcast(again) if several <= FEW_IDS else again, p + "id", "left_semi")
    again = again.union(rows.where(f"{p}id IS NULL").select(*again.columns))

    def classes(batch):
        sets = [shingles(x, rule.n) for x in binary_list(batch.column("text"))]
        return {p + "cls": [signature(x) if len(x) else None for x in sets]}

    again = with_columns(again, classes, f"{p}cls binary")
    kept = found.where("cls IS NOT NULL AND NOT lost").select(F.col("doc_id").alias("kid"), F.col("cls").alias("kcls")).distinct()
    once = again.where(f"{p}cls IS NOT NULL").dropDuplicates([p + "id", p + "cls"])
    once = once.join(kept, (F.col(p + "cls") == F.col("kcls")) & F.col(p + "id").eqNullSafe(F.col("kid")), "left_semi")
    return plain.union(once.select(*docs.columns)).union(again.where(f"{p}cls IS NULL").select(*docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
  UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) IN (1, 2)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT x, y FROM o JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * overlap >= 90 * (a.n + b.n - overlap)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""
