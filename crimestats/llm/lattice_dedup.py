"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected to eight dimensions by TABLES random maps; each projection is decoded to its nearest point of the E8
lattice.  A vector lives in its point's cell and also probes the PROBES neighbouring cells it is closest to.  Cells with a home and
another vector are compared: cosines in double precision, links from ``threshold`` on.  Vectors are compared within one label and
one dimension only.

Equal vectors are one class (all linked); classes are compared.  A pair that meets in several cells counts in the first of them, by
table, then cell, so cells return a count per class and a spanning forest instead of pairs.  Cells of more than BLOCK classes are cut
into blocks and each pair of blocks is a task of its own.

Null labels, null vectors, vectors with a null or non-finite component and zero vectors link with nothing.  A null vec_id names no
component unless all its ids are null.  Repeated rows are vectors of one class.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import connected_components, scratch, small_batches, staged

#: Production parameters.
THRESHOLD = 0.93
TABLES, PROBES, SCALE = 12, 3, 2.4
BLOCK = 1024
SEED = 20


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, times two."""
    whole = [[(2 * s if k == i else 2 * t if k == j else 0) for k in range(8)] for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    half = [signs for signs in product((1, -1), repeat=8) if np.prod(signs) > 0]
    return np.array(whole + half, np.int64)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(1) % 2)
    off = x[odd] - f[odd]
    worst = np.abs(off).argmax(1)
    f[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return f


def nearest_points(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points, times two."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.rint(2 * np.where(nearer[:, None], a, b)).astype(np.int64)


@lru_cache(maxsize=64)
def projection(dimension: int, table: int) -> np.ndarray:
    rows = np.random.default_rng([SEED, dimension, table]).normal(size=(max(dimension, 8), 8))
    q, _ = np.linalg.qr(rows)
    return q[:dimension] * np.sqrt(max(dimension, 8) / 8) * SCALE


def cells(units: np.ndarray, label: int, table: int) -> np.ndarray:
    """Hashes of a vector's home cell (column 0) and of the cells that it probes."""
    x = units @ projection(units.shape[1], table)
    home = nearest_points(x)
    near = minimal_vectors()
    toward = (x - home / 2) @ near.T
    best = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
    points = np.concatenate([home[:, None], home[:, None] + near[best]], axis=1).astype(np.uint64)
    h = np.full(points.shape[:2], (label * 1_000_003 + units.shape[1]) * 64 + table, np.int64).view(np.uint64)
    for k in range(8):
        h = (h ^ points[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def unit_rows(vectors: pa.Array) -> np.ndarray:
    x = np.stack(vectors.to_numpy(zero_copy_only=False)).astype(np.float64) if len(vectors) else np.zeros((0, 1))
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _vector(vectors: DataFrame):
    kind = vectors.schema["embedding"].dataType
    return F.col("embedding") if kind.simpleString() in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v and good: whether the vector can link."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), _vector(vectors).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.withColumn("good", F.coalesce(F.col("label").isNotNull() & fine, F.lit(False)))


def addresses(classes: DataFrame) -> DataFrame:
    """cell, tab, cid, home: each class's home and probed cells in every table."""
    small_batches(classes.sparkSession)

    def run(batches):
        for batch in batches:
            cid, label = batch.column("cid").to_numpy(), batch.column("label").to_numpy()
            vectors = batch.column("v")
            size = np.array([len(x) for x in vectors])
            for key in sorted(set(zip(label.tolist(), size.tolist()))):
                rows = np.flatnonzero((label == key[0]) & (size == key[1]))
                units = unit_rows(vectors.take(pa.array(rows)))
                for t in range(TABLES):
                    c = cells(units, key[0], t)
                    yield pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(np.full(c.size, t, np.int32)), pa.array(np.repeat(cid[rows], c.shape[1])),
                                                      pa.array(np.tile(np.arange(c.shape[1]) == 0, len(rows)))], names=["cell", "tab", "cid", "home"])

    return classes.select("cid", "label", "v").mapInArrow(run, "cell long, tab int, cid long, home boolean")


def dealt(members: DataFrame) -> DataFrame:
    """cell, tab, one, two, side, cid, home: members of shared cells, those of large cells repeated for each pair of blocks."""
    sizes = members.groupBy("cell", "tab").agg(F.count("*").alias("m"), F.min("cid").alias("lo"), F.max("cid").alias("hi"), F.max("home").alias("homes"))
    sizes = sizes.where("lo <> hi AND homes").select("cell", "tab", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(sizes, ["cell", "tab"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.select("cell", "tab", "cid", "home", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return rows.select("cell", "tab", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                       F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "cid", "home")


def _met_before(codes: list, a: np.ndarray, b: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Whether pairs (a, b) meet in an earlier table, or in a smaller cell of this one.  codes[t]: home and probed cells of each row."""
    before = np.zeros(len(a), bool)
    for t in range(table + 1):
        left = np.flatnonzero(~before)
        x, y = codes[t][a[left]], codes[t][b[left]]
        met = np.zeros(len(left), bool)
        for k in range(PROBES + 1):
            # Home of one and home or probe of the other.
            met |= (x[:, 0] == y[:, k]) & ((t < table) | (x[:, 0] < cell))
            met |= (y[:, 0] == x[:, k]) & ((t < table) | (y[:, 0] < cell))
        before[left[met]] = True
    return before


def _one_cell(key: tuple, cid: np.ndarray, side: np.ndarray, home: np.ndarray, copies: np.ndarray, units: np.ndarray, label: int, threshold: float):
    """(class, linked vectors) and forest edges of one pair of blocks of a cell."""
    cell, tab, one, two = key
    left, right = (np.arange(len(cid)),) * 2 if one == two else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    pairs = []
    for start in range(0, len(left), 256):
        part = left[start:start + 256]
        i, j = np.nonzero((units[part] @ units[right].T >= threshold) & (home[part][:, None] | home[right][None]))
        keep = cid[part[i]] < cid[right[j]] if one == two else np.ones(len(i), bool)
        pairs.append((part[i[keep]], right[j[keep]]))
    used = np.unique(np.concatenate([x for p in pairs for x in p])) if pairs else []
    if not len(used):
        return [], []
    place = np.zeros(len(cid), np.int64)
    place[used] = np.arange(len(used))
    codes = [cells(units[used], label, t) for t in range(tab + 1)]
    links, parent, edges = np.zeros(len(cid), np.int64), list(range(len(cid))), []

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in pairs:
        new = ~_met_before(codes, place[a], place[b], tab, cell)
        a, b = a[new], b[new]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = find(x), find(y)
            if p != q:
                parent[p] = q
                edges.append((int(cid[x]), int(cid[y])))
    some = np.flatnonzero(links)
    return list(zip(cid[some].tolist(), links[some].tolist())), edges


def cell_links(rows: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """a, b, links: per class a the vectors it links with in a cell (b null), and the edges of a spanning forest (links 0)."""
    def kernel(table: pa.Table) -> pa.Table:
        keys = [table.column(c).to_numpy() for c in ("cell", "tab", "one", "two")]
        cid, side, home, copies, label = (table.column(c).to_numpy() for c in ("cid", "side", "home", "copies", "label"))
        vectors = table.column("v").combine_chunks()
        order = np.lexsort(keys)
        change = np.any([np.diff(k[order], prepend=k[order[0]]) != 0 for k in keys], axis=0)
        counts, edges = [], []
        for rows in np.split(order, np.flatnonzero(change)):
            if len(rows) > 1:
                got = _one_cell(tuple(int(k[rows[0]]) for k in keys), cid[rows], side[rows], home[rows], copies[rows],
                                unit_rows(vectors.take(pa.array(rows))), int(label[rows[0]]), threshold)
                counts += got[0]
                edges += got[1]
        return pa.table({"a": pa.array([x for x, _ in counts + edges], pa.int64()), "b": pa.array([None] * len(counts) + [y for _, y in edges], pa.int64()),
                         "links": pa.array([n for _, n in counts] + [0] * len(edges), pa.int64())})

    # Small cells share a call; a call holds the pairs of blocks of about as many rows as a large cell's.
    groups = max(1, -(-rows.count() // BLOCK))
    full = rows.join(classes.select("cid", "label", "v", "copies"), "cid")
    return full.groupBy(F.pmod(F.xxhash64("cell", "tab", "one", "two"), F.lit(groups)).alias("call")).applyInArrow(kernel, "a long, b long, links long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    small_batches(vectors.sparkSession)
    rows = prepared(vectors)
    classes = rows.where("good").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()))
    with scratch(vectors.sparkSession) as tables:
        members = tables.table(addresses(classes), "addresses")
        found = staged(cell_links(tables.table(dealt(members), "dealt"), classes, threshold))
    components = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    info = classes.join(links, "cid", "left").join(components, classes.cid == components.node, "left").withColumn("root", F.coalesce("component", "cid"))
    smallest = info.groupBy("root").agg(F.min("rep").alias("component_id"))
    info = staged(info.join(smallest, "root").select("label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    # Many copies of one vector meet one row: their side of the join can be split.
    linked = rows.where("good").join(info, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(embedding) IS NOT NULL),
link AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                      WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
