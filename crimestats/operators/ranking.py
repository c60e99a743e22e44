"""Dense ranks without a single-task window.

``dense_rank() over (order by k)`` with no partition sends every row to one
task, and ``over (partition by p order by k)`` sends a whole partition value to
one task -- fatal if one incident or case holds a third of the rows.  Here the
rank is computed over the *distinct* keys, which are split into ordered range
buckets; each bucket is ranked by a small window and shifted by the number of
keys in the buckets before it.

Bucket boundaries are literal values picked from a bounded sample of the
distinct keys (two small jobs: a count -- or a caller's estimate -- and a
sample of at most a few thousand rows).  Because they are literals in the
plan, re-running a lost task recomputes exactly the same buckets.  They are one
sorted array in which a key's bucket is found by bisection (``bucket_of``), so
the expression is as large for two buckets as for five thousand.  The number of
buckets follows the bytes of the distinct keys (BUCKET_BYTES each).

``distinct_dense_rank`` ranks the distinct keys, to be joined back to rows;
``with_row_ranks`` ranks the rows where they are, in one shuffle and no join,
for keys that few rows share.

Order is ascending with NULLS LAST on every key column (the source database's
default, SURVEY T9); ranks are BIGINT.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crimestats.operators.relational import nulls_last_key

# One bucket is ranked by one task: bytes of its keys or rows as text, and what one costs besides.
BUCKET_BYTES = 16 << 20
KEY_BYTES = 8
SAMPLES_PER_BUCKET = 20
SAMPLE_SEED = 20160101


def _sort_key(cols: list[str]) -> Column:
    return F.struct(*(f.alias(f"_s{i}") for i, f in enumerate(nulls_last_key(*cols))))


def _sql_literal(value, dtype: str) -> str:
    if value is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"
    if isinstance(value, int):
        return f"CAST({value} AS {dtype})"
    return f"CAST('{value}' AS {dtype})"


class Keys(NamedTuple):
    """Number of distinct keys and the bytes of one on average, both estimates."""

    count: int
    size: float

    def buckets(self, keys_per_bucket: int | None = None) -> int:
        each = keys_per_bucket or max(1, BUCKET_BYTES / (self.size + KEY_BYTES))
        return max(1, math.ceil(self.count / each))


def bucket_of(cols: list[str], bounds: list, schema) -> Column:
    """Number of boundaries at or below the key of ``cols``: bisection in one array literal, whatever its length."""
    if not bounds:
        return F.lit(0)
    fields = ", ".join(f"_s{2 * i}: boolean, _s{2 * i + 1}: {schema[c].dataType.simpleString()}" for i, c in enumerate(cols))
    text = json.dumps([{f"_s{i}": v for i, v in enumerate(b) if v is not None} for b in bounds], default=str)
    array = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    key, n = _sort_key(cols), len(bounds)
    steps = F.array(*(F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (key >= F.get(array, at + step - 1)), at + step).otherwise(at))


def _boundaries(keys: DataFrame, cols: list[str], n_keys: int, n_buckets: int) -> list:
    fraction = min(1.0, SAMPLES_PER_BUCKET * n_buckets / max(n_keys, 1))
    sample = (keys.sample(withReplacement=False, fraction=fraction, seed=SAMPLE_SEED)
              .select(_sort_key(cols).alias("k")).orderBy("k").collect())
    if len(sample) < 2:
        return []
    step = len(sample) / n_buckets
    picks = [sample[int(round(step * i))]["k"] for i in range(1, n_buckets) if int(round(step * i)) < len(sample)]
    uniq = []
    for p in picks:
        if not uniq or tuple(p) != tuple(uniq[-1]):
            uniq.append(p)
    return uniq


def estimate_distinct(df: DataFrame, key_sets: dict[str, list[str]], carried: list[str] | None = None) -> dict[str, Keys]:
    """Approximate distinct counts of several key sets (HyperLogLog, ~2% error)
    and the average bytes of their keys (of the columns ``carried``, where whole
    rows are ranked) in one aggregate job, enough to size the rank buckets."""
    aggs = []
    for name, cols in key_sets.items():
        size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in carried or cols), F.lit(0))
        aggs += [F.approx_count_distinct(F.struct(*(F.col(c) for c in cols)), rsd=0.02).alias(name), F.avg(size).alias(f"{name}_size")]
    row = df.agg(*aggs).collect()[0]
    return {name: Keys(int(row[name]), float(row[f"{name}_size"] or 0)) for name in key_sets}


def distinct_dense_rank(df: DataFrame, order: list[str], partition: list[str] | None = None,
                        rank_col: str = "DENSE_RANK", keys_per_bucket: int | None = None,
                        size: Keys | None = None) -> DataFrame:
    """Map of the distinct ``partition + order`` keys to their dense rank.

    Without ``partition`` this is the global rank (G11); with it, the rank of
    ``order`` inside each partition value (G10).  Returns the key columns and
    ``rank_col``; join it back to the rows with a null-safe join on the keys.
    ``size`` (an estimate of the distinct keys) skips the counting job;
    ``keys_per_bucket`` sets the buckets by number instead of by bytes.
    """
    partition = list(partition or [])
    cols = partition + list(order)
    dtypes = dict(df.select(*cols).dtypes)
    keys = df.select(*cols).distinct()

    size = size or estimate_distinct(keys, {"k": cols})["k"]
    n_buckets = size.buckets(keys_per_bucket)
    bounds = _boundaries(keys, cols, size.count, n_buckets) if n_buckets > 1 else []

    # Bucket = number of boundaries at or below the key (boundaries ascend).
    bucketed = keys.withColumn("_bucket", bucket_of(cols, bounds, df.schema))

    # Inside a bucket the keys are distinct, so the dense rank is a row number.
    order_fields = [F.col(c).asc_nulls_last() for c in order]
    local_w = Window.partitionBy("_bucket", *partition).orderBy(*order_fields)
    ranked = bucketed.withColumn("_local", F.row_number().over(local_w).cast("long"))

    if not bounds:
        return ranked.select(*cols, F.col("_local").alias(rank_col))

    if not partition:
        # Offset of a bucket = keys in all earlier buckets (one row per bucket).
        sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        offsets = sizes.select(
            "_bucket",
            (F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
        )
        out = ranked.join(F.broadcast(offsets), "_bucket", "left")
        return out.select(*cols, (F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))).cast("long").alias(rank_col))

    # Partitioned: only a partition value that appears in a boundary key can
    # straddle buckets, so offsets exist for at most one partition value per
    # boundary; everything else starts at 1 inside its bucket.
    parts = sorted({tuple(b[2 * i + 1] for i in range(len(partition))) for b in bounds}, key=repr)
    values = ", ".join("(" + ", ".join(_sql_literal(v, dtypes[p]) for v, p in zip(row, partition)) + ")"
                       for row in parts)
    names = ", ".join(f"`{p}`" for p in partition)
    bound_parts = F.broadcast(ranked.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({names})"))
    part_cond = [bucketed[p].eqNullSafe(bound_parts[p]) for p in partition]
    straddling = bucketed.join(bound_parts, part_cond[0] if len(part_cond) == 1 else _and_all(part_cond), "left_semi")
    per_bucket = straddling.groupBy("_bucket", *partition).agg(F.count(F.lit(1)).alias("_n"))
    part_w = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("_bucket", *partition, F.sum("_n").over(part_w).alias("_off"))
    off_cond = [ranked["_bucket"] == offsets["_bucket"]] + [ranked[p].eqNullSafe(offsets[p]) for p in partition]
    out = ranked.join(F.broadcast(offsets), _and_all(off_cond), "left")
    return out.select(*(ranked[c] for c in cols),
                      (ranked["_local"] + F.coalesce(offsets["_off"], F.lit(0))).cast("long").alias(rank_col))


def _and_all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def with_dense_rank(df: DataFrame, order: list[str], partition: list[str] | None = None,
                    rank_col: str = "DENSE_RANK", keys_per_bucket: int | None = None) -> DataFrame:
    """``df`` plus ``dense_rank() over (partition by .. order by .. nulls last)``."""
    ranks = distinct_dense_rank(df, order, partition, rank_col, keys_per_bucket)
    cols = list(partition or []) + list(order)
    renamed = ranks.select(*(F.col(c).alias(f"_rk_{c}") for c in cols), rank_col)
    cond = _and_all([df[c].eqNullSafe(renamed[f"_rk_{c}"]) for c in cols])
    return df.join(renamed, cond, "inner").drop(*(f"_rk_{c}" for c in cols))


def with_row_ranks(df: DataFrame, order: list[str], partition: list[str], rank_col: str,
                   keys_per_bucket: int | None = None, size: Keys | None = None,
                   source: DataFrame | None = None) -> DataFrame:
    """``df`` plus the same rank, found in the rows themselves: one shuffle by
    (bucket, partition) and no join.

    A partition value that straddles buckets is shifted by the distinct keys of
    its earlier buckets; these are counted first (a job over the key columns)
    and broadcast: two rows per boundary at most, or for a value that spans
    whole buckets one each.  Rows of equal keys are ranked by one task, so use
    it where a key (partition and order columns together) is nearly one row.
    ``source`` is a cheaper relation with exactly the keys of ``df``, if any.
    """
    cols = partition + order
    source = df if source is None else source
    size = size or estimate_distinct(df, {"k": cols}, df.columns)["k"]
    n_buckets = size.buckets(keys_per_bucket)
    bounds = _boundaries(source.select(*cols).distinct(), cols, size.count, n_buckets) if n_buckets > 1 else []
    order_fields = [F.col(c).asc_nulls_last() for c in order]
    if not bounds:
        return df.withColumn(rank_col, F.dense_rank().over(Window.partitionBy(*partition).orderBy(*order_fields)).cast("long"))

    bucketed = df.withColumn("_bucket", bucket_of(cols, bounds, df.schema))
    local = F.dense_rank().over(Window.partitionBy("_bucket", *partition).orderBy(*order_fields)).cast("long")
    # Only a partition value that appears in a boundary can straddle buckets.
    names = [f"_p{i}" for i in range(len(partition))]
    parts = sorted({tuple(b[2 * i + 1] for i in range(len(partition))) for b in bounds}, key=repr)
    schema = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, partition))
    held = F.broadcast(df.sparkSession.createDataFrame(parts, schema))
    keys = source.select(*cols).distinct().withColumn("_bucket", bucket_of(cols, bounds, df.schema))
    straddling = keys.join(held, _and_all([keys[c].eqNullSafe(held[n]) for c, n in zip(partition, names)]), "left_semi")
    counted = straddling.groupBy("_bucket", *partition).agg(F.count(F.lit(1)).alias("n")).collect()
    before: dict[tuple, int] = {}
    shifts = []
    for row in sorted(counted, key=lambda r: r["_bucket"]):
        value = tuple(row[c] for c in partition)
        shifts.append((row["_bucket"], *value, before.get(value, 0)))
        before[value] = before.get(value, 0) + row["n"]
    shift = F.broadcast(df.sparkSession.createDataFrame(shifts, f"_b int, {schema}, _shift long"))
    ranked = bucketed.withColumn("_local", local)
    cond = _and_all([ranked["_bucket"] == shift["_b"], *(ranked[c].eqNullSafe(shift[n]) for c, n in zip(partition, names))])
    out = ranked.join(shift, cond, "left")
    return out.select(*df.columns, (F.col("_local") + F.coalesce(F.col("_shift"), F.lit(0))).alias(rank_col))
