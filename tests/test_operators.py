"""General operators: range-bucketed dense ranks against the plain window,
aggregate top-1 against row_number, crosstab, union, semi join."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crimestats.operators import ranking, relational


def _rows(seed: int, n: int, hot_share: float):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        part = "HOT" if rnd.random() < hot_share else rnd.choice(["a", "b", "c", None, "d", "e"])
        key = rnd.choice([None] + [f"k{rnd.randint(0, n // 2):05d}" for _ in range(3)])
        out.append((part, key, i))
    return out


def _window_rank(df, order, partition):
    w = Window.orderBy(*(F.col(c).asc_nulls_last() for c in order))
    if partition:
        w = Window.partitionBy(*partition).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return {tuple(r) for r in df.select(*partition, *order).distinct()
            .select(*partition, *order, F.dense_rank().over(w).cast("long").alias("r")).collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("partitioned", [False, True])
def test_bucketed_dense_rank_matches_window(spark, seed, partitioned):
    df = spark.createDataFrame(_rows(seed, 3000, hot_share=0.34), "part string, key string, id long")
    partition = ["part"] if partitioned else []
    got = {tuple(r) for r in ranking.distinct_dense_rank(df, ["key"], partition, rank_col="r",
                                                         keys_per_bucket=50).collect()}
    assert got == _window_rank(df, ["key"], partition)


def test_with_dense_rank_keeps_every_row(spark):
    df = spark.createDataFrame(_rows(3, 500, hot_share=0.5), "part string, key string, id long")
    out = ranking.with_dense_rank(df, ["key"], ["part"], rank_col="r", keys_per_bucket=20)
    assert out.count() == df.count()
    w = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_last())
    expect = {(r.id, r.r) for r in df.select("id", F.dense_rank().over(w).alias("r")).collect()}
    assert {(r.id, r.r) for r in out.collect()} == expect


def test_top1_matches_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(1, 20), rnd.choice([None, "12", "20", "90"]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k long, code string, id long")
    got = {tuple(r) for r in relational.top1_per_key(df, "k", ["code", "id"], []).collect()}
    w = Window.partitionBy("k").orderBy(F.col("code").asc_nulls_last(), F.col("id"))
    expect = {tuple(r) for r in df.select("k", "code", "id", F.row_number().over(w).alias("rn"))
              .where("rn = 1").drop("rn").collect()}
    assert got == expect


def test_crosstab_union_semi(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("1", None)], "g string, c string")
    got = {r.g: (r.a, r.b) for r in relational.conditional_count_crosstab(df, ["g"], "c", ("a", "b")).collect()}
    assert got == {"1": (1, 1), "2": (1, 0)}
    u = relational.union_distinct(df, df, spark.createDataFrame([("3", None), ("1", None)], "g string, c string"))
    assert u.count() == 5
    other = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    assert relational.exists_in(df, other, "c", "x").count() == 2


def test_count_distinct_over_null_partition(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "y", 1), ("r", "x", None)], "p string, h string, o long")
    got = {(r.p, r.h, r.nv, r.no) for r in relational.count_distinct_over(df, "p", {"nv": "h", "no": "o"}).collect()}
    assert got == {(None, "x", 2, 1), (None, "y", 2, 1), ("r", "x", 1, 0)}


def test_left_join_splittable_equals_left_join(spark):
    rnd = random.Random(11)
    left = spark.createDataFrame([(i, rnd.choice([None, 1, 2, 3, 4])) for i in range(300)], "lid long, k long")
    # key 1 holds about a third of the right rows
    right = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 5, None]), j) for j in range(600)], "rk long, rv long")
    got = relational.left_join_splittable(left, right, "k", "rk")
    expect = left.join(right, left["k"] == right["rk"], "left")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expect.collect()), key=repr)


@pytest.mark.parametrize("per_bucket", [None, 7, 100])
def test_row_ranks_match_the_window(spark, per_bucket):
    """Rows stay as they are, repeated ones too; a hot partition value spans many buckets."""
    rows = _rows(5, 1500, hot_share=0.4)
    df = spark.createDataFrame(rows + rows[:50], "part string, key string, id long")
    out = ranking.with_row_ranks(df, ["key"], ["part"], "r", per_bucket)
    w = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_last())
    want = df.withColumn("r", F.dense_rank().over(w).cast("long"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_row_ranks_cost_one_shuffle(spark):
    df = spark.createDataFrame(_rows(6, 600, hot_share=0.4), "part string, key string, id long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ranking.with_row_ranks(df, ["key"], ["part"], "r", 20)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def test_buckets_by_bisection_in_an_array(spark):
    """Thousands of boundaries are one short expression; places are those of a plain search."""
    import bisect

    df = spark.range(200_000).select((F.col("id") * 7 % 200_003).alias("n"), F.when(F.col("id") % 11 > 0, F.format_string("k'%06d\\", "id")).alias("k"))
    keys = sorted({(r.k is None, r.k or "", r.n) for r in df.limit(40_000).collect()})[::8]
    bounds = [(k[0], None if k[0] else k[1], False, k[2]) for k in keys]
    assert len(bounds) == 5000
    out = df.withColumn("b", ranking.bucket_of(["k", "n"], bounds, df.schema))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") == 2  # one is the column k of this test
    for r in out.sample(0.01, seed=3).collect():
        assert r.b == bisect.bisect_right(keys, (r.k is None, r.k or "", r.n))


def test_rank_buckets_follow_bytes():
    assert ranking.Keys(1_000_000, 20.0).buckets() > 1
    assert ranking.Keys(1000, 20.0).buckets() == 1 and ranking.Keys(0, 0.0).buckets() == 1
    assert ranking.Keys(10 ** 10, 30.0).buckets() > 20_000


def test_key_filter_keeps_every_key_and_few_others(spark, monkeypatch):
    """Null, repeated and negative keys; without a filter (too many keys) the rows stay as they are."""
    keys = spark.createDataFrame([(i * 37 - 500,) for i in range(400)] * 2 + [(None,)], "ID long")
    rows = spark.range(-500, 20_000).select(F.col("id").alias("CASE_ID"), F.lit("x").alias("_bits")).union(spark.createDataFrame([(None, "n")], "k long, v string"))
    kept = [r.CASE_ID for r in relational.passing(rows, "CASE_ID", keys, "ID").collect()]
    want = {i * 37 - 500 for i in range(400)} & set(range(-500, 20_000))
    assert want <= set(kept) and len(kept) == len(set(kept)) and len(kept) < len(want) + 20_000 * 0.2
    assert relational.passing(rows, "CASE_ID", keys.limit(0), "ID").count() == 0
    monkeypatch.setattr(relational, "MAX_FILTER_WORDS", 3)
    assert relational.passing(rows, "CASE_ID", keys, "ID") is rows
