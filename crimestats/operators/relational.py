"""General relational operators behind the reports.

Each is a short composition of DataFrame operators.  The scale rules they
follow: pre-aggregate before a shuffle wherever only keys or extremes are
needed (semi joins, top-1, distinct counts), so a key holding a third of all
rows collapses map-side instead of landing in one task; broadcast only tables
whose row count was checked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crimestats.functions.recode import q

# Code dimension tables above this many rows are joined by shuffle, not broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def is_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain distributed count (partial counts per task, one number each to
    the final task): exact, and unlike ``limit(n).count()`` it never funnels
    up to n rows per partition into a single task when the table turns out
    to be large."""
    return df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows (a code
    table of short strings: tens of MB at most); beyond the bound the
    planner's shuffle join (and AQE's runtime choice) applies."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def conditional_count_crosstab(df: DataFrame, keys: list[str], code_col: str, codes: tuple[str, ...]) -> DataFrame:
    """One row per key group, one BIGINT count per code; an absent code is 0.

    Not ``pivot``: pivot leaves NULL for a code missing in a group.  The counts
    are partial aggregates, so the shuffle carries one row per group per task.
    """
    code = F.col(code_col)
    return df.groupBy(*keys).agg(*(F.count_if(code == c).alias(c) for c in codes))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL UNION: set union by column name, NULLs compare equal."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def disjoint_union(*dfs: DataFrame) -> DataFrame:
    """G5 for inputs that are sets and share no row (each fixes another code, say):
    the same rows as ``union_distinct``, without its shuffle of all columns."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def exists_in(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (join used as a filter).

    ``other`` is reduced to its distinct keys first; the partial aggregate
    removes duplicate (possibly hot) keys before they are shuffled.
    """
    keys = other.select(F.col(right_key).alias("_exists_key")).where(F.col("_exists_key").isNotNull()).distinct()
    return df.join(keys, F.col(left_key) == F.col("_exists_key"), "left_semi")


def not_in_subquery(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left_key NOT IN (SELECT right_key FROM other)`` with SQL NULL logic.

    A NULL in the subquery empties the result; a NULL left key survives only an
    empty subquery.  Both facts are one aggregate row over the distinct keys
    that the anti join reads too; the join compares null-safely, which changes
    nothing (a NULL key empties the result anyway) but keeps both readers on
    the same plan, so the exchange of the keys is built once and reused.
    """
    keys = other.select(F.col(right_key).alias("_not_in_key")).distinct()
    facts = keys.agg(F.struct(F.count("*").alias("n"), F.count("_not_in_key").alias("k")).alias("f")).scalar()
    kept = df.join(keys, F.col(left_key).eqNullSafe(F.col("_not_in_key")), "left_anti")
    return kept.where((facts["n"] == facts["k"]) & (F.col(left_key).isNotNull() | (facts["n"] == 0)))


# A key filter has KEY_FILTER_BITS bits for each key in words of 64, and is used up to so many words (16 bytes each when broadcast).
KEY_FILTER_BITS, MAX_FILTER_WORDS = 8, 4_000_000


def _filter_place(key: str, words: int) -> list[Column]:
    """Word and bit of a key in a filter of so many words."""
    place = F.pmod(F.xxhash64(key), F.lit(words * 64))
    return [F.floor(place / 64).alias("__key_word"), F.expr("1L").alias("__key_one"), F.pmod(place, F.lit(64)).cast("int").alias("__key_shift")]


def passing(df: DataFrame, key: str, keys: DataFrame, keys_key: str) -> DataFrame:
    """The rows of ``df`` whose key may occur in ``keys``: all that do and few
    others, told before any shuffle.  A join with ``keys`` follows in any case.

    The filter is a Bloom filter of one hash, as a relation of words of 64 bits:
    its size is set by the number of ``keys`` rows, which is counted, its words
    are combined in the map tasks, and it is broadcast.  At most one bit in
    KEY_FILTER_BITS is set, so about one foreign key in nine passes.  Above
    MAX_FILTER_WORDS (32 million keys) ``df`` is returned as it is."""
    words = max(1, -(-keys.count() * KEY_FILTER_BITS // 64))
    if words > MAX_FILTER_WORDS:
        return df
    held = keys.where(F.col(keys_key).isNotNull()).select(*_filter_place(keys_key, words))
    held = held.groupBy("__key_word").agg(F.bit_or(F.expr("shiftleft(__key_one, __key_shift)")).alias("__key_bits"))
    placed = df.where(F.col(key).isNotNull()).select(*df.columns, *_filter_place(key, words))
    met = placed.join(F.broadcast(held), "__key_word")
    return met.where(F.expr("shiftright(__key_bits, __key_shift) & 1") == 1).select(*df.columns)


def left_join_splittable(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT OUTER JOIN right ON left_key = right_key`` as an inner join
    plus the unmatched left rows.

    AQE's skew join can split either side of an inner join but only the left
    side of a left outer join, so a right-side key holding a third of all rows
    (one homicide with most offenders) would otherwise run in one task.  The
    unmatched rows come from an anti join against the right's distinct keys,
    which are pre-aggregated map-side.  Right columns must not clash with left.
    """
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("_lj_key")).where(F.col("_lj_key").isNotNull()).distinct()
    unmatched = left.join(keys, left[left_key] == keys["_lj_key"], "left_anti")
    unmatched = unmatched.select(*left.columns, *(F.lit(None).cast(f.dataType).alias(f.name)
                                                  for f in right.schema.fields))
    return matched.unionByName(unmatched)


def nulls_last_key(*cols: str) -> list[Column]:
    """Sort fields that order NULL after every value, ascending."""
    out: list[Column] = []
    for c in cols:
        out += [F.col(c).isNull(), F.col(c)]
    return out


def top1_per_key(df: DataFrame, key: str, order: list[str], payload: list[str]) -> DataFrame:
    """Per ``key`` the row that sorts first on ``order`` (ascending, NULLS
    LAST, later fields break ties), as an aggregate: ``min`` of a struct.

    A window with ``row_number() = 1`` would put every row of a key into one
    task; ``min`` is combined map-side, so a hot key costs one row per task.
    """
    fields = nulls_last_key(*order) + [F.col(c) for c in payload if c not in order]
    names = [f"_o{i}" for i in range(len(fields))]
    best = F.min(F.struct(*(f.alias(n) for f, n in zip(fields, names)))).alias("_best")
    grouped = df.groupBy(key).agg(best)
    value_names = {c: names[2 * i + 1] for i, c in enumerate(order)}
    extra = [c for c in payload if c not in order]
    for j, c in enumerate(extra):
        value_names[c] = names[2 * len(order) + j]
    return grouped.select(key, *(F.col(f"_best.{value_names[c]}").alias(c) for c in order + extra))


def count_distinct_per_key(df: DataFrame, key: str | list[str], cols: dict[str, str]) -> DataFrame:
    """G9 (aggregate form): ``{alias: column}`` distinct counts per key (one
    column or several), BIGINT.

    Spark cannot evaluate a DISTINCT aggregate as a window (SURVEY T10); the
    grouped form is planned with an expand + two-level aggregate whose first
    shuffle is on (key, value), so a hot key is spread by its values.
    """
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(*(F.count_distinct(F.col(c)).cast("long").alias(a) for a, c in cols.items()))


def count_distinct_over(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """``count(distinct c) over (partition by key)`` attached to every row.

    NULL keys form one partition, as in a window, so the join back is null-safe.
    """
    counts = count_distinct_per_key(df, key, cols).withColumnRenamed(key, "_cd_key")
    joined = df.join(counts, df[key].eqNullSafe(counts["_cd_key"]), "inner")
    return joined.drop("_cd_key")


def with_codes(df: DataFrame, key: str, rows: Sequence[tuple[str | None, ...]], names: Sequence[str]) -> DataFrame:
    """G12 for long code tables: ``df`` with the columns ``names`` of the row of
    ``rows`` whose first value equals ``key``; all NULL where there is none.

    One hash probe a row, whatever the length of the table (a CASE chain tests
    its values one by one).  ``rows`` are literals of the program, one per key,
    so the broadcast relation does not grow with any input."""
    if len({r[0] for r in rows}) != len(rows):
        raise ValueError("a code table has one row per key")
    values = ", ".join("(" + ", ".join("CAST(NULL AS STRING)" if v is None else q(v) for v in r) + ")" for r in rows)
    table = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(__code_key, {', '.join(names)})")
    return df.join(F.broadcast(table), F.col(key) == F.col("__code_key"), "left").drop("__code_key")


def swap_when(swap: Column, keep: Column, pairs: list[tuple[Column, Column]]) -> list[tuple[Column, Column]]:
    """Exchange two column groups.

    For each ``(a, b)``: first output ``b if swap else a``, second output
    ``b if keep else a``.  The two predicates are separate on purpose: with SQL
    NULL logic a NULL condition takes the ELSE branch in both (SURVEY T14).
    """
    return [(F.when(swap, b).otherwise(a), F.when(keep, b).otherwise(a)) for a, b in pairs]


def select_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop helper columns, then deduplicate."""
    return df.select(*cols).distinct()
