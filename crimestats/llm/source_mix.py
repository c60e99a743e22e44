"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document of quality weight w has the key -ln(u) / w, u uniform from a digest of its id; documents in order of their keys
are a weighted sample without replacement.  Each source is taken in whole epochs as often as its target holds its
size, then in key order until the rest of the target is used up; the document on the border gives its first words.

The order is never sorted as a whole: sizes are summed by (source, key bin) before the shuffle, running totals over the bins
find the one bin in which a source's rest ends, and only that bin's documents are ranked, after a second, finer binning.

Null text and text without words have size 0 and are never taken.  A null source is a source of its own (last).
Rows with equal doc_ids (or null ones) share u; they are ordered by size, text digest and row, so repeated rows are separate
documents that follow one another.  An empty table gives an empty mix.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, Window, functions as F

from crimestats.llm.common import join_few, staged, with_columns

#: Production parameters: weights by position of the source, share of all sizes, and the largest number of epochs.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
#: Bins of one level; two levels leave about a sixteen-millionth of a source to rank.
BINS = 4096
MIN_QUALITY = 0.05
SYMBOLS = "#*$%&|<>"


def sized_columns() -> dict:
    """doc_id, the source and its key sk (never null), size in words, sampling key and tie-break, from a document's columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "))
    empty = ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    quality = F.greatest(F.lit(MIN_QUALITY), F.lit(1.0) - F.lit(4.0) * symbols / F.greatest(F.length(text), F.lit(1)))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    source = F.col("source").cast("string")
    columns = {"doc_id": F.col("doc_id").cast("long"), "source": source, "sk": F.coalesce(F.concat(F.lit("="), source), F.lit("-")),
               "size": F.when(empty, F.lit(0)).otherwise(words).cast("long"), "key": -F.log(u) / quality, "tie": F.md5(text)}
    return {k: v.alias(k) for k, v in columns.items()}


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """source, source_size, target: shares by weight, stopped at ``epochs`` times the source, the excess reshared.

    The level at which all sources that aren't stopped get level * weight is found from running sums in the order
    in which sources reach their stop.  One row per source: as many as the mix names.
    """
    per = sizes.groupBy("source", "sk").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = staged(per.withColumn("weight", w).withColumn("stop", epochs * F.col("source_size").cast("double")))
    total = share * float(per.agg(F.sum("source_size")).first()[0] or 0)
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(total) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    open_ = staged(per.withColumn("level", level)).where(F.col("level") * F.col("weight") <= F.col("stop"))
    # Once a source stays below its stop, all later ones do, at the same level: the first is the level.
    found = open_.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last()).select("level").first()
    return per.select("sk", "source_size", (F.least("stop", F.lit(found[0]) * F.col("weight")) if found else F.col("stop"))
                      .alias("target"))


def _bin(t, lo, width):
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((t - lo) / width * BINS).cast("int")))


def _border(sums: DataFrame) -> DataFrame:
    """sk, border, border_from: the bin of each source (at most BINS rows) in which its running size passes ``rest``, and
    the size before that bin.  ``sums``: sk, bin, bin_size, rest."""
    run = F.sum("bin_size").over(Window.partitionBy("sk").orderBy("bin"))
    before = F.col("upto") - F.col("bin_size")
    return sums.withColumn("upto", run).where((F.col("upto") > F.col("rest")) & (before <= F.col("rest"))).select(
        "sk", F.col("bin").alias("border"), before.alias("border_from"))


def _keyed(df: DataFrame, sources: DataFrame, spread: str) -> DataFrame:
    """Rows with their bin and their source's columns, ``inside`` (in the border bin) and ``extra`` (what bins alone decide)."""
    rows = join_few(df.withColumn("t", F.lit(1.0) - F.exp(-F.col("key"))).withColumn("bin", _bin(F.col("t"), F.lit(0.0), F.lit(1.0))),
                    sources, "sk", spread)
    inside = (F.col("rest") > 0) & (F.col("bin") == F.coalesce("border", F.lit(-1)))
    extra = F.when((F.col("rest") > 0) & (F.col("bin") < F.col("border")), F.col("size")).otherwise(F.lit(0).cast("long"))
    return rows.withColumn("inside", inside).withColumn("extra", extra)


def _plan(sizes: DataFrame, weights, share, epochs) -> tuple[DataFrame, DataFrame]:
    """sources (sk, source_size, target, epochs, rest, border, border_from) and the border bins' rows with their ``extra``."""
    targets = source_targets(sizes, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = staged(targets.withColumn("epochs", whole).withColumn(
        "rest", F.floor(F.col("target") + 1e-6).cast("long") - F.col("epochs") * F.col("source_size")))
    # 1 - exp(-key) spreads the keys over the unit interval.
    bins = sizes.withColumn("bin", _bin(F.lit(1.0) - F.exp(-F.col("key")), F.lit(0.0), F.lit(1.0)))
    sums = bins.groupBy("sk", "bin").agg(F.sum("size").alias("bin_size"))
    border = _border(join_few(sums, targets.select("sk", "rest"), "sk", "bin"))
    sources = staged(targets.join(border, "sk", "left"))
    fine = _keyed(sizes, sources, "row").where("inside").drop("extra")
    fine = staged(fine.withColumn("rest", F.col("rest") - F.col("border_from"))
                  .withColumn("bin", _bin(F.col("t"), F.col("border") / BINS, F.lit(1.0 / BINS))).drop("border", "border_from"))
    second = staged(_border(fine.groupBy("sk", "bin", "rest").agg(F.sum("size").alias("bin_size"))))
    fine = join_few(fine, second, "sk", "row")
    order = Window.partitionBy("sk").orderBy("key", "doc_id", "size", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("border_from")
    ranked = fine.where("bin = border").withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before)))
    others = fine.where("bin <> border").withColumn("extra", F.when(F.col("bin") < F.col("border"), F.col("size")).otherwise(F.lit(0)))
    columns = ["row", "doc_id", "tie", "size", "source_size", "target", "epochs", F.col("extra").cast("long").alias("extra")]
    return sources, staged(others.select(*columns).union(ranked.select(*columns)))


def _sizes(docs: DataFrame) -> DataFrame:
    return staged(docs.select(*sized_columns().values()).withColumn("row", F.monotonically_increasing_id()))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every document."""
    sizes = _sizes(docs)
    sources, inside = _plan(sizes, weights, share, epochs)
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken")
    columns = ["doc_id", "size", "source_size", "target", taken]
    return _keyed(sizes, sources, "row").where("NOT inside").select(*columns).union(inside.select(*columns))


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """The mix as documents: each row as often as it is taken whole, and the one on a source's border cut to its first words.

    Columns are those of ``docs`` (``n_chars``, if there, follows the cut); a document that isn't taken doesn't occur.
    Only the border bins' texts are joined with what their rows get; all others are decided by their source's row.
    """
    sources, inside = _plan(_sizes(docs), weights, share, epochs)
    p = "__llm_"
    keyed = docs.select(F.struct(*docs.columns).alias(p + "doc"), *sized_columns().values())
    keyed = _keyed(keyed, sources, "tie")
    plain = keyed.where("NOT inside AND size > 0").withColumn("copies", (F.col("epochs") + F.signum("extra")).cast("int")).where("copies > 0")
    plain = plain.select(p + "doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(p + "doc.*")
    # Equal rows pool what they get and share it out in turn.
    pool = inside.groupBy(F.col("doc_id").alias("pid"), F.col("tie").alias("ptie")).agg(F.sum("extra").alias("pool"))
    turn = F.row_number().over(Window.partitionBy("doc_id", "tie").orderBy("size")) - 1
    few = keyed.where("inside").join(pool, F.col("doc_id").eqNullSafe(F.col("pid")) & (F.col("tie") == F.col("ptie")))
    few = few.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("pool") - turn * F.col("size"))))
    few = few.withColumn("takes", F.concat(F.array_repeat(F.col("size"), F.col("epochs").cast("int")), F.array(F.col("part"))))
    few = few.select(p + "doc.*", F.col("size").alias(p + "size"), F.explode("takes").alias(p + "take")).where(f"{p}take > 0")

    def cut(batch):
        takes, sizes = (batch.column(p + x).to_pylist() for x in ("take", "size"))
        return {p + "text": [first_words(x, k) if k < n else x for x, k, n in zip(batch.column("text").to_pylist(), takes, sizes)]}

    cut_rows = with_columns(few, cut, f"{p}text string")
    changed = {"text": F.col(p + "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(p + "text").cast(docs.schema["n_chars"].dataType)
    return plain.union(cut_rows.withColumns(changed).select(*docs.columns))


def first_words(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    end = 0
    for found in itertools.islice(re.finditer(r"[^\x20\x09-\x0D]+", text), n):
        end = found.end()
    return text[:end]


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
z AS (SELECT doc_id, source, md5(text) AS tie, len(regexp_extract_all(text, '[^ \t-\r]+')) AS size,
             -ln((('0x' || substr(digest, 1, 12))::BIGINT + 0.5) / {float(1 << 48)!r})
             / greatest({MIN_QUALITY}, 1.0 - 4.0 * length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) / greatest(length(text), 1)) AS key
      FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM z GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(rank - 1) % 3 + 1] AS weight, {EPOCHS} * source_size::DOUBLE AS stop FROM s),
l AS (SELECT *, ({SHARE} * (SELECT sum(source_size) FROM s) - coalesce(sum(stop) OVER (ORDER BY stop / weight, rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY stop / weight, rank
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT source, source_size, least(stop, weight * (SELECT level FROM l WHERE level * weight <= stop ORDER BY stop / weight, rank LIMIT 1))
             AS target FROM l),
r AS (SELECT z.doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
             coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id, size, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
      FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
       (epochs * size + greatest(0, least(size, floor(target + 1e-6) - epochs * source_size - run)))::BIGINT AS taken
FROM r
"""
