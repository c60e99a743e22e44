"""Token counts by an exact length histogram.

Documents are encoded with a public byte-level BPE vocabulary and counted by encoded length.  For every
occurring length L (as a context limit) the suffix sums give: documents and tokens at or above L, tokens left after
truncating every document to L, and the share of documents that fit.  Totals and quantiles read off the same table.

Null text has length 0, like empty text; an empty table gives an empty histogram.  Only the text is read.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window, functions as F

from crimestats.llm.common import binary_list, map_batches, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The word pattern that belongs to the vocabulary (a fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths of one bucket of the two-level suffix sum.
BUCKET = 256
_encoders: dict = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def document_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """length of every document, in tokens of the whole text."""
    def fn(batch):
        enc = encoder(vocabulary)
        return {"length": [len(enc.encode_ordinary(x.decode())) if x else 0 for x in binary_list(batch.column("text"))]}

    return map_batches(docs.select(F.col("text").cast("string")), fn, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """length, docs: the exact histogram, combined before the shuffle."""
    return lengths.groupBy("length").agg(F.count("*").alias("docs"))


def suffix_table(hist: DataFrame) -> DataFrame:
    """Per length L: docs_from/tokens_from (documents of length >= L), docs_upto, truncated_tokens (sum of min(length, L)).

    Suffix sums in two levels: over buckets of BUCKET lengths, then within each bucket.
    """
    hist = hist.withColumn("bucket", F.floor(F.col("length") / BUCKET)).withColumn("tokens", F.col("length") * F.col("docs"))
    # One row per occurring bucket: as many as the longest document has BUCKETs of tokens at most.
    down = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    above = hist.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).select(
        "bucket", F.coalesce(F.sum("d").over(down), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(down), F.lit(0)).alias("tokens_above"))
    within = Window.partitionBy("bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.join(above, "bucket").select(
        "length", "docs", (F.sum("docs").over(within) + F.col("docs_above")).alias("docs_from"),
        (F.sum("tokens").over(within) + F.col("tokens_above")).alias("tokens_from"))
    all_ = hist.agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).first()
    docs, tokens = F.lit(all_["d"] or 0), F.lit(all_["t"] or 0)
    below = tokens - F.col("tokens_from")
    return sums.select(
        "length", "docs", "docs_from", "tokens_from",
        (docs - F.col("docs_from") + F.col("docs")).alias("docs_upto"),
        (below + F.col("length") * F.col("docs_from")).alias("truncated_tokens"))


def quantile(table: DataFrame, q: float) -> int | None:
    """Smallest length L with at least q of all documents of length <= L, from the suffix table."""
    row = table.agg(F.sum("docs").alias("n")).first()
    if not row["n"]:
        return None
    return table.where(F.col("docs_upto") >= F.lit(q * row["n"])).agg(F.min("length")).first()[0]


def totals_at(table: DataFrame, limit: int) -> tuple[int, int]:
    """(tokens after truncation to ``limit``, documents longer than it), for any limit."""
    row = table.agg(F.sum(F.least("length", F.lit(limit)) * F.col("docs")),
                    F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("docs"))), F.lit(0))).first()
    return row[0] or 0, row[1]


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_table(staged(histogram(document_lengths(docs))))
