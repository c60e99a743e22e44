"""Quality rules by host.

Each text is measured once; rule failures are summed by host (``source``), the hosts' failure rates are
shrunk with a beta prior fitted to all hosts by moments, and the hosts' verdicts are joined back to the documents.

Host verdicts, from the shrunk rates: ``reject`` (a rule fails for more than ``max_rate`` of the host's
documents: all go), ``strict`` (some soft rule fails at more than ``excess`` times the prior's mean rate: documents
that fail a soft rule go), ``trusted`` (only documents that fail a soft rule grossly go).  A small host's few failures
hardly move its shrunk rate, so it is trusted until it has shown more than the others.  Documents that fail a base
rule or, by two to four times a soft rule's bound, that rule always go.

Null text counts as empty; a null source is a host of its own; repeated rows count as often as they occur;
an empty table gives an empty result; other columns are ignored (by ``filter_documents``: kept).
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from crimestats.llm.common import binary_list, join_few, map_batches, staged, with_columns

#: Production parameters.
MIN_WORDS = 50
MAX_RATE = 0.5
STRICT_EXCESS = 1.25
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RULES = ("base_failed", "symbols_failed", "lines_failed", "length_failed")
SOFT = RULES[1:]
GROSS = "gross_failed"


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(raw: bytes, n_chars: int) -> tuple[int, ...]:
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    blanks = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    return (len(words), n_chars - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(words), len(lines))


def _measure_batch(batch: pa.RecordBatch, prefix: str) -> dict[str, list]:
    texts = batch.column("text")
    sizes = pc.utf8_length(texts.cast(pa.string())).to_pylist()
    rows = [measure(x or b"", n or 0) for x, n in zip(binary_list(texts), sizes)]
    return {prefix + name: [r[i] for r in rows] for i, name in enumerate(MEASURES)}


def _rules(df: DataFrame, prefix: str = "") -> DataFrame:
    c = lambda name: F.col(prefix + name)
    return df.withColumns({
        prefix + "base_failed": (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > 50 * c("n_words")),
        prefix + "symbols_failed": 10 * c("n_symbols") > c("n_words"),
        prefix + "lines_failed": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        prefix + "length_failed": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words")),
        prefix + GROSS: (10 * c("n_symbols") > 4 * c("n_words")) | (10 * c("n_dup_lines") > 6 * c("n_lines"))
        | (2 * c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 30 * c("n_words")),
    })


def document_measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, the measures and the rules' outcomes of every document."""
    def fn(batch):
        return {"doc_id": batch.column("doc_id"), "host": batch.column("host")} | _measure_batch(batch, "")

    slim = docs.select(F.col("doc_id").cast("long"), _host().alias("host"), F.col("text").cast("string"))
    return _rules(map_batches(slim, fn, "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)))


def _host():
    """Key that keeps a null source apart from every string."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))


def host_verdicts(measures: DataFrame, max_rate: float = MAX_RATE, excess: float = STRICT_EXCESS) -> DataFrame:
    """One row per host: documents, failures and shrunk failure rate per rule, verdict."""
    hosts = staged(measures.groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES)))
    stats = hosts.agg(F.count("*").alias("hosts"), *(
        f(F.col(r) / F.col("n")).alias(f"{r}_{k}") for r in RULES for k, f in (("mean", F.avg), ("var", F.var_pop)))).first()
    means = {r: stats[f"{r}_mean"] or 0.0 for r in RULES}
    for r in RULES:
        # Beta(m * s, (1 - m) * s) with the hosts' mean and variance; s is held within 2 and 10^4 pseudo-documents.
        m, v = means[r], stats[f"{r}_var"] or 0.0
        s = min(1e4, max(2.0, m * (1 - m) / v - 1)) if v > 0 else 1e4
        hosts = hosts.withColumn(f"{r}_rate", (F.col(r) + m * s) / (F.col("n") + s))
    rejected = F.greatest(*(F.col(f"{r}_rate") for r in RULES)) > max_rate
    strict = F.greatest(*(F.col(f"{r}_rate") > excess * means[r] for r in SOFT))
    return hosts.withColumn("host_verdict", F.when(rejected, "reject").when(strict, "strict").otherwise("trusted"))


def _kept(prefix: str, verdict: str):
    soft = F.greatest(*(F.col(prefix + r) for r in SOFT))
    return ~F.col(prefix + "base_failed") & ~F.col(prefix + GROSS) & (F.col(verdict) != "reject") & ~((F.col(verdict) == "strict") & soft)


def host_quality(docs: DataFrame, max_rate: float = MAX_RATE, excess: float = STRICT_EXCESS) -> DataFrame:
    """Measures, rule outcomes, host verdict and ``kept`` of every document."""
    measures = staged(document_measures(docs))
    hosts = staged(host_verdicts(measures, max_rate, excess))
    return join_few(measures, hosts.select("host", "host_verdict"), "host", "doc_id").withColumn("kept", _kept("", "host_verdict"))


def filter_documents(docs: DataFrame, max_rate: float = MAX_RATE, excess: float = STRICT_EXCESS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The texts are measured again instead of being shuffled to meet their measures.
    """
    hosts = staged(host_verdicts(staged(document_measures(docs)), max_rate, excess))
    p = "__llm_"
    again = _rules(with_columns(docs, lambda b: _measure_batch(b, p), ", ".join(f"{p}{m} long" for m in MEASURES)), p)
    few = hosts.select(F.col("host").alias(p + "host"), F.col("host_verdict").alias(p + "verdict"))
    return join_few(again.withColumn(p + "host", _host()), few, p + "host", "doc_id").where(_kept(p, p + "verdict")).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    out = host_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *MEASURES, "base_failed", "host_verdict", "kept")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '-') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ \t-\r]+') AS words FROM d),
tri AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT *, unnest(range(3)) AS k FROM rep WHERE c > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^ \t-\r]') GROUP BY doc_id),
m AS (SELECT w.doc_id, host, len(words) AS n_words, length(regexp_replace(text, '[ \t-\r]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lines USING (doc_id)),
r AS (SELECT *, n_words < {MIN_WORDS} OR 2 * n_repeat_words > n_words AS base_failed, 10 * n_symbols > n_words AS f1,
             10 * n_dup_lines > 3 * n_lines AS f2, word_chars < 2 * n_words OR word_chars > 15 * n_words AS f3,
             10 * n_symbols > 4 * n_words OR 10 * n_dup_lines > 6 * n_lines OR 2 * word_chars < 3 * n_words
             OR word_chars > 30 * n_words AS gross FROM m),
h AS (SELECT host, k, count(*) AS n, sum(f::INT) AS bad FROM
      (SELECT host, unnest([0, 1, 2, 3]) AS k, unnest([base_failed, f1, f2, f3]) AS f FROM r) GROUP BY ALL),
p AS (SELECT k, avg(bad / n) AS m, var_pop(bad / n) AS v FROM h GROUP BY k),
s AS (SELECT k, m, CASE WHEN v > 0 THEN least(1e4, greatest(2.0, m * (1 - m) / v - 1)) ELSE 1e4 END AS s FROM p),
v AS (SELECT host, max((bad + m * s) / (n + s)) AS worst, bool_or(k > 0 AND (bad + m * s) / (n + s) > {STRICT_EXCESS} * m) AS soft
      FROM h JOIN s USING (k) GROUP BY host),
o AS (SELECT r.*, CASE WHEN worst > {MAX_RATE} THEN 'reject' WHEN soft THEN 'strict' ELSE 'trusted' END AS host_verdict
      FROM r JOIN v USING (host))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, host_verdict,
       NOT base_failed AND NOT gross AND host_verdict <> 'reject' AND NOT (host_verdict = 'strict' AND (f1 OR f2 OR f3)) AS kept
FROM o
"""
