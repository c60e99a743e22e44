"""Fill-in-the-middle transformation by repeated-capture matching.

A text is cut into units, letter runs and single other characters.  One ``fullmatch`` of ``(unit)*`` retains every
repetition of its group: ``ends(1)`` has an offset per unit, so its length is n and two of its entries are the cuts.  Where
the cuts fall and which form is written comes from a hash of the seed and the doc_id alone, so reruns agree and no row
depends on another.

Forms: ``psm`` writes prefix, suffix, middle and ``spm`` suffix, prefix, middle, each part behind its marker; ``plain`` is
the text itself.  A text that contains a marker is always plain, so the markers of an output are the written ones:
no marker can begin in one part and end in another, as ``<`` occurs in none but at its start.

Null text is treated as empty; an empty text is plain with n = 0.  A null doc_id hashes as an empty one.  Repeated rows get
the same result, an empty table an empty one; other columns than doc_id and text are ignored.  Memory follows the longest text
of a batch: about 50 bytes a unit while it is matched.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from crimestats.llm.common import map_batches

#: The repeated group; its alternatives share no first character, so no repetition is ever given back.
UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Shares(NamedTuple):
    """Seed of the hashes; per cent of texts that are transformed; per cent of these written suffix first."""

    seed: int = 1
    transformed: int = 90
    suffix_first: int = 20


def cuts(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """n and the code point offsets behind which the middle and the suffix begin."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[one - 1] if one else 0, ends[two - 1] if two else 0


def _written(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
    rows = zip(*(batch.column(c).to_pylist() for c in ("text", "h1", "h2", "transform", "suffix_first")))
    for text, h1, h2, transform, suffix_first in rows:
        n, start, end = cuts(text, h1, h2)
        form, output, sizes = "plain", text, (None, None)
        if n and transform and not any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            prefix, middle, suffix = PREFIX + text[:start], MIDDLE + text[start:end], SUFFIX + text[end:]
            form, output = ("spm", suffix + prefix + middle) if suffix_first else ("psm", prefix + suffix + middle)
            sizes = start, end - start
        for name, value in zip(out, (n, form, *sizes, output)):
            out[name].append(value)
    return {"doc_id": batch.column("doc_id"), **out}


def fill_in_middle(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain), output of every document."""
    digest = F.sha2(F.concat(F.lit(f"{shares.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), digest.alias("d"))
    h = [F.conv(F.substring("d", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    rows = rows.select("doc_id", "text", h[0].alias("h1"), h[1].alias("h2"), (h[2] % 100 < shares.transformed).alias("transform"),
                       (h[3] % 100 < shares.suffix_first).alias("suffix_first"))
    return map_batches(rows, _written, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output of a form was made of."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    whole = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(whole)


def query(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored("output", "form"), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(d, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(d, 9, 8))::BIGINT % (len(u) + 1) AS y,
         ('0x' || substr(d, 17, 8))::BIGINT % 100 AS keep, ('0x' || substr(d, 25, 8))::BIGINT % 100 AS turn FROM u),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR keep >= 90 THEN 'plain'
                 WHEN turn < 20 THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(u[1:least(x, y)], ''), '') AS p, coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(x, y) + 1:n], ''), '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
