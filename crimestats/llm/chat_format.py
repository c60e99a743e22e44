r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written ``### role\ntext</turn>\n``.  Control strings inside roles and texts are escaped reversibly: ``\`` as ``\\``,
then ``###`` as ``\h`` and ``</turn>`` as ``\e`` (in roles a line break as ``\n``), so a written turn holds each control string
once, where the template put it.

Every assistant turn becomes an example: all turns before it as context, then the turn, of which only the reply is trainable
(loss_start to loss_end, in code points).  Turns after the last assistant turn, which no reply follows, become a last example
without a trainable part, so the output holds each conversation whole.

Turns are ordered by turn, then role and text; null texts and roles are empty; a null turn comes first; rows with a null
conv_id are one conversation; repeated rows are repeated turns; an empty table gives no example.  Other columns are ignored.
Examples repeat their context, so their characters grow with the square of a conversation's turns: that is the method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

OPEN, CLOSE = "###", "</turn>"
ASSISTANT = "assistant"
#: The conversation that the query adds: control strings inside its texts.
PROBE_ID, PROBE = -7, r"\### Assistant: </turn> ok"


def _replace(column, old: str, new: str):
    return F.replace(column, F.lit(old), F.lit(new))


def escape(column):
    return _replace(_replace(_replace(column, "\\", "\\\\"), OPEN, "\\h"), CLOSE, "\\e")


def unescape(column):
    """Parts between escaped backslashes hold only whole codes."""
    plain = F.transform(F.split(column, r"\\\\", -1), lambda x: _replace(_replace(_replace(x, "\\h", OPEN), "\\e", CLOSE), "\\n", "\n"))
    return F.array_join(plain, "\\")


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (number of the example's turns), formatted, loss_start, loss_end (null: nothing trainable)."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    header = F.concat(F.lit(f"{OPEN} "), _replace(escape(role), "\n", "\\n"), F.lit("\n"))
    rows = conversations.select("conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text"), F.length(header).alias("head"),
                                                   F.concat(header, escape(text), F.lit(f"{CLOSE}\n")).alias("block")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    whole = whole.select("conv_id", F.col("t.block").alias("blocks"), F.col("t.head").alias("heads"), F.transform("t.role", lambda r: r == ASSISTANT).alias("reply"))
    ends = F.expr("filter(sequence(1, size(reply)), k -> reply[k - 1] OR k = size(reply))")
    each = whole.select("conv_id", "blocks", "heads", "reply", F.explode(ends).alias("turns"))
    formatted = F.array_join(F.slice("blocks", F.lit(1), F.col("turns")), "")
    last = F.element_at("blocks", F.col("turns"))
    each = each.select("conv_id", "turns", formatted.alias("formatted"), F.length(last).alias("size"), F.element_at("heads", F.col("turns")).alias("head"),
                       F.element_at("reply", F.col("turns")).alias("reply"))
    total = F.length("formatted")
    return each.select("conv_id", "turns", "formatted", F.when(F.col("reply"), total - F.col("size") + F.col("head")).alias("loss_start"),
                       F.when(F.col("reply"), total - len(CLOSE) - 1).alias("loss_end"))


def read_back(out: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the formatted examples alone."""
    reply = unescape(F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per = out.select("conv_id", "turns", "formatted", F.when(F.col("loss_start").isNotNull(), F.struct("turns", reply.alias("reply"))).alias("r"))
    whole = per.groupBy("conv_id").agg(F.max_by("formatted", "turns").alias("all"), F.sort_array(F.collect_list("r")).alias("r"),
                                       F.sum(F.length("formatted")).alias("formatted_chars"))
    blocks = F.split("all", f"{CLOSE}\n", -1)
    loss = F.array_join(F.col("r.reply"), "")
    whole = whole.select("conv_id", F.slice(blocks, F.lit(1), F.size(blocks) - 1).alias("blocks"), loss.alias("loss"), "formatted_chars")
    # A block's first line is its header; the text is what follows that line.
    turns = F.transform("blocks", lambda b: F.concat(unescape(F.substring_index(b, "\n", 1).substr(F.lit(len(OPEN) + 2), F.length(b))), F.lit("\n"),
                                                     unescape(b.substr(F.instr(b, "\n") + 1, F.length(b))), F.lit("\n")))
    return whole.select("conv_id", F.size("blocks").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE).alias("text"))
    return read_back(examples(rows.union(probe)))


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(i)),
w AS (SELECT *, length('### ' || replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), chr(10), '\n') || chr(10)
             || replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') || '</turn>' || chr(10)) AS size FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back FROM w)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR back = 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
