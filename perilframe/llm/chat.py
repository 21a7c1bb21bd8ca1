"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation its dialogue is rendered with that speaker as the assistant and others as named users;
the training mask covers the assistant's turns only. Instructions (role ``system``) are no participant and stand as they are.

A conversation is rendered in parts of ``PART`` turn numbers, so a very long one never meets in one task or one row; parts are
numbered, and joined in order they give the whole dialogue. Where turn numbers repeat or are missing, so that a part has
more rows than that, its rows are dealt by hash to as many sub-parts as it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 128
NO_SPEAKER = "system"


def rotated(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, assistant, part, sub_part, n_turns, text and mask for every participant and part of a conversation.

    mask: runs of ``length:flag`` over the characters of text, flag 1 where the assistant's own words are to be learned
    (with the end mark). Turns are ordered by turn, then role, then text; repeated rows are rendered as often as they come. Null
    turns come first, a null role speaks as ``unknown``, a null text is empty, rows with a null conv_id are one conversation.
    The mark ``<|`` inside texts and roles, and line ends inside roles, are broken up, so that neither can forge a turn. A
    conversation of instructions only has no participant and no row. Other columns are not looked at.
    """
    role = F.coalesce("role", F.lit("unknown"))
    body = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select("conv_id", "turn", role.alias("role"), body.alias("body"), F.coalesce(F.floor(F.col("turn") / part), F.lit(-1)).cast("long").alias("part"))
    # equal rows are counted before the shuffle and spread again by their copy's number
    rows = rows.groupBy("conv_id", "turn", "role", "body", "part").agg(F.count(F.lit(1)).alias("copies"))
    full = rows.groupBy("conv_id", "part").agg(F.sum("copies").alias("_n")).where(F.col("_n") > part).select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.ceil(F.col("_n") / part).alias("_subs"))
    rows = rows.join(full, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    spot = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("turn").cast("string"), F.lit("")), F.lit(":"), F.col("role"), F.lit(":"), F.col("body"))), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("sub_part", F.coalesce(F.pmod(spot + F.col("_copy"), F.col("_subs")), F.lit(0).cast("long")))
    parts = rows.groupBy("conv_id", "part", "sub_part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "body"))).alias("turns"))
    who = turns.select(F.col("conv_id").alias("_conv"), role.alias("assistant")).where(F.col("assistant") != NO_SPEAKER).distinct()
    both = parts.join(who, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def head(t):
        mine = F.when(t["role"] == F.col("assistant"), F.lit("assistant")).when(t["role"] == NO_SPEAKER, F.lit(NO_SPEAKER))
        name = F.replace(F.replace(t["role"], F.lit("<|"), F.lit("< |")), F.lit("\n"), F.lit(" "))
        return F.concat(F.lit("<|im_start|>"), F.coalesce(mine, F.concat(F.lit("user name="), name)), F.lit("\n"))

    def tail(t):
        return F.concat(t["body"], F.lit("<|im_end|>\n"))

    def mask(t):
        return F.concat(F.length(head(t)), F.lit(":0 "), F.length(tail(t)), F.when(t["role"] == F.col("assistant"), F.lit(":1")).otherwise(F.lit(":0")))

    return both.select(
        "conv_id", "assistant", "part", "sub_part", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), tail(t))), "").alias("text"),
        F.array_join(F.transform("turns", mask), " ").alias("mask"),
    )


#: The same in DuckDB.
SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS body,
         coalesce(CAST(floor(turn / 128) AS BIGINT), -1) AS part FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, role, body) - 1 AS copy, count(*) OVER (PARTITION BY conv_id, part) AS n,
      ('0x' || substr(md5(coalesce(CAST(turn AS VARCHAR), '') || ':' || role || ':' || body), 1, 8))::BIGINT AS spot FROM r),
s AS (SELECT *, CASE WHEN n > 128 THEN (spot + copy) % CAST(ceil(n / 128.0) AS BIGINT) ELSE 0 END AS sub_part FROM n),
w AS (SELECT DISTINCT conv_id, role AS assistant FROM r WHERE role <> 'system'),
j AS (SELECT s.*, w.assistant,
  '<|im_start|>' || CASE WHEN role = assistant THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || replace(replace(role, '<|', '< |'), chr(10), ' ') END || chr(10) AS head,
  body || '<|im_end|>' || chr(10) AS tail FROM s JOIN w ON s.conv_id IS NOT DISTINCT FROM w.conv_id)
SELECT conv_id, assistant, part, CAST(sub_part AS BIGINT) AS sub_part, count(*) AS n_turns, string_agg(head || tail, '' ORDER BY turn NULLS FIRST, role, body) AS text,
  string_agg(length(head) || ':0 ' || length(tail) || CASE WHEN role = assistant THEN ':1' ELSE ':0' END, ' ' ORDER BY turn NULLS FIRST, role, body) AS mask
FROM j GROUP BY conv_id, assistant, part, sub_part
"""
