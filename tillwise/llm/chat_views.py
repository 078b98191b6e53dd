"""Chat formatting by perspective rotation: each participant in turn is the assistant.

Messages stay rows, so a conversation of any length is never gathered. Character offsets in
a rendering are running sums in two levels, over blocks of turns and inside a block, so no task
holds more than a block of a long conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one block of the running sum.
BLOCK = 256
SYSTEM = "system"
#: The template, as one list of pieces.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def speaker(role: Column) -> Column:
    return F.coalesce(role, F.lit("unknown"))


def views(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text to one row per message and perspective.

    For each participant (a speaker other than ``system``) the whole dialogue is rendered:
    that speaker as assistant, the others as users with their names, the system prompt as it is.
    ``start`` is where a message begins in the rendering (characters), and [mask_start,
    mask_end) is what a loss would train on: the assistant's words and their end mark; both are
    equal for other messages. Messages are ordered by turn, then speaker, then text; a null
    turn comes first, a null text is empty, a null role is the speaker ``unknown``; repeated rows
    are repeated messages. A conversation of system prompts alone gives no rows; other columns
    are ignored.
    """
    messages = conversations.select("conv_id", "turn", speaker(F.col("role")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    messages = messages.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 40))).cast("long"))
    people = messages.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    # A participant's own messages are rows of theirs, so this multiplies by participants only.
    seen = messages.join(people.withColumnRenamed("conv_id", "__conv"), F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when(own | (F.col("speaker") == SYSTEM), F.lit("")).otherwise(F.col("speaker"))
    head = F.concat(F.lit(OPEN), "role", F.when(F.col("name") == "", "").otherwise(F.concat(F.lit(" name="), "name")), F.lit(MIDDLE))
    seen = seen.withColumn("role", role).withColumn("name", name).withColumn("head", head)
    seen = seen.withColumn("rendered", F.concat("head", "text", F.lit(CLOSE))).withColumn("width", F.length("rendered").cast("long"))

    key = ("conv_id", "perspective")
    inside = Window.partitionBy(*key, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = seen.groupBy(*key, "block").agg(F.sum("width").alias("sum"), F.count("*").alias("n"))
    blocks = blocks.select(
        *(F.col(k).alias(f"__{k}") for k in (*key, "block")),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("count"),
    )
    placed = seen.withColumn("place", F.row_number().over(inside) - 1).withColumn(
        "inner", F.sum("width").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("width")
    )
    on = F.lit(True)
    for k in (*key, "block"):
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    start = (F.col("chars") + F.col("inner")).alias("start")
    mine = F.col("role") == "assistant"
    out = placed.join(blocks, on).select("*", start)
    mask_start = F.when(mine, F.col("start") + F.length("head")).otherwise(F.col("start")).cast("long")
    mask_end = F.when(mine, F.col("start") + F.length("head") + F.length("text") + len(CLOSE) - 1).otherwise(F.col("start")).cast("long")
    return out.select(
        "conv_id", "perspective", (F.col("count") + F.col("place")).cast("long").alias("position"), "turn", "role", "name",
        "rendered", "start", mask_start.alias("mask_start"), mask_end.alias("mask_end"),
    )


ORACLE = f"""
WITH messages AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM messages WHERE speaker <> '{SYSTEM}'),
seen AS (
  SELECT m.*, perspective,
    CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
    CASE WHEN speaker IN ('{SYSTEM}', perspective) THEN '' ELSE speaker END AS name
  FROM messages m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (SELECT *, '{OPEN}' || role || CASE WHEN name = '' THEN '' ELSE ' name=' || name END || chr(10) AS head FROM seen),
full_text AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM headed),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    CAST(sum(length(rendered)) OVER (w ROWS UNBOUNDED PRECEDING) - length(rendered) AS BIGINT) AS start
  FROM full_text
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text))
SELECT conv_id, perspective, position, turn, role, name, rendered, start,
  CAST(CASE WHEN role = 'assistant' THEN start + length(head) ELSE start END AS BIGINT) AS mask_start,
  CAST(CASE WHEN role = 'assistant' THEN start + length(head) + length(text) + {len(CLOSE) - 1} ELSE start END AS BIGINT) AS mask_end
FROM placed
"""
