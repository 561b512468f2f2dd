"""Multi-party chat formatting by perspective rotation, in DataFrame functions only.

Every participant of a conversation gets a rendering of the whole dialogue in which that speaker is the assistant, all
others are named users, and only the assistant's words (and the end mark after them) are trained on. A
rendering is a sequence of segments, one row per turn, with the places of the segment and of its trained
span in the rendered text; in order of `position` the `rendered` columns of a conversation and perspective are that text. A
conversation of any length therefore never has to fit in one row or task: turns are numbered over range
partitions and worked on in blocks of `BLOCK` turns.

Turns go by `turn` ascending, nulls last, then role and text; repeated rows are turns of their own. Roles in
`system_roles` speak to everyone: they keep their role in each perspective and have none of their own, so a
conversation of such roles alone has no rows. A null role is the speaker `UNNAMED`, a null text is empty, a
null conversation is one conversation. Marks inside a text or name are broken up with a blank, so that no text can
pose as a mark. Further columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted
from tidemart.operators.order import null_safe_join, running

BLOCK = 1024
UNNAMED = "unknown"
OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"
SYSTEM_ROLES = ("system",)


def plain(text: Column) -> Column:
    """Text in which no mark begins."""
    return F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def header(role: Column, name: Column) -> Column:
    """`<|role|>` or `<|role name=...|>` and a line feed."""
    named = F.concat(F.lit(OPEN), role, F.lit(" name="), name, F.lit(CLOSE + "\n"))
    return F.coalesce(named, F.concat(F.lit(OPEN), role, F.lit(CLOSE + "\n")))


def numbered_turns(turns: DataFrame, conversation: str, turn: str, role: str, text: str, system_roles: Sequence[str]) -> DataFrame:
    """Turns with their position from 1 on, and the length of what comes before if nobody were the assistant."""
    speaker = F.coalesce(F.col(quoted(role)).cast("string"), F.lit(UNNAMED))
    rows = turns.select(
        F.col(quoted(conversation)).alias("conv_id"), F.col(quoted(turn)).alias("turn"), speaker.alias("speaker"),
        speaker.isin(list(system_roles)).alias("is_system"), plain(F.col(quoted(text))).alias("content"),
    )
    shown = F.when(F.col("is_system"), header(F.col("speaker"), F.lit(None).cast("string"))).otherwise(header(F.lit("user"), plain(F.col("speaker"))))
    length = F.length(shown) + F.length("content") + F.lit(len(END))
    order = ["turn", "speaker", "content"]
    placed = running(rows, ["conv_id"], order, {"position": ("sum", F.lit(1).cast("long")), "upto": ("sum", length.cast("long"))})
    return placed.withColumn("before", F.col("upto") - length).withColumn("block", F.floor((F.col("position") - 1) / BLOCK)).drop("upto")


def perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    system_roles: Sequence[str] = SYSTEM_ROLES,
) -> DataFrame:
    """One row per conversation, perspective and turn: conv_id, perspective, position, turn, role, name, content,
    rendered, train, start, end (of the segment), mask_start, mask_end (of the trained span; null where nothing is trained)."""
    placed = numbered_turns(turns, conversation, turn, role, text, system_roles)
    spoken = placed.filter(~F.col("is_system")).groupBy("conv_id", "speaker", "block").agg(F.count(F.lit(1)).alias("spoken"))
    speakers = spoken.select("conv_id", F.col("speaker").alias("perspective")).distinct()
    blocks = placed.select("conv_id", "block").distinct()
    # as many rows as blocks and speakers: how often each had spoken before each block
    grid = null_safe_join(blocks, speakers, ["conv_id"], "inner")
    grid = null_safe_join(grid, spoken.withColumnRenamed("speaker", "perspective"), ["conv_id", "perspective", "block"])
    earlier = W.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    grid = grid.withColumn("turns_before", F.coalesce(F.sum("spoken").over(earlier), F.lit(0))).drop("spoken")
    rows = null_safe_join(placed, grid, ["conv_id", "block"], "inner")

    own = ~F.col("is_system") & (F.col("speaker") == F.col("perspective"))
    within = W.partitionBy("conv_id", "block", "perspective").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    said = F.col("turns_before") + F.coalesce(F.sum(own.cast("long")).over(within), F.lit(0))
    as_user = F.length(header(F.lit("user"), plain(F.col("perspective"))))
    as_assistant = F.lit(len(OPEN + "assistant" + CLOSE + "\n"))
    shown_role = F.when(own, "assistant").when(F.col("is_system"), F.col("speaker")).otherwise("user")
    name = F.when(~own & ~F.col("is_system"), plain(F.col("speaker")))
    rows = rows.withColumns({"role": shown_role, "name": name, "train": own, "start": F.col("before") + said * (as_assistant - as_user)})
    rows = rows.withColumn("rendered", F.concat(header(F.col("role"), F.col("name")), "content", F.lit(END)))
    end = F.col("start") + F.length("rendered")
    return rows.select(
        "conv_id", "perspective", "position", "turn", "role", "name", "content", "rendered", "train", "start", end.alias("end"),
        F.when(F.col("train"), F.col("start") + as_assistant).alias("mask_start"), F.when(F.col("train"), end).alias("mask_end"),
    )
