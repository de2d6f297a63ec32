r"""Chat formatting by perspective rotation.

For every participant of a dialogue, `rotate` renders the dialogue once more with that participant
as the assistant and all others as named users. A rendering is a set of message rows in turn
order: chat role, speaker name, the rendered message text, the training mask (true where the loss
counts: the perspective's own turns) and the part of the rendered text that the mask covers. Rows
of one rendering never meet in one task, so a dialogue of any length can be rendered. `position`
orders the rows of equal turn numbers: sort by turn, position.

Texts and names can't forge marks: each `<|` in them, also with backslashes in between, gets one
more backslash (`<\|`), which can be taken off again; line breaks in names become blanks.

System turns (role `system`) belong to no participant: they keep the system role in every
rendering and are never trained on. Defined results: a null role speaks as `unknown`; a null or
empty text renders an empty message; a null conversation id forms one dialogue of its own; equal
turn numbers keep both rows (`position` counts them by role, then text); repeated rows are repeated; a dialogue
with system turns only has no rendering; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, perspective, turn, position, speaker, chat_role, name, message, mask, mask_start, mask_end.

    message is `<|role|>name\\n` + text + `<|end|>\\n`; mask_start and mask_end are code points of
    message (end exclusive, the end mark is trained on), null where nothing is trained on.
    """
    turns = df.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("position", F.row_number().over(Window.partitionBy("conv", "turn").orderBy("speaker", "text")))
    cast = turns.filter(F.col("speaker") != SYSTEM).select(F.col("conv").alias("of"), F.col("speaker").alias("perspective")).distinct()
    both = turns.join(cast, F.col("conv").eqNullSafe(F.col("of")))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    head = F.concat(F.lit("<|"), role, F.lit("|>"), F.when(role == "user", escaped(F.translate("speaker", "\r\n", "  "))).otherwise(F.lit("")), F.lit("\n"))
    body = escaped(F.col("text"))
    return both.select(
        F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "position", "speaker", role.alias("chat_role"),
        F.when(role == "user", F.col("speaker")).alias("name"), F.concat(head, body, F.lit("<|end|>\n")).alias("message"), own.alias("mask"),
        F.when(own, F.length(head)).cast("long").alias("mask_start"), F.when(own, F.length(head) + F.length(body) + F.lit(7)).cast("long").alias("mask_end"),
    )
