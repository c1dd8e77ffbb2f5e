"""Chat formatting with the perspective rotated through all participants.

For every participant of a conversation the dialogue is rendered once with that speaker as
the assistant, the others as named users, and system turns as they are. A mask tells
which characters of the rendered dialogue are to be learned: what the assistant says,
with its end mark. Rows are segments, one per turn and perspective, with their places in the
dialogue: a conversation of any length needs no single row or task that holds it whole.
Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import join_hot

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Turns that one task numbers at a time.
RUN_TURNS = 1024


def rotate(turns: DataFrame) -> DataFrame:
    """Render every conversation from the perspective of each participant.

    ``turns``: conv_id, turn, role, text, any others. Participants are all roles but
    'system'; a conversation without one has no perspective and gives no rows. Returns conv_id,
    perspective, seq (from 0, by turn, role and text), turn, role (assistant, user or
    system), name (of users), segment, mask (1: learned), begin, end (of the segment in the dialogue, in
    characters) and train_begin, train_end (learned part, null if none). A null role is
    the speaker 'unknown', a null text is empty, a null turn comes first, null conversations are one of their
    own; repeated turns stay; marks inside texts and names are broken up; an empty table
    gives no rows.
    """
    name = F.regexp_replace(F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit("unknown")), "[^A-Za-z0-9_-]", "_")
    said = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |"))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    rows = turns.select("conv_id", conv.alias("conv"), "turn", name.alias("speaker"), said.alias("said"))
    rows = rows.withColumn("run", F.expr(f"cast(floor(coalesce(turn, -1) / {RUN_TURNS}) as long)"))
    counts = rows.groupBy("conv").agg(F.count("*").alias("turns"))
    speakers = rows.where("speaker != 'system'").select("conv", "speaker").distinct()
    people = speakers.groupBy("conv").agg(F.array_sort(F.collect_list("speaker")).alias("people")).join(counts, "conv")
    total = turns.count()
    seen = join_hot(rows, people, "conv", "turns", total).withColumn("perspective", F.explode("people"))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == "system", "system").when(own, "assistant").otherwise("user")
    seen = seen.withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", F.col("speaker")))
    head = F.concat(F.lit(BEGIN), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    seen = seen.withColumn("head", F.length(head).cast("long")).withColumn("segment", F.concat(head, "said", F.lit(END + "\n")))
    seen = seen.withColumn("chars", F.length("segment").cast("long"))
    near = Window.partitionBy("conv", "perspective", "run").orderBy("turn", "speaker", "said")
    seen = seen.withColumn("seq", F.row_number().over(near) - 1)
    seen = seen.withColumn("end", F.sum("chars").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    # places of whole runs: one small row each
    by_run = Window.partitionBy("conv", "perspective").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    ahead = seen.groupBy("conv", "perspective", "run").agg(F.count("*").alias("n"), F.sum("chars").alias("c"))
    ahead = ahead.select(
        "conv", "perspective", "run",
        F.coalesce(F.sum("n").over(by_run), F.lit(0)).alias("seq_ahead"),
        F.coalesce(F.sum("c").over(by_run), F.lit(0)).alias("chars_ahead"),
    )
    seen = seen.join(ahead, ["conv", "perspective", "run"])
    end = F.col("end") + F.col("chars_ahead")
    begin = end - F.col("chars")
    mask = F.when(F.col("role") == "assistant", 1).otherwise(0)
    return seen.select(
        "conv_id", "perspective", (F.col("seq") + F.col("seq_ahead")).cast("long").alias("seq"), "turn", "role", "name", "segment",
        mask.alias("mask"), begin.alias("begin"), end.alias("end"),
        F.when(mask == 1, begin + F.col("head")).alias("train_begin"),
        F.when(mask == 1, end - 1).alias("train_end"),
    )
