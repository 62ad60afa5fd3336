"""Multi-party perspective rotation: each participant in turn is the assistant.

For every participant of a dialogue the whole dialogue is rendered with that speaker as
assistant and everyone else as a named user; the mask marks what the model is trained on, the
assistant's own texts and their end marks. The system role speaks as system in every
perspective and has none of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import running_total

#: Turns in one rendered row; a longer dialogue goes on in the next part.
PART = 64
SYSTEM = "system"
NOBODY = "unknown"
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    """The text with every opening mark doubled, so that it cannot be taken for one of ours."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, role, text and rank, from 0, of each turn in its dialogue.

    Turns are ordered by turn (null first), role and text. A dialogue may hold most of the
    table: ranks come from counts of runs of turn numbers, never from one task per dialogue.
    """
    rows = turns.select(
        "conv_id",
        F.coalesce("conv_id", F.lit(0)).alias("c"),
        F.col("conv_id").isNull().alias("c_null"),
        F.coalesce("turn", F.lit(-(2**62))).cast("long").alias("t"),
        F.coalesce("role", F.lit(NOBODY)).alias("speaker"),
        F.col("role").isNotNull().alias("named"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1).alias("one"),
    ).withColumn("run", F.floor(F.col("t") / PART))
    return running_total(rows, ["c", "c_null"], "run", ["t", "named", "speaker", "text"], "one", "rank")


def perspectives(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, assistant, part, n_turns, text and mask of every perspective of every dialogue.

    `turns` needs conv_id, turn, role and text; other columns are ignored. A row holds up to
    `part` turns, all of them in order, so no row and no task grows with the dialogue. `mask`
    lists (start, end) in code points of the row's text, end exclusive. A null role speaks as
    user "unknown" and has no perspective, a null text is empty, a null conv_id is a dialogue of
    its own, repeated turns stay. A dialogue without participants and an empty table give no rows.
    """
    ranked = numbered(turns)
    people = ranked.where(F.col("named") & (F.col("speaker") != SYSTEM)).select(
        "c", "c_null", F.col("speaker").alias("assistant")
    )
    both = ranked.join(people.distinct(), ["c", "c_null"])
    own = F.col("named") & (F.col("speaker") == F.col("assistant"))
    head = (
        F.when(own, "<|assistant|>\n")
        .when(F.col("named") & (F.col("speaker") == SYSTEM), "<|system|>\n")
        .otherwise(F.concat(F.lit("<|user:"), escaped(F.col("speaker")), F.lit("|>\n")))
    )
    said = F.struct(
        "rank",
        F.length(head).alias("head"),
        F.concat(head, escaped(F.col("text")), F.lit(END)).alias("body"),
        own.alias("own"),
    )
    grouped = both.groupBy(
        "conv_id", "c", "c_null", "assistant", F.floor(F.col("rank") / part).alias("part")
    ).agg(F.array_sort(F.collect_list(said)).alias("turns"))  # `part` turns at most

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state: Column, x: Column) -> Column:
        end = state["at"] + F.length(x["body"])
        span = F.struct((state["at"] + x["head"]).alias("start"), end.alias("end"))
        mask = F.when(x["own"], F.array_append(state["mask"], span)).otherwise(state["mask"])
        return F.struct(end.alias("at"), mask.alias("mask"))

    return grouped.select(
        "conv_id",
        "assistant",
        "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: x["body"]), "").alias("text"),
        F.aggregate("turns", start, step, lambda s: s["mask"]).alias("mask"),
    )
