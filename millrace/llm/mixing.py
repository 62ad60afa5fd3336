"""Mixing sources by a time-varying curriculum, with DataFrame functions only.

Each source has a weight that changes in a straight line over the run. Its integral over the
whole run is the source's share of all tokens, its integral up to time t the share of them
demanded by then. A document whose tokens lie at cumulative demand u of its source is due at
the time t whose integral is u, so inverting the integral gives every document its training
position, and sorting by position mixes the sources in the wanted, changing proportions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import WORD, checkpoint, running_total

#: (weight at the start, weight at the end); sources in order take them in turn. Their
#: integrals are 3, 1 and 2: the first fades out, the second comes in, the third is constant.
SCHEDULES = ((4.5, 1.5), (0.5, 1.5), (2.0, 2.0))
#: Words of the mix in all words.
TOTAL = 1.5
#: No source, and so no document, is taken more often than this.
EPOCHS = 2


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sources: DataFrame,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    total: float = TOTAL,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Add rank, schedule and target to a table of source and source_size, one row a source.

    Sources are ranked by code point, null last. Shares go by the integral of the schedule.
    A source of which more than `epochs` times its size were asked stops there, and the excess
    is shared again by weight until none is above. That end is found directly: with sources
    in the order of epochs * size / weight, the level (words per unit of weight) is the largest
    that results when the first k sources are held at their limit.
    """
    kinds = len(schedules)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = (F.col("rank") % kinds + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(float(s[i])) for s in schedules]), turn)
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", "rank")
    held = F.sum("stop").over(by_limit.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("rank", rank)
        .withColumns({"w_start": pick(0), "w_end": pick(1)})
        .withColumn("weight", (F.col("w_start") + F.col("w_end")) / 2)
        .withColumn("stop", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("ratio", F.col("stop") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(total))
        .withColumn("level", (F.col("wanted") - F.coalesce(held, F.lit(0.0))) / rest)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("stop", F.col("weight") * F.col("level")))
        .select("source", "source_size", "rank", "w_start", "w_end", "target")
    )


def due(share: Column, start: Column, end: Column) -> Column:
    """The time in [0, 1] by which this share of a source's tokens is demanded.

    Solves start * t + (end - start) * t^2 / 2 = share * (start + end) / 2.
    """
    slope = end - start
    root = F.sqrt(start * start + slope * (start + end) * share)
    return F.when(slope == 0, share).otherwise((root - start) / slope)


def curriculum(
    docs: DataFrame,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    total: float = TOTAL,
    epochs: int = EPOCHS,
    carry: bool = False,
) -> DataFrame:
    """One row per row of `docs` (doc_id, source, text): what the mix takes of it and when.

    Gives doc_id, source, size, source_size, target, taken (words, repeats counted) and the
    position of each of its `epochs` turns in the run (null where the turn takes less than
    half of it). A source's documents come in the order of md5(doc_id), once over for each
    epoch; the words of a source add up to its rounded target, so the last document of a source
    may be taken in part. With `carry` the whole row of `docs` comes along as struct `row`, and `place`,
    where the row stands in its source's time whether or not it is taken; rows of one id and size
    are then told apart by their contents. Null texts have no words and nothing is taken of them;
    null sources are one source; equal ids and equal rows are rows of their own. Other columns are
    ignored.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row"), _tie(docs).alias("tie")] if carry else []),
    )
    if not carry:
        sized = checkpoint(sized)
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), schedules, total, epochs)
    rows = (
        sized.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("bucket", F.substring("key", 1, 3))
    )
    order = ["key", "size", *(["tie"] if carry else [])]
    rows = running_total(rows, ["rank"], "bucket", order, "size", "before")
    budget = F.floor(F.col("target") + F.lit(0.5))
    turns = [
        F.greatest(
            F.lit(0),
            F.least(F.col("size"), budget - F.col("source_size") * e - F.col("before")),
        )
        for e in range(epochs)
    ]
    rows = rows.withColumns({f"turn_{e}": t for e, t in enumerate(turns)})
    middle = lambda e: (
        F.col("source_size") * e + F.col("before") + F.col(f"turn_{e}") / 2
    ) / F.greatest(budget, F.lit(1))
    rows = rows.withColumns(
        {
            f"position_{e}": F.when(
                (F.col(f"turn_{e}") > 0) & (F.col(f"turn_{e}") * 2 >= F.col("size")),
                due(middle(e), F.col("w_start"), F.col("w_end")),
            )
            for e in range(epochs)
        }
    )
    share = F.least(F.col("before") / F.greatest(budget, F.lit(1)), F.lit(1.0))
    rows = rows.withColumn("place", due(share, F.col("w_start"), F.col("w_end")))
    taken = sum((F.col(f"turn_{e}") for e in range(1, epochs)), F.col("turn_0"))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        *[f"position_{e}" for e in range(epochs)],
        *(["row", "place"] if carry else []),
    )


def _tie(docs: DataFrame) -> Column:
    """A hash of the row; rows that share it are taken for equal."""
    unordered = (T.MapType, T.VariantType)
    values = [
        F.to_json(F.struct(docs[f.name])) if isinstance(f.dataType, unordered) else docs[f.name] for f in docs.schema
    ]
    return F.xxhash64(*values)


def mixed(
    docs: DataFrame,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    total: float = TOTAL,
    epochs: int = EPOCHS,
) -> DataFrame:
    """The rows of `docs` in training order, each whole and as often as it has positions.

    A row without a word cannot change what share a source has: it comes once, at its place.
    """
    plan = curriculum(docs, schedules, total, epochs, carry=True)
    due_at = F.array_compact(F.array(*[f"position_{e}" for e in range(epochs)]))
    positions = F.when(F.col("size") == 0, F.array("place")).otherwise(due_at)
    return (
        plan.select(F.explode(positions).alias("position"), "row")
        .orderBy("position", "row.doc_id")
        .select("row.*")
    )


