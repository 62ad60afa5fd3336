"""Connected components of a graph given by links, by repeated local contraction.

In each round every vertex moves to the least of itself and its neighbours, links follow their
ends, and links within one vertex vanish. The first round takes the least by number, which
collapses stars at once; the others by a hash that changes with the round, which shortens long
chains by a constant factor whatever their numbering. Only vertex numbers and links are
shuffled; minima are merged on the map side, and a vertex with very many links is a hot join
key that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of `links` (a, b), component_id the smallest id.

    Repeated links, loops and both directions of a link do no harm; null ends are ignored.
    """
    edges = checkpoint(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    moves: list[DataFrame] = []
    round_ = 0
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        if round_ == 0:
            to = F.least(F.min("v"), "u")
        else:
            ranked = lambda v: F.struct(F.xxhash64(v, F.lit(round_)).alias("r"), F.col(v).alias("v"))
            to = F.least(F.min(ranked("v")), ranked("u"))["v"]
        least = ends.groupBy("u").agg(to.alias("to"))
        step = checkpoint(least.withColumnRenamed("u", "id"))
        moves.append(step)
        edges = checkpoint(
            edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
            .join(step.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
        round_ += 1
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component_id"))
    # From the last round back: where a vertex ends is where the vertex it moved to ends.
    ends_at = moves[-1].select("id", F.col("to").alias("root"))
    for step in reversed(moves[:-1]):
        later = ends_at.select(F.col("id").alias("to"), "root")
        ends_at = step.join(later, "to", "left").select(
            "id", F.coalesce("root", "to").alias("root")
        )
    least = ends_at.groupBy("root").agg(F.min("id").alias("component_id"))
    return ends_at.join(least, "root").select("id", "component_id")
