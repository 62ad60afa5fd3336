"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, DataFrames only.

Every shard owns `virtual` points of a ring; a key belongs to the first point clockwise of its
hash. A shard takes rows up to its capacity; what comes to a full shard continues clockwise to
the next point whose shard has room. Capacities are exact shares of the row count, so counts
differ by one at most, and most rows stay where the plain ring has them.

Which row overflows does not matter to the balance, so the walk around the ring needs only the
number of rows in each arc (shards * virtual numbers, whatever the input). It yields, for every
arc, which share of its rows goes where; a row finds its share by its rank within the arc.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint, running_total

SHARDS = 8
VIRTUAL = 64
#: The ring has this many positions: the first 32 bits of an md5.
RING = 1 << 32


def ring_points(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(position, shard) of all points, clockwise."""
    return sorted(
        (int(hashlib.md5(f"shard-{s}-{v}".encode()).hexdigest()[:8], 16), s)
        for s in range(shards)
        for v in range(virtual)
    )


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int]]:
    """Allocate the rows of each arc: (arc, shard, rows), in the order of an arc's ranks.

    First every shard keeps what its own arcs bring, arc by arc clockwise, until it is full.
    Then the rows too many move on, one point at a time, each shard again taking those that
    reach it first. Each pass moves every waiting row by one point, so a row ends at the first
    shard with room clockwise of it; sum(room) must be sum(counts) or more.
    """
    points = len(owners)
    waiting = [[(arc, n)] if n else [] for arc, n in enumerate(counts)]  # now at point arc
    placed: list[tuple[int, int, int]] = []
    while any(waiting):
        for point, queue in enumerate(waiting):
            shard, over = owners[point], []
            for arc, n in queue:
                takes = min(n, room[shard])
                if takes:
                    placed.append((arc, shard, takes))
                    room[shard] -= takes
                if n > takes:
                    over.append((arc, n - takes))
            waiting[point] = over
        waiting = [waiting[point - 1] for point in range(points)]
    return placed


def bounded_ring(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of `docs` (doc_id, text).

    The ring key is the text, so copies of a text meet in one arc and share its shards; of a
    group larger than a shard only what overflows moves on. Size is the UTF-8 bytes plus one;
    a null text has none and is a key of its own. Slots count from 0 in each shard without
    gaps. Equal rows get slots of their own, a null doc_id is a row like others, an empty table
    gives no rows, other columns are ignored.
    """
    points = ring_points(shards, virtual)
    positions = ", ".join(f"{p}L" for p, _ in points)
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    # Arc i ends at point i; what lies behind the last point belongs to the first.
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    point = F.size(F.filter(F.expr(f"array({positions})"), lambda p: p < F.col("place")))
    # Within an arc copies stay together, yet a huge group spreads over 256 buckets.
    id_hash = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = checkpoint(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("hash"),
            id_hash.alias("id_hash"),
        )
        .withColumn("place", place)
        .withColumn("arc", (point % len(points)).cast("int"))
        .withColumn(
            "bucket", F.concat(F.substring("hash", 9, 2), F.substring("id_hash", 1, 2))
        )
        .drop("place")
    )
    counts = [0] * len(points)
    for arc, n in rows.groupBy("arc").count().collect():  # shards * virtual rows at most
        counts[arc] = n
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    begun, filled, shares = [0] * len(points), [0] * shards, []
    for arc, shard, n in walk(counts, [s for _, s in points], room):
        shares.append(f"({arc}, {shard}, {begun[arc]}L, {begun[arc] + n}L, {filled[shard]}L)")
        begun[arc] += n
        filled[shard] += n
    shares = shares or ["(-1, 0, 0L, 0L, 0L)"]
    parts = rows.sparkSession.sql(
        f"SELECT * FROM VALUES {', '.join(shares)} AS t(arc, shard, low, high, first)"
    )
    ranked = running_total(
        rows.withColumn("one", F.lit(1)), ["arc"], "bucket", ["hash", "id_hash", "size"], "one", "rank"
    )
    # As many parts as arcs, and at most one more for each point walked past: made here, bounded.
    return ranked.join(
        F.broadcast(parts.withColumnRenamed("arc", "a")),
        (F.col("arc") == F.col("a")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("rank") - F.col("low")).alias("slot"),
    )
