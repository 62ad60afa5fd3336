"""The trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Two sequences are told apart by 128 bits, the
exclusive-or of a hash of each turn with its position, so that prefixes of a conversation of any
length are running values and no task sees a whole conversation.

Runs of nodes with the same members are chains; a chain is known by its smallest member and the
number of its members, and only chains take part in what follows, at most two per distinct
conversation. A chain with at most as many members as the square root of the input's turns lies in
the subtree of one shard root, the highest such node above it; subtrees are dealt over the tasks.
Each task sorts its chains by reverse level order with Spark's external sort and sends the totals
of a chain forward to its parent through a priority queue that spills. What shard roots send to
the chains above them is added up, and those few are worked through in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint

#: Turns of a conversation, or nodes of a chain, that are worked through together.
CHUNK = 4096
#: Messages that a queue holds in memory; more are spilled as sorted runs.
QUEUE = 1 << 18
#: Ids of a node's ending conversations that are joined into one text at a time.
IDS = 1 << 14
PREFIX = ["depth", "a", "b"]


# --- turns in order -----------------------------------------------------------------------


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation in a sorted partition, from 0."""
    part, last, before = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy(zero_copy_only=False)
        first = np.r_[True, conv[1:] != conv[:-1]]
        starts = np.flatnonzero(first)
        i = np.arange(len(conv)) - np.repeat(starts, np.diff(np.r_[starts, len(conv)]))
        if conv[0] == last:
            i[: starts[1] if len(starts) > 1 else len(conv)] += before
        last, before = conv[-1], i[-1] + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(i, pa.int64()), pa.array(np.full(len(i), part), pa.int64())],
            ["conv_id", "key", "weight", "i", "part"],
        )


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key and weight of every turn: its place, identity and bytes of text.

    `turns` needs conv_id, turn, role and text; other columns are ignored. Turns are ordered by
    turn, null first; equal ones by the MD5 of role and text, so that reruns agree. Null roles and
    texts count as empty, repeated rows stay, rows without a conv_id belong to no conversation.
    Rows are dealt by ranges, so that a conversation may span tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.octet_length(text).cast("long").alias("weight"),
        F.monotonically_increasing_id().alias("row"),  # lets equal rows lie in several ranges
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "key", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = checkpoint(
        dealt.select("conv_id", "key", "weight").mapInArrow(
            _numbered, "conv_id long, key string, weight long, i long, part long"
        )
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy("conv_id", "part")
        .count()
        .select("conv_id", "part", F.sum("count").over(earlier).alias("start"))
        .where("start > 0")
    )
    # A partition continues one conversation at most, so there are no more starts than partitions.
    return staged.join(F.broadcast(starts), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("i") + 1 + F.coalesce("start", F.lit(0))).alias("pos"), "key", "weight"
    )


def with_shared_heads(turns: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """Every conversation with its first `taken` turns replaced by those of conversation `base`.

    `turns` is what `ordered` gives; `base` and `taken` are expressions of conv_id, and `taken`
    is `most` at most. Of a shorter base all turns are taken, of an absent one none.
    """
    heads = turns.where(F.col("pos") <= most).groupBy(F.col("conv_id").alias("base")).agg(
        F.collect_list(F.struct("pos", "key", "weight")).alias("heads")  # `most` at most
    )
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    convs = convs.withColumns({"base": base, "taken": taken}).join(heads, "base", "left")
    convs = convs.withColumn(
        "heads", F.filter(F.coalesce("heads", F.array()), lambda t: t["pos"] <= F.col("taken"))
    )
    # One row per chunk of a conversation, so that the turns of a long one are joined in many tasks.
    shifts = convs.select(
        "conv_id",
        "taken",
        (F.size("heads") - F.col("taken")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"length div {CHUNK}"))).alias("chunk"),
    )
    own = (
        turns.withColumn("chunk", F.expr(f"pos div {CHUNK}"))
        .join(shifts, ["conv_id", "chunk"])
        .where("pos > taken")
        .select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "key", "weight")
    )
    inherited = convs.select("conv_id", F.explode("heads").alias("t")).select("conv_id", "t.*")
    return own.unionByName(inherited)


# --- totals by time-forward processing ----------------------------------------------------


class SpillingQueue:
    """A priority queue of rows of six integers, the first three the priority, least first.

    Beyond `room` rows the queue is written, sorted, into the executor's own scratch folder, as
    Spark's sort does, and read back in blocks; files go when they are closed, and a task that
    is run again begins anew.
    """

    def __init__(self, room: int = QUEUE):
        self.room, self.rows, self.heads, self.runs = room, [], [], []

    def push(self, row: tuple) -> None:
        heapq.heappush(self.rows, row)
        if len(self.rows) > self.room:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=folder)
        np.array(sorted(self.rows), np.int64).tofile(run)
        run.seek(0)
        self.rows = []
        self.runs.append(self._read(run))
        self._next(len(self.runs) - 1)

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while len(block := np.fromfile(run, np.int64, 6 * 4096)):
                yield from map(tuple, block.reshape(-1, 6).tolist())

    def _next(self, run: int) -> None:
        row = next(self.runs[run], None)
        if row is not None:
            heapq.heappush(self.heads, (row, run))

    def pop(self, priority: tuple) -> Iterator[tuple]:
        """Take out all rows of this priority; none may be less."""
        while self.rows and self.rows[0][:3] == priority:
            yield heapq.heappop(self.rows)
        while self.heads and self.heads[0][0][:3] == priority:
            row, run = heapq.heappop(self.heads)
            self._next(run)
            yield row


CHAIN = ["conv_id", "n_convs", "top", "bottom", "up_conv", "up_n", "own", "got_children", "got_leaves", "got_saved"]
TOTAL = ["conv_id", "n_convs", "children", "leaves", "below", "up_conv", "up_n", "whole"]


def time_forward(limit: int, room: int = QUEUE):
    """Totals of chains that arrive in reverse level order (bottom falling, conv_id, n_convs).

    A chain takes the messages sent to it off the queue and sends its own totals to its parent,
    which is still to come; parents with more than `limit` members belong to no shard and are
    not sent to.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(room)
        for batch in batches:
            done = []
            for conv, n, top, bottom, up_conv, up_n, own, children, leaves, below in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                for *_, sent_children, sent_leaves, sent_saved in queue.pop((-bottom, conv, n)):
                    children += sent_children
                    leaves += sent_leaves
                    below += sent_saved
                leaves = leaves or 1  # nothing was sent: a leaf
                done.append((conv, n, children, leaves, below, up_conv, up_n, below + own))
                if up_conv is not None and up_n <= limit:
                    queue.push((1 - top, up_conv, up_n, 1, leaves, below + own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*done) if done else [()] * len(TOTAL))], TOTAL
            )

    return work


def _longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _totals(chains: DataFrame, shard_of: DataFrame, limit: int, room: int) -> DataFrame:
    """Totals of all chains: within the shards, then over what their roots send upwards."""
    order = [F.desc("bottom"), "conv_id", "n_convs"]
    none = {c: F.lit(0).cast("long") for c in ("got_children", "got_leaves", "got_saved")}
    low = (
        chains.where(F.col("n_convs") <= limit)
        .join(shard_of, "conv_id")
        .withColumns(none)
        .repartition("shard")
        .sortWithinPartitions(*order)
        .select(*CHAIN)
    )
    low = checkpoint(low.mapInArrow(time_forward(limit, room), _longs(TOTAL)))
    sent = (
        low.where(F.col("up_n") > limit)
        .groupBy(F.col("up_conv").alias("conv_id"), F.col("up_n").alias("n_convs"))
        .agg(
            F.count(F.lit(1)).alias("got_children"),
            F.sum("leaves").alias("got_leaves"),
            F.sum("whole").alias("got_saved"),
        )
    )
    # Every chain here has more than `limit` members in each node, so there are few: one task.
    high = (
        chains.where(F.col("n_convs") > limit)
        .join(sent, ["conv_id", "n_convs"], "left")
        .fillna(0, list(none))
        .repartition(1)
        .sortWithinPartitions(*order)
        .select(*CHAIN)
    )
    everything = 2**63 - 1
    return low.unionByName(high.mapInArrow(time_forward(everything, room), _longs(TOTAL)))


# --- conversations that end at a node -------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each node, sorted, joined by commas into texts of at most `IDS` ids."""
    names = [*PREFIX, "first", "ids"]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * 5
        types = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    node, ids = None, []
    for batch in batches:
        done = []
        for *at, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if at != node or len(ids) >= IDS:
                if ids:
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = at, []
            ids.append(conv)
        yield rows(done)
    yield rows([(*node, ids[0], ",".join(map(str, ids)))] if ids else [])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of each node in their order, one after another."""

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], [*PREFIX, "ends_sha256"]
        )

    node, digest = None, None
    for batch in batches:
        done = []
        for *at, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if at != node:
                if digest:
                    done.append((*node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield rows(done)
    yield rows([(*node, digest.hexdigest())] if digest else [])


def _ends(members: DataFrame) -> DataFrame:
    """ends_sha256 by prefix: of the ids that end there, in order, joined by commas.

    Ids are dealt by ranges, so that a node where many end lies in many tasks; the one task that
    takes the hash of a node, which cannot be split, sees a text for every `IDS` of them.
    """
    last = members.groupBy("conv_id").agg(F.max(F.struct(*PREFIX)).alias("last"))
    order = [*PREFIX, "conv_id"]
    dealt = last.select("last.*", "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)
    texts = dealt.mapInArrow(_chunks, f"{_longs([*PREFIX, 'first'])}, ids string")
    texts = texts.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first")
    return texts.mapInArrow(_digests, f"{_longs(PREFIX)}, ends_sha256 string")


# --- the trie -----------------------------------------------------------------------------


def _members(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the empty one included: the prefix and its parent."""
    hashed = turns.select(
        "conv_id",
        "pos",
        "weight",
        F.expr(f"pos div {CHUNK}").alias("chunk"),
        F.xxhash64("key", "pos").alias("x"),
        F.xxhash64(F.lit("second"), "key", "pos").alias("y"),
    )
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = {"a": F.bit_xor("x"), "b": F.bit_xor("y"), "total": F.sum("weight")}
    inside = hashed.withColumns({name: of.over(so_far) for name, of in sums.items()})
    chunks = hashed.groupBy("conv_id", "chunk").agg(*[of.alias(n) for n, of in zip("xyw", sums.values())])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(
        "conv_id",
        "chunk",
        F.bit_xor("x").over(earlier).alias("start_a"),
        F.bit_xor("y").over(earlier).alias("start_b"),
        F.sum("w").over(earlier).alias("start_total"),
    ).where("chunk > 0")
    joined = inside.join(starts, ["conv_id", "chunk"], "left").fillna(0, ["start_a", "start_b", "start_total"])
    a, b = (F.col(c).bitwiseXOR(F.col(f"start_{c}")) for c in "ab")
    rows = joined.select(
        "conv_id",
        F.col("pos").alias("depth"),
        a.alias("a"),
        b.alias("b"),
        a.bitwiseXOR(F.col("x")).alias("up_a"),
        b.bitwiseXOR(F.col("y")).alias("up_b"),
        "weight",
        (F.col("total") + F.col("start_total")).alias("total"),
    )
    zero = F.lit(0).cast("long")
    root = ids.select("conv_id", *[zero.alias(c) for c in rows.columns[1:]])
    return rows.unionByName(root)


def prefix_trie(
    turns: DataFrame, ids: DataFrame | None = None, limit: int | None = None, room: int = QUEUE
) -> DataFrame:
    """One row per node of the trie of all conversations.

    `turns` holds conv_id, pos, key and weight, as `ordered` gives them; `ids` holds the conv_id of
    every conversation, also of those without turns (by default all in `turns`). The result has
    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, weight times members less one) and ends_sha256.
    conv_id and depth name a node. No conversations give no rows, not even a root. `limit` is the
    number of members up to which a subtree is a shard, by default the square root of the turns.
    """
    ids = turns.select("conv_id").distinct() if ids is None else ids
    members = checkpoint(_members(turns, ids))
    limit = math.isqrt(members.count()) + 1 if limit is None else limit
    nodes = checkpoint(
        members.groupBy(*PREFIX).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            *[F.min(c).alias(c) for c in ("up_a", "up_b", "weight", "total")],
        )
    )
    # A node with more than `limit` members holds as many of the rows: there are rows / limit.
    high = nodes.where(F.col("n_convs") > limit)

    def as_parent(of: DataFrame) -> DataFrame:
        return of.select(
            (F.col("depth") + 1).alias("depth"),
            F.col("a").alias("up_a"),
            F.col("b").alias("up_b"),
            F.col("conv_id").alias("up_conv"),
            F.col("n_convs").alias("up_n"),
        )

    up = ["depth", "up_a", "up_b"]
    below_root = nodes.where("depth > 0")
    tried = below_root.join(F.broadcast(as_parent(high)), up, "left")
    # What is left has parents with `limit` children at most.
    rest = tried.where("up_conv IS NULL").drop("up_conv", "up_n").join(
        as_parent(nodes.where(F.col("n_convs") <= limit)), up
    )
    absent = {c: F.lit(None).cast("long") for c in ("up_conv", "up_n")}
    linked = checkpoint(
        nodes.where("depth = 0")
        .withColumns(absent)
        .unionByName(tried.where("up_conv IS NOT NULL"))
        .unionByName(rest)
    )
    chains = checkpoint(
        linked.groupBy("conv_id", "n_convs")
        .agg(
            F.min("depth").alias("top"),
            F.max("depth").alias("bottom"),
            F.min_by("up_conv", "depth").alias("up_conv"),
            F.min_by("up_n", "depth").alias("up_n"),
            F.sum("weight").alias("weight"),
            F.max("total").alias("bottom_total"),
        )
        .withColumn("own", F.col("weight") * (F.col("n_convs") - 1))
    )
    shard_of = (
        members.join(F.broadcast(high.select(*PREFIX)), PREFIX, "left_anti")
        .groupBy("conv_id")
        .agg(F.min(F.struct(*PREFIX)).alias("shard"))
    )
    totals = _totals(chains, shard_of, limit, room).drop("up_conv", "up_n", "whole")
    spread = totals.join(
        chains.select("conv_id", "n_convs", "top", "bottom", "bottom_total"), ["conv_id", "n_convs"]
    ).withColumn("chunk", F.explode(F.sequence(F.expr(f"top div {CHUNK}"), F.expr(f"bottom div {CHUNK}"))))
    done = linked.withColumn("chunk", F.expr(f"depth div {CHUNK}")).join(spread, ["conv_id", "n_convs", "chunk"])
    return done.join(_ends(members), PREFIX, "left").select(
        "conv_id",
        "depth",
        F.col("up_conv").alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("bottom"), 1).otherwise(F.col("children")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        # Bytes from this node to the end of its chain, and what lies below.
        (
            F.col("below")
            + (F.col("n_convs") - 1) * (F.col("bottom_total") - F.col("total") + F.col("weight"))
        ).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
