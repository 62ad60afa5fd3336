"""Harmonic packing: pieces of reciprocal-capacity classes fill bins of a fixed count.

A sequence holds `capacity` tokens. A piece of class k is at most capacity // k tokens long,
and a bin of class k takes exactly k pieces, so whether a piece fits never depends on other
workers: each one fills its own bins, whatever the order of its documents. Since documents may
be cut, a remainder that would leave its class's slot too empty first gives up a piece of
exactly the next smaller slot; this holds the padding down.

What a worker cannot complete (fewer than k pieces a class) is filled into bins by class over
all workers, and what is left then (fewer than k pieces a class, at most
classes * (classes - 1) / 2 pieces whatever the input) is packed first-fit by falling length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint

CAPACITY = 2048
#: Reciprocal classes: capacity / 1 ... capacity / CLASSES.
CLASSES = 256
#: A piece may leave this share of its slot empty; beyond it the remainder is cut.
SLACK = 1 / 16
#: Remainders up to this length are not cut any more.
TAIL = 32

PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_STAGED = [*PIECES, "worker", "bin", "offset", "klass"]


def cut(tokens: int, capacity: int = CAPACITY, classes: int = CLASSES) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of so many tokens, in its order."""
    pieces = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        fits = min(classes, capacity // rest)
        slot = capacity // fits
        if rest <= TAIL or slot - rest <= SLACK * slot:
            pieces.append((rest, fits))
            break
        exact = capacity // (fits + 1)
        pieces.append((exact, fits + 1))
        rest -= exact
    return pieces


def fill_bins(
    encode: Callable[[list[str]], list[np.ndarray]], capacity: int, classes: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tokenise, cut and fill this worker's own bins; pieces of unfilled bins have bin null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, bins = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                done = []
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
                    start = 0
                    for length, klass in cut(len(ids), capacity, classes):
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        open_bin = waiting.setdefault(klass, [])
                        open_bin.append((doc_id, start, length, crc, len(ids)))
                        start += length
                        if len(open_bin) == klass:
                            offset = 0
                            for piece in open_bin:
                                done.append((*piece, worker, bins, offset, klass))
                                offset += piece[2]
                            bins += 1
                            waiting[klass] = []
                yield rows_of(done, _STAGED)
        left = [(*p, worker, None, None, k) for k, rest in sorted(waiting.items()) for p in rest]
        yield rows_of(left, _STAGED)

    return work


def longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def rows_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def first_fit(capacity: int) -> Callable[[pa.Table], pa.Table]:
    """Pack a bounded number of pieces first-fit, longest first; ties by document and start."""

    def pack(rest: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*[rest.column(c).to_pylist() for c in PIECES]),
            key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[3]),
        )
        free: list[int] = []
        packed, first_open = [], 0
        for piece in rows:
            at = first_open
            while at < len(free) and free[at] < piece[2]:
                at += 1
            if at == len(free):
                free.append(capacity)
            packed.append((*piece, at, capacity - free[at]))
            free[at] -= piece[2]
            while first_open < len(free) and free[first_open] == 0:
                first_open += 1
        return pa.Table.from_batches([rows_of(packed, [*PIECES, "bin", "offset"])])

    return pack


def pack(
    docs: DataFrame,
    encode: Callable[[list[str]], list[np.ndarray]],
    capacity: int = CAPACITY,
    classes: int = CLASSES,
) -> DataFrame:
    """One row per piece: its document, place in it, checksum, sequence and offset there.

    `docs` needs doc_id and text; other columns are ignored. `encode` turns texts into arrays
    of little-endian unsigned 32-bit ids and is called on the executors. Null texts count as
    empty. Repeated rows and ids are packed as often as they occur; a null doc_id stays null.
    An empty table gives no rows. Sequence ids run from 0 without gaps.
    """
    staged = checkpoint(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            fill_bins(encode, capacity, classes), longs(_STAGED)
        )
    )
    full = staged.where("bin IS NOT NULL")
    per_worker = full.groupBy("worker").agg((F.max("bin") + 1).alias("n"))
    before = Window.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_worker.select(  # one row per task that ran
        "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    filled = full.join(starts, "worker").select(
        *PIECES, (F.col("first") + F.col("bin")).alias("sequence_id"), "offset"
    )

    # Second level: what the workers left over, by class. Ranks come from counts per worker.
    left = staged.where("bin IS NULL").withColumn(
        "i",
        F.row_number().over(
            Window.partitionBy("klass", "worker").orderBy("doc_id", "start", "ids_crc32")
        )
        - 1,
    )
    counts = left.groupBy("klass", "worker").count()
    earlier = Window.partitionBy("klass").orderBy("worker")
    ranks = counts.select(
        "klass",
        "worker",
        (F.sum("count").over(earlier) - F.col("count")).alias("base"),
        F.sum("count").over(Window.partitionBy("klass")).alias("total"),
    )
    left = left.join(ranks, ["klass", "worker"]).withColumn(
        "slot", ((F.col("base") + F.col("i")) / F.col("klass")).cast("long")
    )
    complete = F.col("slot") < F.floor(F.col("total") / F.col("klass"))
    inside = Window.partitionBy("klass", "slot").orderBy("base", "i")
    # A class's bins follow those of the smaller classes: prefix sums over a row per class.
    classes_before = Window.orderBy("klass").rowsBetween(Window.unboundedPreceding, -1)
    per_class = ranks.select("klass", F.expr("total div klass").alias("bins")).distinct()
    firsts = per_class.select(
        "klass", F.coalesce(F.sum("bins").over(classes_before), F.lit(0)).alias("first")
    )
    by_class = (
        left.where(complete)
        .withColumn("offset", F.sum("length").over(inside) - F.col("length"))
        .join(F.broadcast(firsts), "klass")  # `classes` rows
        .select(*PIECES, (F.col("first") + F.col("slot")).alias("number"), "offset")
    )
    pooled = (
        left.where(~complete)
        .select(*PIECES)
        .groupBy()
        .applyInArrow(first_fit(capacity), longs([*PIECES, "bin", "offset"]))
    )
    behind = per_class.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("behind"))
    pooled = pooled.crossJoin(F.broadcast(behind)).select(  # one row
        *PIECES, (F.col("behind") + F.col("bin")).alias("number"), "offset"
    )
    shift = F.coalesce(F.sum("n"), F.lit(0)).alias("shift")
    second = (
        by_class.unionByName(pooled)
        .crossJoin(F.broadcast(per_worker.agg(shift)))  # one row
        .select(*PIECES, (F.col("shift") + F.col("number")).alias("sequence_id"), "offset")
    )
    return filled.unionByName(second)


def byte_bpe(name: str = "byte_bpe_50k", end: int = 1) -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of a public byte-level vocabulary, `end` after each document.

    The same ids as the vocabulary's JSON form gives through `tokenizers`, added tokens in the
    text included (tests compare them); its rank form is encoded about four times as fast by
    `tiktoken`. Texts that `tiktoken` cannot encode are encoded by `tokenizers`.
    """
    return _ByteBpe(name, end)


class _ByteBpe:
    def __init__(self, name: str, end: int):
        self.name, self.end = name, end

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        encoding = _encoding(self.name)
        tail = np.array([self.end], "<u4")

        def ids(text: str) -> np.ndarray:
            try:
                return encoding.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # a run of about a million blanks is beyond its regex's stack
                return np.array(_reference(self.name).encode(text, add_special_tokens=False).ids)

        return [np.concatenate([ids(t).astype("<u4"), tail]) for t in texts]


_ENCODINGS: dict[str, object] = {}


def _encoding(name: str):
    if name not in _ENCODINGS:
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as known:
            added = {t["content"]: t["id"] for t in json.load(known)["added_tokens"]}
        _ENCODINGS[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
    return _ENCODINGS[name]


_REFERENCES: dict[str, object] = {}


def _reference(name: str):
    if name not in _REFERENCES:
        import public_tokenizers
        import tokenizers

        _REFERENCES[name] = tokenizers.Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    return _REFERENCES[name]
