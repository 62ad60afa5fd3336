"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to length one and split into halves; each half has a codebook of its own, and
the pairs of codes form a grid of cells. Every vector is stored in its own cell and visits, in
the order of a multi-sequence traversal (nearest pairs of codes first), the cells in which
vectors within the wanted cosine may lie; what it meets there is verified in double precision.

How far the traversal goes is set by recall: vectors of a bounded sample are moved to exactly
the wanted cosine in random directions, and the traversal goes on until it has met the cell of
the moved vector for the target share of them. A link is seen if either end meets the other.

Equal vectors are one vertex with a weight. Cells are compared in blocks, so a cell that holds
a third of all vectors is spread over many tasks, and what leaves a block is one count per
vector and the links that join it, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint
from millrace.llm.components import components
from millrace.llm.vectors import finite, length, matrix

COSINE = 0.95
#: Vectors the codebooks and the traversal's length are fitted on at most, by smallest hash.
SAMPLE = 4096
#: Wanted vectors in a cell on average; sets the number of codes of each half.
PER_CELL = 64
#: Codes of a half at most.
CODES = 256
#: Lengths of vectors that have codebooks of their own, the commonest first; those of any other
#: length share one cell, where blocks of them are compared with all.
LENGTHS = 16
#: Share of sampled neighbours, at exactly the wanted cosine, whose cell is met from one side.
RECALL = 0.995
#: Vectors of a block.
BLOCK = 512


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means centres, started from rows of `x` that lie evenly through it."""
    centres = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest = distances(x, centres).argmin(1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0][:, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows of `x` to all centres."""
    far = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    return np.maximum(far, 0)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = (x.shape[1] + 1) // 2
    return x[:, :half], x[:, half:]


def traverse(left: np.ndarray, right: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells (i, j) by increasing left[i] + right[j], while it is at most `reach` more than the least.

    The multi-sequence algorithm: both lists are sorted, and a cell joins the queue once the
    cells before it in its row and in its column have been taken from it.
    """
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows], right[columns]
    limit = a[0] + b[0] + reach
    queue, taken, cells = [(a[0] + b[0], 0, 0)], {}, []
    while queue:
        far, i, j = heappop(queue)
        if far > limit:
            break
        cells.append((int(rows[i]), int(columns[j])))
        taken[i] = j  # column j of row i is done, as are those before it
        if i + 1 < len(a) and (j == 0 or taken.get(i + 1, -1) == j - 1):
            heappush(queue, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or taken.get(i - 1, -1) >= j + 1):
            heappush(queue, (a[i] + b[j + 1], i, j + 1))
    return cells


class MultiIndex:
    """Two codebooks and how far the traversal goes."""

    def __init__(self, sample: np.ndarray, count: int, cosine: float, recall: float = RECALL):
        codes = int(min(CODES, max(1, math.sqrt(count / PER_CELL))))
        self.books = [codebook(h, codes) for h in halves(sample)]
        random = np.random.default_rng(0)
        side = random.standard_normal(sample.shape)
        side -= (side * sample).sum(1)[:, None] * sample
        side /= np.maximum(np.linalg.norm(side, axis=1), 1e-12)[:, None]
        moved = cosine * sample + math.sqrt(1 - cosine * cosine) * side
        far, cell = self.far(sample), self.cells(moved)
        excess = sum(
            d[np.arange(len(sample)), c] - d.min(1) for d, c in zip(far, cell)
        )
        self.reach = float(np.quantile(excess, recall))

    def far(self, x: np.ndarray) -> list[np.ndarray]:
        return [distances(h, book) for h, book in zip(halves(x), self.books)]

    def cells(self, x: np.ndarray) -> list[np.ndarray]:
        """The codes of each vector's own cell."""
        return [d.argmin(1) for d in self.far(x)]

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """Cell numbers each vector visits, nearest first; its own is the first."""
        far, width = self.far(x), len(self.books[1])
        return [[i * width + j for i, j in traverse(a, b, self.reach)] for a, b in zip(*far)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # no overflow or underflow in squares
    return x / np.linalg.norm(x, axis=1)[:, None]


def _visit(shared):
    """Cells to visit; vectors of a length without an index all lie in cell 0 of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "weight", "size", "embedding"]
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                index = shared.value.get(int(size))
                x = unit(matrix(part.column("embedding")))
                cells = pa.array(index.visits(x) if index else [[0]] * len(x), pa.list_(pa.int32()))
                columns = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, cells], [*names, "cells"])

    return work


def _indexes(groups: DataFrame, cosine: float) -> dict[int, MultiIndex]:
    """An index for each of the commonest lengths that needs more than one cell."""
    counts = groups.groupBy("size").count().where(F.col("count") >= 4 * PER_CELL)
    found = {}
    for size, count in counts.orderBy(F.desc("count"), "size").limit(LENGTHS).collect():
        own = groups.where(F.col("size") == size).select("rep", "embedding", F.xxhash64("rep").alias("h"))
        if count > 4 * SAMPLE:  # the smallest hashes lie below this one; no task sorts more than it needs
            own = own.where(F.col("h") < F.lit(int(-(2**63) + 2**64 * (2 * SAMPLE / count))))
        sample = own.orderBy("h", "rep").limit(SAMPLE).select("embedding").toArrow()
        found[size] = MultiIndex(unit(matrix(sample.column("embedding"))), count, cosine)
    return found


def _compare(cosine: float):
    """Compare the visitors of a block with its residents.

    Gives (a, a, n) for n linked vectors of a, and (a, b, 0) for links that join what the block
    has not joined yet. A pair that meets in both cells is counted for either end in the cell
    of the other; one that meets in one cell only is counted there for both.
    """

    def work(rows: pa.Table) -> pa.Table:
        rep, weight = rows.column("rep").to_numpy(), rows.column("weight").to_numpy()
        resident = rows.column("resident").to_numpy()
        home = rows.column("home").to_numpy()
        x = unit(matrix(rows.column("embedding")))
        here, guests = np.flatnonzero(resident), np.flatnonzero(~resident)
        linked = (x[guests] @ x[here].T) >= cosine
        linked &= rep[guests][:, None] != rep[here][None, :]
        counted = linked @ weight[here]
        back = np.zeros(len(here), np.int64)
        lists = rows.column("cells")
        root = np.arange(len(rep))
        joins = []

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        at_home = {r: i for i, r in zip(here, rep[here])}
        for j in np.flatnonzero(linked.any(0)):
            h = here[j]
            visited = lists[int(h)].values.to_numpy()
            met = guests[linked[:, j]]
            back[j] = weight[met[~np.isin(home[met], visited)]].sum()
            for g in met:
                a, b = top(at_home.get(rep[g], g)), top(h)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    joins.append((rep[g], rep[h]))
        some, more = np.flatnonzero(counted), np.flatnonzero(back)
        a = np.concatenate([rep[guests[some]], rep[here[more]], [x for x, _ in joins]])
        b = np.concatenate([rep[guests[some]], rep[here[more]], [y for _, y in joins]])
        n = np.concatenate([counted[some], back[more], np.zeros(len(joins))])
        return pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64), "n": n.astype(np.int64)})

    return work


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors` (vec_id, embedding).

    n_links is the number of other vec_ids at this cosine or more, component_id the smallest
    vec_id reachable over links. Vectors of different lengths are not linked. A vector that is null,
    zero or holds a null or non-finite component has no links, and neither has one without vec_id,
    whose component is null and which is kept. Equal rows count once; rows of one vec_id are one
    vertex. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    good = finite(vectors).where(F.exists("embedding", lambda x: x != 0)).distinct()
    groups = checkpoint(
        good.groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("vec_id").alias("weight"))
        .withColumn("size", length())
    )
    member = good.join(groups, "embedding").select("vec_id", "rep", "weight")

    kind = groups.schema["embedding"].dataType.simpleString()
    visits = checkpoint(
        groups.select("rep", "weight", "size", "embedding").mapInArrow(
            _visit(spark.sparkContext.broadcast(_indexes(groups, cosine))),
            f"rep long, weight long, size int, embedding {kind}, cells array<int>",
        )
    )
    home = F.col("cells")[0]
    place = ["size", "cell"]
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    residents = visits.groupBy("size", home.alias("cell")).agg(F.count("*").alias("n"))
    guests = visits.select("size", F.explode("cells").alias("cell")).groupBy(*place).agg(F.count("*").alias("m"))
    cells = residents.join(guests, place).select(*place, blocks("n").alias("rows"), blocks("m").alias("columns"))
    of = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shown = ["rep", "weight", "embedding", "home", "cells", "resident"]
    stay = (
        visits.withColumns({"cell": home, "home": home, "resident": F.lit(True)})
        .join(cells, place)
        .select(*place, of("rows").alias("row"), all_of("columns").alias("column"), *shown)
    )
    come = (
        visits.select("rep", "weight", "size", "embedding", home.alias("home"), F.explode("cells").alias("cell"))
        .withColumns({"cells": F.array().cast("array<int>"), "resident": F.lit(False)})
        .join(cells, place)
        .select(*place, all_of("rows").alias("row"), of("columns").alias("column"), *shown)
    )
    met = checkpoint(
        stay.union(come)
        .groupBy(*place, "row", "column")
        .applyInArrow(_compare(cosine), "a long, b long, n long")
    )
    counts = met.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(met.select("a", "b")).withColumnRenamed("id", "rep")
    linked = (
        member.join(counts, "rep", "left")
        .join(joined, "rep", "left")
        .select(
            "vec_id",
            (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    merged = linked.groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return (
        vectors.select(F.col("vec_id").cast("long"))
        .join(merged, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
