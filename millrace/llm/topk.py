"""Exact top-k by inner product with no random access.

Each dimension is a list of a block's rows sorted by their component. A query reads all lists
from the end that is best for it, so many entries at a time, and keeps for every row a lower
bound (what was read, and the worst of each list not met yet) and an upper bound (what was
read, and the last entry read of the others). It stops once few rows outside the best k can
still reach the k-th lower bound of distinct vec_ids; the scores of those that can are then resolved exactly.

Queries and rows are cut into blocks and each pair of blocks is a task; every block yields its
k best vec_ids, and the best k of those are the result. Scores are integers, so nothing is rounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint
from millrace.llm.vectors import finite, length, matrix

K = 5
#: A component x becomes floor(SCALE * x).
SCALE = 256
ROWS, QUERIES = 4096, 256
#: A block's lists are read in so many steps, with a look at the bounds after each.
STEPS = 8
#: Reading stops when no more than this many times k rows can still be among the best.
OPEN = 4


def no_random_access(
    rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, starts: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows that may be among its k best, ties included, and their scores.

    `rows` and `queries` hold integers; `own` marks, per row and query, what is no candidate.
    Rows of one id lie together and count as one among the k best; `starts` says where each id
    begins (without it every row is an id).
    """
    n, columns = len(rows), np.arange(rows.shape[1])
    starts = np.arange(n) if starts is None else starts
    ids = len(starts)
    lists = np.argsort(-rows, axis=0, kind="stable")  # greatest first, one list a column
    place = np.empty_like(lists)
    np.put_along_axis(place, lists, np.arange(n)[:, None], axis=0)
    most, least = rows.max(0), rows.min(0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    above, below = (rows - least).T, (rows - most).T  # what an entry adds to the worst case
    place = place.T
    lower = np.repeat((up @ least + down @ most)[:, None], n, axis=1)  # query x row, nothing read
    lower[own.T] = -np.inf
    waiting, read = np.arange(len(queries)), 0
    found: list = [None] * len(queries)
    for depth in np.unique(np.linspace(0, n, STEPS + 1).astype(int))[1:]:
        # The next entries of all lists, from the top for positive weights, else from the end.
        lower += up @ np.where((place >= read) & (place < depth), above, 0)
        lower += down @ np.where((place < n - read) & (place >= n - depth), below, 0)
        read = depth
        last_up, last_down = rows[lists[depth - 1], columns], rows[lists[n - depth], columns]
        upper = lower + (up * (last_up - least)) @ (place >= depth).astype(float)
        upper += (down * (last_down - most)) @ (place < n - depth).astype(float)
        of_ids = lower if ids == n else np.maximum.reduceat(lower, starts, axis=1)
        bar = np.partition(of_ids, ids - k, axis=1)[:, ids - k] if ids > k else np.full(len(lower), -np.inf)
        open_ = (upper >= bar[:, None]) & (upper > -np.inf)
        settled = (open_.sum(1) <= OPEN * k) | (depth == n)
        for q in np.flatnonzero(settled):
            those = np.flatnonzero(open_[q])
            found[waiting[q]] = (those, (rows[those] @ queries[waiting[q]]).astype(np.int64))
        rest = ~settled
        waiting, lower, up, down = waiting[rest], lower[rest], up[rest], down[rest]
        if len(waiting) == 0:
            break
    return found


def _search(k: int):
    def work(block: pa.Table) -> pa.Table:
        ids, asks = block.column("vec_id").to_numpy(), block.column("asks").to_numpy()
        x = np.floor(SCALE * matrix(block.column("embedding")))
        rows, queries = x[~asks], x[asks]
        row_ids, query_ids = ids[~asks], ids[asks]
        together = np.argsort(row_ids, kind="stable")
        rows, row_ids = rows[together], row_ids[together]
        out: list[tuple] = []
        if len(rows) and len(queries):
            own = row_ids[:, None] == query_ids[None, :]
            starts = np.unique(row_ids, return_index=True)[1]
            found = no_random_access(rows, queries, own, k, starts)
            for query, (those, scores) in zip(query_ids, found):
                order = np.lexsort((row_ids[those], -scores))
                firsts = np.unique(row_ids[those][order], return_index=True)[1]  # best row of each id
                best = order[np.sort(firsts)[:k]]
                out += [(query, row_ids[those[b]], scores[b]) for b in best]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table(
            {n: pa.array(np.array(c, np.int64)) for n, c in zip(("query_id", "vec_id", "score"), columns)}
        )

    return work


def top_k(vectors: DataFrame, every: int, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each query.

    Queries are the rows of `vectors` (vec_id, embedding) whose vec_id is divisible by `every`,
    candidates all rows of another vec_id and of the query's length; ties go to the smaller vec_id.
    A vector that is null, empty, holds a null or non-finite component or has no vec_id takes no
    part. Equal rows count once, and of several vectors of one vec_id the better score does, on
    either side. Components are taken to be below 2^40 in size. Other columns are ignored; an empty
    table gives no rows.
    """
    good = checkpoint(finite(vectors).distinct().withColumn("size", length()))
    asks = F.col("vec_id") % every == 0
    blocks = lambda n, block: F.greatest(F.ceil(n / block), F.lit(1)).cast("int")
    sizes = good.groupBy("size").agg(
        blocks(F.count(F.lit(1)), ROWS).alias("rows"), blocks(F.count_if(asks), QUERIES).alias("queries")
    )
    good = good.join(F.broadcast(sizes), "size")  # one row a length
    number = lambda salt, n: F.pmod(F.xxhash64("vec_id", "embedding", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = good.select(
        "size", number(0, "rows").alias("r"), each("queries").alias("q"), F.lit(False).alias("asks"), "vec_id", "embedding"
    )
    queries = good.where(asks).select(
        "size", each("rows").alias("r"), number(1, "queries").alias("q"), F.lit(True).alias("asks"), "vec_id", "embedding"
    )
    by_block = rows.union(queries).groupBy("size", "r", "q").applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    best = by_block.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
