"""MinHash near-duplicates by min-max hashing.

Of every permutation both the smallest and the largest value of a document's shingles are kept:
two unbiased samples for one evaluation, and together less variable than two minima of
different permutations. Consecutive values form bands; documents that agree in a band are
candidates, and the number of bands is chosen so that a pair at the wanted similarity is missed
with a probability below `MISS`. Every link is confirmed on the full shingle sets.

Equal sets are one vertex from the start. In each bucket every member is compared with the
smallest; links give components; buckets whose members are still in different components are
then compared member by member in blocks, which report how components merge, not pairs. So
no link is lost, and a group of any size leaves as many rows as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint
from millrace.llm.components import components
from millrace.llm.shingles import mix, shingle_set
from millrace.operators.dedup import remove_duplicates

WORDS = 5
#: Smallest similarity of a link, in hundredths.
SIMILARITY = 80
#: Values in a band.
ROWS = 4
#: Probability with which a pair at exactly the wanted similarity may share no band.
MISS = 1e-6
#: Members of a block; two blocks are compared in one task.
BLOCK = 128
_CHUNK = 1 << 15


def band_count(similarity: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (similarity / 100) ** rows))


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of `count` permutations of the 64-bit numbers."""
    drawn = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return drawn[:count] | np.uint64(1), drawn[count:]


def min_max(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Per set its smallest and largest value under each permutation: len(sets) x 2 count.

    The sets must not be empty.
    """
    factors, addends = permutations(count)
    values = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    kept = np.empty((len(sets), 2 * count), np.uint64)
    for p in range(count):
        moved = values * factors[p] + addends[p]
        kept[:, 2 * p] = np.minimum.reduceat(moved, starts)
        kept[:, 2 * p + 1] = np.maximum.reduceat(moved, starts)
    return kept


def band_keys(kept: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per set and band; keys of different bands differ."""
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(kept), 1))
    for r in range(rows):
        key = mix(key ^ kept[:, r : bands * rows : rows])
        key *= np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def _sign(words: int, bands: int):
    count = -(-bands * ROWS // 2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _groups(batch, words):
                sizes = [len(s) for s in sets]
                marks = np.zeros((len(sets), 2), np.uint64)
                keys = np.empty((0, bands), np.int64)
                filled = [i for i, n in enumerate(sizes) if n]
                if filled:
                    full = [sets[i] for i in filled]
                    starts = np.r_[0, np.cumsum([len(s) for s in full])[:-1]]
                    values = np.concatenate(full)
                    marks[filled, 0] = np.add.reduceat(mix(values), starts)
                    marks[filled, 1] = np.add.reduceat(mix(values ^ np.uint64(0x5DEECE66D)), starts)
                    keys = band_keys(min_max(full, count), bands)
                offsets = np.r_[0, np.cumsum([bands * (n > 0) for n in sizes])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(sizes, pa.int64()),
                        pa.array(marks[:, 0].view(np.int64)),
                        pa.array(marks[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                    ],
                    ["doc_id", "n_shingles", "mark1", "mark2", "bands"],
                )

    return work


def _groups(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """The ids and shingle sets of a batch, in groups small enough for the processor's cache."""
    sets, total, begin = [], 0, 0
    texts = batch.column("text")
    for i in range(len(texts)):
        sets.append(shingle_set(texts[i].as_py(), words))
        total += len(sets[-1])
        if total >= _CHUNK or i + 1 == len(texts):
            yield batch.column("doc_id").slice(begin, len(sets)), sets
            sets, total, begin = [], 0, i + 1


def _sets(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _groups(batch, words):
                offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                values = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([ids, lists], ["id", "shingles"])

    return work


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `left` shares with each of `right`."""
    sizes = [len(s) for s in (*left, *right)]
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, len(values), 4096):
        low, high = np.searchsorted(column, [at, at + 4096])
        there = np.zeros((len(sizes), min(4096, len(values) - at)), np.float32)
        there[row[low:high], column[low:high] - at] = 1
        shared += there[: len(left)] @ there[len(left) :].T
    return shared.astype(np.int64)


def _merge_blocks(similarity: int):
    """Compare two blocks of a bucket; give the links that join components not joined yet."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        block = rows.column("block").to_numpy()
        comp = rows.column("comp").to_numpy()
        sets = [s.values.to_numpy() for s in rows.column("shingles")]
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            shared = shared_counts([sets[i] for i in left], [sets[i] for i in right])
            sizes = np.array([len(s) for s in sets])
            union = sizes[left][:, None] + sizes[right][None, :] - shared
            linked = (100 * shared >= similarity * union) & (comp[left][:, None] != comp[right][None, :])
            pairs = {(int(comp[left[i]]), int(comp[right[j]])) for i, j in np.argwhere(linked)}
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while root.get(x, x) != x:
                    root[x] = root.get(root[x], root[x])
                    x = root[x]
                return x

            for a, b in sorted(pairs):
                ra, rb = top(a), top(b)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
                    found.append((a, b))
        return pa.table(
            {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
        )

    return work


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text).

    Texts are lower-cased in A-Z and split at ASCII blanks. Documents are linked if a hundred
    times the size of the intersection of their shingle sets reaches `similarity` times that of
    the union; component_id is the smallest doc_id reachable. A null or blank text has an empty
    set and is linked with nothing, as is a row without doc_id, whose component is null and
    which is kept. Rows of one doc_id are one document with several texts. Other columns are
    ignored; an empty table gives no rows.
    """
    bands = band_count(similarity)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    signed = checkpoint(
        slim.mapInArrow(
            _sign(words, bands),
            "doc_id long, n_shingles long, mark1 long, mark2 long, bands array<long>",
        )
    )
    same = ["n_shingles", "mark1", "mark2"]
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    first = usable.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    members = usable.select("doc_id", *same, "bands").join(first, same)
    keys = members.where("doc_id = rep").select(F.explode("bands").alias("key"), F.col("rep").alias("id"))

    buckets = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    together = checkpoint(keys.distinct().join(buckets.where("low <> high"), "key").select("key", "id", "low"))
    pairs = together.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    wanted = together.select(F.col("id").alias("doc_id")).distinct()
    sets = checkpoint(
        slim.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(words), "id long, shingles array<long>")
    ).where(F.size("shingles") > 0)

    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    sizes = F.size("of_a") + F.size("of_b")
    links = pairs.join(a, "a").join(b, "b").where(shared * 100 >= (sizes - shared) * similarity)
    by_star = checkpoint(components(links.select("a", "b")))

    # Buckets of more than two that the stars left in several components, one of each kind. The
    # members of a bucket's largest component are compared with all others, not with each other.
    comp = F.coalesce("component_id", "id").alias("comp")
    placed = together.join(by_star, "id", "left").select("key", "id", comp)
    open_ = (
        placed.groupBy("key", "comp")
        .agg(F.count("id").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("print"))
        .groupBy("key")
        .agg(
            F.sum("n").alias("n"),
            F.sum("print").alias("print"),
            F.count("comp").alias("comps"),
            F.max(F.struct("n", "comp")).alias("largest"),
        )
        .where("n > 2 AND comps > 1")
        .groupBy("n", "print")
        .agg(F.min(F.struct("key", "largest")).alias("one"))
        .select("one.key", "n", "one.largest")
    )
    blocks = lambda n: F.ceil(n / block).cast("int")
    inside = F.col("comp") == F.col("largest.comp")
    number = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    few, many = F.col("few"), F.col("many")
    own = F.when(inside, few + number(many)).otherwise(number(few))
    others = F.when(inside, few).otherwise(few + many)
    compared = (
        placed.join(open_, "key")
        .withColumns({"few": blocks(F.col("n") - F.col("largest.n")), "many": blocks(F.col("largest.n"))})
        .select("key", "id", "comp", own.alias("block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "comp", "block")
        .join(sets, "id")
        .groupBy("key", "i", "j")
        .applyInArrow(_merge_blocks(similarity), "a long, b long")
    )
    merged = components(compared).select(F.col("id").alias("comp"), F.col("component_id").alias("merged"))
    grouped = (
        members.select("doc_id", "n_shingles", F.col("rep").alias("id"))
        .join(by_star, "id", "left")
        .select("doc_id", "n_shingles", comp)
        .join(merged, "comp", "left")
        .select("doc_id", "n_shingles", F.coalesce("merged", "comp").alias("component_id"))
    )
    alone = signed.where("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return grouped.union(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs` of which one per group of near-duplicates stays, that of least doc_id.

    Of rows that share a doc_id one stays, the least in the other columns. Rows without doc_id
    stay all.
    """
    kept = near_duplicates(docs, words, similarity).where("kept AND doc_id IS NOT NULL")
    rows = docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    return remove_duplicates(rows, ["doc_id"]).unionByName(docs.where("doc_id IS NULL"))
