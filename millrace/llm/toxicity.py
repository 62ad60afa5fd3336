"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams, each with the tiers of repetition it reaches: in some
languages a toxic word shows by being said again and again. Each is scaled by the logarithm of
how much commoner it is in texts labelled toxic than in the others, counted over all labelled
texts, and logistic regression is trained on the scaled sets of a sample, even in both labels.
Whole texts are read, in training and in scoring.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint, crc32_of_id
from millrace.llm.ngrams import Tiers

#: These, TIERS, COST and LEAN are those of a small grid with the best mean of recall and specificity
#: over four inner folds of the training rows.
ORDERS = (4, 5, 6, 7)
BITS = 19
#: How often a text must hold an n-gram for each of its tiers.
TIERS = (1, 2, 3, 4, 6, 8)
#: The regression is fitted on half as many rows of each label at most: those with the smallest
#: hash of their id. The ratios are counted over all labelled rows.
SAMPLE = 8000
#: Features of all rows the regression is fitted on, at most: four bytes each in the one task that
#: fits. Rows are taken by the hash of their id until the next would go beyond it.
FIT_FEATURES = 1 << 25
#: Features whose counts travel together.
WIDE = 1 << 13
#: Bits of the broadcast marks that tell most documents without a label before the join with labels.
MARKS = 1 << 25
#: Cost of a row's loss against the squared weights, and the change at which the fit has converged.
COST, STILL, ROUNDS = 0.3, 1e-3, 200
#: Added to the intercept, since a toxic text that is missed costs more than a clean one flagged.
LEAN = 2.0
#: Rows whose id's crc32 has remainder 0 are held out.
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(crc32_of_id(doc_id) % FOLDS == 0, F.lit(False))


def log_odds() -> F.Column:
    """Per feature the logarithm of toxic against clean texts that have it, each count plus 1; of
    all texts (feature -1) each plus 2. A ratio is that of its feature less that of all texts."""
    more = F.when(F.col("feature") < 0, 2).otherwise(1)
    return (F.log(F.col("toxic") + more) - F.log(F.col("clean") + more)).cast("float")


def fit(sets: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each feature, and the intercept, from the sets, their 0/1 labels and the ratios.

    Logistic regression by dual coordinate descent: one text after another moves the weights
    to where its own loss is least, until none moves any more. Both labels weigh alike.
    Where only one label occurs, or none, nothing can be learnt: all weights are 0 and the
    intercept stands for that label (no labels count as 0).
    """
    n, ones = len(sets), int(toxic.sum())
    if n == 0 or ones in (0, n):
        return np.zeros(len(ratio), np.float32), 20.0 if n and ones else -20.0
    side = np.where(toxic > 0, 1.0, -1.0)
    cost = COST * np.where(toxic > 0, max(1.0, (n - ones) / ones), max(1.0, ones / (n - ones)))
    length = np.array([float(ratio[s] @ ratio[s]) for s in sets]) + 1  # 1 for the intercept
    share, weight, level = np.zeros(n), np.zeros(len(ratio)), 0.0
    draw = np.random.default_rng(0)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in draw.permutation(n):
            those = sets[i]
            scaled = ratio[those]
            margin = side[i] * (float(weight[those] @ scaled) + level)
            new = _least(margin, share[i], length[i], cost[i])
            largest = max(largest, abs(new - share[i]) / cost[i])
            weight[those] += (new - share[i]) * side[i] * scaled
            level += (new - share[i]) * side[i]
            share[i] = new
        if largest < STILL:
            break
    return (weight * ratio).astype(np.float32), float(level) + LEAN


def _least(margin: float, share: float, length: float, cost: float) -> float:
    """The share between 0 and `cost` at which one text's dual loss is least."""
    low, high, z = -60.0, 60.0, min(max(-margin, -50.0), 50.0)
    for _ in range(100):
        p = 1 / (1 + math.exp(-z))
        slope = margin + (cost * p - share) * length + z
        low, high = (low, z) if slope > 0 else (z, high)
        after = z - slope / (cost * p * (1 - p) * length + 1)
        after = after if low < after < high else (low + high) / 2
        if abs(after - z) < 1e-9:
            break
        z = after
    return cost / (1 + math.exp(-z))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many clean and toxic ones of this task's texts have each feature, as compressed arrays of
    WIDE features; behind the last feature stands the one that all texts have."""
    features = Tiers(ORDERS, BITS, TIERS)
    seen = np.zeros((2, features.size + WIDE), np.int32)
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            seen[toxic, features.of(text.as_py() or "")] += 1
            seen[toxic, features.size] += 1
    parts = seen.reshape(2, -1, WIDE)
    where = np.flatnonzero(parts.any((0, 2)))
    packed = [
        zlib.compress(parts[:, at].astype(np.min_scalar_type(parts[:, at].max())).tobytes(), 1) for at in where
    ]
    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(packed, pa.binary())], ["part", "counts"])


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature of one part how many toxic and clean texts have it; -1 stands for all."""
    total = np.zeros((2, WIDE), np.int64)
    for batch in batches:
        for packed in batch.column("counts"):
            raw = zlib.decompress(packed.as_py())
            total += np.frombuffer(raw, f"u{len(raw) // total.size}").reshape(total.shape)
    where, first = np.flatnonzero(total.any(0)), key[0].as_py() * WIDE
    feature = np.where(where + first == len(TIERS) << BITS, -1, where + first).astype(np.int32)
    columns = [feature, total[1, where], total[0, where]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "toxic", "clean"])


def _sets(shared):
    """The features of each text whose ratio is not 0; others have no part in a fit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Tiers(ORDERS, BITS, TIERS), _spread(shared.value) != 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [features.of(t or "") for t in part.column("text").to_pylist()]
                found = [f[counts[f]] for f in found]
                size, packed = [len(f) for f in found], [_packed(f) for f in found]
                columns = [part.column("doc_id"), pa.array(size, pa.int32()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, part.column("toxic")], ["doc_id", "size", "features", "toxic"]
                )

    return work


def _packed(features: np.ndarray) -> bytes:
    """Ascending features by their distances, compressed."""
    return zlib.compress(np.diff(features, prepend=0).astype(np.int32).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.int32), dtype=np.int32)


def _squeezed(values: np.ndarray) -> bytes:
    """A number per feature, mostly 0, for the way through the driver's JVM, which holds copies."""
    return zlib.compress(np.ascontiguousarray(values, np.float32), 1)


def _spread(squeezed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(squeezed), np.float32)


def _likely(own: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of `own` that may have a label: all that have one, and few others while labels are few
    against MARKS. So a join sends few texts about that find nothing."""
    spot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(MARKS)) + 1
    marks = known.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_marks")
    )
    byte = F.expr("hex(substring(_marks, CAST(_at DIV 8 AS INT) + 1, 1))")
    marked = F.conv(byte, 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, CAST(_at % 8 AS INT))")) != 0
    found = own.withColumns({"_bucket": F.bitmap_bucket_number(spot), "_at": F.bitmap_bit_position(spot)})
    # MARKS bits at most, however many labels there are.
    return found.join(F.broadcast(marks), "_bucket").where(marked).select(*own.columns)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Ratios from all labelled documents outside the held-out fold, weights from a sample.

    `labels` needs doc_id and toxic; rows with a null in either are ignored, of repeated ids
    the label 1 wins. Repeated documents count in the ratios as often as they occur. Sets are
    made where the texts lie, without features whose ratio is 0, and only those of the sample, at
    most half as many of each label as it holds and FIT_FEATURES in all, meet in the one task that
    fits.
    """
    size = len(TIERS) << BITS
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    )
    own = docs.select("doc_id", "text").where("doc_id IS NOT NULL").where(~held_out())
    counted = (
        _likely(own, known)
        .join(known, "doc_id")
        .select("text", "toxic")
        .mapInArrow(_count, "part int, counts binary")
        .groupBy("part")
        .applyInArrow(_added, "feature int, toxic long, clean long")
        .where("toxic + clean >= 2 OR feature = -1")  # the ratio of the others is 0
        .select("feature", log_odds().alias("odds"))
        .toArrow()
    )
    feature, odds = counted.column("feature").to_numpy(), counted.column("odds").to_numpy()
    ratio = np.zeros(size + 1, np.float32)  # the last one, feature -1, is that of all texts
    ratio[feature] = odds
    ratio[feature[feature >= 0]] -= ratio[-1]
    del counted, feature, odds
    pa.default_memory_pool().release_unused()
    shared = docs.sparkSession.sparkContext.broadcast(_squeezed(ratio[:-1]))
    del ratio

    halves = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
        for label in (0, 1)
    ]
    texts = (
        own.join(F.broadcast(halves[0].union(halves[1])), "doc_id")  # `sample` rows of two numbers
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    )

    def work(chosen: pa.Table) -> pa.Table:
        chosen = chosen.sort_by("doc_id")
        sets = [_unpacked(s.as_py()) for s in chosen.column("features")]
        weights, level = fit(sets, chosen.column("toxic").to_numpy(), _spread(shared.value))
        return pa.table({"weights": [_squeezed(weights)], "level": [level]})

    sets = checkpoint(texts.mapInArrow(_sets(shared), "doc_id long, size int, features binary, toxic int"))
    by_hash = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # `sample` rows of two numbers
    sizes = sets.select("doc_id", F.sum("size").over(by_hash).alias("until"))
    within = sizes.where(F.col("until") <= FIT_FEATURES).select("doc_id")
    model = (
        sets.join(F.broadcast(within), "doc_id").groupBy().applyInArrow(work, "weights binary, level double").first()
    )
    shared.destroy()  # nothing that is still to be computed needs the ratios
    if model is None:
        return fit([], np.empty(0), np.zeros(size))
    return _spread(model.weights), model.level


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` of `docs` (all without it) and score, 0 to 1, for every row.

    Only the text decides; a null or empty one has no n-grams. A column named `score` in `docs`
    gives way. Repeated rows and null ids are rows like others.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_squeezed(model[0]), model[1]))
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]
    row = F.struct(*[docs[c] for c in kept]).alias("row")
    carried = "text" in kept
    slim = docs.select(row) if carried else docs.select(row, docs["text"].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, level = _spread(shared.value[0]), shared.value[1]
        features = Tiers(ORDERS, BITS, TIERS)
        for batch in batches:
            rows = batch.column("row")
            texts = rows.field("text") if carried else batch.column("text")
            margins = [
                weights[features.of(t.as_py())].sum(dtype=np.float64) if t.is_valid else 0.0
                for t in texts
            ]
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins) + level, -30, 30)))
            yield pa.RecordBatch.from_arrays([rows, pa.array(scores)], ["row", "score"])

    kinds = slim.schema["row"].dataType.simpleString()
    return slim.mapInArrow(work, f"row {kinds}, score double").select("row.*", "score")
