"""Language ID in two steps: first the family, then one-versus-one SVMs within it.

Languages that resemble each other share a family. A linear one-versus-rest machine picks the
family, and within it a linear support vector machine for every pair of languages votes. Both
work on character n-gram counts of the whole text, square-rooted and scaled to length one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import crc32_of_id
from millrace.llm.ngrams import counts

#: Languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "ur"),
}
ORDERS = (1, 2, 3)
BITS = 13
#: Documents the machines are fitted on at most, dealt evenly over the languages, of each those with
#: the smallest hash of the id; and the languages that are learnt, the commonest ones.
SAMPLE, LANGUAGES = 3200, 200
ROUNDS = 150
PENALTY = 1e-4
#: Rows whose id's crc32 has this remainder by four are held out.
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(crc32_of_id(doc_id) % FOLDS == HELD_OUT, F.lit(False))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def features(text: str) -> np.ndarray:
    found = np.sqrt(counts(text, ORDERS, BITS))
    return (found / max(np.sqrt((found * found).sum()), 1e-12)).astype(np.float32)


def fit_svm(x: np.ndarray, positive: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and intercept (last) of a linear SVM with squared hinge, classes weighted evenly."""
    sign = np.where(positive, 1.0, -1.0)
    even = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    weight, move = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    step = 0.25
    for _ in range(rounds):
        ahead = weight + 0.9 * move
        short = np.maximum(0, 1 - sign * (x @ ahead[:-1].astype(np.float32) + ahead[-1]))
        pull = 2 * even * sign * short
        gradient = PENALTY * ahead
        gradient[:-1] -= pull.astype(np.float32) @ x
        gradient[-1] -= pull.sum()
        move = 0.9 * move - step * gradient
        weight = weight + move
    return weight


class Machines:
    """The fitted machines: one for each family, one for each pair within a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        of = np.array(langs)
        families = np.array([family_of(lang) for lang in langs])
        self.families = sorted(set(families))
        rows = [fit_svm(x, families == f) for f in self.families] if len(self.families) > 1 else []
        self.members = [[g for g in self.langs if family_of(g) == f] for f in self.families]
        self.pairs = []
        for members in self.members:
            self.pairs.append([])
            for a, b in combinations(range(len(members)), 2):
                both = np.isin(of, [members[a], members[b]])
                self.pairs[-1].append((a, b, len(rows)))
                rows.append(fit_svm(x[both], of[both] == members[a]))
        self.weights = np.array(rows) if rows else np.zeros((0, (1 << BITS) + 1))

    def predict(self, text: str) -> tuple[str, float]:
        """The language and a confidence between 0 and 1; votes first, then margins, then name."""
        margins = self.weights[:, :-1] @ features(text) + self.weights[:, -1]
        sure = lambda m: 1 / (1 + np.exp(-2 * np.clip(m, -15, 15)))
        family, trust = 0, 1.0
        if len(self.families) > 1:
            family = int(np.argmax(margins[: len(self.families)]))
            trust = sure(margins[family])
        members = self.members[family]
        votes, lead = np.zeros(len(members)), np.zeros(len(members))
        for a, b, row in self.pairs[family]:
            votes[a if margins[row] >= 0 else b] += 1
            lead[a] += margins[row]
            lead[b] -= margins[row]
        best = min(range(len(members)), key=lambda i: (-votes[i], -lead[i], members[i]))
        if len(members) > 1:
            trust *= sure(lead[best] / (len(members) - 1))
        return members[best], float(trust)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            found = [features(t).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang"), pa.array(found, pa.binary())],
                ["doc_id", "lang", "x"],
            )


def train(docs: DataFrame, sample: int = SAMPLE) -> Machines | None:
    """Fit on at most `sample` documents outside the held-out fold, as many of each language.

    Rows with a null id, lang or text take no part, nor do texts without a letter. Of more than
    LANGUAGES languages the commonest are learnt. Which rows are taken is found on ids alone:
    those below a hash that keeps about twice as many are ranked, so no task ranks a whole
    language. Only features of the sample meet, a bounded number. Nothing to learn from gives None.
    """
    usable = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out()).select("doc_id", "lang")
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return None
    quota = max(1, sample // len(sizes))
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, max(2 * quota, quota + 64) / r["n"])) for r in sizes], "lang string, share double"
    )
    h = F.xxhash64("doc_id")
    by_hash = Window.partitionBy("lang").orderBy(h, "doc_id")
    chosen = (
        usable.join(F.broadcast(share), "lang")  # LANGUAGES rows
        .where(h.cast("double") / float(2**63) <= F.col("share") * 2 - 1)
        .distinct()
        .withColumn("i", F.row_number().over(by_hash))
        .where(F.col("i") <= quota)
        .select("doc_id", "lang")
    )
    rows = (
        docs.where(has_letter())
        .select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"])  # `sample` rows
        .groupBy("doc_id", "lang")
        .agg(F.max("text").alias("text"))
        .mapInArrow(_features, "doc_id long, lang string, x binary")
        .toArrow()
        .sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    )
    if rows.num_rows == 0:
        return None
    data = b"".join(rows.column("x").to_pylist())
    x = np.frombuffer(data, np.float32).reshape(rows.num_rows, 1 << BITS)
    return Machines(x, rows.column("lang").to_pylist())


def has_letter() -> F.Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, machines: Machines | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs` (doc_id, text); only text decides.

    A null text or one without a letter is "und" with score 0, as is everything if nothing
    could be learnt. Repeated rows and null ids are rows like others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machines)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            found = [
                learned.predict(text) if known and learned else (UNDETERMINED, 0.0)
                for text, known in zip(
                    batch.column("text").to_pylist(), batch.column("known").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    slim = docs.select(F.col("doc_id").cast("long"), "text", has_letter().alias("known"))
    return slim.mapInArrow(work, "doc_id long, lang_pred string, score double")
