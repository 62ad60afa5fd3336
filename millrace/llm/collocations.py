"""Phrase collocations by broadcast double-array tries over Apriori-safe candidates.

Texts are read once into arrays of 64-bit word codes, a zero where a piece ends. Level by level,
the frequent phrases of k words form a double-array trie that is broadcast; numpy advances the
states of all text positions at once, word by word, and a bincount of the accepting states gives
each task's counts, which are summed over the shards. In the same pass positions where a frequent
phrase of k words and, one word on, another one begin give the candidates of k + 1 words: no other
phrase can be frequent. Their tallies travel as sorted, compressed arrays, not as rows.

A trie holds `most` phrases at most. Are there more, they are counted by several tries, one
pass each, so what is broadcast never grows with the corpus. Codes of words that matter are
checked to stand for one word each, so that no count mixes two.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint

LONGEST = 4
#: Phrases of one broadcast trie: some 24 bytes each.
PHRASES = 1 << 19
#: Distinct words, and pairs of phrase and next word, that a task adds up before it hands them on.
HELD, PAIRS = 1 << 19, 1 << 20
#: Texts are split into words in slices of about so many bytes, cut between words.
SLICE = 1 << 20
#: Words of the corpus for each group that tallies of candidates are added up in.
PER_GROUP = 1 << 21
#: Accepting states whose counts travel together, and tasks whose counts are added up together.
STATES, TASKS = 1 << 12, 1 << 10
#: Copies of a table of counts that a join with hot keys is spread over.
SALTS = 16

_BREAK = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_END = b"."
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else _END[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)
CODES = [f"c{i}" for i in range(1, LONGEST + 1)]


# --- texts to word codes ------------------------------------------------------------------


class _Codes(dict):
    """Codes of the words of one language, kept up to a bound; zero for the end of a piece."""

    def __init__(self, lang: str, seed: int):
        self.lang, self.seed = lang.encode("utf-8", "replace") + b"\t", seed
        self.clear()

    def clear(self) -> None:
        super().clear()
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(self.lang + word, self.seed) or 1
        return code


def slices(text: bytes) -> Iterator[bytes]:
    """The text in parts that end where a word ends."""
    at = 0
    while len(text) - at > SLICE:
        cut = _BREAK.search(text, at + SLICE)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text in order, with `.` where a piece ends."""
    # Once they are mapped, no other ASCII blank than the space is left to split at.
    return text.translate(_PLAIN).replace(_END, b" . ").split()


_STAGED = "lang string, word string, code long, n long, codes binary"
_NAMES = ["lang", "word", "code", "n", "codes"]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), kind)


def _coded(seed: int):
    """Of the texts their codes, some thousand words a row; of each task its words and their counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[str, _Codes] = {}
        counts: dict[str, Counter] = {}

        def counted() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items() if w != _END]
            codes = np.array([books[lang][w] for lang, w, _ in rows], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1].decode("utf-8", "replace") for r in rows], pa.string()),
                    pa.array(codes),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.nulls(len(rows), pa.binary()),
                ],
                _NAMES,
            )

        def coded(arrays: list[np.ndarray]) -> pa.RecordBatch:
            codes = np.concatenate(arrays)
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(1, t) for t in (pa.string(), pa.string(), pa.int64())],
                    pa.array([len(codes)], pa.int64()),
                    pa.array([_packed(codes)], pa.binary()),
                ],
                _NAMES,
            )

        arrays, held = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                lang = lang.as_py()
                if lang not in books:
                    if len(books) >= 64:
                        yield counted()
                        books.clear()
                        counts.clear()
                    books[lang], counts[lang] = _Codes(lang, seed), Counter()
                code = books[lang].__getitem__
                for piece in slices(text.as_py()):
                    words = words_of(piece)
                    counts[lang].update(words)
                    arrays.append(np.fromiter(map(code, words), np.uint64, len(words)))
                    held += len(words) + 1
                arrays.append(np.zeros(1, np.uint64))
                if held > SLICE // 4:
                    yield coded(arrays)
                    arrays, held = [], 0
                if sum(map(len, counts.values())) > HELD:
                    yield counted()
                    counts = {lang: Counter() for lang in books}
        if arrays:
            yield coded(arrays)
        yield counted()

    return work


def read_words(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Codes of all texts; lang, word, code and n of words said `least` times; n of each language."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    seed = 0
    while True:
        staged = checkpoint(rows.mapInArrow(_coded(seed), _STAGED))
        said = staged.where("codes IS NULL")
        word = F.struct("lang", "word")
        words = checkpoint(
            said.groupBy("code")
            .agg(F.min(word).alias("w"), F.max(word).alias("other"), F.sum("n").alias("n"))
            .where(F.col("n") >= least)
        )
        if words.where("w <> other").isEmpty():
            sizes = said.groupBy("lang").agg(F.sum("n").alias("n"))
            return staged.where("codes IS NOT NULL").select("codes", "n"), words.select("w.*", "code", "n"), sizes
        seed += 1  # two words share a code: once in millions of corpora


# --- the double array ---------------------------------------------------------------------


class DoubleArray:
    """A trie of word codes: the child of state s by symbol c is base[s] + c if its check is s."""

    def __init__(self, phrases: np.ndarray):
        """`phrases` holds one phrase a row, as codes; all have the same number of words."""
        self.alphabet = np.unique(phrases)
        self.phrases = phrases = phrases[np.lexsort(phrases.T[::-1])]
        symbols = np.searchsorted(self.alphabet, phrases) + 1  # 0 is no symbol
        self.base = np.zeros(len(self.alphabet) + 2, np.int64)
        self.check = np.full(len(self.base), -1, np.int64)
        self.check[0] = 0  # the root
        self.end = self.low = self.last = 1  # slots in use lie below end; few below low are free
        at = np.zeros(len(phrases), np.int64)  # the state each phrase has reached
        for level in range(phrases.shape[1]):
            at = self._grow(at, symbols[:, level])
        self.base, self.check = self.base[: self.end].copy(), self.check[: self.end].copy()
        self.accepts = np.full(self.end, -1, np.int64)
        self.accepts[at] = np.arange(len(phrases))

    def _grow(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Give the states `at` their children by `symbol`, and return those."""
        new = np.r_[True, (at[1:] != at[:-1]) | (symbol[1:] != symbol[:-1])]  # phrases are sorted
        parent, code = at[new], symbol[new]
        starts = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        n = np.diff(np.r_[starts, len(parent)])
        child = np.empty(len(parent), np.int64)
        for i in np.argsort(-n, kind="stable"):  # the widest first
            if n[i] == 1:
                break
            codes = code[starts[i] : starts[i] + n[i]]
            base = self._place(codes)
            self._take(parent[starts[i]], base, codes)
            child[starts[i] : starts[i] + n[i]] = base + codes
        # A single child fits anywhere; a base may be negative.
        single = starts[n == 1]
        self._reserve(self.end + len(single))
        slots = np.flatnonzero(self.check[: self.end + len(single)] < 0)[: len(single)]
        self.base[parent[single]] = slots - code[single]
        self.check[slots] = parent[single]
        child[single] = slots
        self.end = max(self.end, int(slots.max(initial=0)) + 1)
        return child[np.cumsum(new) - 1]

    def _reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _take(self, parent: int, base: int, codes: np.ndarray) -> None:
        self.base[parent] = base
        self.check[base + codes] = parent
        self.end = max(self.end, int(base + codes[-1]) + 1)

    def _place(self, codes: np.ndarray) -> int:
        """A base at which the slots of all codes are free: first fit, else behind the last slot."""
        apart = codes[1:] - codes[0]
        self._reserve(self.end + int(apart[-1]) + 2)
        while self.low < self.end and (self.check[self.low : self.low + 4096] < 0).sum() < 64:
            self.low += 4096
        # Nodes come by falling width, so the next one often fits where the last one did.
        for start, windows in ((self.last, 8), (self.low, 8)):
            for at in range(start, min(self.end, start + windows * 4096), 4096):
                free = np.flatnonzero(self.check[at : at + 4096] < 0) + at
                free = free[free + apart[-1] < len(self.check)]
                for step in apart:
                    free = free[self.check[free + step] < 0]
                    if not len(free):
                        break
                if len(free):
                    self.last = at
                    return int(free[0] - codes[0])
        self.last = self.end
        return self.end - int(codes[0])

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each code, 0 for words that are in no phrase and ends of pieces."""
        at = np.searchsorted(self.alphabet, codes)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == codes, at + 1, 0)

    def states(self, symbols: np.ndarray, words: int) -> np.ndarray:
        """The number of the phrase that begins at each position, or -1."""
        found = np.full(len(symbols), -1, np.int64)
        where = np.flatnonzero(symbols)
        state = np.zeros(len(where), np.int64)
        for level in range(words):
            inside = where + level < len(symbols)
            where, state = where[inside], state[inside]
            symbol = symbols[where + level]
            step = self.base[state] + symbol
            good = (symbol > 0) & (step > 0) & (step < len(self.check))
            step = np.where(good, step, 0)
            good &= self.check[step] == state
            where, state = where[good], step[good]
        found[where] = self.accepts[state]
        return found


# --- one pass per level ---------------------------------------------------------------------

_TALLY = "bucket long, size long, number binary, last binary, n binary"


def _tally(number: np.ndarray, last: np.ndarray, n: np.ndarray | None = None):
    """Equal pairs of phrase number and next word as one, sorted, with their counts."""
    codes, dense = np.unique(last, return_inverse=True)
    key, first, back = np.unique((number << 32) | dense, return_index=True, return_inverse=True)
    counts = np.bincount(back, n, len(key)).astype(np.int64)
    return number[first], last[first], counts


def _counted(trie, words: int, complete: bool, groups: int):
    """Counts of the trie's phrases, and tallies of the phrases one word longer that may be frequent."""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*found)) if found else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "size", "number", "last", "n"]
        )

    def tallies(number: np.ndarray, last: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        bucket = ((last ^ number.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            those = order[a:b]
            found.append(
                (int(bucket[those[0]]), len(those), _packed(number[those]), _packed(last[those]), _packed(n[those]))
            )
        return rows(found)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: DoubleArray = trie.value
        total = np.zeros(len(known.phrases), np.int64)
        held: list[tuple] = []
        for batch in batches:
            for data, size in zip(batch.column(0), batch.column(1).to_pylist()):
                codes = _unpacked(data.as_py(), size * 8, np.uint64)
                found = known.states(known.symbols(codes), words)
                total += np.bincount(found[found >= 0], minlength=len(total))
                if words == LONGEST:
                    continue
                last = np.r_[codes[words:], np.zeros(words, np.uint64)][: len(codes)]
                # One word on another frequent phrase begins; with several tries, any word.
                goes_on = np.r_[found[1:] >= 0, False] if complete else last > 0
                at = np.flatnonzero((found >= 0) & goes_on)
                if len(at):
                    held.append(_tally(found[at], last[at]))
                if sum(len(h[0]) for h in held) > PAIRS:
                    held = [_tally(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > PAIRS // 2:
                        yield tallies(*held.pop())
        if held:
            yield tallies(*_tally(*map(np.concatenate, zip(*held))))
        share = TaskContext.get().partitionId() // TASKS
        chunks = -(-len(total) // STATES)
        yield rows(
            [
                (-1 - (share * chunks + c), len(part), None, None, _packed(part))
                for c in range(chunks)
                if (part := total[c * STATES : (c + 1) * STATES]).any()
            ]
        )

    return work


def _added(trie, words: int, least: int):
    """Add up the tallies of a bucket, or the counts of some states over some tasks."""

    def work(key: tuple, blobs: pa.Table) -> pa.Table:
        known: DoubleArray = trie.value
        bucket, sizes = key[0].as_py(), blobs.column("size").to_pylist()
        column = lambda name, kind: np.concatenate(
            [_unpacked(b.as_py(), 8 * size, kind) for b, size in zip(blobs.column(name), sizes)]
        )
        n = column("n", np.int64)
        if bucket >= 0:
            number, last, n = _tally(column("number", np.int64), column("last", np.uint64), n)
            kept = n >= least
            codes, n = np.c_[known.phrases[number[kept]], last[kept]], n[kept]
        else:
            chunks = -(-len(known.phrases) // STATES)
            first = (-1 - bucket) % chunks * STATES
            n = n.reshape(len(sizes), -1).sum(0)
            there = np.flatnonzero(n)
            codes, n = known.phrases[first + there], n[there]
        wide = np.zeros((len(codes), LONGEST), np.uint64)
        wide[:, : codes.shape[1]] = codes
        arrays = [np.full(len(codes), codes.shape[1]), *wide.view(np.int64).T, n]
        return pa.table([pa.array(np.ascontiguousarray(a), pa.int64()) for a in arrays], ["k", *CODES, "f"])

    return work


def _blocks(phrases: DataFrame, words: int, most: int) -> Iterator[tuple[np.ndarray, bool]]:
    """The phrases, `most` at a time, as rows of codes, and whether these are all."""
    names = CODES[:words]
    n = phrases.count()
    blocks = max(1, -(-n * 5 // (most * 4))) if n > most else 1
    block = F.pmod(F.xxhash64(*names), F.lit(blocks))
    for i in range(blocks if n else 0):
        part = phrases.where(block == i).select(*names).toArrow()
        if part.num_rows == 0:
            continue
        codes = [c.to_numpy(zero_copy_only=False) for c in part.columns]
        yield np.stack(codes, 1).astype(np.int64).view(np.uint64), blocks == 1


def phrase_counts(
    codes: DataFrame, words: DataFrame, least: int, groups: int, most: int = PHRASES
) -> DataFrame:
    """k, c1 to c4 and f of every phrase of up to four words that occurs `least` times or more."""
    spark: SparkSession = codes.sparkSession
    schema = ", ".join(f"{c} long" for c in ["k", *CODES, "f"])
    frequent = words.select(F.col("code").alias("c1"))
    levels = []
    for k in range(1, LONGEST + 1):
        level, longer = [], []
        for phrases, complete in _blocks(frequent, k, most):
            trie = spark.sparkContext.broadcast(DoubleArray(phrases))
            counted = codes.mapInArrow(_counted(trie, k, complete, groups), _TALLY)
            added = counted.groupBy("bucket").applyInArrow(_added(trie, k, least), schema)
            summed = checkpoint(
                added.groupBy("k", *CODES).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            )
            trie.unpersist()
            level.append(summed.where(F.col("k") == k))
            longer.append(summed.where(F.col("k") == k + 1))
        if not level:
            break
        levels += level
        frequent = longer[0]
        for more in longer[1:]:
            frequent = frequent.unionByName(more)
    if not levels:
        return spark.createDataFrame([], schema)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found


# --- scores ---------------------------------------------------------------------------------


def _salted(df: DataFrame) -> DataFrame:
    """A table of counts, once for each salt, against hot keys on the other side of a join."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def collocations(
    docs: DataFrame,
    least: int = 30,
    scale: int = 2_000_000,
    inside: int = 80,
    first: int = 2000,
    most: int = PHRASES,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n and score.

    `docs` needs lang and text; other columns are ignored. Words, pieces, counts and scores are
    those of phrases of two to four words that occur `least` times: the score is the least over all
    cuts of floor(scale * a / (l + r)), the first such cut counts. A phrase goes where a longer one
    around it has `inside` per cent of its occurrences or more. A null lang counts as `und`, a null
    text as empty; repeated rows count each. A language without such phrases, and an empty table,
    give no rows.
    """
    codes, words, sizes = read_words(docs, least)
    groups = 1 + (codes.agg(F.sum("n")).first()[0] or 0) // PER_GROUP
    phrases = phrase_counts(codes, words, least, groups, most)
    key = F.slice(F.array(*CODES), F.lit(1), F.col("k").cast("int"))
    counts = checkpoint(phrases.select("k", key.alias("key"), "f"))
    candidates = counts.where("k > 1")

    # Longer phrases around a candidate: the most frequent one decides.
    spans = F.expr(
        "flatten(transform(sequence(2, cast(k AS int) - 1), m ->"
        " transform(sequence(1, cast(k AS int) - m + 1), s -> slice(key, s, m))))"
    )
    around = (
        candidates.where("k > 2").select(F.explode(spans).alias("key"), "f")
        .groupBy("key").agg(F.max("f").alias("longer"))
    )
    kept = candidates.join(around, "key", "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * inside)
    )

    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    sides = _salted(counts.select(F.col("key").alias("part"), F.col("f").alias("of_part")))
    cuts = kept.select(
        "key", F.col("f").alias("a"), salt.alias("salt"),
        F.explode(F.expr("sequence(1, cast(k AS int) - 1)")).alias("cut"),
    )
    left = cuts.withColumn("part", F.expr("slice(key, 1, cut)"))
    left = left.join(sides, ["part", "salt"]).withColumnRenamed("of_part", "l")
    right = left.withColumn("part", F.expr("slice(key, cut + 1, size(key) - cut)"))
    both = right.join(sides, ["part", "salt"]).withColumnRenamed("of_part", "r")
    score = F.expr(f"cast(cast({scale} AS decimal(20, 0)) * a div (l + r) AS long)")
    best = both.groupBy("key", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))

    named = _salted(words.select("lang", "word", "code"))
    spelt = (
        best.select("key", salt.alias("salt"), F.posexplode("key").alias("at", "code"))
        .join(named, ["code", "salt"])
        .groupBy("key")
        .agg(
            F.min("lang").alias("lang"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " "
            ).alias("phrase"),  # four words at most
        )
    )
    scored = best.join(spelt, "key").select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of each part of a language first, so that no task orders all phrases of one.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    short = scored.withColumn("part", part).withColumn(
        "i", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    )
    ranked = short.where(F.col("i") <= first).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    return ranked.where(F.col("rank") <= first).join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
