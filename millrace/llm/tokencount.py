"""Token counts by a map-side lookup in two tiers, without any shuffle of pre-tokens.

A text's count is the sum over its pre-tokens, and a pre-token's length does not depend on its
neighbours. The lengths of frequent pre-tokens are broadcast in a compact table; those it lacks
are encoded where they are met and kept in the worker's own cache. Both tiers only save work: a
pre-token in neither is encoded by the vocabulary, so counts are exact whatever the tables hold.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import _encoding, _reference

#: Entries of the broadcast table, and of a worker's cache beside it.
FREQUENT, CACHED = 1 << 15, 1 << 18
#: The table is drawn from at most so many tasks, so much text in each and so many entries of each.
TASKS, TASK_TEXT, TASK_ENTRIES = 64, 1 << 20, 1 << 13
#: Pre-tokens longer than this are not kept in a cache; longer texts are read piece by piece.
LONGEST, WHOLE = 64, 1 << 20


@cache
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


@cache
def _unassigned() -> re.Pattern:
    """Characters without a category here: libraries of other Unicode versions may class them."""
    ranges, start, last = [], None, None
    for code in range(0x110000):
        if unicodedata.category(chr(code)) == "Cn":
            if start is None:
                start = code
            last = code
        elif start is not None:
            ranges.append((start, last))
            start = None
    ranges.append((start, last))
    return re.compile("[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges if a is not None) + "]")


class _Odd(Exception):
    """A character that another Unicode version may class otherwise."""


class Lengths(dict):
    """Lengths in tokens by pre-token: the frequent ones, and a bounded cache of others."""

    def __init__(self, name: str, frequent: dict[str, int], cached: int = CACHED):
        super().__init__(frequent)
        self.name, self.frequent, self.room = name, frequent, len(frequent) + cached

    def __missing__(self, piece: str) -> int:
        if not piece.isascii() and _unassigned().search(piece):
            raise _Odd  # such a piece is in no table, so it is always met here
        # Not by way of the library's own pattern, which a million blanks in a row are too much for.
        n = len(_encoding(self.name)._encode_single_piece(piece))
        if len(piece) <= LONGEST:
            if len(self) >= self.room:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def of(self, text: str) -> int:
        """Tokens of a whole text. Added tokens in it count one each, as the library has it."""
        try:
            return self._count(text)
        except _Odd:
            return len(_reference(self.name).encode(text, add_special_tokens=False).ids)

    def _count(self, text: str) -> int:
        added = _encoding(self.name)._special_tokens
        parts = [text]
        if any(token in text for token in added):
            parts = re.split("|".join(map(re.escape, added)), text)
        n = len(parts) - 1
        for part in parts:
            if len(part) <= WHOLE:
                n += sum(map(self.__getitem__, _pattern().findall(part)))
            else:
                n += sum(self[match[0]] for match in _pattern().finditer(part))
        return n


def frequent_lengths(docs: DataFrame, name: str, entries: int = FREQUENT) -> dict[str, int]:
    """The commonest pre-tokens of a bounded sample, with their lengths.

    At most `TASKS` tasks count the pre-tokens of their first `TASK_TEXT` characters and send the
    driver `TASK_ENTRIES` each; the others stop at once. It is a table for speed only.
    """
    texts = docs.select("text")
    step = -(-texts.rdd.getNumPartitions() // TASKS)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        if TaskContext.get().partitionId() % step == 0:
            room = TASK_TEXT
            for batch in batches:
                for text in batch.column(0):
                    text = (text.as_py() or "")[:room]
                    found.update(p for p in _pattern().findall(text) if len(p) <= LONGEST)
                    room -= len(text)
                    if room <= 0:
                        break
                if room <= 0:
                    break
        top = found.most_common(TASK_ENTRIES)
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    total: Counter = Counter()
    for row in texts.mapInArrow(seen, "piece string, n long").collect():  # TASKS * TASK_ENTRIES rows
        total[row["piece"]] += row["n"]
    lengths, found = Lengths(name, {}), {}
    for piece, _ in total.most_common(entries):
        try:
            found[piece] = lengths[piece]
        except _Odd:
            continue
    return found


def token_counts(docs: DataFrame, name: str = "byte_bpe_50k", entries: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document, in a byte-level public vocabulary.

    `docs` needs doc_id and text; other columns are ignored. Tokens are counted as the vocabulary's
    library gives them without special tokens, truncation or padding; added tokens that stand in a
    text count one each. Null texts count as empty, a null doc_id stays null, repeated rows and ids
    are counted each, and an empty table gives no rows. Texts are read whole, very long ones
    pre-token by pre-token.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_lengths(rows, name, entries))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(name, shared.value)
        for batch in batches:
            texts = batch.column(1)
            tokens = [lengths.of(text.as_py()) for text in texts]
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
