"""Phrase collocations against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations as c

DOCS = "doc_id long, text string, lang string"


def plain(rows, least, inside=80, first=2000, scale=2_000_000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in candidates.items():
        around = [
            b for (other, longer), b in candidates.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        ]
        if any(100 * b >= inside * a for b in around):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((scale * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in {row[0] for row in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *row[1:]) for i, row in enumerate(mine[:first])]
    return sorted(ranked)


def corpus(seed, n=150):
    pick = random.Random(seed)
    words = ["New", "york", "city", "the", "the", "of", "é", "a b", "x\x00y", "CITY", "\x1c"]
    rows = []
    for i in range(n):
        text = "".join(pick.choice(words) + pick.choice([" ", " ", "  ", "\t", ". ", "\n", "!"]) for _ in range(pick.randrange(30)))
        rows.append((i % 9, text, pick.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, None, "en"), (1, "", None), (2, "one", "solo")]


def mined(spark, rows, **more):
    return sorted(map(tuple, c.collocations(spark.createDataFrame(rows, DOCS).repartition(4), **more).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_python(spark, seed):
    rows = corpus(seed)
    wanted = plain(rows, 8)
    assert len(wanted) > 20
    assert mined(spark, rows, least=8) == wanted


def test_many_small_tries_slices_and_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(5)
    for name, value in (("HELD", 4), ("PAIRS", 6), ("SLICE", 16), ("PER_GROUP", 300), ("STATES", 3), ("TASKS", 1)):
        monkeypatch.setattr(c, name, value)
    assert mined(spark, rows, least=8, most=25) == plain(rows, 8)


def test_overlaps_a_hot_phrase_and_the_cut_at_the_first_ranks(spark):
    """Words that repeat overlap; a third of all rows are one text; ranks end where they are cut."""
    rows = [(i, "go go go go go", "en") for i in range(40)] + [(i, "red fox red dog", "en") for i in range(40)]
    rows += [(i, f"red fox w{i}", "en") for i in range(40)]
    assert mined(spark, rows, least=30, inside=101, first=3) == plain(rows, 30, inside=101, first=3)
    assert mined(spark, rows, least=30) == plain(rows, 30)


def test_nothing_frequent_and_no_rows(spark):
    assert mined(spark, [(1, "a b c", "en")]) == []
    assert mined(spark, []) == []


def test_clashing_columns(spark):
    rows = [(1, "a b", "en", "x", 2)] * 40
    docs = spark.createDataFrame(rows, DOCS + ", codes string, n long")
    assert [tuple(r) for r in c.collocations(docs).collect()] == plain([r[:3] for r in rows], 30)


def test_words_that_share_a_code_are_told_apart(spark, monkeypatch):
    """With codes that collide under seed 0 another seed is taken."""
    docs = spark.createDataFrame([(1, "a b a b c", "en")] * 3, DOCS)
    real = c._coded

    def poor(seed):
        return real(seed) if seed else lambda batches: (same(b) for b in real(seed)(batches))

    def same(batch):
        return batch.set_column(2, "code", __import__("pyarrow").array([1 if v is not None else None for v in batch.column(2).to_pylist()], "int64"))

    monkeypatch.setattr(c, "_coded", poor)
    codes, words, sizes = c.read_words(docs, 3)
    assert sorted((r.word, r.n) for r in words.collect()) == [("a", 6), ("b", 6), ("c", 3)]
    assert words.select("code").distinct().count() == 3


def test_the_double_array_accepts_what_it_holds():
    pick = np.random.default_rng(2)
    for words in (1, 2, 3):
        phrases = np.unique(pick.integers(1, 40, (300, words), np.uint64) * np.uint64(2**58 + 7), axis=0)
        known = c.DoubleArray(phrases)
        text = np.r_[pick.choice(phrases.ravel(), 5000), np.zeros(3, np.uint64)]
        got = known.states(known.symbols(text), words)
        listed = {tuple(p): i for i, p in enumerate(known.phrases.tolist())}
        assert got.tolist() == [listed.get(tuple(text[i : i + words].tolist()), -1) for i in range(len(text))]


def test_a_large_array_is_built_fast_and_dense():
    pick = np.random.default_rng(3)
    phrases = np.unique((pick.pareto(1.0, (200_000, 3)) * 50).astype(np.uint64) % np.uint64(50_000) + np.uint64(1), axis=0)
    known = c.DoubleArray(phrases)
    assert len(known.check) < 12 * len(phrases)
    got = known.states(known.symbols(known.phrases[::997].ravel()), 3)
    assert (got[::3] == np.arange(len(phrases))[::997]).all()
