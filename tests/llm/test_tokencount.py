"""Token counts against the vocabulary's own library."""

import random
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.tokencount import Lengths, token_counts

NAME = "byte_bpe_50k"


@cache
def library():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path(f"{NAME}.json"))


def wanted(text):
    return len(library().encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    assert Lengths(NAME, {}).of(text) == wanted(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "É", "1", "'s", "'", "!", "<|endoftext|>", " ", "\x1c", " ", "ʼ", "٣", "՘", "语"])))
def test_blanks_marks_and_added_tokens(parts):
    assert Lengths(NAME, {}).of("".join(parts)) == wanted("".join(parts))


def test_every_character_counts_as_the_library_has_it():
    tokens, lengths = library(), Lengths(NAME, {})
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b 1{chr(c)}2 !{chr(c)} " for c in codes[i : i + 64]) for i in range(0, len(codes), 64)]
    for at in range(0, len(texts), 2048):
        part = texts[at : at + 2048]
        known = [len(e.ids) for e in tokens.encode_batch(part, add_special_tokens=False)]
        assert [lengths.of(t) for t in part] == known


@pytest.mark.parametrize("text", ["x" * 300_000, "ab " * 700_000, " " * 1_200_000 + "a", "語" * 50_000])
def test_very_long_texts(text):
    assert Lengths(NAME, {}).of(text) == wanted(text)


def test_small_tables_and_caches_change_nothing(spark):
    pick = random.Random(3)
    words = ["the", " of", "naïve", "\n", "  ", "12345", "<|endoftext|>", "Straße", "e.g.", "'ll"]
    rows = [(i % 7, "".join(pick.choices(words, k=pick.randrange(0, 60))), "x", 1) for i in range(300)]
    rows += [(None, "hot text", "y", 2), (1, None, "z", 3), (2, "", "z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes long").repartition(5)
    expected = sorted(((i, len((t or "").encode()), wanted(t or "")) for i, t, *_ in rows), key=repr)
    for entries in (3, 1 << 15):
        assert sorted(map(tuple, token_counts(docs, NAME, entries).collect()), key=repr) == expected
    assert token_counts(docs.limit(0)).collect() == []


def test_a_full_cache_begins_anew():
    lengths = Lengths(NAME, {"the": 1}, cached=2)
    text = "one two three four five the end of it"
    assert lengths.of(text) == wanted(text) and len(lengths) <= 4 and "the" in lengths
