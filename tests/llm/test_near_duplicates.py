"""Components, min-max hashing and the multi-index against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import minhash, multiindex, shingles
from millrace.llm.components import components


def closure(vertices, links):
    """Smallest reachable vertex of each."""
    root = {v: v for v in vertices}

    def top(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {v: top(v) for v in vertices}


def test_components(spark):
    graphs = [
        [(i, i + 1) for i in range(300)],  # a chain in the order of its numbers
        [(i, i - 1) for i in range(300, 0, -1)] + [(i, i) for i in range(5)],
        [(0, i) for i in range(1, 500)] + [(7, 7), (7, 0), (0, 7)],  # a star, loops, both directions
        [(i, (i * 7 + 3) % 400) for i in range(400) if i % 5],
    ]
    links = [(a + 1000 * g, b + 1000 * g) for g, graph in enumerate(graphs) for a, b in graph]
    frame = spark.createDataFrame([*links, (None, 1), (1, None)], "a long, b long")
    got = {r.id: r.component_id for r in components(frame).collect()}
    vertices = {v for a, b in links if a != b for v in (a, b)}
    assert got == closure(vertices, [x for x in links if x[0] != x[1]])
    assert components(frame.limit(0)).collect() == []


# --- shingles and min-max hashing ------------------------------------------------------------


def plain_set(text, words):
    split = (text or "").encode().lower().split()
    if not split:
        return frozenset()
    n = min(words, len(split))
    return frozenset(tuple(split[i : i + n]) for i in range(len(split) - n + 1))


def test_shingles_agree_where_the_words_do(monkeypatch):
    texts = ["a b c d", "A  B\tC\x0bd", "a b c", "a b", "b a", "", None, " \n", "É b c d", "é b c d", "ab c d e"]
    sets = [tuple(shingles.shingle_set(t, 3)) for t in texts]
    plain = [plain_set(t, 3) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        assert (sets[i] == sets[j]) == (plain[i] == plain[j])
        assert len(set(sets[i]) & set(sets[j])) == len(plain[i] & plain[j])
    long = " ".join(f"w{i % 997}" for i in range(5000))
    whole = shingles.shingle_set(long, 5)
    monkeypatch.setattr(shingles, "SLICE", 100)
    assert whole.tolist() == shingles.shingle_set(long, 5).tolist()
    assert len(whole) == len(plain_set(long, 5))


def test_min_and_max_estimate_similarity_without_bias():
    draw = np.random.default_rng(0)
    common = shingles.mix(draw.integers(0, 2**62, 600).astype(np.uint64))
    own = shingles.mix(draw.integers(0, 2**62, 400).astype(np.uint64))
    kept = minhash.min_max([np.r_[common, own[:200]], np.r_[common, own[200:]]], 2000)
    same = kept[0] == kept[1]
    assert same[0::2].mean() == pytest.approx(0.6, abs=0.04)
    assert same[1::2].mean() == pytest.approx(0.6, abs=0.04)


def test_enough_bands_for_the_similarity():
    for similarity in (80, 85):
        bands = minhash.band_count(similarity)
        assert (1 - (similarity / 100) ** minhash.ROWS) ** bands <= minhash.MISS


def compare(spark, rows, words, similarity, block=8):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, rep string")
    got = minhash.near_duplicates(docs.repartition(3), words, similarity, block).collect()
    sets = [(i, plain_set(t, words)) for i, t in rows]
    links = [
        (i, j)
        for (i, a), (j, b) in combinations([s for s in sets if s[0] is not None and s[1]], 2)
        if 100 * len(a & b) >= similarity * len(a | b)
    ]
    wanted = closure({i for i, _ in sets if i is not None}, links)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == wanted.get(r.doc_id)
        assert r.kept == (r.doc_id == wanted.get(r.doc_id))
    sizes = sorted((str(i), len(s)) for i, s in sets)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sizes
    return links


def edited(draw, words, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return out


@pytest.mark.parametrize(("words", "similarity"), [(3, 85), (5, 80)])
def test_links_are_those_of_brute_force(spark, words, similarity):
    draw, rows = random.Random(2), []
    for g in range(40):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(20, 150))]
        for _ in range(draw.choice([1, 1, 2, 3, 12])):
            rows.append((len(rows), " ".join(edited(draw, base, draw.randrange(0, 6)))))
    assert len(compare(spark, rows, words, similarity)) > 50


def test_a_chain_whose_ends_differ_and_a_group_around_the_threshold(spark):
    """Members that are not linked with the smallest of their bucket are still found."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(draw, base, 3))) for i in range(60)]
    chain = list(base)
    for i in range(100, 130):
        chain = edited(draw, chain, 2)
        rows.append((i, " ".join(chain)))
    compare(spark, rows, 3, 85)


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"), (None, "one")]
    rows += [(7, "x " * 100_000), (8, "x " * 100_001), (9, "same text here now"), (9, "same text here now")]
    compare(spark, rows, 3, 85)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e f", "x"), (3, "A B C D E F", "y"), (3, "A B C D E F", "y"), (8, "other words", None)]
    rows += [(None, "a b c d e f", "n"), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = minhash.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "8", "9", "None"]


# --- multi-index ------------------------------------------------------------------------------


def test_traversal_is_in_order_and_complete():
    draw = np.random.default_rng(3)
    left, right = draw.random(9), draw.random(7)
    for reach in (0.0, 0.3, 0.9, 5.0):
        cells = multiindex.traverse(left, right, reach)
        far = [left[i] + right[j] for i, j in cells]
        assert far == sorted(far) and len(set(cells)) == len(cells)
        limit = left.min() + right.min() + reach
        assert set(cells) == {(i, j) for i in range(9) for j in range(7) if left[i] + right[j] <= limit}


def compare_vectors(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n_links string")
    got = multiindex.near_duplicates(frame.repartition(3)).collect()
    good = {
        i: np.array(v, np.float32 if kind == "float" else float).astype(float)
        for i, v, _ in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    }
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(i, j) for i, j in combinations(sorted(unit), 2) if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    wanted = closure({i for i, _, _ in rows if i is not None}, links)
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links == sum(r.vec_id in x for x in links)
        assert r.component_id == wanted.get(r.vec_id)
        assert r.kept == (r.vec_id == wanted.get(r.vec_id))
    return links


def test_vectors_against_brute_force_with_a_group_of_a_third(spark):
    draw = np.random.default_rng(5)
    hot = draw.standard_normal(8)
    rows = []
    for i in range(900):
        v = hot + draw.standard_normal(8) * 0.05 if i % 3 == 0 else draw.standard_normal(8)
        rows.append((i, [float(x) for x in v], "clash"))
    rows += [(900 + i, rows[1][1], "copy") for i in range(40)] + [(950, [3 * x for x in rows[1][1]], None)]
    assert len(compare_vectors(spark, rows)) > 30_000


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    one = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    rows = [(1, None, "x"), (2, [], "x"), (3, [0.0] * 8, "x"), (4, [nan, *one[1:]], "x"), (5, [inf, *one[1:]], "x")]
    rows += [(6, [None, *one[1:]], "x"), (7, one, "x"), (7, one, "x"), (8, one, "x"), (9, one[:3], "x"), (None, one, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, extra string")
    got = {r.vec_id: r for r in multiindex.near_duplicates(frame).collect()}
    assert [got[i].n_links for i in (1, 2, 3, 4, 5, 6, 9, None)] == [0] * 8
    assert got[7].n_links == got[8].n_links == 1 and got[8].component_id == 7
    assert got[None].component_id is None and got[None].kept
    assert multiindex.near_duplicates(frame.limit(0)).collect() == []
    huge = [(1, [1e200] * 8, ""), (2, [2e200] * 8, ""), (3, [1e-200] * 8, ""), (4, [-1e-200] * 8, "")]
    frame = spark.createDataFrame(huge, "vec_id long, embedding array<double>, extra string")
    assert {r.vec_id: r.component_id for r in multiindex.near_duplicates(frame).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_recall_over_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = multiindex.unit(np.array([r.embedding for r in table.orderBy("vec_id").collect()], float))
    true = int(((x @ x.T) >= 0.95).sum() - len(x))
    found = sum(r.n_links for r in multiindex.near_duplicates(table).collect())
    assert 0.999 * true <= found <= true


def test_vectors_of_every_length_are_linked_with_their_own(spark, monkeypatch):
    """Five and six of two lengths, and two lengths large enough for codebooks of their own."""
    rows = [(i, [1.0, 2.0], None) for i in range(5)] + [(10 + i, [1.0, 2.0, 0.1 * i], None) for i in range(6)]
    compare_vectors(spark, rows)
    monkeypatch.setattr(multiindex, "PER_CELL", 16)
    draw = np.random.default_rng(9)
    for n, length in ((300, 8), (200, 6), (30, 4)):
        centres = draw.standard_normal((n // 3, length))
        for i in range(n):
            v = centres[i % len(centres)] + draw.standard_normal(length) * 0.08
            rows.append((1000 * length + i, [float(x) for x in v], None))
    assert len(compare_vectors(spark, rows)) > 200
