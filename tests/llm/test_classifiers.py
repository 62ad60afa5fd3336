"""Toxicity and language ID: held-out accuracy, and rows out of the ordinary."""

import pickle
import zlib

import numpy as np
import pytest

from millrace.llm import language, ngrams, queries, toxicity

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, score string"


def test_ngrams_stay_within_words_and_slices_do_not_matter(monkeypatch):
    text = "Ab cdé  fgh\nij" * 5
    whole = np.sort(np.concatenate(list(ngrams.buckets(text, (2, 3), 20))))
    monkeypatch.setattr(ngrams, "SLICE", 7)
    sliced = np.sort(np.concatenate(list(ngrams.buckets(text, (2, 3), 20))))
    assert whole.tolist() == sliced.tolist()
    data = f" {text.lower()} ".encode()
    blank = b" \n"
    wanted = sum(
        not any(c in blank for c in data[i + 1 : i + n - 1])
        for n in (2, 3)
        for i in range(len(data) - n + 1)
    )
    assert len(whole) == wanted
    assert ngrams.counts("", (1, 2), 8).sum() == 3  # the two blanks around nothing, and their pair


def test_toxicity_on_the_held_out_fold(spark):
    scored = queries.QUERIES["op9_ngram_toxicity"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(scored) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    toxic = [r for r in held if truth[r.doc_id] == 1]
    assert np.mean([r.predicted for r in toxic]) > 0.9


def test_toxic_texts_outside_english_are_found(spark):
    scored = queries.QUERIES["op9_ngram_toxicity"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang <> 'en'").select("doc_id")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    held = scored.where("held_out").join(docs, "doc_id").join(labels, "doc_id").collect()
    assert np.mean([r.predicted for r in held if r.toxic == 1]) > 0.7  # 3 of 39 without repetition
    assert np.mean([r.predicted for r in held if r.toxic == 0]) < 0.02


def test_repetition_decides_and_slices_do_not_matter(monkeypatch):
    tiers = ngrams.Tiers((3,), 20, (1, 2, 4))
    once, often = tiers.of("abc"), tiers.of("abc " * 5)
    assert set(once) < set(often) and max(once) < 1 << 20 and max(often) >= 2 << 20
    text = "Ab cdé  fgh\nij" * 5
    whole = np.sort(tiers.of(text))
    monkeypatch.setattr(ngrams, "SLICE", 7)
    assert np.sort(tiers.of(text)).tolist() == whole.tolist()


def test_counts_and_sets_travel_in_few_bytes(spark):
    draw = np.random.default_rng(5)
    words = ["".join(map(chr, draw.integers(97, 123, 6))) for _ in range(3000)]
    texts = [" ".join(draw.choice(words, 300)) for _ in range(200)] + ["", None]
    toxic = [int(t) for t in draw.integers(0, 2, len(texts))]
    rows = spark.createDataFrame(list(zip(texts, toxic)), "text string, toxic int").repartition(3)
    handed = rows.mapInArrow(toxicity._count, "part int, counts binary").collect()
    found = rows.mapInArrow(toxicity._count, "part int, counts binary").groupBy("part")
    found = found.applyInArrow(toxicity._added, "feature int, toxic long, clean long").collect()

    tiers, wanted = ngrams.Tiers(toxicity.ORDERS, toxicity.BITS, toxicity.TIERS), {}
    for text, label in zip(texts, toxic):
        for feature in [-1, *tiers.of(text or "").tolist()]:
            wanted.setdefault(feature, [0, 0])[label] += 1
    assert {r.feature: [r.clean, r.toxic] for r in found} == wanted and len(found) == len(wanted)
    # A row of three numbers for each feature of each of the three tasks took 20 bytes.
    assert sum(len(r.counts) for r in handed) < 3 * 5 * len(wanted)
    for text in texts:
        features = tiers.of(text or "")
        assert np.array_equal(toxicity._unpacked(toxicity._packed(features)), features)
        assert len(toxicity._packed(features)) < 3 * len(features) + 32


def test_texts_without_a_label_stay_where_they_are(spark):
    ids = [0, -1, 1, 2**62, -(2**62), *range(1000, 3000)]
    own = spark.createDataFrame([(i, f"text {i}") for i in ids for _ in range(2)], "doc_id long, text string")
    for some in (ids[::3], ids, []):
        known = spark.createDataFrame([(i, i % 2) for i in some], "doc_id long, toxic int")
        left = [tuple(r) for r in toxicity._likely(own, known).collect()]
        assert {(i, f"text {i}") for i in some} <= set(left) and len(left) == 2 * len(set(left))
        assert len(left) <= 2 * len(some) + 10
    narrow = spark.createDataFrame([(1000, 1)], "doc_id int, toxic int")
    assert toxicity._likely(own, narrow).where("doc_id = 1000").count() == 2


def test_language_on_the_held_out_fold(spark):
    found = queries.QUERIES["op7_language_families"](spark, SF_DIR).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


@pytest.fixture()
def odd(spark):
    rows = [(1, None, "en", "x"), (2, "", None, None), (3, "12 !?", "en", "x"), (None, "hello there", "en", "x")]
    rows += [(4, "the same", "en", "x"), (4, "the same", "en", "x"), (5, "word " * 300_000, None, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (4, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    scored = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(scored) == 7 and all(0 <= r.score <= 1 for r in scored)
    assert len(scored[0]) == 4  # the clashing column gave way
    alone = {r.doc_id: r.score for r in toxicity.score(odd.select("doc_id", "text"), toxicity.train(odd, labels.limit(0))).collect()}
    assert max(alone.values()) < 1e-6


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).collect() == []
    assert language.identify(none, language.train(none)).collect() == []


def test_language_of_odd_rows(spark, odd):
    found = {r.doc_id: r for r in language.identify(odd, language.train(odd)).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1, 2, 3))
    assert found[4].lang_pred == "en" and found[None].lang_pred == "en"
    untaught = language.identify(odd, None).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_family_first_then_pairs_within_it():
    words = {"de": "und der die nicht", "nl": "het een van niet", "fr": "les des une pour", "es": "los las una para"}
    texts = [(" ".join(w.split()[i % 4] for i in range(k, k + 9)), g) for g, w in words.items() for k in range(20)]
    machines = language.Machines(np.array([language.features(t) for t, _ in texts]), [g for _, g in texts])
    assert machines.families == ["germanic", "romance"]
    assert [len(p) for p in machines.pairs] == [1, 1]
    assert all(machines.predict(t)[0] == g for t, g in texts)


def test_what_the_driver_hands_on_of_a_toxicity_model_is_small(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    sent, broadcast, first = [], type(spark.sparkContext).broadcast, type(docs).first

    def noted(self, value):
        sent.append(len(pickle.dumps(value)))
        return broadcast(self, value)

    def taken(self):
        row = first(self)
        sent.append(len(pickle.dumps(row)))
        return row

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    monkeypatch.setattr(type(docs), "first", taken)
    weights, level = model = toxicity.train(docs, labels)
    toxicity.score(docs, model)
    assert weights.dtype == np.float32 and len(weights) == len(toxicity.TIERS) << toxicity.BITS and weights.any()
    assert len(sent) == 3 and max(sent) < weights.nbytes / 4
