"""Base spans against the plain patterns of `re`, votes, training and redaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


BITS = """a@b.c x_d@e.f _d@e.f 1.2.3.4 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 4111-1111-1111-1111
4111111111111111 . @ + - 99 abc é 😀 ( ) 2024-01-15 1234567890123456 a..b@c-.d. 3.3. [at] [dot] ::1""".split()
BITS += [" ", "\n", "+1 (555) 555-1234", "+44 20 7946 0958", "4111 1111 1111 1111", "(555) 123-4567"]


def found(spark, texts, scores=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = pii.train(docs) if scores is None else scores
    out = pii.find(docs, scores).withColumn("red", pii.redacted(F.col("text"), F.col("spans")))
    return {r.doc_id: r for r in out.collect()}


def spans(column):
    return [(s.kind, s.start, s.end) for s in column]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randrange(1, 25))) for _ in range(2000)]
    texts += ["9" * 50_000, "a" * 50_000 + "@b.c", "a@b" + ".c" * 20_000, "1.2.3.4 " * 900, "+1 " * 5000]
    for i, row in found(spark, texts, {}).items():
        assert spans(row.base) == base_spans(texts[i])
        assert spans(row.spans) == spans(row.base)


def test_nulls_empty_texts_and_empty_tables(spark):
    rows = found(spark, [None, "", "no data"])
    assert all(spans(r.spans) == [] for r in rows.values())
    assert rows[0].red is None and rows[1].red == "" and rows[2].red == "no data"
    assert found(spark, []) == {}


def test_repeated_rows_and_other_columns_pass_through(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.com", "x"), (1, "mail a@b.com", "x"), (None, "a@b.org", None)],
        "doc_id long, text string, base_email string",
    ).select("doc_id", "text", F.struct("base_email").alias("doc"))
    out = pii.find(docs, {}).collect()
    assert [r.doc.base_email for r in out] == ["x", "x", None]
    assert all(len(r.base) == 1 for r in out)


def test_em_learns_which_voter_to_trust():
    """Voter 0 is always right, the next two mostly, the last two are noise."""
    draw, counts, truth = random.Random(1), {}, {}
    for _ in range(4000):
        real = draw.random() < 0.4
        sign = 1 if real else -1
        mostly = [sign if draw.random() < sure else -sign for sure in (0.9, 0.8)]
        votes = (sign, *mostly, draw.choice([-1, 0, 1]), draw.choice([-1, 0, 1]))
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = real
    posterior = pii.reliabilities(counts)
    right = sum(n for v, n in counts.items() if (posterior[v] > 0.5) == truth[v])
    assert right > 0.97 * sum(counts.values())


def test_the_classifier_adds_spans_and_never_drops_base_ones(spark):
    """Numbers with a cue before them are learnt from strict ones; dates are not taken for phones."""
    sure = [f"Please call +1 (555) 555-{1000 + i} today" for i in range(60)]
    loose = [f"Please call (555) 555-{1000 + i} today" for i in range(30)]
    dates = [f"see version 2024-01-{10 + i} notes" for i in range(15)]
    rows = found(spark, sure + loose + dates)
    assert all(len(rows[i].spans) == 1 for i in range(60))
    added = sum(spans(rows[60 + i].spans) == [("phone", 12, 26)] for i in range(30))
    assert added == 30
    assert rows[60].red == "Please call [PHONE] today"
    assert all(rows[90 + i].spans == [] for i in range(15))


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("a@b.com", "[EMAIL]"),
        ("é a@b.com, 1.2.3.4!", "é [EMAIL], [IP]!"),
        ("+1.2.3.4.5.6.7.8x", "[PHONE]x"),
        ("4111 1111 1111 1111", "[CARD]"),
    ],
)
def test_redaction(spark, text, wanted):
    assert found(spark, [text], {})[0].red == wanted


def test_two_megabytes_of_matches_take_time_in_proportion(spark):
    import time

    line = "mail jane.doe@example.com or +49 30 1234567, then 12 34 56 78 and x (at) y.org; 4111 1111 1111 1111\n"
    text = line * (2_000_000 // len(line))
    rows = [(1, text), (2, line * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    began = time.time()
    found = pii.find(docs, pii.train(docs)).withColumn("clean", pii.redacted(F.col("text"), F.col("spans")))
    got = {r.doc_id: r for r in found.collect()}
    assert time.time() - began < 120
    for doc_id, text in rows:
        assert [(s.start, s.end) for s in got[doc_id].base if s.kind == "email"] == [
            m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
        ]
        assert got[doc_id].clean == plainly_redacted(text, got[doc_id].spans)
        assert "jane" not in got[doc_id].clean


def plainly_redacted(text, spans):
    out, at = [], 0
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


@pytest.mark.parametrize("seed", range(2))
def test_context_and_redaction_of_dense_texts_match_plain_python(spark, monkeypatch, seed):
    """Neighbours, context and placeholders where matches touch, with small chunks and pieces."""
    import random

    monkeypatch.setattr(pii, "CHUNK", 3)
    monkeypatch.setattr(pii, "PIECE", 16)
    pick = random.Random(seed)
    parts = ["a@b.co", "+1234567890", "12 34", "1.2.3.4", " ", ",", "é𝄞", "tel ", "x(at)y.de", "99-11", "\n", "phone +49 30 1234567 "]
    rows = [(i, "".join(pick.choices(parts, k=pick.randrange(30)))) for i in range(60)] + [(99, None), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    beside = docs.withColumn("_any", F.lit(True)).select(
        "doc_id", "text", *[pii._spans(F.coalesce("text", F.lit("")), p).alias(k) for k, p in pii.STRICT.items()]
    )
    for r in beside.collect():
        for kind in pii.KINDS:
            for s in r[kind]:
                assert r.text[s.start : s.end] == s.value
                assert s.before == r.text[max(0, s.start - pii.CONTEXT) : s.start]
                assert s.after == r.text[s.end : s.end + 1]
    found = pii.find(docs, pii.train(docs)).withColumn("clean", pii.redacted(F.col("text"), F.col("spans")))
    for r in found.collect():
        assert r.clean == (None if r.text is None else plainly_redacted(r.text, r.spans))
        base = [(s.start, s.end) for s in r.base]
        for s in r.spans:
            assert (s.start, s.end) in base or not any(a < s.end and s.start < b for a, b in base)
