"""Personal data by weak supervision, with DataFrame functions only.

Strict patterns give the base spans, looser ones further candidates. Labelers vote on every
candidate: the strict pattern, gazetteers, the words before it, its form and its neighbours,
each for, against or silent. Expectation-maximisation estimates from the votes alone how far
each labeler can be trusted, and its posteriors are the soft labels on which a logistic span
classifier is trained for each kind. Base spans always stay; the classifier decides on the rest.

What training needs is the number of candidates by kind, votes and length class, a bounded
table counted over all documents. Finding, voting and redacting are projections of a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns are written so that a long run of characters is read once: a match cannot start
# within a run whose beginning failed (\G lets one start where the last match ended), and what
# cannot match differently when given back is possessive. They find the same spans as
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The least characters of a match.
SHORTEST = {"email": 5, "ip": 7, "card": 2, "phone": 3}
#: Further candidates: spelt-out addresses, IPv6, 15-digit cards, phone numbers without a plus
#: or that run into other numbers.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]++"
    r"(?:\.[A-Za-z0-9-]++| ?[(\[{] ?dot ?[)\]}] ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.-])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?"
    r"(?:[\x20./-][0-9]{2,5}){2,4}(?![0-9A-Za-z])",
}

#: What any valid match of any pattern contains; texts without it are not searched further.
SIGN = (
    r"[@(\[{:0-9](?:(?<=@)|(?<=[(\[{]) ?[aA][tT] ?[)\]}]|(?<=:)[0-9A-Fa-f]{1,4}:"
    r"|(?<=[0-9])[0-9\x20.()/-]{5,}[0-9])"
)

# Gazetteers and cue words.
DOMAINS = "com org net edu gov info io eu uk de fr es it at ch be nl pl us ca au jp cn in br mx"
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 61 81 82 86 90 91"
CUES = {
    "email": "mail e-mail contact write courriel correo schreib",
    "ip": "ip host server address adresse",
    "card": "card visa mastercard amex credit carte karte tarjeta pay",
    "phone": "phone tel call mobile fax contact telefon telephone llamar appel",
}
AGAINST = "version release isbn issn order invoice date ref id no section page article doi sku"
#: Characters before a candidate that are searched for cue words.
CONTEXT = 32
#: Spans of a text that are stepped over together, and code points of a piece of it.
CHUNK, PIECE = 256, 4096

VOTERS = ("strict", "gazetteer", "context", "form", "neighbours")
#: Rounds of expectation-maximisation and of the classifier's descent.
ROUNDS = 50


def _one_of(words: str) -> str:
    return "|".join(words.split())


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunked(all_: Column) -> Column:
    """An array cut into chunks of CHUNK, so that a step over all of it need not cost its square."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)),
    )


def _running(all_: Column, of: Callable[[Column], Column], add: Callable, make: Callable) -> Column:
    """make(x, so_far) for every x, where so_far adds up `of` over the elements before x."""
    fold = lambda a: F.aggregate(a, F.lit(0), add)

    def over(chunks: Column) -> Column:
        def inside(sums: Column) -> Column:
            return F.flatten(
                F.transform(
                    chunks,
                    lambda chunk, i: _let(
                        fold(F.slice(sums, F.lit(1), i)),
                        lambda before: _let(
                            F.transform(chunk, of),
                            lambda own: F.transform(
                                chunk, lambda x, j: make(x, add(before, fold(F.slice(own, F.lit(1), j))))
                            ),
                        ),
                    ),
                )
            )

        return _let(F.transform(chunks, lambda chunk: fold(F.transform(chunk, of))), inside)

    return _let(_chunked(all_), over)


def _spans(text: Column, pattern: str, shortest: int = 2) -> Column:
    """Array of (start, end, value, before, after) of all matches, leftmost first.

    Places are code points, end exclusive; `before` is the CONTEXT characters before the match,
    `after` the one behind it. Parts between matches and matches alternate, so lengths add up to
    places, and what stands beside a match is taken from the parts and matches around it, never
    searched for from the beginning of the text: its cost is in proportion to its length.
    """

    def paired(found: Column, parts: Column) -> Column:
        # Heads and tails of the parts, so that a long part is walked through once.
        heads = F.transform(parts, lambda p: F.substring(p, 1, 1))
        return _let(
            heads,
            lambda heads: F.transform(
                found,
                lambda m, i: F.struct(
                    F.length(F.get(parts, i)).alias("gap"),
                    (F.length(F.get(parts, i)) + F.length(m)).alias("both"),
                    m.alias("value"),
                    F.concat(F.substring(F.get(parts, i), -CONTEXT, CONTEXT), m).alias("tail"),
                    F.when(F.get(heads, i + 1) != "", F.get(heads, i + 1))
                    .otherwise(F.coalesce(F.substring(F.get(found, i + 1), 1, 1), F.lit("")))
                    .alias("after"),
                ),
            ),
        )

    def beside(pairs: Column) -> Column:
        # With matches of `shortest` characters at least, so many of them and the parts between hold
        # the context.
        near = -(-CONTEXT // shortest)
        return F.transform(
            pairs,
            lambda x, i: F.struct(
                x["gap"].alias("gap"),
                x["both"].alias("both"),
                x["value"].alias("value"),
                x["after"].alias("after"),
                _let(
                    F.concat(
                        F.array_join(
                            F.transform(
                                F.slice(pairs, F.greatest(i - near, F.lit(0)) + 1, F.least(i, F.lit(near))),
                                lambda y: y["tail"],
                            ),
                            "",
                        ),
                        F.substring(x["tail"], F.lit(1), F.length(x["tail"]) - F.length(x["value"])),
                    ),
                    lambda t: F.substring(t, -CONTEXT, CONTEXT),
                ).alias("before"),
            ),
        )

    def placed(x: Column, at: Column) -> Column:
        return F.struct(
            (at + x["gap"]).alias("start"),
            (at + x["both"]).alias("end"),
            x["value"].alias("value"),
            x["before"].alias("before"),
            x["after"].alias("after"),
        )

    pairs = _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: _let(F.split(text, pattern, -1), lambda parts: paired(found, parts)),
    )
    spans = _let(
        _let(pairs, beside), lambda all_: _running(all_, lambda x: x["both"], lambda s, x: s + x, placed)
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    return F.when(F.col("_any") & text.rlike(pattern), spans).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(_digits(value), ""))
    weighed = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    """What a strict match must fulfil; one that fails is dropped, nothing shorter is tried."""
    n = F.length(_digits(value))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _votes(kind: str, span: Column, strict: bool) -> list[Column]:
    """The votes of VOTERS on a span: 1 for, -1 against, 0 silent."""
    value = span["value"]
    n = F.length(_digits(value))
    vote = lambda good, bad: F.when(bad, -1).when(good, 1).otherwise(0)
    before = F.lower(span["before"])
    context = vote(
        before.rlike(rf"\b(?:{_one_of(CUES[kind])})\b"), before.rlike(rf"\b(?:{_one_of(AGAINST)})\b[^a-z]*$")
    )
    around = F.concat(F.substring(span["before"], -1, 1), F.lit("|"), span["after"])
    neighbours = vote(around.rlike(r"^[\s(,;:<\"']?\|[\s),;.:>\"'!?]?$"), around.rlike(r"^[=/#_]|[=/_%]$"))
    if kind == "email":
        gazetteer = vote(value.rlike(rf"(?i)[. )]({_one_of(DOMAINS)})$"), value.rlike(r"\.[0-9]+$"))
        form = vote(value.rlike(r"^[A-Za-z0-9]"), ~value.rlike("[A-Za-z]"))
    elif kind == "ip":
        gazetteer = vote(value.rlike(r"^[1-9]|^[0-9A-Fa-f]{2,4}:"), value.rlike(r"^(?:0+|255)\."))
        form = vote(~value.rlike(r"(?:^|\.)0[0-9]"), value.rlike(r"(?:^|\.)0[0-9]"))
    elif kind == "card":
        gazetteer = vote(value.rlike("^[3-6]"), ~value.rlike("^[3-6]"))
        form = vote(_luhn(value), ~_luhn(value))
    else:
        gazetteer = vote(
            value.rlike(rf"^\+(?:{_one_of(COUNTRY_CODES)})") | value.rlike(r"^\([0-9]{3}\)|^0[1-9]"), F.lit(False)
        )
        date = r"^(?:(?:19|20)[0-9]{2}[ ./-][0-9]{1,2}[ ./-][0-9]{1,2}|[0-9]{1,2}[ ./-][0-9]{1,2}[ ./-](?:19|20)[0-9]{2})"
        form = vote(n.between(9, 13), value.rlike(date) | ~n.between(8, 15))
    return [F.lit(1 if strict else 0), gazetteer, context, form, neighbours]


def _key(kind: str, span: Column, strict: bool) -> Column:
    """The span's features as one string: kind, votes, length class."""
    size = F.least(F.floor((span["end"] - span["start"]) / 8), F.lit(3))
    votes = [v.cast("string") for v in _votes(kind, span, strict)]
    return F.concat_ws(" ", F.lit(kind), *votes, size.cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Add base_<kind> and more_<kind> to `docs` (row, text): arrays of (start, end, key).

    The looser spans are those that overlap no base span of any kind.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    valid = lambda kind: lambda s: _valid(kind, s["value"])
    docs = docs.withColumn("_any", body.rlike(SIGN))
    docs = docs.withColumns({f"base_{k}": F.filter(_spans(body, STRICT[k], SHORTEST[k]), valid(k)) for k in KINDS})
    places = [F.transform(f"base_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS]
    # Base spans in order, in chunks: a looser span looks into the chunks it reaches into only.
    ranges = lambda chunks: F.transform(
        chunks,
        lambda c: F.struct(
            F.get(c, F.lit(0))["start"].alias("start"),
            F.array_max(F.transform(c, lambda b: b["end"])).alias("end"),
            c.alias("spans"),
        ),
    )
    docs = docs.withColumn("_base", _let(_let(F.array_sort(F.concat(*places)), _chunked), ranges))
    meets = lambda b, s: (b["start"] < s["end"]) & (s["start"] < b["end"])
    apart = lambda s: ~F.exists(
        "_base", lambda c: meets(c, s) & F.exists(c["spans"], lambda b: meets(b, s))
    )
    docs = docs.withColumns({f"more_{k}": F.filter(_spans(body, LOOSE[k], 7), apart) for k in KINDS})
    add = lambda kind, strict: lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), _key(kind, s, strict).alias("key")
    )
    return docs.withColumns(
        {f"{w}_{k}": F.transform(f"{w}_{k}", add(k, w == "base")) for w in ("base", "more") for k in KINDS}
    )


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Posterior that a candidate with these votes is personal data, by EM over vote counts.

    Two classes; given the class the voters are independent and a vote is -1, 0 or 1 with
    probabilities of its own. It starts from the majority of the votes.
    """
    posterior = {v: 1 / (1 + math.exp(-sum(v))) for v in counts}
    for _ in range(rounds):
        mass = {y: 2.0 for y in (0, 1)}
        table = {y: [{-1: 1.0, 0: 1.0, 1: 1.0} for _ in VOTERS] for y in (0, 1)}
        for votes, n in counts.items():
            for y in (0, 1):
                share = n * (posterior[votes] if y else 1 - posterior[votes])
                mass[y] += share
                for i, vote in enumerate(votes):
                    table[y][i][vote] += share
        for votes in counts:
            score = math.log(mass[1] / mass[0])
            for i, vote in enumerate(votes):
                good, bad = table[1][i], table[0][i]
                score += math.log(good[vote] / sum(good.values()) * sum(bad.values()) / bad[vote])
            posterior[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
    return posterior


def fit_classifier(
    rows: list[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS
) -> Callable[[tuple[int, ...], int], float]:
    """Logistic regression of the posteriors on votes and length class; rows hold their counts."""
    votes = {}
    for v, _, n in rows:
        votes[v] = votes.get(v, 0) + n
    posterior = reliabilities(votes, rounds)

    def features(v: tuple[int, ...], size: int) -> list[int]:
        return [0, *[1 + 2 * i + (x > 0) for i, x in enumerate(v) if x], 1 + 2 * len(VOTERS) + size]

    weight = [0.0] * (5 + 2 * len(VOTERS))
    everything = sum(votes.values())
    for _ in range(20 * rounds):
        slope = [0.001 * w for w in weight]
        for v, size, n in rows:
            on = features(v, size)
            error = 1 / (1 + math.exp(-sum(weight[f] for f in on))) - posterior[v]
            for f in on:
                slope[f] += error * n / everything
        weight = [w - s for w, s in zip(weight, slope)]
    return lambda v, size: 1 / (1 + math.exp(-sum(weight[f] for f in features(v, size))))


def train(docs: DataFrame) -> dict[str, float]:
    """Score of every feature key that occurs in the texts of `docs`, a bounded table."""
    spans = F.concat(*[f"{w}_{k}" for w in ("base", "more") for k in KINDS])
    found = (
        _keyed(docs.select("text"))
        .select(F.explode(F.transform(spans, lambda s: s["key"])).alias("key"))
        .groupBy("key")
        .count()
        .collect()  # at most 4 kinds * 3^5 votes * 4 length classes
    )
    parsed = {}
    for key, n in found:
        kind, *numbers = key.split(" ")
        *votes, size = map(int, numbers)
        parsed.setdefault(kind, []).append((key, tuple(votes), size, n))
    scores = {}
    for rows in parsed.values():
        rows.sort()
        classify = fit_classifier([(v, s, n) for _, v, s, n in rows])
        scores |= {key: classify(v, s) for key, v, s, _ in rows}
    return scores


def find(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Add base and spans to `docs`: arrays of (kind, start, end), by kind as listed, then start.

    `base` holds the strict spans, `spans` also what the classifier adds. A null text holds
    none. Nothing is shuffled; repeated rows and null ids are rows like others. Columns of
    these two names in `docs` give way.
    """
    good = [k for k, s in sorted(scores.items()) if s >= 0.5]
    kept = [c for c in docs.columns if c.lower() not in ("base", "spans")]
    keyed = _keyed(docs.select(F.struct(*[docs[c] for c in kept]).alias("row"), "text"))
    accepted = F.array(*[F.lit(k) for k in good]).cast("array<string>")
    named = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = {k: F.transform(f"base_{k}", named(k)) for k in KINDS}
    more = {
        k: F.transform(F.filter(f"more_{k}", lambda s: F.array_contains(accepted, s["key"])), named(k)) for k in KINDS
    }
    both = [F.array_sort(F.concat(base[k], more[k])) for k in KINDS]
    return keyed.select("row.*", F.concat(*base.values()).alias("base"), F.concat(*both).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; null stays null.

    Spans that overlap become one placeholder, named after the first of them.
    """
    by_start = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    length = F.length(text)
    # Pieces of the text, so that a part of it is found without a walk from its beginning.
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor(length / PIECE).cast("int")),
        lambda c: F.substring(text, c * PIECE + 1, F.lit(PIECE)),
    )

    def between(pieces: Column, start: Column, end: Column) -> Column:
        number = lambda at: F.floor(at / PIECE).cast("int")
        parts = F.transform(
            F.sequence(number(start), number(end)),
            lambda c: F.substring(
                F.get(pieces, c),
                F.greatest(start - c * PIECE, F.lit(0)) + 1,
                end - F.greatest(start, c * PIECE),
            ),
        )
        return F.array_join(parts, "")

    # Each span with the end of all before it; those that begin behind it are placeholders.
    reached = _running(
        by_start,
        lambda s: s["end"],
        lambda a, b: F.greatest(a, b),
        lambda s, at: F.struct(s["start"].alias("start"), at.alias("at"), s["kind"].alias("kind")),
    )
    heads = F.filter(reached, lambda s: s["start"] >= s["at"])
    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    whole = _let(
        pieces,
        lambda pieces: F.concat(
            F.array_join(
                F.transform(
                    heads,
                    lambda s: F.concat(between(pieces, s["at"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
                ),
                "",
            ),
            between(pieces, last, length),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(whole)
