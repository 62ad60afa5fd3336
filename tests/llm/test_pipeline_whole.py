"""All five stages over a small planted corpus against plain Python: kept ids, texts, repeats, tokens."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations


import corpus_pipeline as pipeline
from millrace.llm.packing import byte_bpe

from test_mixing import reshared
from test_near_duplicates import closure, plain_set


def corpus():
    """Near copies, exact copies, addresses, blank texts and a hot source; no toxic label."""
    draw = random.Random(21)
    rows, word = [], lambda: f"w{draw.randrange(5000)}"
    for i in range(70):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", None])
        rows.append([i, " ".join(word() for _ in range(draw.randrange(8, 120))), "en", source])
    for i in range(6):
        words = rows[i * 4][1].split()
        words[len(words) // 2] = f"edit{i}"
        rows.append([100 + i, " ".join(words), "en", "a"])
        rows.append([200 + i, rows[i * 5][1].upper(), "en", "b"])
    for i in range(5):
        rows.append([300 + i, rows[i * 7 + 1][1] + f" write to someone{i}@example.com today", "en", "hot"])
    rows += [[400, None, "en", "a"], [401, "", None, "hot"], [402, " \n ", "en", None]]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def deduplicated(rows):
    sets = {i: plain_set(t, 5) for i, t, *_ in rows}
    links = [(i, j) for i, j in combinations(sorted(sets), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    first = closure(set(sets), links)
    return [r for r in rows if first[r[0]] == r[0]]


def repeats(rows):
    """How often the mix takes each document, from the rules of the curriculum alone."""
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size[r[0]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal = reshared(total, weights, 1.5 * sum(total.values()))
    out = Counter()
    for source in total:
        budget, before = int(goal[source] + 0.5), 0
        own = sorted((r for r in rows if r[3] == source), key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), size[r[0]]))
        for r in own:
            n = size[r[0]]
            if n == 0:
                out[r[0]] += 1
            for turn in range(2):
                due = max(0, min(n, budget - total[source] * turn - before))
                out[r[0]] += due > 0 and 2 * due >= n
            before += n
    return out


def test_all_stages_match_plain_python(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(i, 1, 0) for i, *_ in rows[::4]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), rows
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "minhash":
            kept = deduplicated(kept)
            assert len(kept) < len(rows)
        elif name == "pii":
            cleaned = [(i, (t or "").replace(f"someone{i - 300}@example.com", "[EMAIL]") if t is not None else None, *r) for i, t, *r in kept]
            kept = [(i, t, lang, s, len(t) if "[EMAIL]" in (t or "") else n) for i, t, lang, s, n in cleaned]
        if name in ("toxicity", "minhash", "pii"):
            assert Counter(map(tuple, out.collect())) == Counter(kept)
        elif name == "mixing":
            often = repeats(kept)
            by_id = {r[0]: r for r in kept}
            wanted = Counter({by_id[i]: n for i, n in often.items() if n})
            assert Counter(map(tuple, out.collect())) == wanted
        else:
            tokens = Counter()
            for p in out.collect():
                tokens[p.doc_id] += p.length
            encode = byte_bpe()
            assert tokens == Counter({i: often[i] * len(encode([by_id[i][1] or ""])[0]) for i in by_id if often[i]})
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")


def test_the_whole_run_keeps_one_folder(spark, tmp_path):
    import glob
    import os

    spark.createDataFrame(corpus()[:20], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(glob.glob(f"{shared}/staged-*"))
    assert pipeline.run(spark, str(tmp_path)).count() > 0
    assert len(set(glob.glob(f"{shared}/staged-*")) - before) == 1 and os.path.isdir(shared)
