"""The queries of the training-data operators, each with its SQL where SQL can express it.

A query applies its operator to the whole of its table; its columns are derived from the
operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat,
    collocations,
    language,
    minhash,
    mixing,
    multiindex,
    packing,
    pii,
    prefixtrie,
    sharding,
    tokencount,
    topk,
    toxicity,
)
from millrace.llm.common import package_for_workers, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            package_for_workers(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            ORACLE[function.__name__] = sql
        return run

    return register


@query()
def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    """
    WITH v AS (
      SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_dot_product(q.e, c.e) AS BIGINT)) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
      GROUP BY q.vec_id, c.vec_id
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
      AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5
    """
)
def op2_no_random_access_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50)


@query()
def op3_min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=85)


@query()
def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.byte_bpe())


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
      FROM documents
    ), sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
    ), ranked AS (
      SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sources
    ), shaped AS (
      SELECT *, CASE rank % 3 WHEN 0 THEN 4.5::DOUBLE WHEN 1 THEN 0.5 ELSE 2 END AS w_start,
        CASE rank % 3 WHEN 2 THEN 2::DOUBLE ELSE 1.5 END AS w_end,
        CASE rank % 3 WHEN 0 THEN 3::DOUBLE WHEN 1 THEN 1 ELSE 2 END AS weight,
        2.0::DOUBLE * source_size AS stop, sum(source_size) OVER () * 1.5::DOUBLE AS wanted
      FROM ranked
    ), levels AS (
      SELECT *, (wanted - coalesce(sum(stop) OVER (ORDER BY stop / weight, rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(weight) OVER (ORDER BY stop / weight, rank
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM shaped
    ), goals AS (
      SELECT *, least(stop, weight * max(level) OVER ()) AS target FROM levels
    ), placed AS (
      SELECT d.doc_id, d.size, g.source_size, g.target, g.w_start, g.w_end,
        floor(g.target + 0.5) AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY g.rank ORDER BY d.key, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
    ), turns AS (
      SELECT *, greatest(0, least(size, budget - before)) AS first,
        greatest(0, least(size, budget - source_size - before)) AS second
      FROM placed
    ), shares AS (
      SELECT *, (before + first / 2) / greatest(budget, 1) AS share FROM turns
    )
    SELECT doc_id, size, source_size, target, CAST(first + second AS BIGINT) AS taken,
      CASE WHEN first = 0 OR first * 2 < size THEN NULL WHEN w_end = w_start THEN share
        ELSE (sqrt(w_start * w_start + (w_end - w_start) * (w_start + w_end) * share) - w_start)
          / (w_end - w_start) END AS position
    FROM shares
    """
)
def op5_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.curriculum(table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", "taken", F.col("position_0").alias("position")
    ).orderBy("position", "doc_id")


@query(
    """
    WITH ranked AS (
      SELECT conv_id, role, replace(coalesce(text, ''), '<|', '<||') AS body,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
          coalesce(text, '')) - 1 AS rank
      FROM conversations
    ), people AS (
      SELECT DISTINCT conv_id, role AS assistant FROM conversations WHERE role <> 'system'
    ), said AS (
      SELECT r.conv_id, p.assistant, r.rank // 64 AS part, r.rank,
        coalesce(r.role = p.assistant, false) AS own,
        CASE WHEN r.role = p.assistant THEN '<|assistant|>' || chr(10)
          WHEN r.role = 'system' THEN '<|system|>' || chr(10)
          ELSE '<|user:' || replace(coalesce(r.role, 'unknown'), '<|', '<||') || '|>' || chr(10) END AS head,
        r.body || '<|end|>' || chr(10) AS tail
      FROM ranked r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id
    ), placed AS (
      SELECT *, sum(length(head) + length(tail)) OVER (PARTITION BY conv_id, assistant, part
          ORDER BY rank) AS until FROM said
    )
    SELECT conv_id, assistant, part, CAST(count(*) AS INTEGER) AS n_turns,
      string_agg(head || tail, '' ORDER BY rank) AS text,
      coalesce(string_agg(CASE WHEN own THEN concat(until - length(tail), ':', until) END, ','
        ORDER BY rank), '') AS mask
    FROM placed GROUP BY conv_id, assistant, part
    """
)
def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.perspectives(table(spark, sf_dir, "conversations"))
    mask = F.transform(
        "mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))
    )
    return rendered.withColumn("mask", F.array_join(mask, ","))


@query()
def op7_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query()
def op8_bounded_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.bounded_ring(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op10_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)  # noqa: E731
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


@query(
    """
    WITH ids AS (
      SELECT conv_id AS c, conv_id - conv_id % 5 AS base,
        (list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
          lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
            lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)
        )) AS crc
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    ), heads AS (SELECT c, base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM ids
    ), t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
          md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
      FROM conversations
    ), rebuilt AS (
      SELECT c, 0 AS part, pos, role, text FROM heads JOIN t ON t.conv_id = base WHERE pos <= h
      UNION ALL SELECT c, 1, pos, role, text FROM heads JOIN t ON t.conv_id = c WHERE pos > h
    ), lists AS (
      SELECT heads.c, coalesce(list({'role': role, 'text': text} ORDER BY part, pos)
        FILTER (WHERE pos IS NOT NULL), []) AS turns
      FROM heads LEFT JOIN rebuilt ON heads.c = rebuilt.c GROUP BY heads.c
    ), members AS (
      SELECT c, d, turns[1:d] AS p, turns[1:d - 1] AS up, len(turns) = d AS ends
      FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM lists)
    ), nodes AS (
      SELECT d, p, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(p[d].text)) END AS own,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
      FROM members GROUP BY d, p
    ), childless AS (
      SELECT *, NOT EXISTS (SELECT 1 FROM nodes k WHERE k.d = n.d + 1 AND k.up = n.p) AS leaf FROM nodes n
    ), sums AS (
      SELECT d, p, sum(own) AS saved, count(*) FILTER (WHERE leaf) AS leaves
      FROM (SELECT lvl AS d, p[1:lvl] AS p, own, leaf
        FROM (SELECT p, own, leaf, unnest(range(d + 1)) AS lvl FROM childless))
      GROUP BY d, p
    )
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
      (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.up = n.p) AS n_children,
      s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.d = n.d AND s.p = n.p
    LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.up
    """
)
def op11_time_forward_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.ordered(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    heads = F.pmod(F.crc32(conv.cast("string")), F.lit(9))
    rebuilt = prefixtrie.with_shared_heads(turns, conv - conv % 5, heads, 8)
    return prefixtrie.prefix_trie(rebuilt, turns.select("conv_id").distinct())


@query()
def op12_two_tier_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k")
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query(
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?

]')) AS t
      FROM documents
    ), split AS (
      SELECT lang, list_filter(regexp_split_to_array(t, '[ 	]+'), lambda x: x <> '') AS ws FROM pieces
    ), grams AS (
      SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
        lambda s: array_to_string(ws[s:s + k - 1], ' '))) AS phrase
      FROM split, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k
    ), f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
    ), sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
    ), cand AS (
      SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30
    ), cuts AS (
      SELECT c.*, cut, array_to_string(ws[1:cut], ' ') AS pl, array_to_string(ws[cut + 1:], ' ') AS pr
      FROM cand c, (SELECT unnest([1, 2, 3]) AS cut) WHERE cut < k
    ), scored AS (
      SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
        CAST((2000000::HUGEINT * c.a) // (l.f + r.f) AS BIGINT) AS score
      FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.pl
      JOIN f r ON r.lang = c.lang AND r.phrase = c.pr
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
    ), around AS (
      SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS longer
      FROM cand, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS s)
      WHERE m < k AND s + m - 1 <= k GROUP BY ALL
    ), kept AS (
      SELECT s.* FROM scored s LEFT JOIN around x ON x.lang = s.lang AND x.phrase = s.phrase
      WHERE x.longer IS NULL OR 100 * x.longer < 80 * s.a
    )
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase) AS rank,
      k.phrase, a, l, r, n, score
    FROM kept k JOIN sizes z ON z.lang = k.lang QUALIFY rank <= 2000
    """
)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
