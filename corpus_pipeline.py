"""The training-data pipeline: five stages over `documents`, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of `documents`. Rows with nulls, blank texts, repeated rows and further columns pass through as
the operators of each stage define it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import minhash, mixing, packing, pii, toxicity
from millrace.llm.common import package_for_workers, table
from millrace.sources.tables import StagedTable


def whole(docs: DataFrame) -> Column:
    """The row as one column, out of the way of the names that operators add."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("doc")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, lets pass."""
    package_for_workers(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(whole(docs), "text"), model, keep=["doc"])
    return scored.where("score < 0.5").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; five words, similarity 0.8."""
    package_for_workers(spark)
    return minhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by the kind; n_chars is counted anew."""
    found = pii.find(docs.select(whole(docs), "text"), pii.train(docs))
    found = found.withColumn("clean", pii.redacted(F.col("text"), F.col("spans")))
    fresh = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        counted = F.length("clean").cast(docs.schema["n_chars"].dataType)
        fresh["n_chars"] = F.when(F.size("spans") > 0, counted).otherwise(F.col("doc.n_chars"))
    return found.select(*[fresh.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each whole and as often as the curriculum takes it.

    Those without a word have no part in the weights; each comes once, where it stands in its source.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    package_for_workers(spark)
    return packing.pack(docs, packing.byte_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("pii", redact),
    ("mixing", mix),
    ("packing", pack),
]
#: Hashing, tokenising and training cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result lies in the shared folder until the next one
    is written, the last one stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        after = StagedTable(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        docs, before = after.df, after
    return docs
