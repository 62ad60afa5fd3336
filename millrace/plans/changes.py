"""Change rows (insert, update, delete) applied to a kept, partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted
from millrace.operators.dedup import window_dedup
from millrace.plans.views import _only
from millrace.sources.tables import StagedTable, write_table

# What a change row does, and the columns a kept table has besides its own.
DELETE = "delete"
OPERATIONS = ("insert", "update", DELETE)
DELETED = "_deleted"
BUCKET = "_bucket"


def _placed(df: DataFrame, key: Sequence[str], buckets: int | None) -> DataFrame:
    if buckets is None:
        return df
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[quoted(k) for k in key]), F.lit(buckets)).cast("int"))


def apply_changes(
    changes: DataFrame,
    path: str,
    key: Sequence[str],
    sequence: str,
    operation: str = "operation",
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
    forget_before=None,
) -> list:
    """Merge change rows into the table at `path`; returns the partitions that were rewritten.

    Per key the row with the greatest `sequence` stays, whether it was in the table or is a change,
    so changes may come late, twice or out of order. A deletion stays as a tombstone (`_deleted`)
    that keeps older changes from bringing the key back; tombstones of rewritten partitions older
    than `forget_before` go. Of changes with one sequence the greatest by all columns counts, a
    deletion before others. Rows without a key, sequence or known operation are refused.

    Only partitions that hold a changed key are read and replaced. They are known from the change
    rows alone: either `partition_by` names columns that a key never changes, or `buckets` deals the
    keys over that many hash partitions, for tables whose keys have no such column. `buckets` is
    fixed for the life of a table. The table need not exist before the first changes.
    """
    if bool(partition_by) == (buckets is not None):
        raise ValueError("give either partition_by or buckets")
    parts = [BUCKET] if buckets is not None else list(partition_by)
    spark = changes.sparkSession
    known = F.lower(pick(changes, operation))
    unfit = pick(changes, sequence).isNull() | known.isNull() | ~known.isin(*OPERATIONS)
    for k in key:
        unfit = unfit | pick(changes, k).isNull()

    rows = changes.withColumn(DELETED, known == DELETE).withColumn("_unfit", unfit)
    order = [sequence, DELETED]
    newest = window_dedup(_placed(rows.drop(operation), key, buckets), [*key, "_unfit"], order)
    # Refused rows are seen in the pass that stages the changes, before anything is written.
    staged = StagedTable(newest, [F.count_if("_unfit").alias("unfit")])
    stages = [staged]
    try:
        if staged.metrics["unfit"]:
            raise ValueError("change rows lack a key, a sequence or a known operation")
        fresh = staged.df.drop("_unfit")
        touched = [tuple(r) for r in fresh.select(*[quoted(p) for p in parts]).distinct().collect()]
        if not touched:
            return []
        both = fresh
        if _exists(spark, path):
            kept = spark.read.schema(fresh.schema).parquet(path)
            # Equal sequences: the change is taken, which for a repeated run is the same row.
            both = kept.filter(_only(parts, touched)).withColumn("_fresh", F.lit(False))
            both = both.unionByName(fresh.withColumn("_fresh", F.lit(True)))
            both = window_dedup(both, key, [sequence, "_fresh"]).drop("_fresh")
        if forget_before is not None:
            both = both.filter(~(F.col(DELETED) & (quoted(sequence) < F.lit(forget_before))))
        merged = StagedTable(both, gather_by=parts)
        stages.append(merged)
        write_table(merged.df, path, partition_by=parts, rebalance=False, replace="partitions")
        return touched
    finally:
        for stage in stages:
            stage.drop()


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_kept(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of a kept table that are not deleted, without its own columns.

    Partition values are read as Spark guesses them from the folders' names unless `schema`
    says otherwise; it names `_deleted` too.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).filter(~F.col(DELETED)).drop(DELETED, BUCKET)
