"""Small helpers of the training-data operators: checkpoints, running totals, free names."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sources.tables import shared_folder

#: A word is a run of anything but these six ASCII blanks (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint(df: DataFrame) -> DataFrame:
    """The rows of `df`, computed once and kept in the folder of spark.checkpoint.dir.

    A lost executor then costs a read, not a recomputation, and every later job sees the
    same rows. Only a local session that names no folder (a test) gets one, in the warehouse; on a
    cluster one that not all executors share is refused.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def package_for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster where that folder is not shared, install the package or pass it as py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of_id(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id written as text; the folds of the classifiers are cut by it."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id)


def running_total(
    df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, into: str
) -> DataFrame:
    """Add `into`: the sum of `value` over the rows of the group that come before, exactly.

    Rows of a group are ordered by `bucket`, then by `order`; columns of `group` and `bucket`
    must not be null. A group may hold most of the table: it is cut into its buckets, whose
    sums (one row a bucket, merged on the map side) give each bucket its start, so that no
    task ever orders more than one bucket of one group.
    """
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *group, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        df.join(starts, [*group, bucket])
        .withColumn(into, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_start")
    )
