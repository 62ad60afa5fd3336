"""Profiles kept for every partition of a table and merged for the whole of it.

A partition's profile is one row: its number of rows and, per column, the nulls, the least and
greatest value and a sketch of the distinct values. All of these merge, so that a gate after an
append reads the partitions that were appended to and the profiles of the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted, sql_name, sql_text
from millrace.operators.quality import NULL_THRESHOLD, ROW_COUNT_MIN
from millrace.sources.tables import write_table

#: Bits of the sketch: its standard error is 1.04 / sqrt(2^BITS), 0.8 per cent.
BITS = 14
ROWS = "row_count"


def _sketched(kind: T.DataType) -> str:
    """How a value goes into the sketch, which takes whole numbers, texts and bytes."""
    return "{}" if isinstance(kind, (T.IntegerType, T.LongType, T.StringType)) else "CAST({} AS STRING)"


def partition_profiles(
    df: DataFrame, partition_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per partition: row_count and per column `<c>_nulls`, `_min`, `_max`, `_distinct`.

    One aggregate over the columns profiled, merged on the map side, so that a partition that
    holds most rows reaches its task as one row per task. Columns without an order are left out.
    """
    fields = {f.name: f.dataType for f in df.schema}
    names = [c for c in df.columns if c not in partition_by] if columns is None else list(columns)
    names = [c for c in names if isinstance(fields[c], T.AtomicType) and not isinstance(fields[c], T.VariantType)]
    found = [F.count(F.lit(1)).alias(ROWS)]
    for name in names:
        value = sql_name(name)
        found += [
            F.expr(f"count(1) - count({value})").alias(f"{name}_nulls"),
            F.expr(f"min({value})").alias(f"{name}_min"),
            F.expr(f"max({value})").alias(f"{name}_max"),
            F.expr(f"hll_sketch_agg({_sketched(fields[name]).format(value)}, {BITS})").alias(f"{name}_distinct"),
        ]
    return df.groupBy(*[pick(df, p).alias(p) for p in partition_by]).agg(*found)


def refresh_profiles(
    df: DataFrame, path: str, partition_by: Sequence[str], columns: Sequence[str] | None = None
) -> None:
    """Profile the partitions that `df` holds, whole, and replace their rows in the kept profiles.

    Pass the rows of the partitions that were written, or all rows for a first time.
    """
    write_table(partition_profiles(df, partition_by, columns), path, partition_by=partition_by)


def merged_profile(profiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column of the whole table, from the profiles of its partitions.

    column, row_count, null_count, min_value and max_value (as text) are exact; distinct_count
    is an estimate, by the standard error of `BITS`. No profiles give a row_count of 0.
    """
    whole = profiles.agg(
        F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS),
        *[F.coalesce(F.sum(quoted(f"{c}_nulls")), F.lit(0)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.min(quoted(f"{c}_min")).cast("string").alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.max(quoted(f"{c}_max")).cast("string").alias(f"g{i}") for i, c in enumerate(columns)],
        *[F.hll_union_agg(quoted(f"{c}_distinct")).alias(f"d{i}") for i, c in enumerate(columns)],
    )
    rows = ", ".join(
        f"named_struct('c', {sql_text(c)}, 'r', {ROWS}, 'n', n{i}, 'l', l{i}, 'g', g{i},"
        f" 'd', coalesce(hll_sketch_estimate(d{i}), 0L))"
        for i, c in enumerate(columns)
    )
    return whole.selectExpr(
        f"inline(array({rows})) AS (column, row_count, null_count, min_value, max_value, distinct_count)"
    )


def profile_gate(merged: DataFrame, checks: Mapping) -> DataFrame:
    """Gate lines of null rates and the row count, from a merged profile, as `quality_gate` has them."""
    threshold = float(checks.get("null_threshold", NULL_THRESHOLD))
    minimum = float(checks.get("row_count_min", ROW_COUNT_MIN))
    rate = F.try_divide("null_count", "row_count")

    def lines(df: DataFrame, check: str, subject, observed, limit: float, passed) -> DataFrame:
        return df.select(
            F.lit(check).alias("check"),
            subject.alias("subject"),
            observed.cast("double").alias("observed"),
            F.lit(limit).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    count = merged.agg(F.max("row_count").alias("row_count"))
    return lines(merged, "null_rate", F.col("column"), rate, threshold, rate <= threshold).unionByName(
        lines(count, "row_count", F.lit("rows"), F.col("row_count"), minimum, F.col("row_count") >= minimum)
    )


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
