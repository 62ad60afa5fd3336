"""Row-level reconciliation: which keys two tables disagree on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted

MISSING, ADDED, CHANGED = "missing", "added", "changed"
#: Hash buckets of the key that checksums are kept for, in each value of `within`.
BUCKETS = 1024


def _hashes(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a row. Nulls are told from absent values, maps are hashed by their JSON text."""
    values = []
    for column in columns:
        value = pick(df, column)
        kind = df.select(value).schema[0].dataType
        if isinstance(kind, (T.MapType, T.VariantType)):
            value = F.to_json(F.struct(value))
        values += [value, value.isNull()]
    one = F.xxhash64(*values).cast("decimal(20,0)")
    return one, F.xxhash64(F.lit("second"), *values).cast("decimal(20,0)")


def _side(df: DataFrame, key, columns, within, buckets, source: bool) -> DataFrame:
    one, two = _hashes(df, columns)
    sign = 1 if source else -1
    return df.select(
        *[pick(df, c).alias(c) for c in dict.fromkeys([*within, *key])],
        F.pmod(F.xxhash64(*[pick(df, k) for k in key]), F.lit(buckets)).cast("int").alias("_bucket"),
        F.lit(int(source)).cast("long").alias("_source"),
        F.lit(int(not source)).cast("long").alias("_target"),
        (one * sign).alias("_one"),
        (two * sign).alias("_two"),
    )


#: Sums whose order does not matter; both sides cancel out where they hold the same rows.
_SUMS = ["_source", "_target", "_one", "_two"]


def _differ() -> Column:
    return (F.col("_source") != F.col("_target")) | (F.col("_one") != 0) | (F.col("_two") != 0)


def bucket_checksums(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    within: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """The buckets of keys whose rows differ between two tables: `within` and `_bucket`.

    Both sides are read once; a task sends one row per bucket it meets.
    """
    columns = [c for c in source.columns if c not in key] if columns is None else list(columns)
    both = _side(source, key, columns, within, buckets, True).unionByName(
        _side(target, key, columns, within, buckets, False)
    )
    groups = [*[quoted(c) for c in within], "_bucket"]
    return both.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in _SUMS]).filter(_differ()).drop(*_SUMS)


def reconcile_rows(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    within: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys that are missing from the target, added to it or changed: key columns and `status`.

    First checksums per bucket of the key are compared, then keys, but only in buckets that differ.
    `within` names columns that both tables are partitioned by and that a key does not change:
    partitions without a difference are not read again, and a bucket is one of its partition. A
    key that occurs several times is changed where its rows, as a bag, are not the same. Null
    keys are keys, `columns` are by default all others of the source. Spark runs the first
    comparison when this is called: at most partitions times `buckets` rows come back.
    """
    if not key:
        raise ValueError("reconcile_rows needs key columns")
    columns = [c for c in source.columns if c not in key] if columns is None else list(columns)
    found = bucket_checksums(source, target, key, columns, within, buckets).collect()
    wanted = _wanted(found, within)
    sides = []
    for df, is_source in ((source, True), (target, False)):
        rows = df.filter(_partitions(found, within)) if within else df
        sides.append(_side(rows, key, columns, within, buckets, is_source).filter(wanted))
    totals = sides[0].unionByName(sides[1]).groupBy(*[quoted(k) for k in key]).agg(
        *[F.sum(c).alias(c) for c in _SUMS]
    )
    status = F.when(F.col("_target") == 0, MISSING).when(F.col("_source") == 0, ADDED).otherwise(CHANGED)
    return totals.filter(_differ()).select(*[quoted(k) for k in key], status.alias("status"))


def _partitions(found: list, within: Sequence[str]) -> Column:
    """Partitions with a difference, as a condition that prunes folders."""
    condition = F.lit(False)
    for values in sorted({tuple(r[c] for c in within) for r in found}, key=repr):
        same = F.lit(True)
        for column, value in zip(within, values):
            same = same & quoted(column).eqNullSafe(F.lit(value))
        condition = condition | same
    return condition


def _wanted(found: list, within: Sequence[str]) -> Column:
    """Rows of buckets with a difference."""
    by_partition: dict[tuple, list[int]] = {}
    for row in found:
        by_partition.setdefault(tuple(row[c] for c in within), []).append(row["_bucket"])
    condition = F.lit(False)
    for values, listed in sorted(by_partition.items(), key=repr):
        same = F.col("_bucket").isin(sorted(listed))
        for column, value in zip(within, values):
            same = same & quoted(column).eqNullSafe(F.lit(value))
        condition = condition | same
    return condition
