"""Deduplication with a reproducible survivor.

All keyed variants share one plan shape, "number the rows of a key, keep number one". Spark
turns it into a group limit before and after the shuffle, so every map task sends at most
one row per key: a key that holds a third of the table costs its reducer one row per map
task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import pick, quoted, row_hash, tie_breaks, unused_name

ROW_HASH = "_row_hash"


def _first_per_key(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    position = unused_name(df, "_position")
    numbered = df.withColumn(
        position, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return numbered.filter(quoted(position) == 1).drop(position)


def remove_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per distinct value of `subset`.

    With a subset the survivor is the smallest row by the remaining columns, so equal input
    gives equal output however it is partitioned. Nulls count as equal.
    """
    rest = tie_breaks(df, subset) if subset else []
    if not rest:
        return df.dropDuplicates()
    return _first_per_key(df, [pick(df, c) for c in subset], rest)


def window_dedup(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: str | Sequence[str],
    descending: bool = True,
    nulls: str | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest (or least) `order_by`.

    Nulls come last when descending and first when ascending unless `nulls` says "first" or
    "last". Rows that tie are told apart by all other columns.
    """
    if not partition_by or not order_by:
        raise ValueError("window_dedup needs key columns and an order")
    if nulls not in (None, "first", "last"):
        raise ValueError(f"nulls must be 'first' or 'last', not {nulls!r}")
    ranked = [order_by] if isinstance(order_by, str) else list(order_by)
    nulls_first = nulls == "first" if nulls else not descending
    direction = {
        (True, True): Column.desc_nulls_first,
        (True, False): Column.desc_nulls_last,
        (False, True): Column.asc_nulls_first,
        (False, False): Column.asc_nulls_last,
    }[descending, nulls_first]
    order = [direction(pick(df, c)) for c in ranked]
    order += tie_breaks(df, [*partition_by, *ranked])
    return _first_per_key(df, [pick(df, c) for c in partition_by], order)


def hash_dedup(df: DataFrame, subset: Sequence[str], safe: bool = False) -> DataFrame:
    """One row per MD5 of the given columns; the hash stays in the output as `_row_hash`.

    See `row_hash` for what the default hash takes as equal and for `safe`.
    """
    if not subset:
        raise ValueError("hash_dedup needs at least one column")
    hashed = df.withColumn(ROW_HASH, row_hash([pick(df, c) for c in subset], safe))
    return _first_per_key(hashed, [quoted(ROW_HASH)], tie_breaks(hashed, [ROW_HASH]))
