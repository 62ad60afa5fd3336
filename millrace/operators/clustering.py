"""Clustering a table by several columns, so that filters on any of them skip most files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted, unused_name
from millrace.operators.lookup import _hashable

#: Bits of a column's rank among its quantiles.
BITS = 6
ACCURACY = 10_000


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number that keeps its order."""
    value = pick(df, name)
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    raise ValueError(f"column {name!r} of type {kind.simpleString()} cannot be clustered by")


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Where a row lies on a curve that winds through all columns at once.

    Each column is ranked among its quantiles, found by one approximate aggregate over the table,
    so that skewed columns are spread evenly too; the bits of the ranks are interleaved, the
    highest first. Nulls rank with the least values. Runs one Spark job.
    """
    if not columns or len(columns) * bits > 62:
        raise ValueError("cluster by at least one column, and by no more than 62 bits in all")
    steps = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(
        *[
            F.percentile_approx(_number(df, c), steps, ACCURACY).alias(f"q{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    position = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        bounds = F.array(*[F.lit(float(b)) for b in found[i] or []] or [F.lit(0.0)] * len(steps))
        value = _number(df, name)
        halves = F.array(*[F.lit(2**b) for b in reversed(range(bits))])
        rank = F.aggregate(halves, F.lit(0), _above(value, bounds))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long")
            position = position + F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i)
    return position


def _above(value: Column, bounds: Column):
    """A step of a search by halves for the number of bounds below a value."""
    return lambda rank, half: F.when(value > F.get(bounds, rank + half - 1), rank + half).otherwise(rank)


def cluster_by(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in about `files` partitions that each hold a small range of every column.

    Write the result without partition columns: each partition is a file whose footer bounds all
    the columns. Rows of one position on the curve, of which a hot value may have many, are
    spread over partitions by a hash of the row.
    """
    place, spread = unused_name(df, "_place"), unused_name(df, "_spread")
    placed = df.withColumns(
        {place: curve_position(df, columns, bits), spread: F.xxhash64(*_hashable(df), F.spark_partition_id())}
    )
    dealt = placed.repartitionByRange(files, quoted(place), quoted(spread))
    return dealt.sortWithinPartitions(quoted(place), *[quoted(c) for c in columns]).drop(place, spread)
