"""Schemas that change over time: the narrowest schema that holds several, and reading into it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import sql_name, sql_text
from millrace.sources.tables import read_table

# Whole numbers from narrow to wide, with the digits each can have.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _WHOLE.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def wider(a: T.DataType, b: T.DataType, at: str = "value") -> T.DataType:
    """The narrowest type that the values of both are cast to.

    Whole numbers widen among each other, with decimals to a decimal that holds the digits of both
    on either side of the point, with floating numbers to double (which rounds whole numbers above
    2^53). A date and a time give the time. Structs take the fields of both by name, arrays and
    maps widen inside. Simple types without a common one become strings; a simple type and a
    nested one, or two nested ones of another kind, have none and are refused.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema([a, b], at)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, f"{at}.element"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key = wider(a.keyType, b.keyType, f"{at}.key")
        return T.MapType(key, wider(a.valueType, b.valueType, f"{at}.value"), True)
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    if isinstance(a, nested) or isinstance(b, nested):
        raise ValueError(f"{at}: {a.simpleString()} and {b.simpleString()} have no common type")
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda k: _WHOLE[type(k)])
    floating = {T.FloatType, T.DoubleType}
    if kinds & floating and all(type(k) in floating or _as_decimal(k) for k in (a, b)):
        return T.DoubleType()
    one, two = _as_decimal(a), _as_decimal(b)
    if one and two:
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if T.DateType in kinds:
        other = b if isinstance(a, T.DateType) else a
        if isinstance(other, (T.TimestampType, T.TimestampNTZType)):
            return other
    return T.StringType()


def merged_schema(schemas: Iterable[T.StructType], at: str = "") -> T.StructType:
    """The fields of all schemas by exact name, first come first, with the wider of their types.

    A field that some schema lacks, or that may be null in one, may be null.
    """

    def two(a: T.StructType, b: T.StructType) -> T.StructType:
        theirs = {f.name: f for f in b}
        fields = []
        for f in a:
            g = theirs.get(f.name)
            name = f"{at}.{f.name}" if at else f.name
            kind = wider(f.dataType, g.dataType, name) if g else f.dataType
            fields.append(T.StructField(f.name, kind, not g or f.nullable or g.nullable))
        mine = {f.name for f in a}
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b if f.name not in mine])

    return reduce(two, schemas)


def _into(value: str, actual: T.DataType, wanted: T.DataType, depth: int = 0) -> str:
    """A value of one type as the wider one, in SQL."""
    if actual == wanted:
        return value
    x = f"x{depth}"
    if isinstance(wanted, T.StructType) and isinstance(actual, T.StructType):
        have = {f.name: f.dataType for f in actual}
        fields = [
            f"{sql_text(f.name)}, "
            + (
                _into(f"{value}.{sql_name(f.name)}", have[f.name], f.dataType, depth + 1)
                if f.name in have
                else f"CAST(NULL AS {f.dataType.simpleString()})"
            )
            for f in wanted
        ]
        return f"IF({value} IS NULL, NULL, named_struct({', '.join(fields)}))"
    if isinstance(wanted, T.ArrayType) and isinstance(actual, T.ArrayType):
        inner = _into(x, actual.elementType, wanted.elementType, depth + 1)
        return f"transform({value}, {x} -> {inner})"
    if isinstance(wanted, T.MapType) and isinstance(actual, T.MapType):
        key = _into(f"{x}.key", actual.keyType, wanted.keyType, depth + 1)
        held = _into(f"{x}.value", actual.valueType, wanted.valueType, depth + 1)
        return f"map_from_entries(transform(map_entries({value}), {x} -> struct({key}, {held})))"
    return f"CAST({value} AS {wanted.simpleString()})"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of `df` in a schema that `merged_schema` gave for it: casts, and nulls for new fields."""
    have = {f.name: f.dataType for f in df.schema}
    columns = []
    for f in schema:
        if f.name in have:
            columns.append(F.expr(_into(sql_name(f.name), have[f.name], f.dataType)).alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def read_generations(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Datasets (or files) of several schemas as one table, every value in the merged type.

    Each path is one generation with a schema of its own; for Parquet that is a footer each, and
    no data. Filters and column selection reach the scan of every generation.
    """
    if not paths:
        raise ValueError("read_generations needs a path")
    frames = [read_table(spark, p, fmt) for p in paths]
    schema = merged_schema(df.schema for df in frames)
    return reduce(DataFrame.unionByName, [conform(df, schema) for df in frames])
