"""Declared schemas: drift of the columns, casting, and the check of the data itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import sql_name, sql_texts, sql_try_cast
from millrace.sources.tables import driver_rows

# The type names a declared schema may use. Any other name is read as a
# Spark type string such as decimal(12,2) or array<float>.
TYPE_NAMES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
}

DRIFT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("column", "kind", "expected", "actual")]
)

Fields = Sequence[Mapping] | Mapping


def _type_of(name: str) -> T.DataType:
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    try:
        return T.DataType.fromDDL(name)
    except ParseException as error:
        raise ValueError(f"unknown type {name!r} in declared schema") from error


def schema_from_spec(fields: Fields) -> T.StructType:
    """A declared schema, `[{name, type, nullable}]` or `{"fields": [...]}`, as a StructType."""
    listed = fields.get("fields", []) if isinstance(fields, Mapping) else fields
    return T.StructType(
        [T.StructField(f["name"], _type_of(f["type"]), f.get("nullable", True)) for f in listed]
    )


def _drift(df: DataFrame, declared: T.StructType) -> list[tuple]:
    """(column, kind, expected, actual) of every difference, in a fixed order."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {f.name: f.dataType.simpleString() for f in declared}
    lines = [(c, "missing", t, None) for c, t in expected.items() if c not in actual]
    lines += [(c, "new", None, t) for c, t in actual.items() if c not in expected]
    lines += [
        (c, "type", t, actual[c]) for c, t in expected.items() if actual.get(c, t) != t
    ]
    return lines


def schema_drift(df: DataFrame, fields: Fields) -> DataFrame:
    """Columns that are new, missing or of another type than declared; reads no data.

    Names are compared by letter case, types in full (precision and element types count);
    column order and nullability do not count.
    """
    return driver_rows(df.sparkSession, _drift(df, schema_from_spec(fields)), DRIFT_SCHEMA)


def _misfits(df: DataFrame, name: str, wanted: T.DataType) -> str:
    """How many values of a column cannot be cast to `wanted`, in SQL."""
    actual = df.schema[name].dataType
    if actual.simpleString() == wanted.simpleString():
        return "0L"
    cast = sql_try_cast(name, actual, wanted)
    try:
        df.selectExpr(cast).schema
    except AnalysisException:
        # Spark has no such cast at all, so no value survives it.
        return f"count({sql_name(name)})"
    return f"count({sql_name(name)}) - count({cast})"


def drift_report(df: DataFrame, fields: Fields) -> DataFrame:
    """`schema_drift` with the number of rows that each difference touches.

    For a missing column these are all rows, for a new one the rows with a value in it, and
    for another type the values that do not fit the declared one. One aggregate over the
    drifted columns only.
    """
    declared = schema_from_spec(fields)
    lines = _drift(df, declared)
    if not lines:
        return schema_drift(df, fields).withColumn("affected_rows", F.lit(0).cast("bigint"))
    counts = {
        "missing": lambda name: "count(1)",
        "new": lambda name: f"count({sql_name(name)})",
        "type": lambda name: _misfits(df, name, declared[name].dataType),
    }
    affected = ", ".join(counts[kind](name) for name, kind, _, _ in lines)
    described = ", ".join(sql_texts(part) for part in zip(*lines))
    return df.selectExpr(f"array({affected}) AS affected").selectExpr(
        f"""inline(arrays_zip({described}, affected))
        AS (column, kind, expected, actual, affected_rows)"""
    )


def cast_to_schema(df: DataFrame, fields: Fields) -> DataFrame:
    """Cast declared columns to their types; a value that does not fit becomes null.

    Columns that are not declared stay as they are, declared ones that are absent are left
    to the drift check. `contract_violations` counts the values lost.
    """
    have = {f.name: f.dataType for f in df.schema}
    casts = {
        f.name: F.expr(sql_try_cast(f.name, have[f.name], f.dataType))
        for f in schema_from_spec(fields)
        if f.name in have and have[f.name].simpleString() != f.dataType.simpleString()
    }
    return df.withColumns(casts) if casts else df


def contract_violations(df: DataFrame, fields: Fields) -> DataFrame:
    """Per declared column: nulls where none are allowed, and values that do not fit the type.

    A declared column that is absent is null in every row. One aggregate for all columns.
    """
    declared = schema_from_spec(fields)
    if not declared.fields:
        raise ValueError("the declared schema has no fields")
    have = set(df.columns)

    def nulls(field: T.StructField) -> str:
        if field.nullable:
            return "0L"
        return f"count(1) - count({sql_name(field.name)})" if field.name in have else "count(1)"

    def misfits(field: T.StructField) -> str:
        return _misfits(df, field.name, field.dataType) if field.name in have else "0L"

    counted = df.selectExpr(
        "count(1) AS row_count",
        f"array({', '.join(map(nulls, declared))}) AS nulls",
        f"array({', '.join(map(misfits, declared))}) AS misfits",
    )
    described = ", ".join(
        [
            sql_texts(f.name for f in declared),
            sql_texts(f.dataType.simpleString() for f in declared),
            f"array({', '.join(str(f.nullable) for f in declared)})",
        ]
    )
    lines = counted.selectExpr(
        f"""inline(arrays_zip({described}, nulls, misfits))
        AS (column, expected, nullable, null_violations, cast_failures)""",
        "row_count",
    )
    return lines.selectExpr(
        "column",
        "expected",
        "nullable",
        "row_count",
        "null_violations",
        "cast_failures",
        "null_violations + cast_failures = 0 AS passed",
    )


def contract_gate(df: DataFrame, fields: Fields) -> DataFrame:
    """`contract_violations` as gate lines: per declared column, what it may not hold.

    A line per column for values that do not fit the type, and one for nulls where none are
    allowed; the threshold of both is 0.
    """
    line = """named_struct('check', '{0}', 'subject', column, 'observed', CAST({1} AS DOUBLE),
        'threshold', CAST(0 AS DOUBLE), 'passed', {1} = 0)"""
    casts = line.format("contract_cast", "cast_failures")
    nulls = line.format("contract_null", "null_violations")
    return contract_violations(df, fields).selectExpr(
        f"inline(IF(nullable, array({casts}), array({casts}, {nulls})))"
    )


def misfit_counts(df: DataFrame, fields: Fields) -> list[tuple[str, Column]]:
    """Per declared column that is there: its name and the aggregate counting what a cast loses."""
    have = set(df.columns)
    return [
        (f.name, F.expr(_misfits(df, f.name, f.dataType)))
        for f in schema_from_spec(fields)
        if f.name in have
    ]


def load_fields(spark, path: str) -> list[dict]:
    """A declared schema kept as a JSON file on any file system Spark can read."""
    rows = (
        spark.read.schema("fields array<struct<name string, type string, nullable boolean>>")
        .json(path, multiLine=True)
        .select(F.inline("fields"))
        .collect()
    )
    return [
        {"name": r["name"], "type": r["type"], "nullable": r["nullable"] is not False} for r in rows
    ]
