"""Column clean-up: narrow, shuffle-free projections and filters.

Each operator is one projection whatever the number of columns, so a wide table is analysed
once per operator and Catalyst fuses the chain into a single code-generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import (
    NULL_WORDS,
    as_flag,
    blank_to_null,
    normalize_name,
    pick,
    quoted,
    sql_name,
    string_columns,
)

# Calendar parts a partition column can hold.
CALENDAR_PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
}


def trim_whitespace(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip outer spaces (not tabs or line ends) from the given or from all string columns."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({c: F.expr(f"trim({sql_name(c)})") for c in names}) if names else df


def standardize_nulls(df: DataFrame, null_values: Sequence[str] | None = None) -> DataFrame:
    """Turn null-like words in string columns into nulls. A given list replaces the usual one."""
    words = list(null_values or NULL_WORDS)
    names = string_columns(df)
    return df.withColumns({c: blank_to_null(c, words) for c in names}) if names else df


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column by `normalize_name`; two columns may not end up with one name."""
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(normalize_name(name), []).append(name)
    clashes = {new: old for new, old in sources.items() if len(old) > 1}
    if clashes:
        raise ValueError(f"column names collide once normalized: {clashes}")
    return df.toDF(*sources)


def standardize_boolean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn yes/no words in the given columns into booleans; other values become null."""
    return df.withColumns({c: as_flag(quoted(c)) for c in columns}) if columns else df


def drop_empty_rows(df: DataFrame, required_columns: Sequence[str]) -> DataFrame:
    """Keep rows in which at least one of the required columns has a value (NaN is one)."""
    if not required_columns:
        raise ValueError("drop_empty_rows needs at least one column")
    return df.filter(reduce(or_, [pick(df, c).isNotNull() for c in required_columns]))


def derive_partitions(
    df: DataFrame, column: str, parts: Sequence[str] | Mapping[str, str] = ("year", "month")
) -> DataFrame:
    """Add calendar columns taken from a date or timestamp, for use as partition columns.

    `parts` lists calendar parts, or maps new column names to parts.
    """
    wanted = dict(parts) if isinstance(parts, Mapping) else {p: p for p in parts}
    unknown = sorted(set(wanted.values()) - set(CALENDAR_PARTS))
    if unknown:
        raise ValueError(f"unknown calendar parts {unknown}; known: {sorted(CALENDAR_PARTS)}")
    taken = {c.lower() for c in df.columns}
    clashes = [name for name in wanted if name.lower() in taken]
    if clashes:
        raise ValueError(f"columns {clashes} exist already")
    value = pick(df, column)
    return df.withColumns({name: CALENDAR_PARTS[part](value) for name, part in wanted.items()})
