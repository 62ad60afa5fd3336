"""Column expressions and naming rules that the operators share.

Everything here builds a Catalyst expression from built-in functions; nothing starts a
Python worker. What is built once per column is written as SQL text: a call on a `Column`
costs the driver a millisecond or two, which adds up on tables with a thousand columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words, pattern and separator that results depend on.
NULL_WORDS = ("N/A", "NA", "null", "NULL", "none", "None", "", "-")
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")
NAME_FILLER = "[^a-z0-9_]"
HASH_SEPARATOR = "||"


def sql_name(name: str) -> str:
    """The top-level column of exactly this name, dots and all, in SQL."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str | None) -> str:
    """A string literal in SQL."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_texts(values: Iterable[str | None]) -> str:
    """An array of string literals in SQL."""
    return f"array({', '.join(sql_text(v) for v in values)})"


def quoted(name: str) -> Column:
    """The top-level column of exactly this name, dots and all."""
    return F.col(sql_name(name))


def pick(df: DataFrame, name: str) -> Column:
    """A column by name; a dotted name that is not a column means a nested field."""
    if "." in name and name not in df.columns:
        return F.col(name)
    return quoted(name)


def unused_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of `df` has that name in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def normalize_name(name: str) -> str:
    """Lower case, outer blanks off, every other symbol one underscore."""
    return re.sub(NAME_FILLER, "_", name.lower().strip())


def blank_to_null(name: str, words: Sequence[str] = NULL_WORDS) -> Column:
    """A column's value unless it is one of `words`; letter case counts."""
    value = sql_name(name)
    listed = ", ".join(sql_text(w) for w in words)
    return F.expr(f"CASE WHEN {value} NOT IN ({listed}) THEN {value} END")


# Blanks and control characters, which casts ignore around a value.
_PAD = r"[\s\p{Cntrl}]*"
# What a text must look like for a cast to have a chance, per type it is cast to.
_CASTABLE = {
    T.IntegralType: rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    T.FractionalType: r"(?i)\p{Nd}|inf|nan",
    T.BooleanType: rf"(?i)^{_PAD}(t|true|y|yes|1|f|false|n|no|0){_PAD}$",
}


def sql_try_cast(name: str, actual: T.DataType, wanted: T.DataType) -> str:
    """`try_cast` of a column in SQL, with the same result.

    Spark finds most texts that are no number or boolean by catching an exception, at ten
    microseconds and more each. Texts that cannot succeed are told apart by a pattern
    first, so a column full of them casts at the speed of a clean one.
    """
    value = sql_name(name)
    cast = f"try_cast({value} AS {wanted.simpleString()})"
    if actual == T.StringType():
        for kind, pattern in _CASTABLE.items():
            if isinstance(wanted, kind):
                return f"CASE WHEN {value} RLIKE {sql_text(pattern)} THEN {cast} END"
    return cast


def as_flag(value: Column) -> Column:
    """A yes/no word in any letter case as a boolean, anything else as null."""
    word = F.lower(value.cast("string"))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def row_hash(values: Sequence[Column], safe: bool = False) -> Column:
    """MD5 over several columns.

    By default the columns are written as text, null as the empty text, and joined by the
    fixed separator, so null equals "" and a value may imitate the separator. `safe` hashes
    a JSON object instead, in which neither can happen.
    """
    if safe:
        fields = [v.alias(f"c{i}") for i, v in enumerate(values)]
        return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
    return F.md5(F.array_join(F.array(*[v.cast("string") for v in values]), HASH_SEPARATOR, ""))


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def tie_breaks(df: DataFrame, used: Iterable[str] = ()) -> list[Column]:
    """An ordering over every column not in `used`.

    Appended to a caller's order it makes the order total, so rows that still tie are equal
    and whichever survives gives the same output. Maps and variants have no order in Spark
    and are compared by their JSON text.
    """
    skip = set(used)
    keys = []
    for field in df.schema:
        if field.name in skip:
            continue
        value = sql_name(field.name)
        if not _orderable(field.dataType):
            value = f"to_json(struct({value}))"
        keys.append(F.asc_nulls_first(F.expr(value)))
    return keys
