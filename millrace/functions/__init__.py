from millrace.functions.columns import (
    FALSE_WORDS,
    HASH_SEPARATOR,
    NAME_FILLER,
    NULL_WORDS,
    TRUE_WORDS,
    as_flag,
    blank_to_null,
    normalize_name,
    quoted,
    row_hash,
    sql_try_cast,
)

__all__ = [
    "FALSE_WORDS",
    "HASH_SEPARATOR",
    "NAME_FILLER",
    "NULL_WORDS",
    "TRUE_WORDS",
    "as_flag",
    "blank_to_null",
    "normalize_name",
    "quoted",
    "row_hash",
    "sql_try_cast",
]
