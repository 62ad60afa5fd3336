"""Data-quality checks as DataFrames.

Null rates and the row count of a table, however wide, come from one aggregate, uniqueness
from one group-by over the key columns, and a gate with both from one pass over the table.
All of them combine on the map side, so a hot key reaches its task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.columns import pick, quoted, sql_name, sql_text, sql_texts

# The thresholds used when a check block names none.
NULL_THRESHOLD = 0.05
ROW_COUNT_MIN = 0


def _null_counts(columns: Sequence[str]) -> str:
    return f"array({', '.join(f'count(1) - count({sql_name(c)})' for c in columns)})"


def profile_metrics(columns: Sequence[str]) -> list[Column]:
    """The row count and the null count of every column, for `agg` or `observe`."""
    return [
        F.expr("count(1)").alias("row_count"),
        F.expr(_null_counts(columns)).alias("null_counts"),
    ]


def profile(df: DataFrame) -> DataFrame:
    """`profile_metrics` of a table as one row."""
    return df.agg(*profile_metrics(df.columns))


def _keyed_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`profile` and the surplus rows of a key in one pass.

    The table is profiled per key, then summed. A table that is already partitioned by the
    key, as deduplication leaves it, is not shuffled again.
    """
    values = [F.expr(f"count({sql_name(c)}) AS v{i}") for i, c in enumerate(df.columns)]
    per_key = df.groupBy(*[pick(df, k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(
        F.expr("count(1) AS n"), *values
    )
    nulls = ", ".join(f"coalesce(sum(n) - sum(v{i}), 0)" for i in range(len(values)))
    return per_key.selectExpr(
        "coalesce(sum(n), 0) AS row_count",
        f"array({nulls}) AS null_counts",
        "coalesce(sum(n) - count(1), 0) AS duplicate_count",
    )


def null_rates(df: DataFrame, null_threshold: float = NULL_THRESHOLD) -> DataFrame:
    """Share of nulls per column; a rate equal to the threshold still passes.

    A table without rows has no rates, and every column fails.
    """
    per_column = profile(df).selectExpr(
        f"inline(arrays_zip({sql_texts(df.columns)}, null_counts)) AS (column, null_count)",
        "row_count",
    )
    rated = per_column.selectExpr(
        "column", "row_count", "null_count", "try_divide(null_count, row_count) AS null_rate"
    )
    passed = F.coalesce(F.col("null_rate") <= float(null_threshold), F.lit(False))
    return rated.withColumn("passed", passed)


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of one composite key; nulls count as values."""
    if not keys:
        raise ValueError("uniqueness needs key columns")
    per_key = df.groupBy(*[pick(df, k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )
    surplus = F.col("row_count") - F.col("distinct_count")
    return totals.select(
        F.lit(", ".join(keys)).alias("keys"),
        "row_count",
        "distinct_count",
        surplus.alias("duplicate_count"),
        (surplus == 0).alias("passed"),
    )


def row_count_check(df: DataFrame, row_count_min: int) -> DataFrame:
    """The row count against a minimum, which itself is enough."""
    count = F.col("row_count")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        count,
        F.lit(int(row_count_min)).cast("bigint").alias("row_count_min"),
        (count >= int(row_count_min)).alias("passed"),
    )


def _line(check: str, subject: str, observed: str, threshold: float | str, passed: str) -> str:
    """One line of a gate as SQL; a threshold that is a string is SQL itself."""
    limit = threshold if isinstance(threshold, str) else f"'{float(threshold)}'"
    return f"""named_struct(
        'check', '{check}',
        'subject', {subject},
        'observed', CAST({observed} AS DOUBLE),
        'threshold', CAST({limit} AS DOUBLE),
        'passed', {passed})"""


def gate_lines(
    df: DataFrame, checks: Mapping, profiled: DataFrame | None = None, one_pass: bool = True
) -> DataFrame:
    """See `quality_gate`. `profiled` is the `profile` row of `df` where it is already known."""
    threshold = float(checks.get("null_threshold", NULL_THRESHOLD))
    minimum = int(checks.get("row_count_min", ROW_COUNT_MIN))
    keys = list(checks.get("uniqueness_keys") or [])
    keyed = bool(keys) and profiled is None and one_pass
    if keyed:
        profiled = _keyed_profile(df, keys)
    elif profiled is None:
        profiled = profile(df)

    rate = "nulls / row_count"
    within = f"{rate} <= CAST('{threshold}' AS DOUBLE)"
    per_column = _line("null_rate", "name", rate, threshold, within)
    no_rows = _line("null_rate", "'*'", "NULL", threshold, "false")
    lines = [
        f"""IF(row_count > 0,
            zip_with({sql_texts(df.columns)}, null_counts, (name, nulls) -> {per_column}),
            array({no_rows}))"""
    ]
    if minimum > 0:
        enough = _line("row_count", "'*'", "row_count", minimum, f"row_count >= {minimum}")
        lines.append(f"array({enough})")
    unique = _line(
        "uniqueness", sql_text(", ".join(keys)), "duplicate_count", 0, "duplicate_count = 0"
    )
    if keyed:
        lines.append(f"array({unique})")
    result = profiled.selectExpr(f"inline(concat({', '.join(lines)}))")
    if keys and not keyed:
        result = result.unionByName(uniqueness(df, keys).selectExpr(f"inline(array({unique}))"))
    return result


def quality_gate(df: DataFrame, checks: Mapping, one_pass: bool = True) -> DataFrame:
    """Every configured check as a row (check, subject, observed, threshold, passed).

    `checks` may hold `null_threshold`, `uniqueness_keys` and `row_count_min`. Null rates
    are always checked; a table without rows fails them with one row. All checks are run,
    whether or not one fails.

    With uniqueness keys the table is read once, and a counter per column goes with each key
    through the shuffle. `one_pass=False` reads it twice, the second time the keys only, which
    suits stored tables of very many columns. The plan never depends on their number.
    """
    return gate_lines(df, checks, one_pass=one_pass)


def reconcile_lines(reconciled: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """The rows of `reconcile` as gate lines: rows and every total, per group, must agree."""
    group = ", ".join(f"coalesce(CAST({sql_name(g)} AS STRING), 'null')" for g in group_by)
    measures = [c.removeprefix("diff_") for c in reconciled.columns if c.startswith("diff_")]
    lines = [
        _line(
            "reconcile",
            f"concat_ws(', ', {sql_text(m)}{', ' + group if group else ''})",
            sql_name(f"target_{m}"),
            sql_name(f"source_{m}"),
            f"{sql_name(f'diff_{m}')} = 0",
        )
        for m in measures
    ]
    return reconciled.selectExpr(f"inline(array({', '.join(lines)}))")


def failures(lines: Iterable[Row]) -> list[str]:
    """Describe the checks that failed among the collected rows of a gate."""
    return [
        f"{r['check']} of {r['subject']}: {r['observed']} against {r['threshold']}"
        for r in lines
        if not r["passed"]
    ]


def failed_checks(gate: DataFrame) -> list[str]:
    """Run a gate, which has a row per column and two more at most, and list its failures."""
    return failures(gate.filter(~F.col("passed")).collect())


def reconcile(
    source: DataFrame,
    target: DataFrame,
    group_by: Sequence[str] = (),
    sums: Sequence[str] = (),
) -> DataFrame:
    """Row counts (and totals of `sums`) of two tables side by side, per group.

    The sides are stacked and grouped once, which needs a single shuffle of partial sums and
    matches null groups. Totals of doubles depend on the order of addition: cast to decimal
    first where exact equality matters.
    """

    def side(df: DataFrame, rows: str) -> DataFrame:
        measures = []
        for prefix in ("source", "target"):
            own = prefix == rows
            measures.append(F.lit(1 if own else 0).cast("bigint").alias(f"{prefix}_rows"))
            measures += [
                (pick(df, s) if own else F.lit(None).cast(df.schema[s].dataType)).alias(
                    f"{prefix}_{s}"
                )
                for s in sums
            ]
        return df.select(*[pick(df, g).alias(g) for g in group_by], *measures)

    stacked = side(source, "source").unionByName(side(target, "target"))
    names = [f"{p}_{m}" for p in ("source", "target") for m in ("rows", *sums)]
    totals = stacked.groupBy(*[quoted(g) for g in group_by]).agg(
        *[F.coalesce(F.sum(quoted(n)), F.lit(0)).alias(n) for n in names]
    )
    diffs = {m: quoted(f"source_{m}") - quoted(f"target_{m}") for m in ("rows", *sums)}
    matched = F.lit(True)
    for diff in diffs.values():
        matched = matched & (diff == 0)
    return totals.withColumns({f"diff_{m}": d for m, d in diffs.items()}).withColumn(
        "matched", matched
    )
