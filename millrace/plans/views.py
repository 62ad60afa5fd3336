"""Kept views that follow their source by deltas instead of being recomputed.

A view is kept as mergeable state: per group the number of rows and, per measure, a sum, a count
or an extreme. A run hands in the rows it added and the rows it took back (a replaced row is both);
only the partitions of the view that hold their groups are read and written again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted, sql_name
from millrace.sources.tables import StagedTable, write_table

# What a measure may be.
KINDS = ("count", "sum", "avg", "min", "max")
ROWS = "_rows"
APPLIED = "_applied"
#: Folders are named by copies of the grouping columns, which themselves stay in the files with
#: their types: a value such as "007" would come back from a folder's name as a number.
COPY = "__part"


def _checked(group_by, measures, partition_by) -> list[tuple[str, str, str | None]]:
    """The measures as (name, kind, column)."""
    listed = []
    for name, rule in measures.items():
        kind, column = (rule, None) if isinstance(rule, str) else (rule[0], rule[1])
        if kind not in KINDS or (column is None and kind != "count"):
            raise ValueError(f"measure {name!r} must be 'count' or (kind, column), kind of {KINDS}")
        listed.append((name, kind, column))
    stray = [c for c in partition_by if c not in group_by]
    if stray:
        raise ValueError(f"a view is partitioned by grouping columns, {stray} are none")
    return listed


def _state(df: DataFrame, group_by: Sequence[str], listed: list, sign: int) -> DataFrame:
    """Each row as the state of a group of one row; rows taken back count negative.

    Extremes of added and of removed rows are kept apart, since only the first can be merged.
    """
    for _, kind, column in listed:
        if kind in ("sum", "avg"):
            wanted = df.select(pick(df, column)).schema[0].dataType
            if isinstance(wanted, (T.FloatType, T.DoubleType)):
                raise ValueError(f"sums of {column!r} cannot be taken back exactly; cast it to a decimal")
    columns = [pick(df, g).alias(g) for g in group_by]
    columns.append(F.lit(sign).cast("long").alias(ROWS))
    for name, kind, column in listed:
        value = pick(df, column) if column else F.lit(1)
        columns.append(F.when(value.isNotNull(), F.lit(sign)).otherwise(0).cast("long").alias(f"{name}_n"))
        if kind in ("sum", "avg"):
            columns.append(F.coalesce(value * sign, value * 0, F.lit(0)).alias(f"{name}_sum"))
        elif kind != "count":
            none = F.lit(None).cast(df.select(value).schema[0].dataType)
            columns.append((value if sign > 0 else none).alias(f"{name}_{kind}"))
            columns.append((none if sign > 0 else value).alias(f"{name}_gone"))
    return df.select(*columns)


def _merged(rows: DataFrame, group_by: Sequence[str], listed: list) -> DataFrame:
    """States of the same group as one; `name_gone` holds the extreme value taken back."""
    aggregates = [F.sum(ROWS).alias(ROWS)]
    for name, kind, _ in listed:
        aggregates.append(F.sum(f"{name}_n").alias(f"{name}_n"))
        if kind in ("sum", "avg"):
            aggregates.append(F.sum(f"{name}_sum").alias(f"{name}_sum"))
        elif kind != "count":
            best = F.min if kind == "min" else F.max
            aggregates += [best(f"{name}_{e}").alias(f"{name}_{e}") for e in (kind, "gone")]
    return rows.groupBy(*[quoted(g) for g in group_by]).agg(*aggregates)


def _lost(listed: list) -> Column:
    """Whether a row that was taken back may have held an extreme that is still reported."""
    found = F.lit(False)
    for name, kind, _ in listed:
        if kind in ("min", "max"):
            best, gone = F.col(f"{name}_{kind}"), F.col(f"{name}_gone")
            reached = gone <= best if kind == "min" else gone >= best
            found = found | (F.col(f"{name}_n") > 0) & gone.isNotNull() & reached
    return found


def _stored(
    state: DataFrame, listed: list, sums: Mapping[str, T.DataType], run_id: str, partition_by: Sequence[str]
) -> DataFrame:
    state = state.drop(*[f"{n}_gone" for n, kind, _ in listed if kind in ("min", "max")])
    # A sum widens a decimal each time it is taken; what is stored keeps one type.
    state = state.withColumns({c: quoted(c).cast(t) for c, t in sums.items()})
    state = state.withColumn(APPLIED, F.lit(run_id))
    return state.withColumns({c + COPY: quoted(c) for c in partition_by})


def _sum_types(empty: DataFrame, group_by, listed) -> dict[str, T.DataType]:
    merged = _merged(empty, group_by, listed).schema
    return {f"{n}_sum": merged[f"{n}_sum"].dataType for n, kind, _ in listed if kind in ("sum", "avg")}


def create_view(
    df: DataFrame,
    path: str,
    group_by: Sequence[str],
    measures: Mapping[str, str | tuple[str, str]],
    partition_by: Sequence[str] = (),
    run_id: str = "created",
) -> None:
    """Compute the state of a view from all rows and write it, replacing what is there.

    `measures` maps names to "count" or (kind, column), kind one of count, sum, avg, min, max. Nulls
    are left out of measures and are groups of their own. Sums need whole numbers or decimals.
    """
    listed = _checked(group_by, measures, partition_by)
    rows = _state(df, group_by, listed, 1)
    sums = _sum_types(rows, group_by, listed)
    state = _stored(_merged(rows, group_by, listed), listed, sums, run_id, partition_by)
    write_table(state, path, partition_by=[c + COPY for c in partition_by], replace="table")


def _only(partition_by: Sequence[str], touched: list) -> Column:
    """The rows of some partitions, as a condition that prunes folders."""
    values = sorted({tuple(row) for row in touched}, key=repr)
    if len(partition_by) == 1 and not any(v is None for (v,) in values):
        return quoted(partition_by[0]).isin([v for (v,) in values])
    found = F.lit(False)
    for row in values:
        same = F.lit(True)
        for column, value in zip(partition_by, row):
            same = same & quoted(column).eqNullSafe(F.lit(value))
        found = found | same
    return found


def apply_delta(
    path: str,
    group_by: Sequence[str],
    measures: Mapping[str, str | tuple[str, str]],
    added: DataFrame,
    removed: DataFrame | None = None,
    partition_by: Sequence[str] = (),
    source: DataFrame | None = None,
    run_id: str | None = None,
) -> list:
    """Bring a view up to date with the rows a run added and took back; returns touched partitions.

    Only partitions that hold a group of those rows are read and replaced. A smallest or greatest
    value that is taken back is found anew from `source`, the table after the change, for just the
    groups concerned; it is needed where such measures and removed rows meet. A run that died
    while it wrote may be repeated under its `run_id` until another one is applied: partitions it
    has reached are left alone. Groups without rows stay as state and are not shown by `read_view`.
    A null partition value is a partition, a delta without rows changes nothing.
    """
    listed = _checked(group_by, measures, partition_by)
    spark = added.sparkSession
    extremes = any(kind in ("min", "max") for _, kind, _ in listed)
    if removed is not None and extremes and source is None:
        raise ValueError("taking rows back from a view with min or max needs the source")
    rows = _state(added, group_by, listed, 1)
    sums = _sum_types(rows, group_by, listed)
    if removed is not None:
        rows = rows.unionByName(_state(removed, group_by, listed, -1))
    # The change is merged once, since its groups are needed more than once: few, and small.
    change = StagedTable(_merged(rows, group_by, listed))
    stages = [change]
    try:
        parts = [quoted(c) for c in partition_by]
        touched = [tuple(r) for r in change.df.select(*parts).distinct().collect()] if parts else []
        if parts and not touched or not parts and change.df.isEmpty():
            return []
        fields = _stored(_merged(change.df, group_by, listed), listed, sums, "", partition_by).schema
        kept, fresh = spark.read.schema(fields).parquet(path), change.df
        copies = [c + COPY for c in partition_by]
        if parts:
            kept = kept.filter(_only(copies, touched))
        if run_id is not None:
            done = kept.filter(F.col(APPLIED) == run_id)
            if parts:
                reached = {tuple(r) for r in done.select(*parts).distinct().collect()}
                left = [t for t in touched if t not in reached]
                if not left:
                    return []
                kept, fresh = kept.filter(_only(copies, left)), fresh.filter(_only(partition_by, left))
                touched = left
            elif not done.isEmpty():
                return []
        state = _merged(kept.drop(APPLIED, *copies).unionByName(fresh, True), group_by, listed)
        if removed is not None and extremes:
            merged = StagedTable(state)
            stages.append(merged)
            state = _repaired(merged.df, source, group_by, listed)
        out = StagedTable(_stored(state, listed, sums, run_id or "delta", partition_by), gather_by=copies)
        stages.append(out)
        write_table(
            out.df,
            path,
            partition_by=copies,
            rebalance=False,
            replace="partitions" if parts else "table",
        )
        return touched
    finally:
        for stage in stages:
            stage.drop()


def _repaired(state: DataFrame, source: DataFrame, group_by: Sequence[str], listed: list) -> DataFrame:
    """The state with extremes that may have gone computed anew from the rows of those groups."""
    lost = _lost(listed)
    groups = state.filter(lost).select(*[quoted(g).alias(f"_g{i}") for i, g in enumerate(group_by)])
    same = [quoted(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group_by)]
    rows = _state(source, group_by, listed, 1).join(groups, same, "left_semi")
    return state.filter(~F.coalesce(lost, F.lit(False))).unionByName(_merged(rows, group_by, listed))


def read_view(
    spark: SparkSession,
    path: str,
    group_by: Sequence[str],
    measures: Mapping[str, str | tuple[str, str]],
) -> DataFrame:
    """The groups of a kept view that have rows, with their measures."""
    listed = _checked(group_by, measures, ())
    state = spark.read.parquet(path).filter(F.col(ROWS) > 0)
    shown = [quoted(g) for g in group_by]
    for name, kind, _ in listed:
        n = f"{sql_name(name + '_n')}"
        if kind == "count":
            of = n
        elif kind == "sum":
            of = f"CASE WHEN {n} > 0 THEN {sql_name(name + '_sum')} END"
        elif kind == "avg":
            of = f"CASE WHEN {n} > 0 THEN CAST({sql_name(name + '_sum')} AS DOUBLE) / {n} END"
        else:
            of = f"CASE WHEN {n} > 0 THEN {sql_name(name + '_' + kind)} END"
        shown.append(F.expr(of).alias(name))
    return state.select(*shown)
