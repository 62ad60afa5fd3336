"""The curated layer: dimensions, facts, and aggregates kept as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from millrace.functions.columns import pick
from millrace.operators.lookup import enrich, one_per_key
from millrace.sources.tables import write_table


def dimension(
    df: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with its attributes: the newest by `order_by` where it is given."""
    ranked = [order_by] if isinstance(order_by, str) else list(order_by or [])
    names = list(dict.fromkeys([*key, *attributes, *ranked]))
    rows = df.select(*[pick(df, c).alias(c) for c in names])
    rows = one_per_key(rows, key, ranked)
    return rows.select(*[pick(rows, c).alias(c) for c in dict.fromkeys([*key, *attributes])])


@dataclass
class Link:
    """How a fact reaches a dimension: `on` maps its columns to the key of the dimension.

    `unique` says that the key is known to be unique, which saves making it so.
    """

    dimension: DataFrame
    on: Mapping[str, str]
    columns: Sequence[str] | None = None
    unique: bool = False


def fact_table(
    fact: DataFrame, links: Sequence[Link], columns: Sequence[str] | None = None
) -> DataFrame:
    """A fact joined to its dimensions, one row per row of `fact`.

    Links are followed in order, so a later one may use columns that an earlier one added.
    Facts without a match keep nulls. A chain of large dimensions is best joined from its
    far end: make a fact table of orders and customers first and link the sales lines to
    that, and the lines are shuffled once, not once per dimension.
    """
    for link in links:
        fact = enrich(fact, link.dimension, link.on, link.columns, unique=link.unique)
    return fact if columns is None else fact.select(*[pick(fact, c).alias(c) for c in columns])


def aggregate_view(
    df: DataFrame, group_by: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """The query behind a kept view: `measures` maps names to aggregates."""
    return df.groupBy(*[pick(df, g).alias(g) for g in group_by]).agg(
        *[expression.alias(name) for name, expression in measures.items()]
    )


def refresh_view(
    df: DataFrame,
    path: str,
    group_by: Sequence[str],
    measures: Mapping[str, Column],
    partition_by: Sequence[str] | None = None,
    replace: str = "table",
) -> None:
    """Recompute a kept view and replace it, so that groups gone from `df` go from it too.

    To refresh some partitions of a view partitioned by columns of `group_by`, pass all source
    rows of just those with `replace="partitions"`; the others stay.
    """
    stray = [c for c in partition_by or [] if c not in group_by]
    if stray:
        raise ValueError(f"a view is partitioned by grouping columns, {stray} are none")
    view = aggregate_view(df, group_by, measures)
    write_table(view, path, partition_by=partition_by, replace=replace)
