"""Enrichment: a left join to a lookup table that never changes the number of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted, unused_name
from millrace.operators.dedup import remove_duplicates, window_dedup


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """A table made unique for use as the lookup side of a join.

    Adaptive execution splits hot keys only where both sides are shuffled for the join
    itself. Deduplicating by a hash next to the key, which groups the same rows, keeps the
    join from reusing that shuffle: a large lookup is sent once more, and the other side,
    which is larger still, stays splittable.
    """
    spread = unused_name(df, "__spread")
    spread_out = df.withColumn(spread, F.xxhash64(*[quoted(k) for k in keys]))
    rows = [*keys, spread]
    if order_by:
        return window_dedup(spread_out, rows, order_by).drop(spread)
    return remove_duplicates(spread_out, rows).drop(spread)


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    columns: Sequence[str] | None = None,
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add `columns` of `lookup` (by default all but its key) to every row of `df`.

    `on` lists shared key names, or maps names in `df` to names in `lookup`. Where the
    lookup repeats a key, its newest row by `order_by` counts, or its smallest row without
    one; `unique` says the key is known to be unique and saves that step. Rows without a
    match, and rows with a null key, get nulls.

    No broadcast hint is given. Spark broadcasts the lookup when its size is below
    `spark.sql.autoBroadcastJoinThreshold`. A larger one takes a sort-merge join, in which
    adaptive execution cuts the hot keys of `df`, null among them, into several tasks.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    if not pairs:
        raise ValueError("enrich needs key columns")
    keys = list(pairs.values())
    added = [c for c in lookup.columns if c not in keys] if columns is None else list(columns)
    taken = {c.lower() for c in df.columns}
    clashes = [c for c in added if c.lower() in taken]
    if clashes:
        raise ValueError(f"columns {clashes} exist already")

    ranked = [order_by] if isinstance(order_by, str) else list(order_by or [])
    needed = list(dict.fromkeys([*keys, *added, *([] if unique else ranked)]))
    side = lookup.select(*[pick(lookup, c).alias(c) for c in needed])
    if not unique:
        side = one_per_key(side, keys, ranked)
    # Key columns get names of their own, so that a lookup may share names with `df`.
    names = {k: unused_name(df, f"__key_{i}") for i, k in enumerate(keys)}
    side = side.select(
        *[quoted(k).alias(n) for k, n in names.items()], *[quoted(c) for c in added]
    )
    condition = [pick(df, mine) == quoted(names[theirs]) for mine, theirs in pairs.items()]
    return df.join(side, condition, "left").drop(*names.values())


#: Keys of the sketch, hot keys reported at most, and parts a hot key is dealt over.
TRACKED, HOT, PARTS = 4096, 64, 32


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 1 / 128) -> list[int]:
    """Hashes of the keys that hold more than `share` of the rows, from a sketch of bounded size.

    The sketch follows `TRACKED` keys per task and errs by a few rows in as many; it costs one scan of
    the key columns. Null keys are hot keys like others. At most `HOT` are reported.
    """
    found = df.select(F.xxhash64(*[pick(df, k) for k in keys]).alias("h")).agg(
        F.expr(f"approx_top_k(h, {HOT}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    row = found.first()
    return sorted(t["item"] for t in row["top"] or [] if t["count"] > share * row["n"])


def enrich_hot(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    columns: Sequence[str] | None = None,
    order_by: str | Sequence[str] | None = None,
    unique: bool = False,
    share: float = 1 / 128,
    parts: int = PARTS,
) -> DataFrame:
    """`enrich`, with the rows of hot keys dealt over `parts` tasks by the join itself.

    It needs no setting of the cluster and holds where several lookups use one key in a row. Hot
    keys are found by `hot_keys`; their rows get one of `parts` numbers, all others 0, and their
    lookup rows, `HOT` at most, are copied for each number. Which rows go where affects
    no result: a key that the sketch misses is joined as any other.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    if not pairs:
        raise ValueError("enrich needs key columns")
    keys = list(pairs.values())
    added = [c for c in lookup.columns if c not in keys] if columns is None else list(columns)
    hot = hot_keys(df, list(pairs), share)
    if not hot:
        return enrich(df, lookup, on, added, order_by, unique)
    ranked = [order_by] if isinstance(order_by, str) else list(order_by or [])
    needed = list(dict.fromkeys([*keys, *added, *([] if unique else ranked)]))
    side = lookup.select(*[pick(lookup, c).alias(c) for c in needed])
    if not unique:
        side = one_per_key(side, keys, ranked)
    salt = unused_name(df, unused_name(lookup, "__salt"))
    # The same row gets the same number when a task is run again; equal rows of different tasks
    # need not share one.
    spread = F.pmod(F.xxhash64(*_hashable(df), F.spark_partition_id()), F.lit(parts)).cast("int")
    mine = F.xxhash64(*[pick(df, c) for c in pairs]).isin(hot)
    theirs = F.xxhash64(*[quoted(k) for k in keys]).isin(hot)
    copies = F.when(theirs, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    dealt = df.withColumn(salt, F.when(mine, spread).otherwise(F.lit(0)))
    side = side.withColumn(salt, F.explode(copies))
    return enrich(dealt, side, {**pairs, salt: salt}, added, unique=True).drop(salt)


def _hashable(df: DataFrame) -> list:
    return [
        F.to_json(F.struct(quoted(f.name))) if isinstance(f.dataType, (T.MapType, T.VariantType)) else quoted(f.name)
        for f in df.schema
    ]
