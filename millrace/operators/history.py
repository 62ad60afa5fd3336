"""History of a dimension: version intervals, and joins as of a time.

A key may hold a third of all rows. So the time line is cut into buckets, rows are sorted inside
(key, bucket) only, and what one bucket hands to the next travels as one row per key and bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick, quoted, unused_name

DAY = 86_400


def _bucket(df: DataFrame, time: Column, width: float) -> Column:
    """The number of the time bucket; `width` in seconds, or in the unit of a number."""
    kind = df.select(time).schema[0].dataType
    if isinstance(kind, T.NumericType):
        return F.floor(time / width).cast("long")
    return F.floor(F.unix_seconds(time.cast("timestamp")) / width).cast("long")


def _beside(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: Column, into: str, ahead: bool
) -> DataFrame:
    """Add the value of the row before (or after) a row of its key, over the borders of buckets.

    `value` must not be null; the new column is null at the first (or last) row of a key.
    """
    edge, rim = F.struct(*[quoted(c) for c in order]), unused_name(df, "_rim")
    inside = Window.partitionBy(*[quoted(c) for c in [*keys, bucket]]).orderBy(*[quoted(c) for c in order])
    over = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(quoted(bucket))
    # Looking back a bucket hands on its last row, looking ahead its first.
    outermost = F.min_by(value, edge) if ahead else F.max_by(value, edge)
    rims = df.groupBy(*[quoted(c) for c in [*keys, bucket]]).agg(outermost.alias(rim))
    rims = rims.withColumn(rim, (F.lead(rim) if ahead else F.lag(rim)).over(over))
    near = (F.lead(value) if ahead else F.lag(value)).over(inside)
    joined = df.withColumn(into, near).join(rims, [*keys, bucket])
    return joined.withColumn(into, F.coalesce(quoted(into), quoted(rim))).drop(rim)


def version_history(
    changes: DataFrame,
    key: Sequence[str],
    time: str,
    attributes: Sequence[str],
    bucket: float = DAY * 32,
) -> DataFrame:
    """Versions of each key: its attributes with valid_from and valid_to (exclusive, null: still).

    `changes` says what the attributes are from a time on. Rows that change nothing make no
    version; of several at one time the greatest by the attributes counts. Rows without a key or
    time make none. Columns besides those named are left out; an empty table gives no rows.
    """
    clashes = {"valid_from", "valid_to"} & {*key, *attributes}
    if clashes:
        raise ValueError(f"columns {sorted(clashes)} exist already")
    rows = changes.select(
        *[pick(changes, c).alias(c) for c in [*key, *attributes]], pick(changes, time).alias("valid_from")
    ).dropna(subset=[*key, "valid_from"])
    state = F.struct(*[quoted(a) for a in attributes])
    rows = rows.groupBy(*[quoted(k) for k in key], "valid_from").agg(F.max(state).alias("_now"))
    rows = rows.withColumn("_bucket", _bucket(rows, F.col("valid_from"), bucket))
    seen = _beside(rows, key, "_bucket", ["valid_from"], F.struct("_now"), "_before", ahead=False)
    new = seen.filter(F.col("_before").isNull() | ~F.col("_before._now").eqNullSafe(F.col("_now")))
    new = new.drop("_before")
    versions = _beside(new, key, "_bucket", ["valid_from"], F.col("valid_from"), "valid_to", ahead=True)
    return versions.select(*[quoted(k) for k in key], "_now.*", "valid_from", "valid_to")


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    time: str,
    version_time: str = "valid_from",
    until: str | None = None,
    columns: Sequence[str] | None = None,
    bucket: float = DAY * 32,
) -> DataFrame:
    """Every fact with the version of its key that held at its time, one row per fact.

    That is the version with the greatest `version_time` not after `time`, unless its `until` has
    come by then. Facts before the first version, and facts without a key or time, get nulls. Of
    versions at one time the greatest by all columns counts. `bucket` is the width of a time bucket
    in seconds (or the unit of a number): what one key has inside one is sorted by one task.

    Facts and versions are stacked and sorted by time inside (key, bucket), where each fact takes
    the last version before it; the last version of earlier buckets comes in as one more row.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    keys = list(pairs.values())
    inner = [*keys, version_time, *([until] if until else [])]
    added = [c for c in versions.columns if c not in inner] if columns is None else list(columns)
    clashes = [c for c in added if c.lower() in {f.lower() for f in facts.columns}]
    if clashes:
        raise ValueError(f"columns {clashes} exist already")

    names = [f"k{i}" for i in range(len(pairs))]
    at = pick(facts, time)
    row = F.struct(*[quoted(c) for c in facts.columns]).alias("fact")
    keyed = facts.select(*[pick(facts, c).alias(n) for c, n in zip(pairs, names)], at.alias("t"), row)
    complete = F.lit(True)
    for name in [*names, "t"]:
        complete = complete & F.col(name).isNotNull()
    keyed = keyed.withColumn("bucket", _bucket(keyed, F.col("t"), bucket))

    held = F.struct(
        *[pick(versions, c).alias(f"a{i}") for i, c in enumerate(added)],
        (pick(versions, until) if until else F.lit(None).cast("timestamp")).alias("until"),
    )
    kind = facts.select(at).schema[0].dataType
    dated = versions.select(
        *[pick(versions, c).alias(n) for c, n in zip(keys, names)],
        pick(versions, version_time).cast(kind).alias("t"),
        held.alias("version"),
    ).dropna(subset=[*names, "t"])
    dated = dated.groupBy(*names, "t").agg(F.max("version").alias("version"))
    dated = dated.withColumn("bucket", _bucket(dated, F.col("t"), bucket))

    # What each bucket takes in: one row per key and bucket, from the last version of each.
    place = [*names, "bucket"]
    last = dated.groupBy(*place).agg(F.max_by("version", "t").alias("version"))
    asked = keyed.filter(complete).select(*place).distinct()
    earlier = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    steps = last.unionByName(asked, True).groupBy(*place).agg(F.max("version").alias("version"))
    carried = steps.select(*place, F.last("version", True).over(earlier).alias("version"))
    carried = carried.filter(F.col("version").isNotNull())

    stacked = (
        keyed.filter(complete)
        .select(*place, "t", F.lit(2).alias("kind"), "fact")
        .unionByName(dated.select(*place, "t", F.lit(1).alias("kind"), "version"), True)
        .unionByName(carried.withColumn("kind", F.lit(0)), True)
    )
    so_far = Window.partitionBy(*place).orderBy(
        F.asc_nulls_first(F.when(F.col("kind") > 0, F.col("t"))), "kind"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = stacked.withColumn("version", F.last("version", True).over(so_far)).filter("kind = 2")
    if until:
        over = F.col("version.until") <= F.col("t")
        joined = joined.withColumn("version", F.when(~F.coalesce(over, F.lit(False)), F.col("version")))
    rest = keyed.filter(~complete).select("fact")
    whole = joined.select("fact", "version").unionByName(rest, True)
    return whole.select(
        "fact.*", *[F.col("version")[f"a{i}"].alias(c) for i, c in enumerate(added)]
    )


def failure_episodes(
    log: DataFrame, job: Sequence[str], time: str, failed: Column, bucket: float = DAY * 32
) -> DataFrame:
    """Runs of failures of each job, and how long each took to recover.

    An episode is a longest run of times of a job at which something failed: started, ended (its last
    failure), failures (rows that failed), recovered_at (the next time without a failure, null
    where none has come) and seconds_to_recover. Rows at one time are one time, which failed if
    any of them did; rows without a job or time are left out. Neighbours are found inside time
    buckets and over their borders, so that a job with most of the rows is spread over tasks.
    """
    rows = log.select(*[pick(log, j).alias(j) for j in job], pick(log, time).alias("_t"), failed.alias("_f"))
    rows = rows.dropna(subset=[*job, "_t"])
    times = rows.groupBy(*[quoted(j) for j in job], "_t").agg(F.count_if(F.coalesce("_f", F.lit(False))).alias("_n"))
    times = times.withColumn("_bucket", _bucket(times, F.col("_t"), bucket))
    state = F.struct(F.col("_t").alias("t"), (F.col("_n") > 0).alias("bad"))
    beside = _beside(times, job, "_bucket", ["_t"], state, "_before", ahead=False)
    beside = _beside(beside, job, "_bucket", ["_t"], state, "_after", ahead=True)
    bad = beside.filter("_n > 0")
    starts = bad.filter("_before IS NULL OR NOT _before.bad").select(
        *[quoted(j) for j in job], F.col("_t").alias("_from"), F.col("_t").alias("started")
    )
    failures = bad.select(*[quoted(j) for j in job], "_t", "_n", "_after")
    dated = as_of_join(failures, starts, list(job), "_t", "_from", columns=["started"], bucket=bucket)
    last = F.max(F.struct("_t", "_after"))
    found = dated.groupBy(*[quoted(j) for j in job], "started").agg(F.sum("_n").alias("failures"), last.alias("l"))
    seconds = F.timestamp_diff("SECOND", F.col("started"), F.col("recovered_at"))
    return found.select(
        *[quoted(j) for j in job],
        "started",
        F.col("l._t").alias("ended"),
        "failures",
        F.col("l._after.t").alias("recovered_at"),
    ).withColumn("seconds_to_recover", seconds)
