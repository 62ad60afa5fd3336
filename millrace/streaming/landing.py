"""Landing a stream of files in a table, once each, with duplicates left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import quoted, unused_name
from millrace.sources.tables import FORMATS, write_table


def land_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    path: str,
    progress: str,
    keys: Sequence[str] = (),
    time: str | None = None,
    delay: str = "1 day",
    fmt: str = "parquet",
    files_per_batch: int = 1000,
    batch_column: str = "batch_id",
    options: dict | None = None,
) -> int:
    """Land all files that have arrived in `source` since the last call; returns the batches run.

    Structured Streaming keeps in `progress` which files were read. Each batch is written as the
    partition of its number, which a batch that is repeated after a failure replaces, so every
    file lands once. With `keys`, rows of a key seen already are left out as long as they
    come within `delay` of the newest `time`; the state holds the keys of that span only. A row
    that is later than `delay` is dropped, since it cannot be told from a duplicate any more.
    Rows without a time cannot be late and are all landed. Empty batches write nothing.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")
    if keys and time is None:
        raise ValueError("leaving out duplicates needs the time column they are bounded by")
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    stream = reader.options(**(options or {})).load(source)
    if batch_column in stream.columns:
        raise ValueError(f"column {batch_column!r} exists already; name another batch_column")
    if keys:
        stream = _distinct(stream, list(keys), time, delay)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(batch_column, F.lit(number).cast("long"))
        write_table(rows, path, partition_by=[batch_column], rebalance=False, replace="partitions")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])


def _distinct(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    moment = unused_name(stream, "_moment")
    # Watermarks need an instant; a local time is taken as it stands.
    dated = stream.withColumn(moment, quoted(time).cast("timestamp"))
    timed = dated.filter(quoted(moment).isNotNull()).withWatermark(moment, delay)
    once = timed.dropDuplicatesWithinWatermark(keys)
    return once.unionByName(dated.filter(quoted(moment).isNull())).drop(moment)
