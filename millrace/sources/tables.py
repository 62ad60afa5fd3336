"""File datasets: reading, writing, raw landing, and tables staged between jobs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import quoted, sql_name

# The formats a dataset may have. Delta needs its package on the cluster.
FORMATS = ("parquet", "json", "csv", "delta")

# Spark writes times to text formats in milliseconds unless told otherwise.
FULL_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: Applications and the folders that were found to serve them.
_SHARED: set[tuple[str, str]] = set()


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")
    return fmt


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping | None = None,
) -> DataFrame:
    """A dataset as a lazy DataFrame.

    Give JSON and CSV a schema: without one Spark reads JSON once over just to infer it.
    """
    reader = spark.read.format(_checked(fmt)).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    options: Mapping | None = None,
    rebalance: bool = True,
    replace: str = "partitions",
) -> None:
    """Write a dataset, optionally into partition folders.

    Overwriting a partitioned dataset replaces only the partitions that `df` has rows for,
    so a rerun of one month leaves the others alone. With `replace="table"` the whole table is
    replaced, also partitions that `df` has no rows for; `df` must not read it then.

    Rows are first gathered by partition value, or every task would write a small file into
    every folder. The rebalance hint lets adaptive execution split a partition value that
    holds a large share of the rows over many tasks and merge small ones. Pass
    `rebalance=False` where rows are already gathered or all belong to one value.
    """
    if replace not in ("partitions", "table"):
        raise ValueError(f"replace must be 'partitions' or 'table', not {replace!r}")
    writer_mode = mode.lower()
    parts = list(partition_by or [])
    if parts and rebalance:
        df = df.hint("rebalance", *[quoted(c) for c in parts])
    writer = df.write.format(_checked(fmt)).mode(writer_mode)
    if parts:
        writer = writer.partitionBy(*parts)
        if writer_mode == "overwrite":
            kind = "dynamic" if replace == "partitions" else "static"
            writer = writer.option("partitionOverwriteMode", kind)
    if fmt in ("json", "csv"):
        writer = writer.options(**FULL_TIMES)
    writer.options(**(options or {})).save(path)


def land_raw(
    df: DataFrame,
    root: str,
    source: str,
    ingest_date: date | str,
    fmt: str = "parquet",
    append: bool = False,
) -> str:
    """Write a source unchanged to the raw layer, in a folder per source and day.

    Landing a day again replaces that day, so it can be repeated; `append` adds to it instead.
    A source without rows leaves the day as it is.
    """
    path = f"{root.rstrip('/')}/{source}"
    dated = df.withColumn("ingest_date", F.lit(str(ingest_date)).cast("date"))
    mode = "append" if append else "overwrite"
    write_table(dated, path, fmt, mode, ["ingest_date"], rebalance=False)
    return path


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Delete one partition folder of a table; none and no table are nothing to delete."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return
    for entry in system.listStatus(folder):
        # Spark writes odd symbols of a value as %XX.
        if unquote(entry.getPath().getName()) == f"{column}={value}":
            system.delete(entry.getPath(), True)


def driver_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few values that the driver holds as a table.

    They go into the plan as literals. `createDataFrame` would start Python workers for them.
    """
    values, lines = {}, []
    for row in rows or [[None] * len(schema)]:
        names = [f"v{len(values) + i}" for i in range(len(row))]
        lines.append("(" + ", ".join(f":{n}" for n in names) + ")")
        values |= {n: str(v) if isinstance(v, datetime) else v for n, v in zip(names, row)}
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(lines)}", values)
    typed = table.toDF(*schema.names).selectExpr(
        *[f"CAST({sql_name(f.name)} AS {f.dataType.simpleString()})" for f in schema]
    )
    return typed if rows else typed.limit(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: that of spark.checkpoint.dir, else the warehouse.

    No setting of the session is changed. The first of the two that serves is taken, each tried once
    a session; where none does, the error says what became of them. A folder named without a file
    system is given the cluster's own. One of the local file system serves a cluster only where it
    is a mount that driver and executors share, which is tried by a small job; a local session must
    be able to make folders in it.
    """
    named = [spark.conf.get(key, None) for key in ("spark.checkpoint.dir", "spark.sql.warehouse.dir")]
    folders = [f.rstrip("/") for f in named if f]
    if spark.conf.get("spark.master", "").startswith("local"):
        folders = folders or ["spark-warehouse"]
        return next((f for f in folders[:-1] if _is_writable(spark, f)), folders[-1])
    refused, cause = [], None
    for folder in folders:
        try:
            if not re.match("[A-Za-z][A-Za-z0-9+.-]*:", folder):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                system = path.getFileSystem(spark._jsc.hadoopConfiguration())
                folder = path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
            if not folder.startswith("file:") or _is_shared(spark, folder):
                return folder
            refused.append(f"{folder} loses files")
        except Exception as error:
            refused.append(f"{folder}: {str(error).strip().partition(chr(10))[0]}")
            cause = error
    refusal = "spark.checkpoint.dir is not set to a folder all executors share"
    raise ValueError("; ".join([refusal, *refused])) from cause


def _is_writable(spark: SparkSession, folder: str) -> bool:
    """Whether the driver can make a folder there; taken for granted without a JVM to ask."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return True
    known = (spark.sparkContext.applicationId, folder)
    if known not in _SHARED:
        trial = jvm.org.apache.hadoop.fs.Path(f"{folder}/trial-{uuid.uuid4().hex}")
        try:
            system = trial.getFileSystem(spark._jsc.hadoopConfiguration())
            if not system.mkdirs(trial):
                return False
            system.delete(trial, True)
        except Exception:
            return False
        _SHARED.add(known)
    return True


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what tasks write into a local folder comes back whole, for the driver lists the
    files and other tasks read them. Executors that join later are not tried."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _SHARED:
        tasks = 2 * spark.sparkContext.defaultParallelism
        trial, rows = f"{folder}/trial-{uuid.uuid4().hex}", spark.range(0, tasks, 1, tasks)
        try:
            rows.write.parquet(trial)
            if spark.read.schema(rows.schema).parquet(trial).count() < tasks:
                return False
        finally:
            _delete(spark, trial)
        _SHARED.add(known)
    return True


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder in the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class StagedTable:
    """A DataFrame written once to the shared folder and read from there afterwards.

    Several jobs over an expensive plan then share one run of it, all see the same rows, and
    the loss of an executor costs a re-read, not a recomputation. Aggregates in `metrics`
    are gathered while the rows are written. They sit in the stage that writes, whose tasks
    Spark counts once each, so repeated tasks do not inflate them.
    """

    def __init__(
        self, df: DataFrame, metrics: Sequence[Column] = (), gather_by: Sequence[str] = ()
    ):
        self.spark = df.sparkSession
        self.path = new_folder(self.spark, "staged")
        if gather_by:
            df = df.hint("rebalance", *[quoted(c) for c in gather_by])
        seen = Observation() if metrics else None
        rows = df.observe(seen, *metrics) if seen else df
        try:
            rows.write.parquet(self.path)
        except Exception:
            self.drop()
            raise
        self.metrics = seen.get if seen else {}
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the written table; `df` cannot be used any more."""
        _delete(self.spark, self.path)
