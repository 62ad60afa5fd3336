"""The run ledger and the event log, kept as append-only tables.

A run adds one row when it starts and one when it ends; nothing is updated in place. The
state of a run, the last success of a job and its figures are queries over those rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import pick
from millrace.sources.compaction import compact, read_compacted
from millrace.sources.tables import write_table

# The states of a run.
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
#: A run that died or failed for good: what it wrote is gone and its rows are read by others.
ABANDONED = "ABANDONED"

# The events of a job that queries over its log look for.
JOB_STARTED = "job_started"
SOURCE_READ = "source_read"
JOB_COMPLETE = "job_complete"
JOB_FAILED = "job_failed"

# Times are UTC wall-clock times, so that no session time zone changes them.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("low_mark", T.StringType()),
        T.StructField("attempt", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("level", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("elapsed_sec", T.DoubleType()),
        T.StructField("event", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("detail", T.StringType()),
    ]
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema
        ]
    )


def append_run_events(events: DataFrame, path: str, error_length: int | None = None) -> None:
    """Append start and end rows to a ledger, error messages whole unless a length is given."""
    rows = _aligned(events, LEDGER_SCHEMA)
    if error_length is not None:
        rows = rows.withColumn("error_message", F.substring("error_message", 1, error_length))
    write_table(rows, path, mode="append")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger, from the folder itself and from folders below it.

    Each row is seen once, also while the ledger is compacted. Read the rows of one job by the
    job's folder; once compacted, a run has no folder of its own.
    """
    return read_compacted(spark, path, LEDGER_SCHEMA)


def compact_ledger(
    spark: SparkSession, path: str, min_files: int = 8, keep_seconds: float = 86_400.0
) -> int:
    """Rewrite the small files of a ledger while runs append to it; the jobs rewritten.

    One Spark job rewrites every job that has `min_files` new files; jobs keep manifests of
    their own, so a run still lists its job's folder only. See `millrace.sources.compaction`.
    """
    return compact(spark, path, LEDGER_SCHEMA, min_files, keep_seconds)


def run_state(ledger: DataFrame) -> DataFrame:
    """The present state of every run: its latest row, with the time of its first one."""
    latest = F.max(
        F.struct(
            "event_time",
            (F.col("status") != RUNNING).alias("ended"),
            "status",
            "rows_read",
            "rows_written",
            "watermark",
            "error_message",
        )
    )
    runs = ledger.groupBy("job_name", "run_id").agg(
        F.min("event_time").alias("start_time"), latest.alias("last")
    )
    return runs.select(
        "job_name",
        "run_id",
        "last.status",
        "start_time",
        F.when(F.col("last.ended"), F.col("last.event_time")).alias("end_time"),
        "last.rows_read",
        "last.rows_written",
        "last.watermark",
        "last.error_message",
    )


def last_success(ledger: DataFrame, job_name: str | None = None) -> DataFrame:
    """The successful run that ended last: of one job (none or one row), or of every job."""
    if job_name is not None:
        ledger = ledger.filter(F.col("job_name") == job_name)
    done = run_state(ledger).filter(F.col("status") == SUCCESS)
    if job_name is not None:
        return done.orderBy(F.desc_nulls_last("end_time"), F.desc("run_id")).limit(1)
    order = F.struct("end_time", "run_id")
    newest = done.groupBy("job_name").agg(
        F.max_by(F.struct(*[c for c in done.columns if c != "job_name"]), order).alias("run")
    )
    return newest.select("job_name", "run.*")


def run_intervals(ledger: DataFrame) -> DataFrame:
    """Per run: its state and the interval (`low_mark`, `watermark`] that its last success read.

    A run that succeeded once keeps its interval whatever its later repetitions come to, for
    the rows are its own from then on. Both marks are null for a run that never succeeded.
    """
    done = F.max(
        F.when(F.col("status") == SUCCESS, F.struct("event_time", "low_mark", "watermark"))
    )
    runs = ledger.groupBy("job_name", "run_id").agg(
        F.min("event_time").alias("start_time"),
        F.max(F.struct("event_time", (F.col("status") != RUNNING).alias("ended"), "status")).alias(
            "last"
        ),
        done.alias("done"),
    )
    return runs.select(
        "job_name",
        "run_id",
        "start_time",
        "last.status",
        F.col("done").isNotNull().alias("succeeded"),
        "done.low_mark",
        "done.watermark",
    )


def greatest_mark(intervals: DataFrame, wanted: T.DataType) -> str | None:
    """The greatest upper mark of runs that succeeded, compared as values of type `wanted`."""
    typed = F.col("watermark").try_cast(wanted)
    top = intervals.filter("succeeded").agg(F.max_by("watermark", typed).alias("mark")).first()
    return top["mark"]


def open_attempts(ledger: DataFrame, now: datetime, lease_seconds: float | None) -> DataFrame:
    """Launches that began and did not end: `run_id`, `attempt`.

    With a lease, a launch that has not written to the ledger for that long is dead and left out.
    """
    last = F.max(F.struct("event_time", (F.col("status") != RUNNING).alias("ended")))
    found = ledger.groupBy("run_id", "attempt").agg(last.alias("last")).filter("NOT last.ended")
    if lease_seconds is not None:
        age = F.timestamp_diff("MICROSECOND", F.col("last.event_time"), F.lit(now).cast("timestamp_ntz"))
        found = found.filter(age < lease_seconds * 1_000_000)
    return found.select("run_id", "attempt")


def run_metrics(ledger: DataFrame) -> DataFrame:
    """Per job: runs by state, share of successes, rows moved and seconds taken."""
    state = run_state(ledger)
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))

    def counted(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return state.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        counted(SUCCESS).alias("succeeded"),
        counted(FAILED).alias("failed"),
        counted(RUNNING).alias("running"),
        (counted(SUCCESS) / F.count(F.lit(1))).alias("success_rate"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
        F.sum(seconds).alias("total_seconds"),
        F.max(seconds).alias("longest_seconds"),
    )


def incremental_filter(
    df: DataFrame,
    column: str,
    watermark,
    inclusive: bool = False,
    nulls: bool = False,
    until=None,
) -> DataFrame:
    """Rows newer than a watermark; without one, all rows.

    `until` leaves out rows newer than that value, so that both marks of an earlier run give
    the rows of that run again.

    `inclusive` takes the rows of the watermark itself again, for sources in which more of them
    may arrive later; write such rows so that they replace those read before. `nulls` keeps
    rows without a value, which otherwise only a first run without a watermark sees.

    The watermark is cast to the type of the column, never the column to that of the
    watermark, so that the comparison reaches the scan.
    """
    value = pick(df, column)
    wanted = df.select(value.alias("v")).schema["v"].dataType
    bounds = []
    if watermark is not None:
        mark = F.lit(watermark).cast(wanted)
        bounds.append(value >= mark if inclusive else value > mark)
    if until is not None:
        bounds.append(value <= F.lit(until).cast(wanted))
    for bound in bounds:
        df = df.filter(bound | value.isNull() if nulls else bound)
    return df


def append_log_events(events: DataFrame, path: str) -> None:
    """Append events to a log of JSON lines."""
    write_table(_aligned(events, EVENT_SCHEMA), path, "json", "append")


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", True).json(path)


def logged_events(log: DataFrame, level: str = "ERROR") -> DataFrame:
    """The events of one level, newest first."""
    return (
        log.filter(F.col("level") == level)
        .select("timestamp", "job_name", "event", "rows_in", "rows_out")
        .orderBy(F.desc_nulls_last("timestamp"))
    )
