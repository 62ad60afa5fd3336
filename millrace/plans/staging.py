"""The configured job: read, compare with the declared schema, transform, gate, write, record.

Nothing between reading and gating runs a Spark job. A run costs a narrow count of the
source, one pass that transforms and stages the rows while profiling them, a group-by over
the key columns of the staged rows, and the write of the target, whatever the number of
columns and transforms.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from millrace.functions.columns import normalize_name, pick, quoted
from millrace.operators import cleanse, dedup, ledger, lookup, quality, schema
from millrace.sources.tables import (
    FULL_TIMES,
    StagedTable,
    driver_rows,
    drop_partition,
    read_table,
    write_table,
)

log = logging.getLogger(__name__)


@dataclass
class PipelineRun:
    """What a run did. `drift` and `quality` hold one row per finding or check."""

    job_name: str
    run_id: str
    status: str = ledger.RUNNING
    rows_read: int | None = None
    rows_written: int | None = None
    low_mark: str | None = None
    watermark: str | None = None
    drift: list[Row] = field(default_factory=list)
    quality: list[Row] = field(default_factory=list)


class QualityError(ValueError):
    """A quality check failed; nothing was written."""


class RunConflictError(RuntimeError):
    """Another launch of an incremental job is under way; nothing was read or written."""


class SchemaDriftError(ValueError):
    """The source differs from the declared schema and the job does not allow it."""


# --- transforms ---------------------------------------------------------------------------


def _cleanse(df: DataFrame, spec: Mapping) -> DataFrame:
    return (
        df.transform(cleanse.trim_whitespace)
        .transform(cleanse.standardize_nulls)
        .transform(cleanse.normalize_column_names)
    )


def _deduplicate(df: DataFrame, spec: Mapping, **params) -> DataFrame:
    rule = {**(spec.get("dedup") or {}), **params}
    if rule.get("partition_by") and rule.get("order_by"):
        return dedup.window_dedup(df, **rule)
    return dedup.remove_duplicates(df, rule.get("subset"))


def _fields(df: DataFrame, spec: Mapping, fields=None) -> list:
    """The declared fields, by the names that the columns of `df` have."""
    declared = fields if fields is not None else spec["schema"]
    listed = declared.get("fields", []) if isinstance(declared, Mapping) else declared
    have = set(df.columns)
    # Once names are normalized, a declared name stands for its normalized form.
    return [f if f["name"] in have else {**f, "name": normalize_name(f["name"])} for f in listed]


def _cast(df: DataFrame, spec: Mapping, fields=None) -> DataFrame:
    return schema.cast_to_schema(df, _fields(df, spec, fields))


def _enrich(df: DataFrame, spec: Mapping, table: Mapping, **params) -> DataFrame:
    other = read_table(
        df.sparkSession,
        table["path"],
        table.get("format", "parquet"),
        table.get("schema"),
        table.get("options"),
    )
    return lookup.enrich(df, other, **params)


def _without_spec(operator: Callable) -> Callable:
    return lambda df, spec, **params: operator(df, **params)


TRANSFORMS: dict[str, Callable] = {
    "cleanse": _cleanse,
    "deduplicate": _deduplicate,
    "cast": _cast,
    "enrich": _enrich,
    "trim_whitespace": _without_spec(cleanse.trim_whitespace),
    "standardize_nulls": _without_spec(cleanse.standardize_nulls),
    "normalize_column_names": _without_spec(cleanse.normalize_column_names),
    "standardize_boolean": _without_spec(cleanse.standardize_boolean),
    "drop_empty_rows": _without_spec(cleanse.drop_empty_rows),
    "derive_partitions": _without_spec(cleanse.derive_partitions),
    "hash_dedup": _without_spec(dedup.hash_dedup),
}
SHUFFLING = {"deduplicate", "hash_dedup", "enrich"}


def _steps(spec: Mapping) -> list[tuple[str, dict]]:
    """The listed transforms as (name, parameters), in list order."""
    steps = []
    for entry in spec.get("transforms", ["cleanse"]):
        params = {"step": entry} if isinstance(entry, str) else dict(entry)
        name = params.pop("step", None)
        if name not in TRANSFORMS:
            raise ValueError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}")
        steps.append((name, params))
    return steps


def transform(
    df: DataFrame, spec: Mapping, casts: list[tuple[list[str], Observation]] | None = None
) -> DataFrame:
    """Apply the transforms of a job spec, lazily and in list order.

    With a list `casts`, every cast step adds to it its columns and an observation of how many
    values of each it loses, filled by the first job that runs the plan.
    """
    for name, params in _steps(spec):
        if name == "cast" and casts is not None:
            counts = schema.misfit_counts(df, _fields(df, spec, **params))
            if counts:
                seen = Observation()
                casts.append(([n for n, _ in counts], seen))
                df = df.observe(seen, F.array(*[c for _, c in counts]).alias("lost"))
        df = TRANSFORMS[name](df, spec, **params)
    return df


# --- the run ------------------------------------------------------------------------------


def _checked(spec: Mapping) -> None:
    missing = [k for k in ("job_name", "source", "target") if k not in spec]
    missing += [f"{k}.path" for k in ("source", "target") if k in spec and "path" not in spec[k]]
    if missing:
        raise ValueError(f"job spec lacks {missing}")
    for name, params in _steps(spec):
        if name == "cast" and not (params.get("fields") or spec.get("schema")):
            raise ValueError("the cast step needs a declared schema")
    source, target = spec["source"], spec["target"]
    if target.get("replace") not in (None, "table", "partitions"):
        raise ValueError("target.replace must be 'table' or 'partitions'")
    if spec.get("contract", "raise") not in ("raise", "warn"):
        raise ValueError("contract must be 'raise' or 'warn'")
    if source.get("incremental"):
        if target.get("mode", "overwrite").lower() != "append" and not _by_partition(spec):
            raise ValueError(
                "an incremental source needs target mode append, or a target partitioned by "
                "its column whose partitions are replaced"
            )
        if not spec.get("ledger"):
            raise ValueError("an incremental source needs a ledger to keep its watermark")


def _by_partition(spec: Mapping) -> bool:
    """Whether an incremental run replaces the partitions of the values it reads."""
    source, target = spec["source"], spec["target"]
    return (
        target.get("mode", "overwrite").lower() == "overwrite"
        and target.get("replace") == "partitions"
        and source["incremental"]["column"] in (target.get("partition_by") or [])
    )


def _under(root: str, job_name: str, run_id: str | None = None) -> str:
    """The folder of a job, or of one of its runs, below a ledger or log."""
    names = [f"job-{job_name}"] + ([f"run-{run_id}"] if run_id is not None else [])
    return "/".join([root.rstrip("/"), *(re.sub(r"[^A-Za-z0-9.-]", "_", n) for n in names)])


class _Recorder:
    """Writes the ledger rows of one run, and its events once it has ended.

    Every run has a folder of its own, so runs that end at the same time do not meet in one
    write folder.
    """

    def __init__(self, spark: SparkSession, spec: Mapping, run: PipelineRun):
        self.spark, self.run, self.started = spark, run, time.monotonic()
        self.spec, self.attempt = spec, uuid.uuid4().hex
        self.ledger, self.log = [
            _under(spec[k], run.job_name, run.run_id) if spec.get(k) else None
            for k in ("ledger", "event_log")
        ]
        self.events: list[tuple] = []

    def state(self, status: str, error: str | None = None) -> None:
        self.run.status = status
        if self.ledger is None:
            return
        run = self.run
        row = (
            run.job_name,
            run.run_id,
            status,
            ledger.utc_now(),
            run.rows_read,
            run.rows_written,
            run.watermark,
            error,
            run.low_mark,
            self.attempt,
        )
        ledger.append_run_events(
            driver_rows(self.spark, [row], ledger.LEDGER_SCHEMA), self.ledger
        )

    def end(self, launches: set[tuple[str, str | None]], status: str, why: str) -> None:
        """Record for launches of any run of the job, as (run id, attempt), that they ended."""
        for run_id, attempt in sorted(launches, key=str):
            row = (self.run.job_name, run_id, status, ledger.utc_now()) + (None,) * 3
            folder = _under(self.spec["ledger"], self.run.job_name, run_id)
            ledger.append_run_events(
                driver_rows(self.spark, [(*row, why, None, attempt)], ledger.LEDGER_SCHEMA), folder
            )

    def event(self, event, level="INFO", rows_in=None, rows_out=None, detail=None) -> None:
        elapsed = round(time.monotonic() - self.started, 2)
        now = ledger.utc_now()
        run = self.run
        self.events.append(
            (now, level, run.job_name, run.run_id, elapsed, event, rows_in, rows_out, detail)
        )

    def flush(self) -> None:
        if self.log is not None and self.events:
            ledger.append_log_events(
                driver_rows(self.spark, self.events, ledger.EVENT_SCHEMA).coalesce(1), self.log
            )


def _previous(spark: SparkSession, spec: Mapping) -> DataFrame | None:
    """What the ledger says about earlier runs of the job, or None before the first one.

    Only the folder of the job is listed, however many jobs share the ledger.
    """
    if not spec.get("ledger"):
        return None
    try:
        rows = ledger.read_ledger(spark, _under(spec["ledger"], spec["job_name"]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.filter(F.col("job_name") == spec["job_name"])


def _open(previous: DataFrame | None, lease_seconds=None) -> set[tuple[str, str | None]]:
    """Launches of the job that have begun and, as far as the ledger tells, not ended."""
    if previous is None:
        return set()
    found = ledger.open_attempts(previous, ledger.utc_now(), lease_seconds)
    return {(r["run_id"], r["attempt"]) for r in found.collect()}


def _refuse(others: set[tuple[str, str | None]], job_name: str) -> None:
    if others:
        named = ", ".join(sorted({run_id for run_id, _ in others}))
        raise RunConflictError(
            f"job {job_name!r} is being run already, by {named}; if that launch is dead, "
            "repeat it under its run id or give the job lease_seconds"
        )


def _dead_runs(previous: DataFrame | None) -> list[str]:
    """Run ids that never succeeded and are not given up, the newest first.

    There are as many as launches failed since the last run, since each run gives up the others.
    """
    if previous is None:
        return []
    runs = ledger.run_intervals(previous).filter("NOT succeeded")
    runs = runs.filter(F.col("status") != ledger.ABANDONED)
    return [r["run_id"] for r in runs.orderBy(F.desc("start_time"), F.desc("run_id")).collect()]


@dataclass
class _Interval:
    """What an incremental run reads: values above `low`; of a repeated run, up to `high`."""

    low: str | None = None
    high: str | None = None
    replay: bool = False


def _interval(previous: DataFrame | None, run_id: str, wanted) -> _Interval:
    """The interval of a run by what the ledger holds of the job.

    A run that succeeded before reads its own interval again, whatever has landed and run since.
    Any other begins at the greatest mark that a successful run of the job has reached.
    Ledgers that kept no lower mark give it as the greatest mark of the runs begun earlier.
    """
    if previous is None:
        return _Interval()
    runs = ledger.run_intervals(previous)
    own = runs.filter((F.col("run_id") == run_id) & F.col("succeeded")).first()
    others = runs.filter(F.col("run_id") != run_id)
    if own is None:
        return _Interval(ledger.greatest_mark(others, wanted))
    low = own["low_mark"]
    if low is None:
        began = F.lit(str(own["start_time"])).cast("timestamp_ntz")
        low = ledger.greatest_mark(others.filter(F.col("start_time") < began), wanted)
    return _Interval(low, own["watermark"], replay=True)


def _give_up(spark: SparkSession, spec: Mapping, run: PipelineRun, record: _Recorder, dead) -> None:
    """Delete what runs that never succeeded have written, for this run reads their rows too."""
    others = [run_id for run_id in dead if run_id != run.run_id]
    target = spec["target"]
    column = target.get("run_column", "run_id")
    if others and column and target.get("mode", "overwrite").lower() == "append":
        for run_id in others:
            drop_partition(spark, target["path"], column, run_id)
    record.end({(run_id, record.attempt) for run_id in others}, ledger.ABANDONED, "given up")


def run_pipeline(spark: SparkSession, spec: Mapping, run_id: str | None = None) -> PipelineRun:
    """Run a job described by a plain dict.

    Required: `job_name`, `source.path`, `target.path`. Optional: `source` format, schema,
    options and `incremental` {column, inclusive}; `target` format, mode, partition_by,
    options and `rebalance` false where rows need not be gathered by partition value before
    the write; `schema` (declared fields, or the path of a JSON file holding them) with
    `on_drift` "warn" or "raise" and `contract` "raise" or "warn"; `transforms`, by default
    ["cleanse"], each a name or {"step": name, ...parameters}; `dedup`; `quality_checks`;
    `ledger` and `event_log` paths; `rerun` "skip" to leave a run id alone that has already
    succeeded.

    Mode overwrite replaces the whole target, so that nothing stays that the source does not
    hold any more; `target.replace` "partitions" replaces only the partitions written. Mode
    append writes a partition `run_id` (another name by `target.run_column`) that a rerun of
    the same run id replaces; `run_column` None appends plainly, and a rerun doubles.

    An incremental run reads what is newer than the greatest mark that a successful run has
    reached and, where it replaces partitions by the incremental column, the last value again.
    The ledger keeps both marks of every run: a run id that has succeeded reads its own
    interval again, however much has landed since, and so replaces its rows by the same ones.
    Without a run id a launch takes up the newest run that failed; what other runs that never
    succeeded left in the target is deleted, since their rows are read again. While another
    launch of the job is under way a launch raises RunConflictError: of two that begin at
    once both may do so, but never both run. A launch that died without a trace holds the job
    until it is repeated under its run id or, with `lease_seconds`, has been silent that long.
    Rows without a value in the incremental column fail the job.

    Where a schema is declared and a cast step is listed, values that do not fit and nulls that
    are not allowed are counted in the pass that stages the rows and become gate lines.
    A failed quality check raises and leaves the target untouched, but for `reconcile` in the
    checks (true, or {group_by, sums}), which compares the rows with the written target.
    `rows_written` stays unknown in mode ignore.
    """
    _checked(spec)
    incremental = spec["source"].get("incremental")
    over: set = set()
    if incremental:
        previous = _previous(spark, spec)
        alive = _open(previous, spec.get("lease_seconds"))
        # Launches to take over from: of the run that is named, and those whose lease is out.
        over = {a for a in _open(previous) if a not in alive or a[0] == run_id}
        _refuse(alive - over, spec["job_name"])
        if run_id is None:
            run_id = next(iter(_dead_runs(previous)), None)
    run = PipelineRun(spec["job_name"], run_id or uuid.uuid4().hex)
    record = _Recorder(spark, spec, run)
    stages: list[StagedTable] = []
    try:
        previous = _previous(spark, spec)
        if spec.get("rerun") == "skip" and previous is not None:
            done = ledger.run_state(previous.filter(F.col("run_id") == run.run_id)).collect()
            if done and done[0]["status"] == ledger.SUCCESS:
                run.status, run.watermark = ledger.SUCCESS, done[0]["watermark"]
                run.rows_read, run.rows_written = done[0]["rows_read"], done[0]["rows_written"]
                record.event("run_skipped")
                return run
        record.end(over, ledger.FAILED, "taken over")
        record.state(ledger.RUNNING)
        record.event(ledger.JOB_STARTED)
        if incremental:
            # Read once more, now that others can see this launch.
            previous = _previous(spark, spec)
            _refuse(_open(previous) - {(run.run_id, record.attempt)}, run.job_name)
            _give_up(spark, spec, run, record, _dead_runs(previous))

        df = _read(spark, spec, run, previous, stages)
        record.event(ledger.SOURCE_READ, rows_out=run.rows_read)
        if spec.get("schema"):
            spec = {**spec, "schema": _declared(spark, spec["schema"])}
            _check_drift(df, spec, run, record)

        steps = [name for name, _ in _steps(spec)]
        bound = bool(spec.get("schema")) and "cast" in steps
        casts: list[tuple[list[str], Observation]] = []
        df = transform(df, spec, casts if bound else None)
        target = spec["target"]
        parts = list(target.get("partition_by") or [])
        absent = [c for c in parts if c not in df.columns]
        if absent:
            raise ValueError(f"the target is partitioned by {absent}, which no step provides")
        record.event("transforms_planned", rows_in=run.rows_read)

        checks = spec.get("quality_checks")
        gathered = False
        known = None
        if bound or (checks is not None and any(name in SHUFFLING for name in steps)):
            gather_by = parts if target.get("rebalance", True) else []
            staged = StagedTable(df, quality.profile_metrics(df.columns), gather_by)
            stages.append(staged)
            df, gathered = staged.df, True
            nulls = ", ".join(f"{n}L" for n in staged.metrics["null_counts"])
            known = spark.range(1).selectExpr(
                f"{staged.metrics['row_count']}L AS row_count", f"array({nulls}) AS null_counts"
            )
        failed: list[str] = []
        if checks is not None:
            gate = quality.gate_lines(df, checks, known, checks.get("one_pass", True))
            run.quality = gate.collect()
            failed = quality.failures(run.quality)
        if bound:
            lines = _contract_lines(df, spec, casts, staged.metrics)
            run.quality = [*run.quality, *lines]
            broken = quality.failures(lines)
            if broken and spec.get("contract", "raise") == "warn":
                record.event("contract_broken", "WARNING", detail="; ".join(broken))
            else:
                failed += broken
        if checks is not None or bound:
            record.event("quality_checked", "ERROR" if failed else "INFO", detail="; ".join(failed))
        if failed:
            raise QualityError("quality checks failed: " + "; ".join(failed))

        _write(df, target, parts, gathered, run)
        record.event("target_written", rows_in=run.rows_read, rows_out=run.rows_written)
        if checks is not None and checks.get("reconcile"):
            lines = _reconciled(spark, df, target, parts, checks["reconcile"], run).collect()
            run.quality = [*run.quality, *lines]
            failed = quality.failures(lines)
            record.event("target_reconciled", "ERROR" if failed else "INFO", detail="; ".join(failed))
            if failed:
                raise QualityError("the target differs from what was to be written: " + "; ".join(failed))
        record.state(ledger.SUCCESS)
        record.event(ledger.JOB_COMPLETE, rows_in=run.rows_read, rows_out=run.rows_written)
        return run
    except Exception as error:
        record.event(ledger.JOB_FAILED, "ERROR", rows_in=run.rows_read, detail=str(error))
        try:
            record.state(ledger.FAILED, str(error))
        except Exception:
            log.exception("run %s of %s could not record its failure", run.run_id, run.job_name)
        raise
    finally:
        # Neither a leftover folder nor a lost log line changes how the run ended.
        for tidy in (*[s.drop for s in stages], record.flush):
            try:
                tidy()
            except Exception:
                log.exception("run %s of %s left something behind", run.run_id, run.job_name)


def _contract_lines(
    df: DataFrame, spec: Mapping, casts: list[tuple[list[str], Observation]], metrics: Mapping
) -> list[Row]:
    """Gate lines of the declared schema, from what was counted while the rows were staged."""
    lost: dict[str, int] = {}
    for names, seen in casts:
        for name, n in zip(names, seen.get["lost"]):
            lost[name] = lost.get(name, 0) + n
    nulls = dict(zip(df.columns, metrics["null_counts"]))
    found = [("contract_cast", name, n) for name, n in lost.items()]
    for field_ in schema.schema_from_spec(_fields(df, spec)):
        if not field_.nullable:
            found.append(("contract_null", field_.name, nulls.get(field_.name, metrics["row_count"])))
    return [
        Row(check=check, subject=name, observed=float(n), threshold=0.0, passed=n == 0)
        for check, name, n in found
    ]


def _run_column(df: DataFrame, target: Mapping) -> str | None:
    """The partition column that holds the run id of appended rows."""
    if target.get("mode", "overwrite").lower() != "append":
        return None
    column = target.get("run_column", "run_id")
    if column in df.columns:
        raise ValueError(f"column {column!r} exists already; name another target.run_column")
    return column


def _reconciled(
    spark: SparkSession, df: DataFrame, target: Mapping, parts: list, rule, run: PipelineRun
) -> DataFrame:
    """Gate lines comparing the rows to be written with what the target now holds of them."""
    rule = {} if rule is True else dict(rule)
    sums, groups = list(rule.get("sums", [])), list(rule.get("group_by", []))
    column, fmt = _run_column(df, target), target.get("format", "parquet")
    # Partition values are read by the types they were written with: as text, run id "007" or
    # "1e5" stays what it is, where Spark would take it for a number.
    types = StructType([*df.schema, *([StructField(column, StringType())] if column else [])])
    written = read_table(
        spark, target["path"], fmt, None if fmt == "delta" else types, target.get("options")
    )
    if column:
        written = written.filter(quoted(column) == run.run_id).drop(column)
    if target.get("replace") == "partitions":
        groups = list(dict.fromkeys([*groups, *parts]))
    both = quality.reconcile(df, written, groups, sums)
    if target.get("replace") == "partitions":
        both = both.filter("source_rows > 0")  # the other partitions are none of this run's
    return quality.reconcile_lines(both, groups)


def _read(
    spark: SparkSession, spec: Mapping, run: PipelineRun, previous: DataFrame | None, stages: list
) -> DataFrame:
    """The source rows, counted in a pass that reads no column or the watermark column only.

    JSON and CSV are parsed once: their rows are staged as Parquet and counted on the way.
    """
    source = spec["source"]
    df = read_table(
        spark,
        source["path"],
        source.get("format", "parquet"),
        source.get("schema"),
        source.get("options"),
    )
    incremental = source.get("incremental")
    if source.get("format", "parquet") in ("json", "csv"):
        staged = StagedTable(df, [F.count(F.lit(1)).alias("n")])
        stages.append(staged)
        df = staged.df
        if not incremental:
            run.rows_read = staged.metrics["n"]
            return df
    if not incremental:
        run.rows_read = df.count()
        return df
    column = incremental["column"]
    unmarked = df.filter(pick(df, column).isNull()).count()
    if unmarked:
        raise ValueError(f"{unmarked} rows have no {column!r}, by which the source is read")
    inclusive = incremental.get("inclusive", _by_partition(spec))
    wanted = df.select(pick(df, column)).schema[0].dataType
    read = _interval(previous, run.run_id, wanted)
    if read.replay and read.high is None:
        df = df.filter(F.lit(False))  # the run found an empty source
    df = ledger.incremental_filter(df, column, read.low, inclusive, until=read.high)
    newest = F.max(pick(df, column))
    if isinstance(wanted, TimestampType):
        # With its offset, so that a run in another time zone reads the same instant.
        newest = F.date_format(newest, FULL_TIMES["timestampFormat"])
    seen = df.agg(F.count(F.lit(1)).alias("n"), newest.cast("string").alias("newest")).first()
    run.rows_read, run.low_mark = seen["n"], read.low
    # A repeated run keeps its upper mark, also where its last rows are gone from the source.
    run.watermark = read.high if read.replay else seen["newest"] or read.low
    return df


def _declared(spark: SparkSession, declared) -> list:
    if isinstance(declared, str):
        return schema.load_fields(spark, declared)
    return declared


def _check_drift(df: DataFrame, spec: Mapping, run: PipelineRun, record: _Recorder) -> None:
    run.drift = schema.schema_drift(df, spec["schema"]).collect()
    if not run.drift:
        return
    found = "; ".join(f"{d['kind']} {d['column']}" for d in run.drift)
    record.event("schema_drift", "WARNING", detail=found)
    if spec.get("on_drift", "warn") == "raise":
        raise SchemaDriftError(f"schema drift: {found}")


def _write(df: DataFrame, target: Mapping, parts: list, gathered: bool, run: PipelineRun) -> None:
    if parts and not gathered and target.get("rebalance", True):
        df = df.hint("rebalance", *[pick(df, c) for c in parts])
    mode, replace = target.get("mode", "overwrite"), target.get("replace", "table")
    column = _run_column(df, target)
    if column:
        # A rerun of this run id replaces the partition that it wrote before.
        df, parts = df.withColumn(column, F.lit(run.run_id)), [column, *parts]
        mode, replace = "overwrite", "partitions"
    # Mode ignore may write nothing at all, and then there is nothing to observe.
    written = None if mode.lower() == "ignore" else Observation()
    write_table(
        df if written is None else df.observe(written, F.count(F.lit(1)).alias("n")),
        target["path"],
        target.get("format", "parquet"),
        mode,
        parts,
        target.get("options"),
        rebalance=False,
        replace=replace,
    )
    run.rows_written = written.get["n"] if written else None
