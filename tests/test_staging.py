"""Configured jobs from end to end."""

import json
import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

import millrace as m
from conftest import rows

#: Scans of parcels on their way: the newest scan of a parcel counts, weights come as text.
DECLARED = {
    "fields": [
        {"name": "parcel_no", "type": "long", "nullable": False},
        {"name": "depot", "type": "string"},
        {"name": "weight_kg", "type": "decimal(6,2)"},
        {"name": "scanned", "type": "timestamp_ntz", "nullable": False},
    ]
}


def day(n):
    return datetime(2024, n, 1, 12)


@pytest.fixture
def job(spark, tmp_path):
    raw = str(tmp_path / "raw")
    scans = [
        ("101 ", "Bern", "2.50", day(5)),
        ("101", " Basel", "2.5", day(7)),
        ("205", "Chur ", "-", day(7)),
        ("333", "Bern", "0.75", day(6)),
        ("333", "n/k", "0.70", day(4)),
    ]
    spark.createDataFrame(
        scans, "`Parcel No` string, depot string, `Weight.kg` string, scanned timestamp_ntz"
    ).write.parquet(raw)
    return {
        "job_name": "parcel_scans",
        "source": {"path": raw},
        "target": {"path": str(tmp_path / "parcels"), "partition_by": ["month"]},
        "schema": DECLARED,
        "transforms": [
            "cleanse",
            "deduplicate",
            "cast",
            {"step": "derive_partitions", "column": "scanned", "parts": ["month"]},
        ],
        "dedup": {"partition_by": ["parcel_no"], "order_by": "scanned"},
        "quality_checks": {
            "null_threshold": 0.4,
            "uniqueness_keys": ["parcel_no"],
            "row_count_min": 2,
        },
        "ledger": str(tmp_path / "ledger"),
        "event_log": str(tmp_path / "log"),
    }


EXPECTED = [
    (101, "Basel", Decimal("2.50"), day(7), 7),
    (205, "Chur", None, day(7), 7),
    (333, "Bern", Decimal("0.75"), day(6), 6),
]


def state(spark, job, run_id):
    runs = m.run_state(m.read_ledger(spark, job["ledger"]))
    return runs.filter(runs.run_id == run_id).first()


def test_whole_job(spark, job):
    run = m.run_pipeline(spark, job, "r1")
    assert rows(spark.read.parquet(job["target"]["path"])) == EXPECTED
    assert (run.status, run.rows_read, run.rows_written) == ("SUCCESS", 5, 3)
    assert {(d["column"], d["kind"]) for d in run.drift} == {
        ("parcel_no", "missing"),
        ("weight_kg", "missing"),
        ("Parcel No", "new"),
        ("Weight.kg", "new"),
    }
    kinds = Counter(c["check"] for c in run.quality)
    assert kinds == {"null_rate": 5, "row_count": 1, "uniqueness": 1, "contract_cast": 4, "contract_null": 2}
    assert all(c["passed"] for c in run.quality)
    recorded = state(spark, job, "r1")
    assert (recorded["status"], recorded["rows_read"], recorded["rows_written"]) == ("SUCCESS", 5, 3)
    assert recorded["start_time"] <= recorded["end_time"]
    log = m.read_event_log(spark, job["event_log"])
    assert {"job_started", "schema_drift", "job_complete"} <= {r["event"] for r in log.collect()}
    assert m.logged_events(log).count() == 0


def test_rerun_leaves_the_same_target_and_nothing_staged(spark, job):
    m.run_pipeline(spark, job, "r1")
    m.run_pipeline(spark, job, "r1")
    m.run_pipeline(spark, job, "r2")
    assert rows(spark.read.parquet(job["target"]["path"])) == EXPECTED
    assert not [n for n in os.listdir(m.shared_folder(spark)) if n.startswith("staged")]


def test_rerun_can_be_skipped(spark, job):
    m.run_pipeline(spark, job, "r1")
    job["rerun"] = "skip"
    job["source"]["path"] += "-gone"
    run = m.run_pipeline(spark, job, "r1")
    assert (run.status, run.rows_written) == ("SUCCESS", 3)
    with pytest.raises(Exception):
        m.run_pipeline(spark, job, "r2")


def test_failed_gate_writes_nothing_and_is_recorded(spark, job):
    job["quality_checks"]["row_count_min"] = 100
    with pytest.raises(m.QualityError, match="row_count"):
        m.run_pipeline(spark, job, "bad")
    assert not os.path.exists(job["target"]["path"])
    recorded = state(spark, job, "bad")
    assert recorded["status"] == "FAILED" and "row_count" in recorded["error_message"]
    errors = m.logged_events(m.read_event_log(spark, job["event_log"]))
    assert {r["event"] for r in errors.collect()} == {"quality_checked", "job_failed"}
    assert m.last_success(m.read_ledger(spark, job["ledger"]), job["job_name"]).collect() == []
    assert not [n for n in os.listdir(m.shared_folder(spark)) if n.startswith("staged")]


def test_gate_without_shuffles_is_not_staged(spark, job):
    job["transforms"] = ["cleanse"]
    job["target"].pop("partition_by")
    job["quality_checks"] = {"uniqueness_keys": ["scanned"]}
    with pytest.raises(m.QualityError, match="uniqueness of scanned"):
        m.run_pipeline(spark, job)
    job["quality_checks"] = {"null_threshold": 0.3}
    assert m.run_pipeline(spark, job).rows_written == 5


def test_defaults(spark, job):
    spec = {k: job[k] for k in ("job_name", "source", "target")}
    spec["target"].pop("partition_by")
    run = m.run_pipeline(spark, spec)
    assert (run.rows_read, run.rows_written, run.quality) == (5, 5, [])
    out = spark.read.parquet(spec["target"]["path"])
    assert out.columns == ["parcel_no", "depot", "weight_kg", "scanned"]
    assert rows(out)[2] == ("205", "Chur", None, day(7))


def test_full_row_dedup_without_a_rule(spark, job):
    job.pop("dedup")
    job["transforms"] = ["cleanse", "deduplicate"]
    job["target"].pop("partition_by")
    job["quality_checks"] = {}
    job["quality_checks"]["null_threshold"] = 1
    assert m.run_pipeline(spark, job).rows_written == 5


def test_transforms_run_in_list_order(spark, job):
    job["transforms"] = ["standardize_nulls", "trim_whitespace"]
    df = spark.createDataFrame([(" NA ",)], "a string")
    assert rows(m.transform(df, job)) == [("NA",)]
    job["transforms"].reverse()
    assert rows(m.transform(df, job)) == [(None,)]


def test_every_transform_can_be_configured(spark, tmp_path):
    lookup = str(tmp_path / "lookup")
    spark.createDataFrame([("x", 1)], "k string, extra int").write.parquet(lookup)
    spec = {
        "transforms": [
            "normalize_column_names",
            {"step": "standardize_boolean", "columns": ["flag"]},
            {"step": "drop_empty_rows", "required_columns": ["k"]},
            {"step": "hash_dedup", "subset": ["k"]},
            {"step": "deduplicate", "subset": ["k"]},
            {"step": "cast", "fields": [{"name": "N", "type": "integer"}]},
            {"step": "enrich", "table": {"path": lookup}, "on": ["k"]},
        ]
    }
    df = spark.createDataFrame([("x", "YES", "7"), ("x", "YES", "7"), (None, "no", "8")], "K string, Flag string, N string")
    out = m.transform(df, spec).drop("_row_hash")
    assert rows(out) == [("x", True, 7, 1)]


def test_refused_specs(spark, job, tmp_path):
    for change, message in (
        ({"job_name": None}, "job_name"),
        ({"source": {}}, "source.path"),
        ({"transforms": ["cleanse", "polish"]}, "polish"),
        ({"schema": None}, "cast"),
        ({"source": {"path": "x", "incremental": {"column": "t"}}}, "append"),
    ):
        spec = {**job, **change}
        spec = {k: v for k, v in spec.items() if v is not None}
        with pytest.raises(ValueError, match=message):
            m.run_pipeline(spark, spec)
    assert not os.path.exists(job["ledger"])


def test_missing_partition_column_is_named(spark, job):
    job["transforms"] = ["cleanse"]
    with pytest.raises(ValueError, match="month"):
        m.run_pipeline(spark, job, "r1")
    assert state(spark, job, "r1")["status"] == "FAILED"


def test_drift_can_stop_a_job(spark, job):
    job["on_drift"] = "raise"
    with pytest.raises(m.SchemaDriftError, match="new Parcel No"):
        m.run_pipeline(spark, job, "r1")
    assert state(spark, job, "r1")["rows_read"] == 5


def test_declared_schema_may_be_a_file(spark, job, tmp_path):
    path = tmp_path / "parcels.json"
    path.write_text(json.dumps(DECLARED))
    job["schema"] = str(path)
    assert m.run_pipeline(spark, job).rows_written == 3


def test_text_source_with_options(spark, job, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(" a ", "1"), ("N/A", "2")], "`N o` string, v string").write.csv(path, header=True)
    spec = {
        "job_name": "csv",
        "source": {"path": path, "format": "csv", "options": {"header": True}},
        "target": {"path": str(tmp_path / "json"), "format": "json", "mode": "append"},
    }
    m.run_pipeline(spark, spec)
    m.run_pipeline(spark, spec)
    out = spark.read.schema("n_o string, v string").json(spec["target"]["path"]).drop("run_id")
    assert rows(out) == sorted([("a", "1"), (None, "2")] * 2, key=repr)


def test_incremental_loads(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    spec = {
        "job_name": "inc",
        "source": {"path": raw, "incremental": {"column": "t"}},
        "target": {"path": out, "mode": "append"},
        "ledger": str(tmp_path / "ledger"),
    }

    def arrive(*months):
        spark.createDataFrame([(n, day(n)) for n in months], "id int, t timestamp_ntz").write.mode(
            "append"
        ).parquet(raw)

    arrive(1, 2)
    assert m.run_pipeline(spark, spec).rows_written == 2
    arrive(3)
    run = m.run_pipeline(spark, spec)
    assert (run.rows_read, run.watermark) == (1, "2024-03-01 12:00:00")
    again = m.run_pipeline(spark, spec)
    assert (again.rows_read, again.watermark) == (0, "2024-03-01 12:00:00")
    arrive(4)
    m.run_pipeline(spark, spec)
    assert [r[0] for r in rows(spark.read.parquet(out))] == [1, 2, 3, 4]


def test_an_unreadable_source_is_recorded(spark, job):
    job["source"]["path"] += "-gone"
    with pytest.raises(Exception):
        m.run_pipeline(spark, job, "r1")
    recorded = state(spark, job, "r1")
    assert recorded["status"] == "FAILED" and job["source"]["path"] in recorded["error_message"]


def test_odd_job_names_keep_their_ledger(spark, job):
    job["job_name"] = "_team/a b:ü"
    m.run_pipeline(spark, job, ".r/1")
    last = m.last_success(m.read_ledger(spark, job["ledger"]), job["job_name"]).first()
    assert last["run_id"] == ".r/1"


def test_every_mode_can_be_configured(spark, job):
    job["transforms"] = ["cleanse"]
    del job["target"]["partition_by"], job["quality_checks"]
    for mode, written, rows_there in (
        ("ignore", None, 5),
        ("ignore", None, 5),
        ("append", 5, 10),
        ("overwrite", 5, 5),
    ):
        job["target"] |= {"mode": mode, "run_column": None}
        assert m.run_pipeline(spark, job).rows_written == written
        assert spark.read.parquet(job["target"]["path"]).count() == rows_there
    job["target"]["mode"] = "error"
    with pytest.raises(AnalysisException):
        m.run_pipeline(spark, job)


def test_a_watermark_means_the_same_in_every_time_zone(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spec = {
        "job_name": "zones",
        "source": {"path": raw, "incremental": {"column": "t"}},
        "target": {"path": str(tmp_path / "out"), "mode": "append"},
        "ledger": str(tmp_path / "ledger"),
    }
    spark.sql("SELECT timestamp'2024-06-01 12:00:00.123456Z' AS t").write.parquet(raw)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        assert m.run_pipeline(spark, spec).rows_read == 1
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        assert m.run_pipeline(spark, spec).rows_read == 0
        spark.sql("SELECT timestamp'2024-06-01 12:00:00.123457Z' AS t").write.mode("append").parquet(raw)
        assert m.run_pipeline(spark, spec).rows_read == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- reruns, contracts, reconciliation --------------------------------------------------------

ITEM = "sku string, amount string, at timestamp_ntz"


def shipments(spark, tmp_path, data, **more):
    raw = str(tmp_path / "shipments")
    spark.createDataFrame(data, ITEM).write.mode("overwrite").parquet(raw)
    return {
        "job_name": "shipments",
        "source": {"path": raw},
        "target": {"path": str(tmp_path / "shipped"), "partition_by": ["year", "month"]},
        "transforms": ["cleanse", "deduplicate", {"step": "derive_partitions", "column": "at"}],
        "dedup": {"partition_by": ["sku"], "order_by": "at"},
        "quality_checks": {"null_threshold": 1, "uniqueness_keys": ["sku"], "reconcile": True},
        "ledger": str(tmp_path / "book"),
        **more,
    }


def test_a_full_reload_leaves_no_stale_rows(spark, tmp_path):
    """A newer row in another month, and a month that vanished at the source."""
    first = [("s1", "4", day(1)), ("s2", "5", day(2)), ("s3", "6", day(5))]
    spec = shipments(spark, tmp_path, first)
    m.run_pipeline(spark, spec)
    spec = shipments(spark, tmp_path, first[:2] + [("s1", "9", day(3))])
    m.run_pipeline(spark, spec)
    out = spark.read.parquet(spec["target"]["path"])
    assert rows(out.select("sku", "amount", "month")) == [("s1", "9", 3), ("s2", "5", 2)]
    spec["target"]["replace"] = "partitions"
    spark.createDataFrame([("s7", "1", day(3))], ITEM).write.mode("overwrite").parquet(spec["source"]["path"])
    m.run_pipeline(spark, spec)
    assert rows(spark.read.parquet(spec["target"]["path"]).select("sku")) == [("s2",), ("s7",)]


def test_an_append_run_can_be_repeated(spark, tmp_path):
    spec = shipments(spark, tmp_path, [("s1", "4", day(1)), ("s2", "5", day(2))])
    spec["target"]["mode"] = "append"
    for run_id, there in (("a", 2), ("a", 2), ("b", 4)):
        assert m.run_pipeline(spark, spec, run_id).rows_written == 2
        assert spark.read.parquet(spec["target"]["path"]).count() == there


def test_an_incremental_run_that_died_before_its_success_is_taken_up(spark, tmp_path, monkeypatch):
    spec = shipments(spark, tmp_path, [("s1", "4", day(1))], transforms=["cleanse"], quality_checks=None)
    spec["source"]["incremental"] = {"column": "at"}
    spec["target"] = {"path": str(tmp_path / "inc"), "mode": "append"}
    m.run_pipeline(spark, spec, "one")
    spark.createDataFrame([("s2", "5", day(2))], ITEM).write.mode("append").parquet(spec["source"]["path"])
    import millrace.plans.staging as staging

    state_of = staging._Recorder.state

    def dies(self, status, error=None):
        if status == "SUCCESS":
            raise SystemExit
        return state_of(self, status, error)

    with monkeypatch.context() as patch:
        patch.setattr(staging._Recorder, "state", dies)
        with pytest.raises(SystemExit):
            m.run_pipeline(spark, spec)
    with pytest.raises(m.RunConflictError):  # it might be running still
        m.run_pipeline(spark, spec)
    run = m.run_pipeline(spark, {**spec, "lease_seconds": 0})
    assert (run.status, run.rows_read) == ("SUCCESS", 1)
    assert rows(spark.read.parquet(spec["target"]["path"]).select("sku")) == [("s1",), ("s2",)]
    assert m.run_pipeline(spark, spec).rows_read == 0  # the dead launch is closed


def landed(spark, root, sku, when):
    m.land_raw(spark.createDataFrame([(sku, "1", day(when))], ITEM), root, "items", f"2024-05-0{when}")


@pytest.fixture()
def increments(spark, tmp_path):
    return {
        "job_name": "items",
        "source": {"path": str(tmp_path / "raw" / "items"), "incremental": {"column": "ingest_date"}},
        "target": {"path": str(tmp_path / "kept"), "mode": "append"},
        "transforms": [],
        "ledger": str(tmp_path / "book"),
    }


def kept(spark, spec):
    return sorted(r.sku for r in spark.read.parquet(spec["target"]["path"]).collect())


def test_a_repeated_run_reads_its_own_interval_after_new_rows_have_landed(spark, tmp_path, increments):
    root = str(tmp_path / "raw")
    for when, name in ((1, "first"), (2, "second")):
        landed(spark, root, f"s{when}", when)
        assert m.run_pipeline(spark, increments, name).rows_read == 1
    landed(spark, root, "s3", 3)
    again = m.run_pipeline(spark, increments, "second")
    assert (again.rows_read, again.low_mark, again.watermark) == (1, "2024-05-01", "2024-05-02")
    assert kept(spark, increments) == ["s1", "s2"]
    assert m.run_pipeline(spark, increments, "third").rows_read == 1
    for name in ("first", "second", "third", "second"):
        assert m.run_pipeline(spark, increments, name).rows_read == 1
        assert kept(spark, increments) == ["s1", "s2", "s3"]
    assert m.run_pipeline(spark, increments, "fourth").rows_read == 0
    landed(spark, root, "s4", 4)
    assert m.run_pipeline(spark, increments, "fourth").rows_read == 0  # it read an empty interval
    assert m.run_pipeline(spark, increments).rows_read == 1
    assert kept(spark, increments) == ["s1", "s2", "s3", "s4"]


def test_marks_are_compared_as_values_not_as_text(spark, tmp_path, increments):
    raw = increments["source"]["path"]
    increments["source"]["incremental"]["column"] = "n"
    for n in (9, 10, 11):
        spark.sql(f"SELECT {n} AS n, 's{n}' AS sku").write.mode("append").parquet(raw)
        assert m.run_pipeline(spark, increments, f"run {n}").rows_read == 1
    assert m.run_pipeline(spark, increments, "run 9").rows_read == 1
    assert kept(spark, increments) == ["s10", "s11", "s9"]


def test_a_failed_repetition_keeps_the_interval(spark, tmp_path, increments, monkeypatch):
    import millrace.plans.staging as staging

    root = str(tmp_path / "raw")
    for when, name in ((1, "first"), (2, "second")):
        landed(spark, root, f"s{when}", when)
        m.run_pipeline(spark, increments, name)
    with monkeypatch.context() as patch:
        patch.setattr(staging, "_write", lambda *a: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            m.run_pipeline(spark, increments, "first")
    landed(spark, root, "s3", 3)
    assert m.run_pipeline(spark, increments).rows_read == 1  # not taken up as if it had no rows
    assert m.run_pipeline(spark, increments, "first").rows_read == 1
    assert kept(spark, increments) == ["s1", "s2", "s3"]


def test_what_a_failed_run_left_is_deleted_before_others_read_its_rows(spark, tmp_path, increments, monkeypatch):
    import millrace.plans.staging as staging

    root, state_of = str(tmp_path / "raw"), staging._Recorder.state
    landed(spark, root, "s1", 1)

    def dies(self, status, error=None):
        if status == "SUCCESS":
            raise OSError("after the target was written")
        return state_of(self, status, error)

    with monkeypatch.context() as patch:
        patch.setattr(staging._Recorder, "state", dies)
        for name in ("odd/name 1", "b"):
            with pytest.raises(OSError):
                m.run_pipeline(spark, increments, name)
    assert kept(spark, increments) == ["s1"]
    landed(spark, root, "s2", 2)
    assert m.run_pipeline(spark, increments, "c").rows_read == 2
    assert kept(spark, increments) == ["s1", "s2"]
    book = m.run_state(m.read_ledger(spark, increments["ledger"]))
    assert {r.run_id: r.status for r in book.collect()} == {
        "odd/name 1": "ABANDONED", "b": "ABANDONED", "c": "SUCCESS"
    }
    assert m.run_pipeline(spark, increments, "b").rows_read == 0
    assert kept(spark, increments) == ["s1", "s2"]


def test_of_two_launches_at_once_one_backs_off(spark, tmp_path, increments, monkeypatch):
    import millrace.plans.staging as staging

    landed(spark, str(tmp_path / "raw"), "s1", 1)
    state_of, inner = staging._Recorder.state, []

    def meets(self, status, error=None):
        state_of(self, status, error)
        if status == "RUNNING" and not inner:
            inner.append("begun")
            with pytest.raises(m.RunConflictError):
                m.run_pipeline(spark, increments)

    with monkeypatch.context() as patch:
        patch.setattr(staging._Recorder, "state", meets)
        assert m.run_pipeline(spark, increments).rows_read == 1
    assert kept(spark, increments) == ["s1"]


def test_marks_of_an_old_ledger_are_found(spark, tmp_path, increments):
    """Ledgers written before lower marks were kept."""
    root = str(tmp_path / "raw")
    for when, name in ((1, "first"), (2, "second"), (3, "third")):
        landed(spark, root, f"s{when}", when)
        m.run_pipeline(spark, increments, name)
    old = m.read_ledger(spark, increments["ledger"]).drop("low_mark", "attempt").collect()
    fields = m.read_ledger(spark, increments["ledger"]).drop("low_mark", "attempt").schema
    book = {**increments, "ledger": str(tmp_path / "old")}
    spark.createDataFrame(old, fields).coalesce(1).write.parquet(f"{book['ledger']}/job-items/run-x")
    assert m.run_pipeline(spark, book, "second").rows_read == 1
    assert kept(spark, book) == ["s1", "s2", "s3"]


@pytest.mark.parametrize("name", ["007", "1e5", "2024-01-01", "true", "a/b c", "None"])
def test_a_target_is_reconciled_whatever_the_run_id_looks_like(spark, tmp_path, name):
    spec = shipments(spark, tmp_path, [("s1", "4", day(1)), ("s2", "5", day(2))])
    spec["target"] = {"path": str(tmp_path / "kept"), "mode": "append"}
    for run_id in (name, "other", name):
        assert m.run_pipeline(spark, spec, run_id).rows_written == 2
    assert spark.read.parquet(spec["target"]["path"]).count() == 4


def test_whole_days_can_be_read_again_until_they_are_complete(spark, tmp_path):
    """Late rows with the watermark's own value arrive; partitions of that value are replaced."""
    root, spec = str(tmp_path / "lake"), shipments(spark, tmp_path, [], transforms=["cleanse"])
    raw = spark.createDataFrame([("s1", "1", day(1)), ("s2", "2", day(1)), ("s3", "3", day(2))], ITEM)
    spec["source"] = {"path": f"{root}/items", "incremental": {"column": "ingest_date"}}
    spec["target"] = {"path": str(tmp_path / "o"), "partition_by": ["ingest_date"], "replace": "partitions"}
    spec["quality_checks"] = {"null_threshold": 1}
    m.land_raw(raw.limit(1), root, "items", "2024-05-01")
    m.run_pipeline(spark, spec)
    m.land_raw(raw.filter("sku < 's3'"), root, "items", "2024-05-01")
    m.land_raw(raw.filter("sku = 's3'"), root, "items", "2024-05-02")
    for _ in range(2):
        m.run_pipeline(spark, spec)
        assert rows(spark.read.parquet(spec["target"]["path"]).select("sku")) == [("s1",), ("s2",), ("s3",)]


def test_rows_without_a_mark_fail_an_incremental_run(spark, tmp_path):
    spec = shipments(spark, tmp_path, [("s1", "4", day(1)), ("s2", "5", None)], transforms=["cleanse"])
    spec["source"]["incremental"] = {"column": "at"}
    spec["target"] = {"path": str(tmp_path / "inc"), "mode": "append"}
    with pytest.raises(ValueError, match="1 rows have no 'at'"):
        m.run_pipeline(spark, spec)
    assert not os.path.exists(spec["target"]["path"])


CONTRACT = {"fields": [{"name": "sku", "type": "string", "nullable": False}, {"name": "amount", "type": "int"}]}


def test_a_broken_contract_fails_the_job_and_writes_nothing(spark, tmp_path):
    data = [(None, "4", day(1)), ("s2", "x", day(2)), ("s3", "7", day(2))]
    spec = shipments(spark, tmp_path, data, schema=CONTRACT, transforms=["cleanse", "deduplicate", "cast"])
    del spec["target"]["partition_by"], spec["quality_checks"]
    with pytest.raises(m.QualityError, match="contract_cast of amount: 1.0.*contract_null of sku: 1.0"):
        m.run_pipeline(spark, spec, "r")
    assert not os.path.exists(spec["target"]["path"])
    assert "contract_null" in state(spark, spec, "r")["error_message"]
    spec["contract"] = "warn"
    run = m.run_pipeline(spark, spec)
    assert run.rows_written == 3
    assert {(q.check, q.subject, q.observed) for q in run.quality} == {
        ("contract_cast", "amount", 1.0),
        ("contract_cast", "sku", 0.0),
        ("contract_null", "sku", 1.0),
    }


def test_the_target_is_reconciled_with_what_was_to_be_written(spark, tmp_path, monkeypatch):
    spec = shipments(spark, tmp_path, [("s1", "4", day(1)), ("s2", "5", day(2))])
    run = m.run_pipeline(spark, spec)
    assert [(q.observed, q.threshold) for q in run.quality if q.check == "reconcile"] == [(2.0, 2.0)]
    import millrace.plans.staging as staging

    def loses_a_row(df, *args, **kwargs):
        return m.write_table(df.filter("sku <> 's2'"), *args, **kwargs)

    monkeypatch.setattr(staging, "write_table", loses_a_row)
    with pytest.raises(m.QualityError, match="reconcile of rows: 1.0 against 2.0"):
        m.run_pipeline(spark, spec)


def test_text_is_parsed_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "csv")
    spark.range(50).selectExpr("id % 20 AS k", "id AS v").write.csv(path, header=True)
    spec = {
        "job_name": "text",
        "source": {"path": path, "format": "csv", "schema": "k string, v string", "options": {"header": True}},
        "target": {"path": str(tmp_path / "out")},
        "transforms": ["cleanse", {"step": "deduplicate", "subset": ["k"]}],
        "quality_checks": {"uniqueness_keys": ["k"]},
    }
    import millrace.plans.staging as staging

    inputs = []

    class Recorded(staging.StagedTable):
        def __init__(self, df, *args, **kwargs):
            inputs.extend(df.inputFiles())
            super().__init__(df, *args, **kwargs)

    def written(df, *args, **kwargs):
        inputs.extend(df.inputFiles())
        return m.write_table(df, *args, **kwargs)

    monkeypatch.setattr(staging, "StagedTable", Recorded)
    monkeypatch.setattr(staging, "write_table", written)
    run = m.run_pipeline(spark, spec)
    assert (run.rows_read, run.rows_written) == (50, 20)
    text = [f for f in inputs if f.endswith(".csv")]
    assert text and len(text) == len(set(text))
