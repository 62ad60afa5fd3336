"""The run ledger, the event log and incremental loads."""

from datetime import datetime, timedelta

import pytest

import millrace as m
from conftest import plan, rows
from millrace.operators.ledger import LEDGER_SCHEMA

EVENT = LEDGER_SCHEMA[:8]  # rows without marks and launches

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.fixture
def ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    events = [
        ("a", "r9", "RUNNING", at(0), None, None, None, None),
        ("a", "r9", "SUCCESS", at(1), 10, 9, "5", None),
        ("a", "r1", "RUNNING", at(2), None, None, None, None),
        ("a", "r1", "SUCCESS", at(4), 20, 18, "7", None),
        ("a", "r5", "RUNNING", at(5), None, None, None, None),
        ("a", "r5", "FAILED", at(6), 3, None, None, "x" * 3000),
        ("b", "r1", "RUNNING", at(1), None, None, None, None),
    ]
    for event in events:
        m.append_run_events(spark.createDataFrame([event], EVENT), path)
    return m.read_ledger(spark, path)


def test_state_keeps_the_start_time(ledger):
    got = {(r["job_name"], r["run_id"]): r for r in m.run_state(ledger).collect()}
    assert len(got) == 4
    done = got["a", "r1"]
    assert (done["status"], done["start_time"], done["end_time"]) == ("SUCCESS", at(2), at(4))
    assert (done["rows_read"], done["rows_written"]) == (20, 18)
    running = got["b", "r1"]
    assert (running["status"], running["start_time"], running["end_time"]) == ("RUNNING", at(1), None)


def test_errors_are_kept_whole_unless_a_length_is_given(spark, ledger, tmp_path):
    failed = m.run_state(ledger).filter("status = 'FAILED'").first()
    assert set(failed["error_message"]) == {"x"} and len(failed["error_message"]) > 1000
    path = str(tmp_path / "short")
    m.append_run_events(ledger, path, error_length=7)
    short = m.run_state(m.read_ledger(spark, path)).filter("status = 'FAILED'").first()
    assert short["error_message"] == "x" * 7


def test_last_success_goes_by_time_not_by_run_id(ledger):
    last = m.last_success(ledger, "a").collect()
    assert [(r["run_id"], r["watermark"]) for r in last] == [("r1", "7")]
    assert m.last_success(ledger, "b").collect() == []
    assert m.last_success(ledger, "nobody").collect() == []
    assert [(r["job_name"], r["run_id"]) for r in m.last_success(ledger).collect()] == [("a", "r1")]


def test_job_filter_reaches_the_scan(ledger):
    assert "EqualTo(job_name,a)" in plan(m.last_success(ledger, "a"))


def test_a_run_that_starts_again_is_running(spark, ledger, tmp_path):
    again = spark.createDataFrame(
        [("a", "r5", "RUNNING", at(9), None, None, None, None)], EVENT
    )
    state = m.run_state(ledger.unionByName(again, True)).filter("job_name = 'a' AND run_id = 'r5'").first()
    assert (state["status"], state["start_time"], state["end_time"]) == ("RUNNING", at(5), None)


def test_events_may_leave_out_columns(spark, tmp_path):
    path = str(tmp_path / "l")
    m.append_run_events(spark.createDataFrame([("j", "r", "RUNNING")], "job_name string, run_id string, status string"), path)
    assert m.read_ledger(spark, path).schema == LEDGER_SCHEMA
    assert m.read_ledger(spark, path).first()["event_time"] is None


def test_metrics(ledger):
    a = {r["job_name"]: r for r in m.run_metrics(ledger).collect()}["a"]
    assert (a["runs"], a["succeeded"], a["failed"], a["running"]) == (3, 2, 1, 0)
    assert (a["rows_read"], a["rows_written"]) == (33, 27)
    assert (a["total_seconds"], a["longest_seconds"]) == (4 * 3600, 2 * 3600)
    assert a["success_rate"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("mark", ["2024-01-01 01:00:00", at(1)])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_incremental_filter(spark, tmp_path, kind, mark):
    path = str(tmp_path / "t")
    data = [(1, at(0)), (2, at(1)), (3, at(2)), (4, None)]
    spark.createDataFrame(data, f"id int, t {kind}").write.parquet(path)
    df = spark.read.parquet(path)
    newer = m.incremental_filter(df, "t", mark)
    assert [r[0] for r in rows(newer)] == [3]
    assert "GreaterThan(t," in plan(newer)
    assert m.incremental_filter(df, "t", None).count() == 4


def test_event_log(spark, tmp_path):
    path = str(tmp_path / "log")
    events = spark.createDataFrame(
        [(at(1), "ERROR", "j", "e1", 1), (at(3), "ERROR", "j", "e2", 2), (at(2), "INFO", "j", "e3", 3)],
        "timestamp timestamp_ntz, level string, job_name string, event string, rows_in long",
    )
    m.append_log_events(events, path)
    found = m.logged_events(m.read_event_log(spark, path))
    assert [r["event"] for r in found.collect()] == ["e2", "e1"]
    assert found.columns == ["timestamp", "job_name", "event", "rows_in", "rows_out"]
