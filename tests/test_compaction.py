"""Compaction of the ledger while others read and append."""

import os
import threading
from datetime import datetime, timedelta

import pytest

import millrace as m
from conftest import plan, rows
from millrace.operators.ledger import LEDGER_SCHEMA
from millrace.sources import compaction
from millrace.sources.tables import driver_rows

T0 = datetime(2024, 1, 1)


def append(spark, path, job, run, n=0, status="SUCCESS"):
    row = (job, run, status, T0 + timedelta(hours=n), n, n, None, None, None, None)
    folder = f"{path}/job-{job}/run-{run}" if job else path
    m.append_run_events(driver_rows(spark, [row], LEDGER_SCHEMA), folder)


def ids(df):
    return sorted(((r["job_name"], r["run_id"]) for r in df.collect()), key=str)


def shown(spark, path):
    return ids(m.read_ledger(spark, path))


def small_files(path):
    """Data files outside hidden folders."""
    found = []
    for folder, _, names in os.walk(path):
        below = os.path.relpath(folder, path).split(os.sep)
        if not any(p.startswith("_") for p in below):
            found += [n for n in names if n.endswith(".parquet")]
    return found


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "led ger+%41")
    for n in range(6):
        append(spark, path, "a", f"r{n}", n)
    append(spark, path, "b", "r0")
    append(spark, path, "b", "r0", 1)
    append(spark, path, None, "flat")
    return path


def test_rows_are_the_same_and_files_are_fewer(spark, path):
    before = rows(m.read_ledger(spark, path))
    assert m.compact_ledger(spark, path, min_files=1) == 3
    after = m.read_ledger(spark, path)
    assert rows(after) == before and after.schema == LEDGER_SCHEMA
    assert len(after.inputFiles()) == 3
    assert shown(spark, f"{path}/job-a") == [("a", f"r{n}") for n in range(6)]
    assert len(m.read_ledger(spark, f"{path}/job-a").inputFiles()) == 1
    # Repeated rows stay: b's run was recorded twice.
    assert shown(spark, f"{path}/job-b") == [("b", "r0")] * 2


def test_a_job_is_read_without_listing_others(spark, path):
    m.compact_ledger(spark, path, min_files=1)
    named = m.read_ledger(spark, f"{path}/job-a").inputFiles()
    assert all("unit=-job-a" in f for f in named)
    assert "EqualTo(job_name,a)" in plan(m.last_success(m.read_ledger(spark, path), "a"))


def test_few_new_files_are_left_alone(spark, path):
    assert m.compact_ledger(spark, path, min_files=3) == 1  # a alone
    assert m.compact_ledger(spark, path, min_files=3) == 0
    append(spark, path, "a", "r6")
    assert m.compact_ledger(spark, path, min_files=3) == 0
    assert shown(spark, f"{path}/job-a") == [("a", f"r{n}") for n in range(7)]


def test_replaced_files_go_after_their_time(spark, path):
    before = rows(m.read_ledger(spark, path))
    old_plan = m.read_ledger(spark, path)
    m.compact_ledger(spark, path, min_files=1)
    assert len(small_files(path)) == 9 and rows(old_plan) == before
    m.compact_ledger(spark, path, min_files=1, keep_seconds=0)
    assert small_files(path) == [] and rows(m.read_ledger(spark, path)) == before
    append(spark, path, "a", "late")
    m.compact_ledger(spark, path, min_files=1, keep_seconds=0)
    m.compact_ledger(spark, path, min_files=1, keep_seconds=0)
    assert len(rows(m.read_ledger(spark, path))) == len(before) + 1
    assert m.compact_ledger(spark, path, min_files=1, keep_seconds=0) == 0


def test_files_and_work_grow_with_the_logarithm(spark, tmp_path):
    path = str(tmp_path / "l")
    merged = 0
    for n in range(16):
        append(spark, path, "a", f"r{n:02}", n)
        m.compact_ledger(spark, path, min_files=1, keep_seconds=0)
        number = compaction._Folder(spark, path).manifests()["job-a"]
        state = compaction._Folder(spark, path).manifest("job-a", number)
        assert len(state["files"]) <= 5
        merged += sum(f.startswith("../") for f in state["covers"])
        assert sum(state["files"].values()) == n + 1
    assert len(shown(spark, path)) == 16
    assert merged < 16 * 5


def test_an_append_during_a_compaction_is_kept(spark, path, monkeypatch):
    rewrite = compaction._rewrite

    def meanwhile(folder, *args):
        written = rewrite(folder, *args)
        append(spark, path, "a", "meanwhile")
        return written

    monkeypatch.setattr(compaction, "_rewrite", meanwhile)
    m.compact_ledger(spark, path, min_files=1)
    assert ("a", "meanwhile") in shown(spark, path)
    assert len(shown(spark, path)) == 10


def test_of_two_compactions_one_publishes(spark, path, monkeypatch):
    rewrite, published = compaction._rewrite, []

    def overtaken(folder, *args):
        written = rewrite(folder, *args)
        monkeypatch.setattr(compaction, "_rewrite", rewrite)
        published.append(m.compact_ledger(spark, path, min_files=1))
        return written

    before = rows(m.read_ledger(spark, path))
    monkeypatch.setattr(compaction, "_rewrite", overtaken)
    assert m.compact_ledger(spark, path, min_files=1) == 0
    assert published == [3] and rows(m.read_ledger(spark, path)) == before


def test_a_manifest_that_appears_while_a_reader_lists(spark, path, monkeypatch):
    m.compact_ledger(spark, path, min_files=1)
    append(spark, path, "a", "r6")
    listed = compaction._Folder.listed

    def slow(folder):
        found = listed(folder)
        monkeypatch.setattr(compaction._Folder, "listed", listed)
        m.compact_ledger(spark, path, min_files=1)
        return found

    monkeypatch.setattr(compaction._Folder, "listed", slow)
    assert shown(spark, f"{path}/job-a") == [("a", f"r{n}") for n in range(7)]


def test_a_compaction_that_dies_changes_nothing(spark, path, monkeypatch):
    before = rows(m.read_ledger(spark, path))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(compaction._Folder, "publish", dies)
        m.compact_ledger(spark, path, min_files=1)
    assert rows(m.read_ledger(spark, path)) == before
    assert len(os.listdir(f"{path}/_compacted")) == 1
    m.compact_ledger(spark, path, min_files=1, keep_seconds=0)
    assert len([f for f in os.listdir(f"{path}/_compacted") if not f.startswith(".")]) == 1
    assert rows(m.read_ledger(spark, path)) == before


def test_readers_and_writers_at_once(spark, tmp_path):
    path, seen, stop = str(tmp_path / "l"), [], threading.Event()
    append(spark, path, "a", "r00")

    def read():
        while not stop.is_set():
            found = shown(spark, path)
            assert len(found) == len(set(found))
            seen.append(len(found))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 9):
        append(spark, path, "a" if n % 3 else "b", f"r{n:02}")
        m.compact_ledger(spark, path, min_files=2)
    stop.set()
    reader.join()
    assert seen == sorted(seen) and len(shown(spark, path)) == 9


def test_hot_job_empty_files_and_refusals(spark, tmp_path):
    path = str(tmp_path / "l")
    hot = spark.range(3000).selectExpr("'hot' AS job_name", "cast(id AS string) AS run_id")
    m.append_run_events(hot.repartition(6), f"{path}/job-hot")
    m.append_run_events(hot.limit(0), f"{path}/job-none")
    append(spark, path, "a", "r0")
    m.compact_ledger(spark, path, min_files=1)
    assert m.read_ledger(spark, path).count() == 3001
    assert m.read_ledger(spark, f"{path}/job-none").count() == 0
    with pytest.raises(ValueError, match="one unit"):
        m.compact_ledger(spark, f"{path}/job-hot", min_files=1)


def test_runs_go_on_after_a_compaction(spark, tmp_path):
    source, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    spec = {
        "job_name": "j",
        "source": {"path": source, "incremental": {"column": "id"}},
        "target": {"path": str(tmp_path / "out"), "mode": "append"},
        "ledger": ledger,
    }
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).write.mode("append").parquet(source)
        run = m.run_pipeline(spark, spec)
        assert run.rows_read == 10
        m.compact_ledger(spark, ledger, min_files=1, keep_seconds=0)
    m.run_pipeline(spark, spec, run_id=run.run_id)
    assert sorted(r["id"] for r in spark.read.parquet(spec["target"]["path"]).collect()) == list(range(30))
