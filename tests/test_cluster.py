"""Queries that write tables of their own, on sessions whose first named folder does not serve."""

import os

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as entry_module
import millrace as m

SF_DIR = "/root/testdata/sf0.001"
#: Findings F2 to F22, which a cluster refused for its folder.
WRITING = """append_roundtrip cdc_merge clustered_read curated_view event_log_errors
incremental_reload incremental_replay last_success ledger_compacted partition_pruned_read
partitioned_roundtrip profile_merged raw_landing read_csv read_json run_metrics run_state
schema_evolution staging_job staging_reload stream_landing""".split()


class Elsewhere:
    """The given session under other settings."""

    def __init__(self, spark, master, **folders):
        self.spark, self.conf = spark, self
        self.settings = {"spark.master": master} | folders

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def __getattr__(self, name):
        return getattr(self.spark, name)


def elsewhere(spark, master, first, second):
    folders = {"spark.checkpoint.dir": str(first), "spark.sql.warehouse.dir": str(second)}
    return Elsewhere(spark, master, **folders)


@pytest.mark.parametrize("name", WRITING)
def test_query_writes_to_the_folder_that_serves(spark, tmp_path, name):
    session = elsewhere(spark, "spark://host:7077", "/proc/none", f"file:{tmp_path}/shared")
    result = entry_module.queries()[name](session, SF_DIR)
    columns = sorted(result.columns)
    with duckdb.connect() as duck:
        for file in os.listdir(SF_DIR):
            duck.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
        picked = ", ".join(f'"{c}"' for c in columns)
        wanted = duck.execute(f"SELECT {picked} FROM ({entry_module.oracle_sql()[name]})").fetchall()
    assert rows(result.select(*columns)) == sorted(wanted, key=repr)
    assert os.listdir(f"{tmp_path}/shared") and not list(tmp_path.glob("shared/trial-*"))


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_the_warehouse_serves_where_the_first_folder_does_not(spark, tmp_path, master):
    first, second = f"file:{tmp_path}/first", f"file:{tmp_path}/second"
    assert m.shared_folder(elsewhere(spark, master, first, second)) == first
    assert m.shared_folder(elsewhere(spark, master, "/proc/none", second)) == second
    assert m.shared_folder(elsewhere(spark, master, "file:/proc/none", second)) == second
    assert not list(tmp_path.glob("*/trial-*"))


def test_the_refusal_says_what_became_of_each_folder(spark):
    session = elsewhere(spark, "spark://host:7077", "/proc/none", "file:/proc/other")
    with pytest.raises(ValueError, match="spark.checkpoint.dir.*file:/proc/none.*file:/proc/other"):
        m.shared_folder(session)
