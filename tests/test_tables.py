"""Reading and writing datasets."""

import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import millrace as m
from conftest import plan, rows
from millrace.sources.tables import driver_rows


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [(1, "a", 2023), (2, "b", 2024), (3, None, 2024)], "id int, s string, year int"
    )


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_round_trip(spark, small, tmp_path, fmt):
    path = str(tmp_path / fmt)
    m.write_table(small, path, fmt)
    assert rows(m.read_table(spark, path, fmt, small.schema)) == rows(small)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_text_formats_keep_microseconds(spark, tmp_path, fmt):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2024, 1, 2, 3, 4, 5, 1))],
        "t timestamp, n timestamp_ntz",
    )
    path = str(tmp_path / fmt)
    m.write_table(df, path, fmt)
    assert rows(m.read_table(spark, path, fmt, df.schema)) == rows(df)


def test_csv_header_and_schemaless_names(spark, small, tmp_path):
    path = str(tmp_path / "c")
    m.write_table(small, path, "csv", options={"header": True})
    assert m.read_table(spark, path, "csv", options={"header": True}).columns == small.columns
    assert m.read_table(spark, path, "csv").columns == ["_c0", "_c1", "_c2"]


def test_unknown_formats_are_refused(spark, small, tmp_path):
    with pytest.raises(ValueError, match="orc"):
        m.read_table(spark, "x", "orc")
    with pytest.raises(ValueError, match="orc"):
        m.write_table(small, str(tmp_path / "x"), "orc")


def test_delta_is_accepted_by_name(spark, small, tmp_path):
    """Its package is not installed here, so the error is Spark's own."""
    with pytest.raises(Exception) as caught:
        m.read_table(spark, str(tmp_path / "x"), "delta").count()
    assert not isinstance(caught.value, ValueError)


def test_modes(spark, small, tmp_path):
    path = str(tmp_path / "t")
    m.write_table(small, path, mode="error")
    with pytest.raises(AnalysisException):
        m.write_table(small, path, mode="error")
    m.write_table(small, path, mode="ignore")
    assert spark.read.parquet(path).count() == 3
    m.write_table(small, path, mode="append")
    assert spark.read.parquet(path).count() == 6
    m.write_table(small, path)
    assert spark.read.parquet(path).count() == 3


def test_overwrite_leaves_other_partitions(spark, small, tmp_path):
    path = str(tmp_path / "t")
    m.write_table(small, path, partition_by=["year"])
    rerun = spark.createDataFrame([(9, "z", 2024)], small.schema)
    for _ in range(2):
        m.write_table(rerun, path, partition_by=["year"])
        assert rows(spark.read.parquet(path)) == [(1, "a", 2023), (9, "z", 2024)]


def test_partition_filter_reaches_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "t")
    m.write_table(small, path, partition_by=["year"])
    text = plan(m.read_table(spark, path).filter("year = 2024 AND id > 1"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "GreaterThan(id,1)" in text


def test_rows_are_gathered_before_a_partitioned_write(spark, tmp_path):
    df = spark.range(0, 8000, 1, 16).select("id", (F.col("id") % 4).alias("p"))
    gathered, scattered = str(tmp_path / "g"), str(tmp_path / "s")
    m.write_table(df, gathered, partition_by=["p"])
    m.write_table(df, scattered, partition_by=["p"], rebalance=False)

    def files(path):
        return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)

    assert files(gathered) == 4
    assert files(scattered) == 64
    assert rows(spark.read.parquet(gathered)) == rows(spark.read.parquet(scattered))


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    """One partition value with most of the rows is written by several tasks."""
    df = spark.range(0, 400_000, 1, 16).select(
        F.md5(F.col("id").cast("string")).alias("v"), F.expr("if(id % 100 = 0, 1, 0)").alias("p")
    )
    path = str(tmp_path / "t")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        m.write_table(df, path, partition_by=["p"])
    finally:
        spark.conf.set(size, before)
    names = [n for n in os.listdir(f"{path}/p=0") if n.endswith(".parquet")]
    assert len(names) > 4
    assert spark.read.parquet(path).count() == 400_000


def test_raw_landing(spark, small, tmp_path):
    root = str(tmp_path / "raw")
    path = m.land_raw(small, root, "people", "2024-01-15")
    m.land_raw(small, root + "/", "people", "2024-01-16")
    landed = spark.read.parquet(path)
    assert path == f"{root}/people"
    assert landed.count() == 6
    assert rows(landed.filter("ingest_date = DATE'2024-01-16'").drop("ingest_date")) == rows(small)


def test_staged_table(spark, small):
    wide = small.withColumn("odd name.x", F.lit(1)).repartition(3)
    staged = m.StagedTable(wide, [F.count(F.lit(1)).alias("n"), F.count("s").alias("s")], ["year"])
    assert staged.metrics == {"n": 3, "s": 2}
    assert staged.df.columns == wide.columns
    assert rows(staged.df) == rows(wide)
    assert staged.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    staged.drop()
    assert not os.path.exists(staged.path)


def test_driver_rows(spark):
    schema = T.StructType(
        [
            T.StructField("odd `name", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("t", T.TimestampNTZType()),
            T.StructField("d", T.DoubleType()),
        ]
    )
    data = [
        ("it's \\ ? :x 'q'", 2**40, datetime(2024, 1, 2, 3, 4, 5, 678901), 1.5),
        (None, None, None, None),
    ]
    df = driver_rows(spark, data, schema)
    assert df.schema.simpleString() == schema.simpleString()
    assert rows(df) == sorted(data, key=repr)
    assert rows(driver_rows(spark, [data[1]], schema)) == [data[1]]
    empty = driver_rows(spark, [], schema)
    assert empty.schema.simpleString() == schema.simpleString() and rows(empty) == []
    assert "ExistingRDD" not in plan(df) and "LocalTableScan" in plan(df)


def test_shared_folder_comes_from_the_session(spark):
    assert m.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert m.new_folder(spark, "x") != m.new_folder(spark, "x")


def test_reading_is_lazy_about_columns(spark, small, tmp_path):
    path = str(tmp_path / "t")
    m.write_table(small, path)
    assert "ReadSchema: struct<id:int>" in plan(m.read_table(spark, path).select("id"))


class Session:
    """Just enough of a session to ask for its settings."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        m.shared_folder(Session(**{"spark.master": "yarn"}))
    named = Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///marks/"})
    assert m.shared_folder(named) == "hdfs:///marks"
    for folder in ("file:/tmp/x", "file:///tmp/x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            m.shared_folder(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": folder}))


class OnCluster(Session):
    """A session with settings of a cluster, whose reader sees some files only where asked to."""

    def __init__(self, spark, files="*", **settings):
        super().__init__(**{"spark.master": "spark://host:7077"} | settings)
        self.spark, self.files = spark, files

    @property
    def read(self):
        return self.spark.read.option("pathGlobFilter", self.files)

    def __getattr__(self, name):
        return getattr(self.spark, name)


def test_a_cluster_may_name_a_mount_that_its_executors_share(spark, small, tmp_path):
    for folder in (tmp_path / "a", f"file://{tmp_path}/b/"):
        session = OnCluster(spark, **{"spark.checkpoint.dir": str(folder)})
        path = m.new_folder(session, "orders")
        assert path.startswith("file:/") and f"{tmp_path}/" in path
        assert not list(tmp_path.glob("*/trial-*"))
        m.write_table(small, path)
        assert rows(m.read_table(session, path)) == rows(small)
    warehouse = OnCluster(spark, **{"spark.sql.warehouse.dir": f"file:{tmp_path}/w"})
    assert m.shared_folder(warehouse) == f"file:{tmp_path}/w"


def test_a_cluster_may_not_name_a_folder_that_loses_files(spark, tmp_path):
    for folder, files in ((tmp_path / "c", "part-00000*"), ("/proc/none", "*")):
        session = OnCluster(spark, files, **{"spark.checkpoint.dir": str(folder)})
        for _ in range(2):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                m.shared_folder(session)


def test_a_local_session_falls_back_to_the_warehouse_and_keeps_its_settings():
    settings = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/data/warehouse"}
    local = Session(**settings)
    assert m.shared_folder(local) == "file:/data/warehouse"
    assert local.settings == settings


def test_landing_a_day_again_replaces_it(spark, small, tmp_path):
    root = str(tmp_path / "raw")
    for day in ("2024-01-15", "2024-01-16", "2024-01-15"):
        path = m.land_raw(small, root, "people", day)
    assert spark.read.parquet(path).count() == 2 * small.count()
    m.land_raw(small, root, "people", "2024-01-15", append=True)
    assert spark.read.parquet(path).count() == 3 * small.count()


def test_overwriting_partitions_or_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    m.write_table(both, path, partition_by=["p"])
    m.write_table(both.filter("p = 'a'"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 2
    m.write_table(both.filter("p = 'a'"), path, partition_by=["p"], replace="table")
    assert rows(spark.read.parquet(path)) == [(1, "a")]
    with pytest.raises(ValueError, match="replace"):
        m.write_table(both, path, replace="rows")
