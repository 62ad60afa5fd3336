"""Declared schemas, drift, casting and contract checks."""

import json

import pytest
from pyspark.sql import types as T

import millrace as m
from conftest import plan, rows

DECLARED = [
    {"name": "id", "type": "long", "nullable": False},
    {"name": "born", "type": "date"},
    {"name": "score", "type": "double", "nullable": True},
]


def test_type_names():
    names = ["string", "integer", "long", "double", "float", "boolean", "timestamp", "date"]
    got = m.schema_from_spec([{"name": n, "type": n} for n in names])
    assert [f.dataType for f in got] == [
        T.StringType(),
        T.IntegerType(),
        T.LongType(),
        T.DoubleType(),
        T.FloatType(),
        T.BooleanType(),
        T.TimestampType(),
        T.DateType(),
    ]


def test_other_types_are_spark_types(spark):
    fields = {
        "fields": [
            {"name": "p", "type": "decimal(12,2)", "nullable": False},
            {"name": "a", "type": "array<float>"},
            {"name": "t", "type": "timestamp_ntz"},
        ]
    }
    got = m.schema_from_spec(fields)
    assert got.simpleString() == "struct<p:decimal(12,2),a:array<float>,t:timestamp_ntz>"
    assert [f.nullable for f in got] == [False, True, True]
    with pytest.raises(ValueError, match="nonsense"):
        m.schema_from_spec([{"name": "x", "type": "nonsense("}])


def test_no_drift_whatever_the_order_and_nullability(spark):
    df = spark.createDataFrame([], "score double, id bigint, born date")
    assert rows(m.schema_drift(df, DECLARED)) == []
    assert rows(m.drift_report(df, DECLARED)) == []


def test_drift_kinds(spark):
    df = spark.createDataFrame([], "ID bigint, born timestamp, score double, extra int")
    assert [tuple(r) for r in m.schema_drift(df, DECLARED).collect()] == [
        ("id", "missing", "bigint", None),
        ("ID", "new", None, "bigint"),
        ("extra", "new", None, "int"),
        ("born", "type", "date", "timestamp"),
    ]


def test_drift_sees_precision_and_time_zones(spark):
    df = spark.createDataFrame([], "p decimal(10,2), t timestamp_ntz")
    declared = [{"name": "p", "type": "decimal(12,2)"}, {"name": "t", "type": "timestamp"}]
    assert [r["column"] for r in m.schema_drift(df, declared).collect()] == ["p", "t"]


def test_drift_report_counts_rows(spark):
    df = spark.createDataFrame([("1", "x"), ("q", None), (None, None)], "id string, extra string")
    assert rows(m.drift_report(df, DECLARED)) == sorted(
        [
            ("born", "missing", "date", None, 3),
            ("score", "missing", "double", None, 3),
            ("extra", "new", None, "string", 1),
            ("id", "type", "bigint", "string", 1),
        ],
        key=repr,
    )


def test_cast(spark):
    df = spark.createDataFrame([("7", "2024-01-02", "1.5", "k"), ("x", "?", None, "k")], "id string, born string, score string, keep string")
    out = m.cast_to_schema(df, DECLARED)
    assert out.schema.simpleString() == "struct<id:bigint,born:date,score:double,keep:string>"
    assert [r["id"] for r in out.collect()] == [7, None]
    assert out.collect()[0]["score"] == 1.5
    same = spark.createDataFrame([(1,)], "id bigint")
    assert rows(m.cast_to_schema(same, DECLARED)) == [(1,)]


def test_contract(spark):
    df = spark.createDataFrame([("7", "?"), (None, None), ("z", "2024-01-01")], "id string, born string")
    got = {r["column"]: r for r in m.contract_violations(df, DECLARED).collect()}
    assert (got["id"]["null_violations"], got["id"]["cast_failures"]) == (1, 1)
    assert (got["born"]["null_violations"], got["born"]["cast_failures"]) == (0, 1)
    assert got["score"]["passed"] and not got["id"]["passed"]
    required = m.contract_violations(df, [{"name": "x", "type": "date", "nullable": False}])
    assert required.first()["null_violations"] == 3
    assert plan(m.contract_violations(df, DECLARED)).count("Exchange") == 1


def test_contract_where_no_cast_exists(spark):
    df = spark.createDataFrame([([1],), (None,)], "a array<int>")
    got = m.contract_violations(df, [{"name": "a", "type": "integer"}]).first()
    assert got["cast_failures"] == 1


def test_declared_schema_from_a_file(spark, tmp_path):
    path = tmp_path / "people.json"
    path.write_text(json.dumps({"fields": DECLARED}, indent=2))
    fields = m.load_fields(spark, str(path))
    assert m.schema_from_spec(fields) == m.schema_from_spec(DECLARED)
