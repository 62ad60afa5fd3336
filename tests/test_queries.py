"""Every registered query against its SQL in DuckDB: rows, column types and values."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
#: Queries of the training-data subpackage, where it is there, have tests of their own.
ADDED = set(entry_module._training_data()[0])


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) - ADDED == set(ORACLE) - ADDED


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ADDED))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]).split("(")[0] for d in expected.description}
    assert columns == sorted(types)

    actual_types = {f.name: f.dataType.simpleString() for f in result.schema}
    described = {
        r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    }
    assert {c: TYPES.get(t, t.upper()) for c, t in actual_types.items()} == described

    picked = ", ".join(f'"{c}"' for c in columns)
    wanted = duck.execute(f"SELECT {picked} FROM ({ORACLE[name]})").fetchall()
    got = [tuple(r) for r in result.select(*[f"`{c}`" for c in columns]).collect()]
    assert len(got) == len(wanted)
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 8
