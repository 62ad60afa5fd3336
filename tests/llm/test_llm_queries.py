"""Queries with SQL against DuckDB; every query runs and has the columns of its contract."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from millrace.llm import queries as llm

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

COLUMNS = {
    "op1_": "vec_id n_links component_id kept",
    "op2_": "query_id rank vec_id score",
    "op3_": "doc_id n_shingles component_id kept",
    "op4_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_": "doc_id size source_size target taken",
    "op6_": "conv_id assistant part text mask",
    "op7_": "doc_id held_out lang_pred score",
    "op8_": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_": "doc_id held_out score predicted",
    "op10_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_": "doc_id n_bytes n_tokens over_limit",
    "op13_": "lang rank phrase a l r n score",
}


def test_all_thirteen_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert "pipeline" in names
    for prefix in COLUMNS:
        assert sum(n.startswith(prefix) for n in names) == 1


@pytest.mark.parametrize("prefix", sorted(COLUMNS))
def test_columns(spark, prefix):
    name = next(n for n in llm.QUERIES if n.startswith(prefix))
    result = llm.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert set(COLUMNS[prefix].split()) <= set(result.columns)


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = llm.QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    picked = ", ".join(f'"{c}"' for c in columns)
    wanted = duck.execute(f"SELECT {picked} FROM ({llm.ORACLE[name]})").fetchall()
    got = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
