"""Registered queries of the folder: SQL twins give the same rows, and the contract names them all."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
from marketlake.llm.queries import ORACLE, QUERIES  # noqa: E402


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(QUERIES)
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {name.split("_")[0] for name in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, tables, name):
    con = duckdb.connect()
    for table in compare.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tables}/{table}.parquet')")
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    frame = contract.queries()[name](spark, tables)
    assert sorted(frame.columns) == sorted(columns)
    assert compare._rows(frame.columns, [tuple(r) for r in frame.collect()]) == compare._rows(columns, found.fetchall())
