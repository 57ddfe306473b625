"""Every registered query against its oracle SQL, on the smallest tables."""

import importlib.util
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry_module)
OWN = set(entry_module.CHECKS)  # others have tests beside them
QUERIES = {k: v for k, v in entry_module.queries().items() if k in OWN}
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value) if isinstance(value, Decimal) else repr(value)


def ordered(columns, rows):
    index = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in index) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = ordered(df.columns, df.collect())
    assert got and got == ordered(columns, result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
