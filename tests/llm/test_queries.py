"""The registered queries that SQL can express, against that SQL."""

import duckdb
import pytest

from sluice.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = duck.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    rows = sorted((tuple(r[k] for k in order) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == rows


def test_every_operator_is_registered():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_minhash", "op2_decontaminate", "op3_extendible_shards", "op4_quality_rules", "op5_suffix_dedup",
        "op6_mix", "op7_secrets", "op8_warc", "op9_fuzzy_lines", "op10_token_counts",
        "op11_prefix_trie", "op12_resample", "op13_packing",
    ]
