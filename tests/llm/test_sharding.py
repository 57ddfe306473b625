from collections import defaultdict

import pytest

from clashes import unharmed
from sluice.llm import sharding


@pytest.mark.parametrize("limit", [20_000, 300_000, 1 << 40])
def test_shards_fit_and_only_full_buckets_split(given, limit):
    rows = sharding.shard(given, limit).withColumn("b", sharding.text_bytes()).collect()
    assert len(rows) == given.count()
    sizes, prefixes = defaultdict(int), set()
    for r in rows:
        sizes[r.shard] += r.b
        assert len(r.shard) == r.depth
    for shard, size in sizes.items():
        own = [r for r in rows if r.shard == shard]
        assert {r.shard_bytes for r in own} == {size} and {r.shard_rows for r in own} == {len(own)}
        assert size <= limit or len(own) == 1
        prefixes.add(shard)
    for shard in prefixes:
        assert not any(other != shard and other.startswith(shard) for other in prefixes)
        parent = shard[:-1]
        assert shard == "" or sum(s for p, s in sizes.items() if p.startswith(parent)) > limit  # its parent had to split


def test_odd_rows(odd, nothing):
    out = sharding.shard(odd, 1000)
    assert sorted(out.columns) == sorted({*odd.columns, "shard", "depth", "shard_bytes", "shard_rows"})
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.shard is not None for r in rows)
    assert unharmed(out, "shard", "depth")
    twins = {r.shard for r in rows if r.doc_id == 10_001}
    assert len(twins) == 1
    assert sharding.shard(nothing, 1000).count() == 0


def test_reruns_agree_whatever_the_partitions(given):
    first = {(r.doc_id, r.shard) for r in sharding.shard(given, 50_000).collect()}
    assert first == {(r.doc_id, r.shard) for r in sharding.shard(given.repartition(7), 50_000).collect()}


def test_equal_rows_share_a_shard_above_the_limit(spark):
    same = spark.createDataFrame([(1, "x" * 100)] * 20 + [(2, "y")], "doc_id long, text string")
    rows = sharding.shard(same, 500).collect()
    assert {r.shard_bytes for r in rows if r.doc_id == 1} == {2000} and {r.shard_bytes for r in rows if r.doc_id == 2} == {1}
