import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clashes import unharmed
from sluice.llm import mixing


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in above)
        free -= above
    return target


def check(df, **options):
    rows = df.select("doc_id", "source", mixing.word_count().alias("size")).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    target = expected_targets(sizes)
    pieces = mixing.draw(df, **options).cache()
    got = mixing.taken(pieces).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
    per_source = {r.source: r for r in pieces.groupBy("source").agg(F.max("target").alias("t"), F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))).alias("w")).collect()}
    for s, t in target.items():
        assert math.isclose(per_source[s].t, t, rel_tol=1e-9, abs_tol=1e-9)
        assert (per_source[s].w or 0) == math.floor(t + 0.5)
    drawn = pieces.filter("shard IS NOT NULL")
    assert drawn.groupBy("source", "round", "block").agg(F.count_distinct("shard").alias("n")).filter("n > 1").isEmpty()  # shards are disjoint
    return pieces, got


def test_targets_are_met_to_the_word(given):
    pieces, got = check(given, block_words=256, shard_words=20_000)
    sizes = [r.n for r in pieces.filter("shard IS NOT NULL").groupBy("shard").agg(F.count_distinct("source", "round", "block").alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) - min(sizes) <= len(sizes) + 1  # equal numbers of blocks; empty trimmed ends aside
    again = sorted((r.doc_id, r.taken, r.shards) for r in mixing.taken(mixing.draw(given.repartition(5), block_words=256, shard_words=20_000)).collect())
    assert again == sorted((r.doc_id, r.taken, r.shards) for r in got)


def test_odd_rows(odd, nothing):
    check(odd, block_words=64, shard_words=5000)
    assert mixing.taken(mixing.draw(nothing)).count() == 0
    drawn = mixing.mixed(odd)
    assert drawn.columns == odd.columns and drawn.count() > 0 and unharmed(drawn) and mixing.mixed(nothing).count() == 0


def test_documents_come_as_often_as_they_are_taken(given):
    got = {r.doc_id: r.taken / r["size"] for r in mixing.taken(mixing.draw(given)).collect() if r["size"]}
    copies = {r.doc_id: r.n for r in mixing.mixed(given).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(copies.get(i, 0) == math.floor(t + 0.5) for i, t in got.items())


@pytest.mark.parametrize("good, total, draws", [(5, 10, 4), (1, 50, 7), (40, 100, 30), (700, 5000, 2500), (0, 9, 3), (9, 9, 3)])
def test_hypergeometric_draws(spark, good, total, draws):
    n = 4000
    df = spark.range(n).select(
        mixing.hypergeometric(*(F.lit(x).cast("long") for x in (good, total, draws)), (F.col("id") + 0.5) / n).alias("k")
    )
    got = np.array([r.k for r in df.collect()])
    assert (np.diff(got) >= 0).all() and got.min() >= max(0, draws - (total - good)) and got.max() <= min(draws, good)
    mean = draws * good / total
    var = mean * (1 - good / total) * (total - draws) / max(1, total - 1)
    assert abs(got.mean() - mean) < 0.02 + 0.01 * math.sqrt(var) and abs(got.var() - var) <= 0.02 + 0.02 * var


def test_quotas_are_dealt_whole(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0), (3, 1000)], "rank int, quota long")
    rows = mixing.split_quotas(quotas, 9, 3).collect()
    for rank, quota in ((0, 100), (1, 7), (3, 1000)):
        own = sorted((r.first, r.quota) for r in rows if r.rank == rank)
        assert sum(q for _, q in own) == quota and [f for f, _ in own] == [sum(q for _, q in own[:k]) for k in range(len(own))]
    per_shard = [sum(r.quota for r in rows if r.shard == s) for s in range(9)]
    assert max(per_shard) - min(per_shard) <= 1


def test_words(spark):
    df = spark.createDataFrame([("a b c\x0bd",), ("",), (None,)], "text string")
    assert [r[0] for r in df.select(mixing.word_count()).collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", "a b c\x0bd")), 0, 0]
