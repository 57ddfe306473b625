"""Lookups of rows with heavy keys."""

import pytest
from pyspark.sql import functions as F

from sluice import ConfigError, heavy_keys, lookup_enrich


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows have key 5, a third none."""
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).cast("long")
    return spark.range(0, 30_000, 1, 8).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 30_000, 2).unionByName(spark.range(5, 6)).select("id", F.concat(F.lit("n"), "id").alias("name"))


@pytest.fixture
def as_on_a_stream(spark):
    """No broadcast that is not asked for, and nothing re-planned."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_heavy_keys_are_found(spark, rows):
    of = lambda value: spark.range(1).select(F.xxhash64(F.lit(value).cast("long"))).first()[0]
    assert set(heavy_keys(rows, ["k"])) == {of(5), of(None)}
    assert heavy_keys(rows, ["id"]) == [] and heavy_keys(rows.limit(0), ["k"]) == []
    assert len(heavy_keys(rows.withColumn("j", F.lit("x")), ["j", "k"], 0.3)) == 2


def test_no_task_holds_a_heavy_key(rows, names, as_on_a_stream):
    plain = lookup_enrich(rows, names, {"k": "id"}, ["name"])
    apart = lookup_enrich(rows, names, {"k": "id"}, ["name"], heavy_keys(rows, ["k"]))
    assert largest_task(plain) > 10_000 and largest_task(apart) < 4_000
    assert apart.columns == plain.columns and apart.exceptAll(plain).count() == plain.exceptAll(apart).count() == 0
    # named keys that are rare, or not there at all, change nothing
    odd = lookup_enrich(rows, names, {"k": "id"}, ["name"], [1, 2, *heavy_keys(rows.limit(10), ["k"], 0.01)])
    assert odd.exceptAll(plain).count() == plain.exceptAll(odd).count() == 0


def test_heavy_keys_on_a_stream(spark, rows, names, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = lookup_enrich(stream, names, {"k": "id"}, ["name"], heavy_keys(rows, ["k"]))
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
    assert query.trigger(availableNow=True).start().awaitTermination(60) is not False
    got, want = spark.read.parquet(str(tmp_path / "out")), lookup_enrich(rows, names, {"k": "id"}, ["name"])
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_types_must_agree(rows, names):
    with pytest.raises(ConfigError, match="same types"):
        lookup_enrich(rows, names.withColumn("id", F.col("id").cast("int")), {"k": "id"}, ["name"], [1])
