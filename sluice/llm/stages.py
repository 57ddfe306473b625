"""The pipeline's stages; each takes (spark, docs, sf_dir) and returns the rows it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, minhash, mixing, quality, sharding
from sluice.llm.common import prepare, table

SHARD_BYTES = 1 << 20


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from those labelled."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is similar by 0.8 or more on five-word shingles."""
    prepare(spark)
    return minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    prepare(spark)
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    prepare(spark)
    return sharding.shard(docs, SHARD_BYTES)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]
