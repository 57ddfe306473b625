"""The corpus pipeline: documents in, deduplicated, decontaminated and mixed shards out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import prepare, table, written
from sluice.llm.stages import STAGES

#: No SQL: near-duplicates, learned rules and the mix can't be expressed; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
