"""The check registry and the inputs the checks share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import apply_conf, shared_dir, ship_package

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None):
    """Register the function under its own name with the SQL that gives the same rows."""

    def add(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            ship_package(spark, Path(__file__).resolve().parent)  # the scorers live here
            return run(spark, sf_dir)

        CHECKS[run.__name__] = Check(configured, sql)
        return run

    return add


def register(name: str, run: Query, sql: str | None) -> None:
    run.__name__ = name
    check(sql)(run)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with holes: no type on errors, no value on views."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(kind != "error", kind).alias("event_type"),
        F.when(kind != "view", F.col("value")).alias("value"),
        "props",
    )


SPARSE = (
    "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, "
    "CASE WHEN event_type <> 'view' THEN value END AS value, props FROM events)"
)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns))


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder in the shared area for a table a check writes."""
    return f"{shared_dir(spark)}/sluice-checks/{what}-{uuid.uuid4().hex}"
