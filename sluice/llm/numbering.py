"""Consecutive numbers along an order of all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.common import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` written in ``order`` (which should tell all rows apart), with ``name`` counting from 0.

    Rows are dealt out by ranges of the order, so equal leading keys do not share a task; only the row counts of
    the ranges, at most one per shuffle partition, are brought together.
    """
    along = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(along.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + within).drop("_at", "_part", "_start")
