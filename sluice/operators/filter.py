"""Row filter step."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.functions.predicates import predicate
from sluice.spec import FilterRule


def filter_rows(df: DataFrame, rule: FilterRule) -> DataFrame:
    """Keep the rows for which the rule holds."""
    return df.filter(predicate(rule, df.schema))
