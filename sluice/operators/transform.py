"""Projection step: field mappings as one ``select``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.mappings import mapping
from sluice.schema import ref, spark_type
from sluice.spec import TableSchema, TransformRule


def transform_rows(
    df: DataFrame,
    rule: TransformRule,
    declared: TableSchema | None = None,
    output_schema: TableSchema | None = None,
) -> DataFrame:
    """Apply all mappings to the input row at once.

    Without ``output_schema`` the input columns stay and new outputs are appended; with it the result
    has exactly its columns, an output it does not name is dropped, and a column nothing fills is
    null. A later mapping to the same output wins. ``declared`` gives constants the type of the
    column they fill.
    """
    schema = df.schema
    made = {m.output: mapping(m, schema, output_schema or declared) for m in rule.mappings}
    if output_schema is None:
        names = [*schema.names, *(n for n in made if n not in schema.names)]
        return df.select(*(made.get(n, ref(n)).alias(n) if n in made else ref(n) for n in names))
    out = []
    for f in output_schema.fields:
        if f.name in made:
            out.append(made[f.name].alias(f.name))
        elif f.name in schema.names:
            out.append(ref(f.name))
        else:
            out.append(F.lit(None).cast(spark_type(f)).alias(f.name))
    return df.select(*out)
