"""Table statements for a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from sluice.schema import quote, spark_type
from sluice.spec import LakeSpec, TableSchema

# Formats whose tables take row-level changes.
ROW_LEVEL_FORMATS = ("iceberg", "delta", "hudi", "paimon")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(database: str) -> str:
    return f"CREATE DATABASE IF NOT EXISTS {quote(database)}"


def table_path(lake: LakeSpec, schema: TableSchema) -> str:
    return f"{lake.warehouse.rstrip('/')}/{lake.database}.db/{schema.table}"


def create_table(
    identifier: str,
    schema: TableSchema,
    fmt: str = "parquet",
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
    bucket_column: str | None = None,
    folders: Mapping[str, str] | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with NOT NULL columns and partitions.

    The primary key has no clause of its own in Spark, so it is kept as the ``primary-keys`` property. ``folders`` maps
    partition keys to the text columns that name their folders instead.
    """
    folders = folders or {}
    columns = []
    for f in schema.fields:
        columns.append(f"{quote(f.name)} {spark_type(f).simpleString().upper()}" + (" NOT NULL" if schema.required(f) else ""))
    partitions = [quote(folders.get(k, k)) for k in schema.partition_keys]
    columns += [f"{quote(name)} STRING" for key, name in folders.items() if name != key]
    if bucket_column:
        columns.append(f"{quote(bucket_column)} INT")
        partitions.append(quote(bucket_column))
    props = dict(properties or {})
    if schema.primary_keys:
        props["primary-keys"] = ",".join(schema.primary_keys)
    sql = f"CREATE TABLE IF NOT EXISTS {identifier} ({', '.join(columns)}) USING {fmt}"
    if partitions:
        sql += f" PARTITIONED BY ({', '.join(partitions)})"
    if location:
        sql += f" LOCATION {_text(location)}"
    if props:
        sql += " TBLPROPERTIES (" + ", ".join(f"{_text(k)} = {_text(v)}" for k, v in props.items()) + ")"
    return sql


def merge(identifier: str, schema: TableSchema, source: str, sequence: Sequence[str] = ()) -> str:
    """Whole-row upsert for a catalog with row-level operations; a row of a lower sequence changes nothing."""
    on = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in schema.primary_keys)
    newer = ""
    if sequence:
        side = lambda x: "struct(" + ", ".join(f"{x}.{quote(f)}" for f in sequence) + ")"
        newer = f" AND {side('s')} >= {side('t')}"
    return (
        f"MERGE INTO {identifier} AS t USING {source} AS s ON {on} "
        f"WHEN MATCHED{newer} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
