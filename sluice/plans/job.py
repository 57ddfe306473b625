"""Run a job end to end: decode, steps, target table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from sluice.operators.aggregate import WINDOW_COLUMN
from sluice.operators.inference import ScorerFactory
from sluice.plans.chain import Chain
from sluice.plans.needs import needed_fields
from sluice.operators.enrich import latest_per_key
from sluice.schema import check_on_null, conform, ref
from sluice.session import apply_conf, path_exists, remove_path
from sluice.sinks import ddl
from sluice.sinks.keyed import BUCKET_COLUMN, KeyedTable, folder_column, set_aside, with_folders, write_batch
from sluice.sources.decode import decode_json
from sluice.sources.messages import SOURCE_COLUMN
from sluice.spec import ConfigError, JobSpec

# Table properties the engine acts on; all others are passed through.
BUCKET_PROPERTY = "bucket"
CHANGELOG_PROPERTY = "changelog-producer"
SEQUENCE_PROPERTY = "sequence.field"
_DEFAULT_BUCKETS = 8


def rows_of(
    job: JobSpec,
    messages: DataFrame,
    scorers: Mapping[str, ScorerFactory] | None = None,
    on_bad_record: str = "fail",
    keep_hidden: bool = False,
    chain: Chain | None = None,
) -> DataFrame:
    """Messages decoded and taken through the job's steps, or those of ``chain``, before conformance.

    Fields that the job's steps make nothing of are not looked for in the messages, and null; a ``chain`` may look at any.
    """
    fields = needed_fields(job, sequence_fields(job)) if chain is None else None
    decoded = decode_json(messages, job.schema, on_bad_record, fields=fields)
    return (chain or Chain.from_job(job, scorers)).apply(decoded, keep_hidden)


def batch_result(
    job: JobSpec,
    messages: DataFrame,
    scorers: Mapping[str, ScorerFactory] | None = None,
    on_bad_record: str = "fail",
    on_null: str = "fail",
    chain: Chain | None = None,
) -> DataFrame:
    """The job over a batch of messages, in the declared schema.

    ``chain`` replaces the job's own steps: ``Chain.from_job(job).add(own)`` or any other steps.
    """
    return conform(rows_of(job, messages, scorers, on_bad_record, chain=chain), job.schema, on_null)


def table_of(spark: SparkSession, job: JobSpec, name: str | None = None) -> KeyedTable:
    """The job's keyed target table; ``name`` is what :func:`ensure_table` returned, if it was called."""
    if job.lake is None:
        raise ConfigError(f"job {job.name!r}: no target table is configured")
    props = job.lake.table_properties
    buckets = int(props.get(BUCKET_PROPERTY, -1))  # -1 leaves the number to the engine
    if buckets < 1 and buckets != -1:
        raise ConfigError(f"job {job.name!r}: {BUCKET_PROPERTY} must be positive, or -1")
    return KeyedTable(
        spark,
        ddl.table_path(job.lake, job.schema),
        job.schema,
        buckets if buckets > 0 else _DEFAULT_BUCKETS,
        changelog=props.get(CHANGELOG_PROPERTY) == "input",
        name=name,
        sequence=tuple(sequence_fields(job)),
    )


def sequence_fields(job: JobSpec) -> list[str]:
    """The declared sequence fields, which order the rows of a key in and across batches."""
    field = job.lake.table_properties.get(SEQUENCE_PROPERTY) if job.lake else None
    return [f.strip() for f in field.split(",")] if field else []


def ensure_table(spark: SparkSession, job: JobSpec, fmt: str = "parquet") -> str:
    """Create the job's database and table where they are missing; returns the table's name.

    With a row-level format the table goes into the job's catalog, which must be configured as
    ``spark.sql.catalog.<name>``; a Parquet table goes into the session catalog at the warehouse path.
    """
    lake = job.lake
    if lake is None:
        raise ConfigError(f"job {job.name!r}: no target table is configured")
    parts = [lake.database, job.schema.table]
    row_level = fmt in ddl.ROW_LEVEL_FORMATS
    if row_level:
        parts.insert(0, lake.catalog_name)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ddl.quote(parts[0])}.{ddl.quote(parts[1])}")
    else:
        spark.sql(ddl.create_database(lake.database))
    identifier = ".".join(ddl.quote(p) for p in parts)
    keyed = bool(job.schema.primary_keys) and not row_level
    spark.sql(
        ddl.create_table(
            identifier,
            job.schema,
            fmt,
            lake.table_properties,
            None if row_level else ddl.table_path(lake, job.schema),
            BUCKET_COLUMN if keyed else None,
            None if row_level else {k: folder_column(job.schema, k) for k in job.schema.partition_keys},
        )
    )
    foldered = keyed or (job.schema.partition_keys and not row_level)
    if foldered and path_exists(spark, ddl.table_path(lake, job.schema)):
        # a table found at its path already has folders the catalog may not know
        spark.sql(f"ALTER TABLE {identifier} RECOVER PARTITIONS")
    return identifier


def sequence(job: JobSpec, rows: DataFrame) -> list[str | Column]:
    """What decides which row of a key is the latest within one batch."""
    order: list[str | Column] = list(sequence_fields(job))
    if WINDOW_COLUMN in rows.columns:
        order.append(WINDOW_COLUMN)
    if SOURCE_COLUMN in rows.columns:
        order.append(SOURCE_COLUMN)
    return order


def run_batch(
    spark: SparkSession,
    job: JobSpec,
    messages: DataFrame,
    scorers: Mapping[str, ScorerFactory] | None = None,
    on_bad_record: str = "fail",
    on_null: str = "fail",
    batch_id: int | str = 0,
    run_id: str | None = None,
    chain: Chain | None = None,
    fmt: str = "parquet",
    register: bool = False,
) -> DataFrame:
    """Replay a batch of messages into the job's table and return the table's rows.

    Give ``run_id`` and ``batch_id`` to repeat a replay that failed: it replaces what it wrote before. By default each
    call is its own run. ``chain`` replaces the job's own steps. ``register`` creates the database and table in the
    session catalog; a row-level ``fmt`` always does so in the job's own, and merges.
    """
    apply_conf(spark)
    run_id = run_id or uuid.uuid4().hex
    rows = rows_of(job, messages, scorers, on_bad_record, keep_hidden=True, chain=chain)
    if fmt in ddl.ROW_LEVEL_FORMATS:
        identifier = ensure_table(spark, job, fmt)
        merge_batch(job, identifier, rows, batch_id, run_id, on_null)
        return spark.table(identifier)
    if job.schema.primary_keys:
        table = table_of(spark, job, ensure_table(spark, job) if register else None)
        table.upsert(rows, batch_id, run_id, sequence(job, rows), on_null)
        return table.read()
    path = ddl.table_path(job.lake, job.schema)
    append_batch(job, rows, batch_id, run_id, on_null)
    return spark.read.schema(conform(rows, job.schema, "drop").schema).parquet(path).select(*(ref(n) for n in job.schema.names))


def append_batch(job: JobSpec, rows: DataFrame, batch_id: int | str, run_id: str, on_null: str) -> None:
    """Add a batch to a table without a primary key, in folders of its own; repeating it replaces them."""
    check_on_null(on_null)
    schema, path = job.schema, ddl.table_path(job.lake, job.schema)
    stage = f"{path}__incoming/{uuid.uuid4().hex}"
    if on_null == "quarantine":
        rows = set_aside(rows, schema, path, stage, batch_id, run_id)
    out = with_folders(conform(rows, schema, on_null), schema)
    folders = [folder_column(schema, k) for k in schema.partition_keys]
    write_batch(out.hint("rebalance", *map(ref, folders)) if folders else out, path, batch_id, run_id, folders)
    if on_null == "quarantine":
        remove_path(rows.sparkSession, stage)


def merge_batch(job: JobSpec, identifier: str, rows: DataFrame, batch_id: int | str, run_id: str, on_null: str) -> None:
    """Merge a batch into a table that takes row-level changes. It is evaluated once, as a merge may read its source twice."""
    check_on_null(on_null)
    spark, path = rows.sparkSession, ddl.table_path(job.lake, job.schema)
    stage = f"{path}__incoming/{uuid.uuid4().hex}"
    if on_null == "quarantine":
        rows = set_aside(rows, job.schema, path, stage, batch_id, run_id)
    order = sequence(job, rows)
    extra = tuple(o for o in order if isinstance(o, str) and o not in job.schema.names)
    latest = latest_per_key(conform(rows, job.schema, on_null, keep=extra), job.schema.primary_keys, order)
    latest = latest.select(*(ref(n) for n in job.schema.names))
    latest.write.mode("overwrite").parquet(f"{stage}/latest")
    view = f"_sluice_{uuid.uuid4().hex}"
    spark.read.schema(latest.schema).parquet(f"{stage}/latest").createOrReplaceTempView(view)
    try:
        spark.sql(ddl.merge(identifier, job.schema, view, sequence_fields(job)))
    finally:
        spark.catalog.dropTempView(view)
    remove_path(spark, stage)
