"""Run jobs as Structured Streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.inference import ScorerFactory
from sluice.plans.chain import Chain
from sluice.plans.job import append_batch, ensure_table, merge_batch, rows_of, sequence, table_of
from sluice.schema import check_on_null, ref
from sluice.session import apply_conf, ship_package
from sluice.sinks import ddl
from sluice.sources.config_tables import ConfigTables
from sluice.sources.decode import BAD_RECORD, decode_json
from sluice.sources.messages import read_kafka
from sluice.spec import AggregateRule, ConfigError, JobSpec
from sluice.streaming.processors import STORE

_PARTITIONS = "spark.sql.shuffle.partitions"


def max_wait_ms(job: JobSpec) -> int | None:
    """The longest a row may wait for its inference batch; the trigger interval stands for it."""
    waits = [s.function.max_wait_ms for s in job.steps if s.function is not None]
    return min(waits) if waits else None


def _trigger(job: JobSpec, trigger: dict | None) -> dict:
    if trigger is not None:
        return trigger
    wait = max_wait_ms(job)
    return {} if wait is None else {"processingTime": f"{wait} milliseconds"}


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's own id, kept in its checkpoint: the same after a restart, new for a new run."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads(lines[0][0])["id"]


def _own_settings(job: JobSpec, trigger: dict | None) -> dict[str, str]:
    """What the session must have while the job's query starts, which copies it.

    A parallelism of 1, the default, says nothing and leaves the session's number.
    """
    own = {_PARTITIONS: str(job.parallelism)} if job.parallelism > 1 else {}
    carries = any(s.function is not None and s.function.carries for s in job.steps)
    rules = [AggregateRule.from_json(s.config or {}) for s in job.steps if s.type == "aggregate"]
    if carries or any(r.final and r.window.kind == "session" for r in rules):
        own[STORE[0]] = STORE[1]
    if carries and trigger and {"availableNow", "once"} & set(trigger):
        # A run up to what is there now would wait for the clock in empty batches without an end.
        own["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    return own


def _start(spark: SparkSession, job: JobSpec, writer, trigger: dict | None) -> StreamingQuery:
    own = _own_settings(job, trigger)
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def upsert_batches(
    job: JobSpec, checkpoint: str, on_null: str, name: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that puts each micro-batch into the job's keyed table."""

    def write(rows: DataFrame, batch_id: int) -> None:
        table = table_of(rows.sparkSession, job, name)
        table.upsert(rows, batch_id, _run_id(rows.sparkSession, checkpoint), sequence(job, rows), on_null)

    return write


def merge_batches(job: JobSpec, checkpoint: str, identifier: str, on_null: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a catalog with row-level operations."""

    def write(rows: DataFrame, batch_id: int) -> None:
        merge_batch(job, identifier, rows, batch_id, _run_id(rows.sparkSession, checkpoint), on_null)

    return write


def append_batches(job: JobSpec, checkpoint: str, on_null: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends each micro-batch once, whatever is repeated."""

    def write(rows: DataFrame, batch_id: int) -> None:
        append_batch(job, rows, batch_id, _run_id(rows.sparkSession, checkpoint), on_null)

    return write


def run_stream(
    spark: SparkSession,
    job: JobSpec,
    checkpoint: str,
    source: DataFrame | None = None,
    scorers: Mapping[str, ScorerFactory] | None = None,
    trigger: dict | None = None,
    on_bad_record: str = "fail",
    on_null: str = "fail",
    output_mode: str = "append",
    fmt: str = "parquet",
    register: bool = False,
    chain: Chain | None = None,
) -> StreamingQuery:
    """Start the job; messages come from its Kafka topic unless a ``source`` stream is given.

    A table with a primary key is upserted batch by batch, others are appended to, each batch in folders of its own
    that a repeated one replaces. ``chain`` replaces the job's own steps. ``on_bad_record="quarantine"`` leaves bad messages out here; pair it with
    :func:`start_quarantine`, which stores them. ``register`` also creates the database and table in
    the session catalog; without it the table is its folder alone.
    """
    apply_conf(spark)
    check_on_null(on_null)
    if source is None:
        if job.kafka is None:
            raise ConfigError(f"job {job.name!r}: no source is configured")
        source = read_kafka(spark, job.kafka, job.parallelism)
    mode = "drop" if on_bad_record == "quarantine" else on_bad_record
    rows = rows_of(job, source, scorers, mode, keep_hidden=True, chain=chain)
    options = {"checkpointLocation": checkpoint}
    if fmt in ddl.ROW_LEVEL_FORMATS and job.schema.primary_keys:
        write = merge_batches(job, checkpoint, ensure_table(spark, job, fmt), on_null)
    elif job.schema.primary_keys:
        write = upsert_batches(job, checkpoint, on_null, ensure_table(spark, job) if register else None)
    else:
        write = append_batches(job, checkpoint, on_null)
    writer = rows.writeStream.foreachBatch(write).outputMode(output_mode)
    trig = _trigger(job, trigger)
    writer = writer.options(**options).queryName(job.name)
    return _start(spark, job, writer.trigger(**trig) if trig else writer, trig)


def run_job(spark: SparkSession, name: str, config: ConfigTables, checkpoint: str, **options) -> StreamingQuery:
    """Load an active job by name and start it; ``options`` as for :func:`run_stream`."""
    return run_stream(spark, config.load(name), checkpoint, **options)


def start_quarantine(
    spark: SparkSession, job: JobSpec, source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store the messages of ``source`` that cannot be decoded, as text, under ``path``.

    A Kafka source of its own needs a consumer group of its own: ``read_kafka(spec, group="quarantine")``.
    """
    bad = decode_json(source, job.schema, "keep").filter(ref(BAD_RECORD).isNotNull()).select(ref(BAD_RECORD).alias("value"))
    writer = bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_reloading(
    spark: SparkSession,
    name: str,
    load_config: Callable[[SparkSession], ConfigTables],
    source: DataFrame,
    checkpoint: str,
    scorers: Mapping[str, ScorerFactory] | None = None,
    trigger: dict | None = None,
    on_bad_record: str = "fail",
    on_null: str = "fail",
) -> StreamingQuery:
    """Run a job whose rules are read again for every micro-batch.

    A table without a primary key is appended to, as in :func:`run_stream`. Only row-by-row steps can change under way, so
    a job with an aggregation is refused.
    """
    apply_conf(spark)
    ship_package(spark)
    mode = "drop" if on_bad_record == "quarantine" else on_bad_record

    def write(messages: DataFrame, batch_id: int) -> None:
        session = messages.sparkSession
        job = load_config(session).load(name)
        if any(s.type == "aggregate" for s in job.steps):
            raise ConfigError(f"job {name!r}: rules of a job with an aggregation cannot be reloaded")
        rows = rows_of(job, messages, scorers, mode, keep_hidden=True)
        run_id = _run_id(session, checkpoint)
        if job.schema.primary_keys:
            table_of(session, job).upsert(rows, batch_id, run_id, sequence(job, rows), on_null)
        else:
            append_batch(job, rows, batch_id, run_id, on_null)

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(f"{name}-reloading")
    return (writer.trigger(**trigger) if trigger else writer).start()
