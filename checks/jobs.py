"""Sink and whole-job checks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from checks.base import check, new_folder, rounded, table
from sluice import Chain, JobSpec, KeyedTable, StepSpec, TableSchema, batch_result, conform, latest_per_key, run_stream
from sluice.plans.job import append_batch, rows_of, run_batch, sequence, table_of
from sluice.spec import InferenceSpec, LakeSpec

_RATED = TableSchema.from_json(
    {
        "table": "events_rated",
        "fields": [
            {"name": "event_id", "type": "LONG"},
            {"name": "user_id", "type": "LONG", "nullable": False},
            {"name": "ts", "type": "TIMESTAMP"},
            {"name": "event_type", "type": "STRING"},
            {"name": "value", "type": "DOUBLE"},
            {"name": "weight", "type": "DOUBLE"},
            {"name": "heavy", "type": "BOOLEAN"},
        ],
        "primaryKeys": ["user_id", "event_type"],
    }
)
_FUNCTION = InferenceSpec("rate-events", "http", ("value",), ("weight", "heavy"), model_name="rater")
_STEPS = (
    StepSpec("filter", {"conditions": [{"field": "value", "op": "gte", "value": 2.5}]}),
    StepSpec("transform", {"mappings": [{"output": "event_type", "inputs": ["event_type", "user_id"], "op": "concat", "separator": "/"}]}),
    StepSpec("ai-inference", None, _FUNCTION),
)


def _rater(spec):
    def score(batch: pd.DataFrame) -> pd.DataFrame:
        weight = batch["value"] / 64
        return pd.DataFrame({"weight": weight, "heavy": weight > 1.5})

    return score


_SCORERS = {"rate-events": _rater}


def _messages(events):
    """Events as messages, in event order."""
    message = F.struct(
        "event_id", "user_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "event_type", "value"
    )
    return events.select(F.to_json(message).alias("value"), F.struct("event_id").alias("_src"))


def _job(spark, what: str, schema: TableSchema = _RATED, steps=_STEPS, **properties: str) -> JobSpec:
    lake = LakeSpec(new_folder(spark, what), table_properties={"bucket": "8", **properties})
    return JobSpec(what, schema, lake=lake, steps=steps)


_ENRICHED = (
    "(SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts, concat(event_type, '/', CAST(user_id AS VARCHAR)) AS event_type, value, "
    "value / 64 AS weight, value / 64 > 1.5 AS heavy FROM events WHERE value >= 2.5)"
)
_ENRICHED_COLUMNS = "event_id, user_id, ts, event_type, value, weight, heavy"
_LATEST_ENRICHED = (
    f"SELECT {_ENRICHED_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn "
    f"FROM {_ENRICHED} e) r WHERE rn = 1"
)


@check(f"SELECT {_ENRICHED_COLUMNS} FROM {_ENRICHED} e")
def sample_job(spark, sf):
    """Decode, filter, transform, score and conform all events."""
    return batch_result(JobSpec("sample", _RATED, steps=_STEPS), _messages(table(spark, sf, "events")), _SCORERS)


@check(_LATEST_ENRICHED)
def sample_job_latest(spark, sf):
    """The sample job's target table as its readers see it: the latest row per key."""
    job = JobSpec("sample", _RATED, steps=_STEPS)
    rows = rows_of(job, _messages(table(spark, sf, "events")), _SCORERS, keep_hidden=True)
    kept = conform(rows, job.schema, keep=("_src",))
    return latest_per_key(kept, job.schema.primary_keys, sequence(job, rows)).drop("_src")


@check(f"SELECT {_ENRICHED_COLUMNS} FROM {_ENRICHED} e WHERE event_id % 3 <> 0")
def job_with_own_step(spark, sf):
    """A user's function between two steps of the config, through the job's own runner."""
    job = JobSpec("own", _RATED, steps=_STEPS)
    first, *rest = Chain.from_job(job, _SCORERS).steps
    chain = Chain([first]).add(lambda rows: rows.filter("event_id % 3 <> 0")).add_all(rest)
    return batch_result(job, _messages(table(spark, sf, "events")), chain=chain)


def _event_stream(spark, sf):
    """The events table as a stream, be it one file or a folder of files."""
    schema = table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).format("parquet")
    path = f"{sf}/events.parquet"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory()
    return reader.load(path) if is_folder else reader.option("pathGlobFilter", "events.parquet").load(sf)


@check(_LATEST_ENRICHED)
def stream_sample_job(spark, sf):
    """The sample job as a stream into its keyed table."""
    job = _job(spark, "stream_sample_job")
    query = run_stream(
        spark,
        job,
        f"{job.lake.warehouse}/checkpoint",
        source=_messages(_event_stream(spark, sf)),
        scorers=_SCORERS,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return table_of(spark, job).read()


_HOURLY = TableSchema.from_json(
    {
        "table": "hourly",
        "fields": [
            {"name": "event_type", "type": "STRING"},
            {"name": "window_start", "type": "TIMESTAMP"},
            {"name": "total", "type": "DOUBLE"},
            {"name": "n", "type": "LONG"},
            {"name": "user_id", "type": "LONG"},
            {"name": "value", "type": "DOUBLE"},
            {"name": "ts", "type": "TIMESTAMP"},
        ],
        "primaryKeys": ["event_type", "window_start"],
    }
)
_HOURLY_STEP = StepSpec(
    "aggregate",
    {
        "key_fields": ["event_type"],
        "time_field": "ts",
        "watermark": "0 seconds",
        "window": {"type": "tumbling", "size_seconds": 3600},
        "aggregations": [{"output": "total", "op": "sum", "input": "value"}, {"output": "n", "op": "count"}],
        "emit_window": True,
    },
)


@check(
    "SELECT event_type, make_timestamp((epoch_us(ts) // 3600000000) * 3600000000) AS window_start, "
    "round(sum(value), 6) AS total, count(*) AS n FROM events WHERE value >= 2.5 GROUP BY ALL"
)
def stream_windows(spark, sf):
    """Event-time windows on a stream, upserted as they grow."""
    job = _job(spark, "stream_windows", _HOURLY, (_STEPS[0], _HOURLY_STEP))
    query = run_stream(
        spark,
        job,
        f"{job.lake.warehouse}/checkpoint",
        source=_messages(_event_stream(spark, sf)),
        trigger={"availableNow": True},
        output_mode="update",
    )
    query.awaitTermination()
    return rounded(table_of(spark, job).read().select("event_type", "window_start", "total", "n"), 6, "total")


@check(
    "SELECT event_type, window_start, total, n FROM (SELECT concat(event_type, '/', CAST(user_id AS VARCHAR)) AS event_type, "
    "make_timestamp((epoch_us(ts) // 3600000000) * 3600000000) AS window_start, round(sum(value), 6) AS total, count(*) AS n "
    "FROM events WHERE value >= 2.5 GROUP BY ALL) h"
)
def job_with_aggregate(spark, sf):
    """Decode, filter, transform and aggregate in one batch."""
    job = JobSpec("hourly", _HOURLY, steps=(*_STEPS[:2], _HOURLY_STEP))
    rows = rows_of(job, _messages(table(spark, sf, "events")))
    return rounded(rows.select("event_type", "window_start", "total", "n"), 6, "total")


_CONFORMED = TableSchema.from_json(
    {
        "table": "conformed",
        "fields": [
            {"name": "l_orderkey", "type": "STRING", "nullable": False},
            {"name": "l_linenumber", "type": "LONG"},
            {"name": "l_quantity", "type": "INT"},
            {"name": "l_extendedprice", "type": "DECIMAL", "precision": 12, "scale": 2},
            {"name": "l_shipdate", "type": "DATE"},
            {"name": "note", "type": "STRING"},
        ],
    }
)


@check(
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, "
    "CAST(l_extendedprice AS DECIMAL(12, 2)) AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate, CAST(NULL AS VARCHAR) AS note FROM lineitem"
)
def sink_conform(spark, sf):
    return conform(table(spark, sf, "lineitem"), _CONFORMED)


@check("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL")
def sink_not_null_drop(spark, sf):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    schema = TableSchema.from_json(
        {
            "table": "strict",
            "fields": [
                {"name": "event_id", "type": "LONG"},
                {"name": "user_id", "type": "LONG", "nullable": False},
                {"name": "event_type", "type": "STRING", "nullable": False},
            ],
        }
    )
    return conform(table(spark, sf, "events").withColumn("event_type", kind), schema, on_null="drop")


_STATE = TableSchema.from_json(
    {
        "table": "user_state",
        "fields": [
            {"name": "user_id", "type": "LONG"},
            {"name": "event_type", "type": "STRING"},
            {"name": "event_id", "type": "LONG"},
            {"name": "value", "type": "DOUBLE"},
        ],
        "primaryKeys": ["user_id", "event_type"],
        "partitionKeys": ["event_type"],
    }
)


def _two_upserts(spark, sf, what: str, **options) -> KeyedTable:
    """All events in two batches: the later half of the ids replaces what the first half wrote."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    target = KeyedTable(spark, new_folder(spark, what), _STATE, buckets=4, **options)
    late = F.col("event_id") % 2 == 1
    target.upsert(events.filter(~late), 0, order_by=["event_id"])
    target.upsert(events.filter(late), 1, order_by=["event_id"])
    return target


_UPSERTED = (
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY event_id % 2 DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1"
)


@check(_UPSERTED)
def sink_upsert(spark, sf):
    return _two_upserts(spark, sf, "sink_upsert").read()


@check(_UPSERTED)
def sink_upsert_deltas(spark, sf):
    """The same through two replays of a job whose table properties ask for rare compactions, which the engine passes on."""
    job = JobSpec("deltas", _STATE, lake=LakeSpec(new_folder(spark, "sink_upsert_deltas"), table_properties={"bucket": "4", "full-compaction.delta-commits": "10"}))
    messages = _messages(table(spark, sf, "events"))
    late = F.col("_src.event_id") % 2 == 1
    run_batch(spark, job, messages.filter(~late))
    return run_batch(spark, job, messages.filter(late))


@check(
    "SELECT user_id, kind, event_id, value FROM (SELECT user_id, kind, event_id, value, row_number() OVER "
    "(PARTITION BY user_id, kind ORDER BY event_id % 2 DESC, event_id DESC) AS rn FROM "
    "(SELECT *, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS kind FROM events) k) e WHERE rn = 1"
)
def sink_upsert_empty_partition(spark, sf):
    """An empty text is a partition like any other."""
    schema = TableSchema.from_json(
        {
            "table": "by_kind",
            "fields": [
                {"name": "user_id", "type": "LONG"},
                {"name": "kind", "type": "STRING"},
                {"name": "event_id", "type": "LONG"},
                {"name": "value", "type": "DOUBLE"},
            ],
            "primaryKeys": ["user_id", "kind"],
            "partitionKeys": ["kind"],
        }
    )
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("kind")
    events = table(spark, sf, "events").select("user_id", kind, "event_id", "value")
    target = KeyedTable(spark, new_folder(spark, "sink_upsert_empty_partition"), schema, buckets=2)
    late = F.col("event_id") % 2 == 1
    target.upsert(events.filter(~late), 0, order_by=["event_id"])
    target.upsert(events.filter(late), 1, order_by=["event_id"])
    return target.read()


@check(
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY event_id DESC) AS rn FROM events) e WHERE rn = 1"
)
def sink_upsert_out_of_order(spark, sf):
    """The half of higher sequence numbers comes first; the late half replaces only what is older."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    target = KeyedTable(spark, new_folder(spark, "sink_upsert_out_of_order"), _STATE, buckets=4, sequence=("event_id",))
    middle = events.agg(F.expr("(min(event_id) + max(event_id)) div 2")).first()[0]
    target.upsert(events.filter(F.col("event_id") > middle), 0, order_by=["event_id"])
    target.upsert(events.filter(F.col("event_id") <= middle), 1, order_by=["event_id"])
    return target.read()


@check(
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY batch DESC, event_id DESC) AS rn FROM (SELECT *, CASE WHEN event_type = 'click' THEN 0 ELSE event_id % 3 END AS batch FROM events) b) e WHERE rn = 1"
)
def sink_upsert_three_batches(spark, sf):
    """Three batches that insert and update; the folders of clicks are touched by the first alone."""
    batch = F.when(F.col("event_type") == "click", 0).otherwise(F.col("event_id") % 3)
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    target = KeyedTable(spark, new_folder(spark, "sink_upsert_three_batches"), _STATE, buckets=4)
    for k in range(3):
        target.upsert(events.filter(batch == k), k, order_by=["event_id"])
    return target.read()


@check("SELECT CAST(event_id % 2 AS VARCHAR) AS batch, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def sink_changelog(spark, sf):
    target = _two_upserts(spark, sf, "sink_changelog", changelog=True)
    log = spark.read.parquet(target.changelog_path)
    grouped = log.groupBy(F.col("_batch").cast("string").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(grouped, 4, "total")


_APPENDED = TableSchema.from_json(
    {
        "table": "appended",
        "fields": [
            {"name": "event_id", "type": "LONG"},
            {"name": "user_id", "type": "LONG"},
            {"name": "event_type", "type": "STRING", "nullable": False},
            {"name": "value", "type": "DOUBLE"},
        ],
        "partitionKeys": ["event_type"],
    }
)


def _append_job(spark, what: str) -> JobSpec:
    return JobSpec(what, _APPENDED, lake=LakeSpec(new_folder(spark, what)))


@check("SELECT event_id, user_id, event_type, value FROM events")
def sink_append(spark, sf):
    """Rows without a primary key, appended in two batches to a partitioned table."""
    job, messages = _append_job(spark, "sink_append"), _messages(table(spark, sf, "events"))
    late = F.col("_src.event_id") % 2 == 1
    run_batch(spark, job, messages.filter(~late))
    return run_batch(spark, job, messages.filter(late))


@check("SELECT event_id, user_id, event_type, value FROM events")
def sink_append_replayed(spark, sf):
    """A batch that is replayed replaces what it wrote before."""
    job, messages = _append_job(spark, "sink_append_replayed"), _messages(table(spark, sf, "events"))
    for batch in (0, 1, 1):
        out = run_batch(spark, job, messages.filter(F.col("_src.event_id") % 2 == batch), batch_id=batch, run_id="replay")
    return out


@check(
    "SELECT event_id, user_id, event_type, value, false AS rejected FROM events WHERE event_type <> 'error' UNION ALL "
    "SELECT event_id, user_id, NULL, value, true FROM events WHERE event_type = 'error'"
)
def sink_not_null_quarantine(spark, sf):
    """Accepted rows of an append table and those set aside for an empty required field."""
    job = _append_job(spark, "sink_not_null_quarantine")
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = table(spark, sf, "events").withColumn("event_type", kind).select(*_APPENDED.names)
    append_batch(job, rows, 0, "run", "quarantine")
    path = f"{job.lake.warehouse}/{job.lake.database}.db/appended"
    read = spark.read.schema(rows.schema)
    kept = read.parquet(path).select(*rows.columns, F.lit(False).alias("rejected"))
    return kept.unionByName(read.parquet(f"{path}__rejected").select(*rows.columns, F.lit(True).alias("rejected")))


@check(
    "SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events WHERE user_id % 2 = 0 "
    "GROUP BY event_type, (epoch_us(ts) // 86400000000)"
)
def job_decodes_what_it_needs(spark, sf):
    """Days of a job that looks at four of the declared fields; the others stay in the messages."""
    day = {
        "keyFields": ["event_type"], "timeField": "ts", "window": {"sizeSeconds": 86400},
        "aggregations": [{"output": "n", "op": "count"}, {"output": "total", "op": "sum", "input": "value"}],
    }
    wide = TableSchema.from_json(
        {"table": "days", "fields": [f.__dict__ for f in _RATED.fields] + [{"name": f"unused_{i}", "type": "STRING"} for i in range(20)]}
    )
    keep = {"conditions": [{"field": "heavy", "op": "eq", "value": True}]}
    job = _job(spark, "job_decodes_what_it_needs", wide, (StepSpec("filter", keep), StepSpec("aggregate", day)))
    message = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "event_type", "value", (F.col("user_id") % 2 == 0).alias("heavy"),
        *(F.lit("long text").alias(f"unused_{i}") for i in range(20)),
    )
    messages = table(spark, sf, "events").select(F.to_json(message).alias("value"))
    return rounded(rows_of(job, messages), 6, "total")
