"""Configured and streaming jobs, and checks of what goes wrong in a call."""

from __future__ import annotations

import json
import time

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import check, new_folder, register, table
from checks.jobs import _ENRICHED, _ENRICHED_COLUMNS, _LATEST_ENRICHED, _RATED, _SCORERS, _event_stream, _job, _messages
from checks.scoring import _OUTPUTS, _spec
from sluice import (
    ConfigTables, FilterRule, StepSpec, TableSchema, TransformRule, batch_result, build_requests, decode_json, dedup, filter_rows, infer,
    parse_responses, read_files, run_reloading, run_stream, transform_rows,
)
from sluice.operators.inference import http_scorer
from sluice.plans.job import table_of

_ONCE = {"availableNow": True}

# --- jobs from config tables --------------------------------------------------------------------

# The columns of the config tables, an interface that jobs share.
_JOBS = "job_name string, parallelism int, kafka_config string, paimon_config string, schema_config string, status int"
_STEP_ROWS = "id bigint, job_name string, step_order int, processor_type string, function_id string, processor_config string, status int"
_FUNCTIONS = (
    "function_id string, function_name string, function_type string, service_url string, service_type string, model_name string, "
    "input_fields string, output_fields string, batch_size int, max_wait_ms int, async_capacity int, failure_strategy string, "
    "extra_config string, status int"
)


def _document(schema: TableSchema) -> str:
    fields = [{"name": f.name, "type": f.type, "nullable": not schema.required(f)} for f in schema.fields]
    return json.dumps({"table": schema.table, "fields": fields, "primaryKeys": list(schema.primary_keys)})


def _config(spark, warehouse: str, least: float = 2.5) -> ConfigTables:
    """The sample job's rows, out of order and among disabled ones."""
    lake, schema = json.dumps({"warehouse": warehouse, "tableProperties": {"bucket": "4"}}), _document(_RATED)
    keep = json.dumps({"conditions": [{"field": "value", "op": "gte", "value": least}]})
    name = json.dumps({"mappings": [{"output": "event_type", "inputs": ["event_type", "user_id"], "op": "concat", "separator": "/"}]})
    none = json.dumps({"conditions": [{"field": "value", "op": "lt", "value": -1}, {"field": "value", "op": "not_null"}]})
    jobs = [("rated", 2, None, lake, "{}", 0), ("rated", 2, None, lake, schema, 1), ("other", 1, None, lake, schema, 1)]
    steps = [
        (4, "rated", 3, "ai-inference", "rate-events", None, 1),
        (3, "rated", 2, "transform", None, name, 1),
        (2, "rated", 2, "filter", None, none, 0),
        (1, "rated", 1, "filter", None, keep, 1),
        (5, "other", 1, "filter", None, none, 1),
    ]
    row = ("rating", "http", "http://rater.test", "generic", "rater", '["value"]', '["weight","heavy"]', 128, 50, 8, "FAIL", None)
    functions = [("rate-events", *row[:-1], "{bad", 0), ("rate-events", *row, 1)]
    return ConfigTables(spark.createDataFrame(jobs, _JOBS), spark.createDataFrame(steps, _STEP_ROWS), spark.createDataFrame(functions, _FUNCTIONS))


@check(f"SELECT {_ENRICHED_COLUMNS} FROM {_ENRICHED} e")
def job_from_config(spark, sf):
    """The sample job as its config rows define it."""
    job = _config(spark, new_folder(spark, "job_from_config")).load("rated")
    return batch_result(job, _messages(table(spark, sf, "events")), _SCORERS)


@check(_LATEST_ENRICHED)
def job_reloaded(spark, sf):
    """The same as a stream that reads its rules again for each batch."""
    warehouse = new_folder(spark, "job_reloaded")
    query = run_reloading(
        spark, "rated", lambda session: _config(session, warehouse), _messages(_event_stream(spark, sf)), f"{warehouse}/checkpoint", _SCORERS, _ONCE
    )
    query.awaitTermination()
    return table_of(spark, _config(spark, warehouse).load("rated")).read()


@check(f"SELECT {_ENRICHED_COLUMNS} FROM {_ENRICHED} e")
def file_replay(spark, sf):
    """Messages written as lines of text and replayed from the files."""
    path = new_folder(spark, "file_replay")
    _messages(table(spark, sf, "events")).select("value").write.text(path)
    job = _job(spark, "replay")
    return batch_result(job, read_files(spark, path), _SCORERS)


# --- streams ------------------------------------------------------------------------------------

_SUMS = TableSchema.from_json(
    {
        "table": "sums",
        "fields": [
            {"name": "event_type", "type": "STRING"},
            {"name": "window_start", "type": "TIMESTAMP"},
            {"name": "n", "type": "LONG"},
            {"name": "top", "type": "DOUBLE"},
            {"name": "user_id", "type": "LONG"},
            {"name": "value", "type": "DOUBLE"},
            {"name": "ts", "type": "TIMESTAMP"},
        ],
        "primaryKeys": ["event_type", "window_start"],
    }
)


def _windows(spark, sf, what: str, mode: str, **rule):
    """Windows of a stream, upserted into a keyed table."""
    step = {
        "key_fields": ["event_type"],
        "emit_window": True,
        "aggregations": [{"output": "n", "op": "count"}, {"output": "top", "op": "max", "input": "value"}],
        **rule,
    }
    job = _job(spark, what, _SUMS, (StepSpec("aggregate", step),))
    source = _messages(_event_stream(spark, sf))
    query = run_stream(spark, job, f"{job.lake.warehouse}/checkpoint", source=source, trigger=_ONCE, output_mode=mode)
    query.awaitTermination()
    return table_of(spark, job).read().select("event_type", "window_start", "n", "top")


_MS = "date_trunc('millisecond', ts)"


@check(
    "SELECT event_type, make_timestamp((epoch_us(ts) // 7200000000 - k) * 7200000000) AS window_start, count(*) AS n, max(value) AS top "
    "FROM events, (VALUES (0), (1), (2)) o(k) GROUP BY ALL"
)
def stream_sliding(spark, sf):
    """Windows of six hours every two."""
    window = {"type": "sliding", "sizeSeconds": 21600, "slideSeconds": 7200}
    return _windows(spark, sf, "stream_sliding", "update", time_field="ts", watermark="365 days", window=window)


@check(
    f"SELECT event_type, min(t) AS window_start, count(*) AS n, max(value) AS top FROM (SELECT *, sum(opens) OVER (PARTITION BY event_type "
    f"ORDER BY t, event_id) AS sid FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY event_type ORDER BY t, event_id) < INTERVAL 900 SECONDS "
    f"THEN 0 ELSE 1 END AS opens FROM (SELECT *, {_MS} AS t FROM events) e) o) s GROUP BY event_type, sid"
)
def stream_session(spark, sf):
    """Sessions that end after a quarter of an hour without an event."""
    window = {"type": "session", "gapSeconds": 900}
    return _windows(spark, sf, "stream_session", "complete", time_field="ts", watermark="365 days", window=window)


@check("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_processing_time(spark, sf):
    """Windows by the clock: which ones depends on the run, but every event is in one."""
    out = _windows(spark, sf, "stream_processing_time", "update", window={"sizeSeconds": 3600})
    return out.groupBy("event_type").agg(F.sum("n").alias("n"))


@check("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Repeated keys of a stream dropped within their watermark."""
    path = new_folder(spark, "stream_dedup")
    schema = TableSchema.from_json({"table": "d", "fields": [f.__dict__ for f in _SUMS.fields if f.name in ("event_type", "user_id", "ts")]})
    rows = dedup(decode_json(_messages(_event_stream(spark, sf)), schema), ["user_id", "event_type"], "ts", "365 days")
    writer = rows.select("user_id", "event_type").writeStream.format("parquet").option("path", f"{path}/out")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(**_ONCE).start().awaitTermination()
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{path}/out")


# --- calls that take too long ---------------------------------------------------------------------


def _sleepy(spec):
    """Too slow for the batches of bucket 3."""

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        if batch["bucket"].iloc[0] == 3:
            time.sleep(spec.async_timeout_ms / 1000 + 1.5)
        return pd.DataFrame({"score": batch["value"] / 1000, "high": batch["value"] > 100})

    return score


def _with_timeouts(strategy: str):
    def run(spark, sf):
        rows = table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 7)
        spec = _spec(input_fields=("bucket", "value"), failure_strategy=strategy, batch_size=8192, async_timeout_ms=1500)
        return infer(rows, spec, _sleepy, _OUTPUTS, batch_by="bucket").select("event_id", "bucket", "score", "high")

    return run


register(
    "infer_timeout_pass_through",
    _with_timeouts("PASS_THROUGH"),
    "SELECT event_id, user_id % 7 AS bucket, CASE WHEN user_id % 7 <> 3 THEN value / 1000 END AS score, "
    "CASE WHEN user_id % 7 <> 3 THEN value > 100 END AS high FROM events",
)
register(
    "infer_timeout_skip",
    _with_timeouts("SKIP"),
    "SELECT event_id, user_id % 7 AS bucket, value / 1000 AS score, value > 100 AS high FROM events WHERE user_id % 7 <> 3",
)

# --- batches and calls ------------------------------------------------------------------------------


def _measured(spec):
    """Says of each row how large its batch was."""
    return lambda batch: [{"rows": len(batch)}] * len(batch)


_SCORED = TableSchema.from_json(
    {
        "table": "scored",
        "fields": [{"name": "event_id", "type": "LONG"}, {"name": "user_id", "type": "LONG"}, {"name": "value", "type": "DOUBLE"}, {"name": "rows", "type": "LONG"}],
        "primaryKeys": ["event_id"],
    }
)


@check("SELECT CAST(64 AS BIGINT) AS rows, count(*) // 64 * 64 AS n FROM events")
def stream_full_batches(spark, sf):
    """A stream's model batches fill up over micro-batches; what does not fill one waits in the state."""
    function = _spec(function_id="measure", input_fields=("value",), output_fields=("rows",), max_wait_ms=3_600_000, extra_config={"carry": True})
    job = _job(spark, "stream_full_batches", _SCORED, (StepSpec("ai-inference", None, function),))
    events = _event_stream(spark, sf)
    run = run_stream(spark, job, f"{job.lake.warehouse}/checkpoint", source=_messages(events), scorers={"measure": _measured}, trigger=_ONCE)
    run.awaitTermination()
    return table_of(spark, job).read().groupBy("rows").agg(F.count(F.lit(1)).alias("n"))


def _moody(spec):
    """A service that refuses the first attempts of a batch and then answers."""
    refused = []

    def post(url, body, timeout, headers):
        if len(refused) < 2:
            refused.append(url)
            raise OSError("refused")
        refused.clear()
        return json.dumps([{"score": row["value"] / 1000, "high": row["value"] > 100} for row in json.loads(body)["inputs"]])

    return http_scorer(spec, post)


@check("SELECT event_id, value / 1000 AS score, value > 100 AS high FROM events")
def infer_retry(spark, sf):
    """Refused calls are made again, within the batch's time."""
    spec = _spec(input_fields=("value",), service_url="http://rater.test", service_type="generic", batch_size=4096, failure_strategy="FAIL", async_capacity=1)
    return infer(table(spark, sf, "events"), spec, _moody, _OUTPUTS).select("event_id", "score", "high")


# --- requests and answers ---------------------------------------------------------------------------


@check("SELECT count(*) AS in_requests, true AS spread, true AS few FROM lineitem")
def payload_hot_rows(spark, sf):
    """One row repeated: every copy in a request, no bucket with more than its slices, and hardly a short request."""
    same = table(spark, sf, "lineitem").select(F.lit(1).alias("user_id"), F.lit(2.5).alias("value"))
    spec = _spec(service_type="torchserve", input_fields=("user_id", "value"))
    made = build_requests(same, spec, ["user_id"], buckets=64).select("bucket", F.size("rows").alias("size"))
    per = made.groupBy("bucket").agg(F.sum("size").alias("rows"), F.count(F.lit(1)).alias("requests"), F.sum((F.col("size") < 64).cast("int")).alias("short"))
    share = F.max("rows") <= F.greatest(F.lit(8 * 4096), F.sum("rows") / 8)
    return per.agg(F.sum("rows").alias("in_requests"), share.alias("spread"), (F.max("short") <= 1).alias("few"))


@check("SELECT event_id, user_id AS user_out, value AS value_out FROM events")
def payload_triton_text(spark, sf):
    """A tensor answer whose last number is text."""
    outputs = TableSchema.from_json({"table": "o", "fields": [{"name": "user_out", "type": "LONG"}, {"name": "value_out", "type": "DOUBLE"}]})
    spec = _spec(service_type="triton", input_fields=("user_id", "value"), output_fields=("user_out", "value_out"), function_type="http")
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    requests = build_requests(events, spec, ["event_id"])
    answer = F.regexp_replace(F.replace("request", F.lit('"inputs"'), F.lit('"outputs"')), r"([0-9.E-]+)\]\}\]\}$", '"$1"]}]}')
    return parse_responses(requests.withColumn("response", answer), spec, outputs).select("event_id", "user_out", "value_out")


# --- exact numbers ------------------------------------------------------------------------------------


@check("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS VARCHAR) || '2345' AS DECIMAL(18, 5)) AS exact FROM lineitem")
def tf_cast_decimal_declared(spark, sf):
    """A cast to the precision and scale that the output declares."""
    text = F.concat(F.col("l_quantity").cast("string"), F.lit("2345"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    declared = TableSchema.from_json({"table": "t", "fields": [{"name": "exact", "type": "DECIMAL", "precision": 18, "scale": 5}]})
    rule = TransformRule.from_json({"mappings": [{"output": "exact", "input": "text", "op": "type_cast", "target_type": "DECIMAL"}]})
    return transform_rows(rows, rule, declared=declared).select("l_orderkey", "l_linenumber", "exact")


@check("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '0.0000000000000000001' WHEN 1 THEN '-1e-25' ELSE '3e-19' END AS tiny FROM events WHERE event_id % 3 <> 1")
def filter_numeric_text_exact(spark, sf):
    """Texts of numbers too small for a decimal are still above zero."""
    n = F.col("event_id") % 3
    tiny = F.when(n == 0, "0.0000000000000000001").when(n == 1, "-1e-25").otherwise("3e-19")
    rows = table(spark, sf, "events").select("event_id", tiny.cast(T.StringType()).alias("tiny"))
    return filter_rows(rows, FilterRule.from_json({"conditions": [{"field": "tiny", "op": "gt", "value": 0}]}))


@check("SELECT count(*) AS n, round(sum(value), 4) AS total FROM events")
def agg_session_global(spark, sf):
    """Sessions without a key: every event is in one."""
    from sluice import AggregateRule, aggregate_rows

    rule = AggregateRule.from_json(
        {
            "key_fields": [],
            "time_field": "ts",
            "window": {"type": "session", "gapSeconds": 60},
            "aggregations": [{"output": "n", "op": "count"}, {"output": "total", "op": "sum", "input": "value"}],
        }
    )
    sessions = aggregate_rows(table(spark, sf, "events"), rule)
    return sessions.agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
