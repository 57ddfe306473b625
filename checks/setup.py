"""What a job sets up: its table, its parallelism, the scorers it chooses, and the rules that it refuses."""

from __future__ import annotations

from dataclasses import replace

import pandas as pd
from pyspark.sql import functions as F

from checks.base import check, new_folder, table
from checks.jobs import _ENRICHED_COLUMNS, _HOURLY, _HOURLY_STEP, _STATE, _UPSERTED, _event_stream, _job, _messages
from sluice import (
    AggregateRule, ConfigError, FilterRule, JobSpec, StepSpec, TransformRule, aggregate_rows, batch_result, filter_rows, run_stream, transform_rows,
)
from sluice.operators.inference import register_scorer
from sluice.plans.job import ensure_table, run_batch, table_of
from sluice.spec import InferenceSpec, LakeSpec


@check(_UPSERTED)
def sink_created_table(spark, sf):
    """A database and a keyed table made from the job's schema, twice, then written in two batches and read by name."""
    folder = new_folder(spark, "sink_created_table")
    lake = LakeSpec(folder, database=f"checks_{folder[-12:]}", table_properties={"bucket": "4"})
    job = JobSpec("created", _STATE, lake=lake)
    name = ensure_table(spark, job)
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    late = F.col("event_id") % 2 == 1
    target = table_of(spark, job, name)
    target.upsert(events.filter(~late), 0, order_by=["event_id"])
    assert ensure_table(spark, job) == name  # what is there stays
    target.upsert(events.filter(late), 1, order_by=["event_id"])
    return spark.table(name).select("user_id", "event_type", "event_id", "value")


@check("SELECT event_type, count(*) AS n, CAST(3 AS BIGINT) AS partitions FROM events GROUP BY 1")
def job_parallelism(spark, sf):
    """A stream keeps its state in as many partitions as the job's parallelism says, and the session's number stays."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    step = StepSpec("aggregate", {**_HOURLY_STEP.config, "watermark": "365 days"})
    job = replace(_job(spark, "job_parallelism", _HOURLY, (step,)), parallelism=3)
    source = _messages(_event_stream(spark, sf))
    query = run_stream(spark, job, f"{job.lake.warehouse}/checkpoint", source=source, trigger={"availableNow": True}, output_mode="update")
    query.awaitTermination()
    if spark.conf.get("spark.sql.shuffle.partitions") != before:
        raise AssertionError("a job's parallelism changed the session")
    state = [s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]]
    counts = table_of(spark, job).read().groupBy("event_type").agg(F.sum("n").alias("n"))
    return counts.withColumn("partitions", F.lit(max(state)).cast("bigint"))


def _refused(compiled) -> bool:
    try:
        compiled()
    except ConfigError:
        return True
    return False


@check(
    "SELECT event_type, count(*) AS n, true AS in_filter, true AS in_transform, true AS in_aggregate, true AS as_step FROM events GROUP BY 1"
)
def rules_refused(spark, sf):
    """No kind of event is the name of an operator, so rules that use it as one are refused, before any row is read."""
    events = table(spark, sf, "events")
    kinds = [r[0] for r in events.select("event_type").distinct().collect()]  # a handful by design of the table

    def refused(kind: str) -> list[bool]:
        condition = {"conditions": [{"field": "value", "op": kind, "value": 1}]}
        mapping = {"mappings": [{"output": "value", "inputs": ["value"], "op": kind}]}
        sums = {"key_fields": ["user_id"], "time_field": "ts", "window": {"type": "tumbling", "size_seconds": 60}, "aggregations": [{"output": "x", "op": kind, "input": "value"}]}
        return [
            _refused(lambda: filter_rows(events, FilterRule.from_json(condition))),
            _refused(lambda: transform_rows(events, TransformRule.from_json(mapping))),
            _refused(lambda: aggregate_rows(events, AggregateRule.from_json(sums))),
            _refused(lambda: run_batch(spark, _job(spark, "refused", steps=(StepSpec(kind, {}),)), _messages(events))),
        ]

    marks = spark.createDataFrame([(k, *refused(k)) for k in kinds], "event_type string, in_filter boolean, in_transform boolean, in_aggregate boolean, as_step boolean")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(marks), "event_type", "left")


def _weigher(spec):
    return lambda batch: pd.DataFrame({"weight": batch["value"] / 64})


def _judge(spec):
    return lambda batch: pd.DataFrame({"heavy": batch["weight"] > 1.5})


@check(
    "SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts, event_type, value, value / 64 AS weight, value / 64 > 1.5 AS heavy FROM events"
)
def infer_scorer_choice(spark, sf):
    """One function finds its scorer by its type, in any case; the next, which reads the first one's output, is replaced by its id."""
    register_scorer("weigher", _weigher)
    by_type = InferenceSpec("weigh-events", "WEIGHER", ("value",), ("weight",))
    by_id = InferenceSpec("judge-events", "http", ("weight",), ("heavy",))
    job = _job(spark, "infer_scorer_choice", steps=(StepSpec("ai-inference", None, by_type), StepSpec("ai-inference", None, by_id)))
    out = batch_result(job, _messages(table(spark, sf, "events")), scorers={"judge-events": _judge})
    return out.select(*_ENRICHED_COLUMNS.split(", "))
