"""Checks of streams whose windows are given out once, when they are complete."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, new_folder, table
from checks.jobs import _event_stream, _job, _messages
from sluice import StepSpec, TableSchema, run_stream
from sluice.plans.job import table_of

_SCHEMA = TableSchema.from_json(
    {
        "table": "complete",
        "fields": [
            {"name": "event_type", "type": "STRING"},
            {"name": "window_start", "type": "TIMESTAMP"},
            {"name": "window_end", "type": "TIMESTAMP"},
            {"name": "n", "type": "LONG"},
            {"name": "top", "type": "DOUBLE"},
            {"name": "users", "type": "LONG"},
            {"name": "user_id", "type": "LONG"},
            {"name": "value", "type": "DOUBLE"},
            {"name": "ts", "type": "TIMESTAMP"},
        ],
        "primaryKeys": ["event_type", "window_start"],
    }
)
_SUMS = [{"output": "n", "op": "count"}, {"output": "top", "op": "max", "input": "value"}]
_USERS = [{"output": "users", "op": "count_distinct", "input": "user_id"}]
_MS = "date_trunc('millisecond', ts)"
_PASSED = f"(SELECT max({_MS}) - INTERVAL 1 HOUR FROM events)"


def _complete(spark, sf, what: str, window: dict, aggregations: list, closed: bool = False):
    """The windows that a stream in append mode has put into its table.

    ``closed``: when all events are read, a last message of a later time moves the watermark on, as a source does that
    ends, so that windows open until then are given out too. Its own window stays open.
    """
    step = {
        "key_fields": ["event_type"], "time_field": "ts", "watermark": "1 hour", "final": True, "emit_window": True,
        "window": window, "aggregations": aggregations,
    }
    job = _job(spark, what, _SCHEMA, (StepSpec("aggregate", step),))
    events, ends = table(spark, sf, "events"), f"{new_folder(spark, what)}-end"
    last = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).withColumn("event_type", F.lit("end of the stream"))
    last = last.select(*(F.col(f.name) if f.name in last.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema))
    last.limit(0).write.parquet(ends)
    source = _messages(_event_stream(spark, sf).unionByName(spark.readStream.schema(events.schema).parquet(ends)))
    for more in (False, True) if closed else (False,):
        if more:
            last.write.mode("append").parquet(ends)
        run_stream(spark, job, f"{job.lake.warehouse}/checkpoint", source=source, trigger={"availableNow": True}).awaitTermination()
    return table_of(spark, job).read().select("event_type", "window_start", *(a["output"] for a in aggregations))


@check(
    "SELECT * FROM (SELECT event_type, make_timestamp((epoch_us(ts) // 1800000000) * 1800000000) AS window_start, "
    "count(DISTINCT user_id) AS users, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2) w "
    f"WHERE window_start + INTERVAL 30 MINUTE <= {_PASSED}"
)
def stream_distinct_exact(spark, sf):
    """Exact distinct counts of half-hour windows of a stream."""
    return _complete(spark, sf, "stream_distinct_exact", {"sizeSeconds": 1800}, [*_USERS, *_SUMS])


@check(
    "SELECT * FROM (SELECT event_type, make_timestamp((epoch_us(ts) // 7200000000 - k) * 7200000000) AS window_start, "
    "count(DISTINCT user_id) AS users, count(*) AS n, max(value) AS top FROM events, (VALUES (0), (1), (2)) o(k) GROUP BY 1, 2) w "
    f"WHERE window_start + INTERVAL 6 HOUR <= {_PASSED}"
)
def stream_sliding_panes(spark, sf):
    """Windows of six hours every two, made of finished panes."""
    window = {"type": "sliding", "sizeSeconds": 21600, "slideSeconds": 7200}
    return _complete(spark, sf, "stream_sliding_panes", window, [*_USERS, *_SUMS])


@check(
    f"SELECT event_type, min(t) AS window_start, count(*) AS n, max(value) AS top FROM (SELECT *, sum(opens) OVER (PARTITION BY event_type "
    f"ORDER BY t, event_id) AS sid FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY event_type ORDER BY t, event_id) <= INTERVAL 900 SECONDS "
    f"THEN 0 ELSE 1 END AS opens FROM (SELECT *, {_MS} AS t FROM events) e) o) s GROUP BY event_type, sid "
    f"HAVING min(t) < {_PASSED} - INTERVAL 1 DAY"
)
def stream_session_panes(spark, sf):
    """Sessions joined from finished panes, up to the last day; they may go on until the stream ends."""
    out = _complete(spark, sf, "stream_session_panes", {"type": "session", "gapSeconds": 900}, _SUMS, closed=True)
    upto = F.date_trunc("millisecond", F.max("ts")) - F.expr("INTERVAL 25 HOURS")
    last = table(spark, sf, "events").agg(upto.cast("timestamp_ntz").alias("upto"))  # one row
    return out.join(F.broadcast(last), F.col("window_start") < F.col("upto")).drop("upto")
