"""Window aggregation checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import SPARSE, check, register, rounded, sparse_events, table
from sluice import AggregateRule, aggregate_rows

_SUMS = [
    {"output": "total", "op": "sum", "input": "value"},
    {"output": "n", "op": "count"},
    {"output": "mean", "op": "avg", "input": "value"},
    {"output": "low", "op": "min", "input": "value"},
    {"output": "high", "op": "max", "input": "value"},
]
_DISTINCT = [{"output": "users", "op": "count_distinct", "input": "user_id"}, {"output": "n", "op": "count"}]


def _rule(window: dict, aggregations: list, keys=("event_type",), **rest) -> AggregateRule:
    doc = {"keyFields": list(keys), "timeField": "ts", "window": window, "aggregations": aggregations, "emit_window": True}
    return AggregateRule.from_json({**doc, **rest})


def _run(rule: AggregateRule, source=sparse_events):
    def run(spark, sf):
        out = aggregate_rows(source(spark, sf), rule)
        if "mean" in out.columns:
            # a float's 24 bits hide the order of summation, and no mean lies half-way between two
            out = out.withColumn("mean", F.col("mean").cast("float").cast("double"))
        return rounded(out, 6, *(c for c in ("total",) if c in out.columns))

    return run


_ZERO_SQL = (
    "round(sum(coalesce(value, 0)), 6) AS total, count(*) AS n, avg(coalesce(value, 0))::FLOAT::DOUBLE AS mean, "
    "min(coalesce(value, 0)) AS low, max(coalesce(value, 0)) AS high"
)
_SKIP_SQL = (
    "round(sum(value), 6) AS total, count(*) AS n, avg(value)::FLOAT::DOUBLE AS mean, min(value) AS low, max(value) AS high"
)


def _bounds(start: str, size: int) -> str:
    return f"{start} AS window_start, {start} + INTERVAL {size} SECOND AS window_end"


def _floor(seconds: int) -> str:
    return f"make_timestamp((epoch_us(ts) // {seconds}000000) * {seconds}000000)"


def _covering(size: int, slide: int, source: str = SPARSE) -> str:
    """Each event once per sliding window that covers it."""
    step = f"{slide}000000"
    return (
        f"(SELECT e.*, make_timestamp((epoch_us(ts) // {step} - k) * {step}) AS w "
        f"FROM {source} e, generate_series(0, {-(-size // slide) - 1}) AS g(k) "
        f"WHERE epoch_us(ts) < (epoch_us(ts) // {step} - k) * {step} + {size}000000)"
    )


def _sessions(keys: str, gap: int) -> str:
    """Events with the running number of their session."""
    order = f"PARTITION BY {keys} ORDER BY ts, event_id" if keys else "ORDER BY ts, event_id"
    return (
        f"(SELECT f.*, sum(opens) OVER ({order} ROWS UNBOUNDED PRECEDING) AS sid FROM ("
        f"SELECT e.*, CASE WHEN ts <= lag(ts) OVER ({order}) + INTERVAL {gap} SECOND THEN 0 ELSE 1 END AS opens "
        f"FROM {SPARSE} e) f)"
    )


register(
    "agg_tumbling",
    _run(_rule({"type": "tumbling", "sizeSeconds": 3600}, _SUMS)),
    f"SELECT event_type, {_ZERO_SQL}, {_bounds(_floor(3600), 3600)} FROM {SPARSE} e GROUP BY event_type, {_floor(3600)}",
)
register(
    "agg_tumbling_default",
    _run(_rule({}, _SUMS, keys=("user_id", "event_type"))),
    f"SELECT user_id, event_type, {_ZERO_SQL}, {_bounds(_floor(60), 60)} FROM {SPARSE} e GROUP BY user_id, event_type, {_floor(60)}",
)
register(
    "agg_sliding",
    _run(_rule({"type": "sliding", "sizeSeconds": 7200, "slideSeconds": 1800}, _SUMS)),
    f"SELECT event_type, {_ZERO_SQL}, {_bounds('w', 7200)} FROM {_covering(7200, 1800)} c GROUP BY event_type, w",
)
register(
    "agg_sliding_uneven",
    _run(_rule({"type": "sliding", "sizeSeconds": 5400, "slideSeconds": 3600}, _SUMS)),
    f"SELECT event_type, {_ZERO_SQL}, {_bounds('w', 5400)} FROM {_covering(5400, 3600)} c GROUP BY event_type, w",
)
register(
    "agg_sliding_with_gaps",
    _run(_rule({"type": "sliding", "sizeSeconds": 1800, "slideSeconds": 7200}, _SUMS)),
    f"SELECT event_type, {_ZERO_SQL}, {_bounds('w', 1800)} FROM {_covering(1800, 7200)} c GROUP BY event_type, w",
)
register(
    "agg_sliding_distinct",
    _run(_rule({"type": "sliding", "sizeSeconds": 7200, "slideSeconds": 3600}, _DISTINCT)),
    f"SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n, {_bounds('w', 7200)} "
    f"FROM {_covering(7200, 3600)} c GROUP BY event_type, w",
)


def _by_day(rule: AggregateRule, *digest: str):
    """Windows are far more than rows here, so each day's are reduced to a few figures over all of them."""

    def run(spark, sf):
        out = aggregate_rows(sparse_events(spark, sf), rule)
        day = F.date_trunc("day", "window_start").alias("day")
        return out.groupBy("event_type", day).agg(F.count(F.lit(1)).alias("windows"), *map(F.expr, digest))

    return run


register(
    "agg_sliding_fine",
    _by_day(
        _rule({"type": "sliding", "sizeSeconds": 3600, "slideSeconds": 1}, _SUMS),
        "round(max(total), 6) AS most", "round(min(total), 6) AS least", "sum(n) AS n", "max(CAST(mean AS FLOAT)) AS mean",
        "min(low) AS low", "min(high) AS high", "max(low) AS top_low",
    ),
    "SELECT event_type, date_trunc('day', w)::TIMESTAMP AS day, count(*) AS windows, round(max(total), 6) AS most, "
    "round(min(total), 6) AS least, CAST(sum(n) AS BIGINT) AS n, max(mean::FLOAT) AS mean, min(low) AS low, min(high) AS high, "
    "max(low) AS top_low "
    f"FROM (SELECT event_type, w, sum(coalesce(value, 0)) AS total, count(*) AS n, avg(coalesce(value, 0)) AS mean, "
    f"min(coalesce(value, 0)) AS low, max(coalesce(value, 0)) AS high FROM {_covering(3600, 1)} c GROUP BY event_type, w) g "
    "GROUP BY event_type, date_trunc('day', w)",
)
register(
    "agg_sliding_distinct_fine",
    _by_day(
        _rule({"type": "sliding", "sizeSeconds": 36000, "slideSeconds": 60}, _DISTINCT),
        "sum(users) AS users", "max(users) AS most_users", "min(users) AS least_users", "sum(n) AS n",
    ),
    "SELECT event_type, date_trunc('day', w)::TIMESTAMP AS day, count(*) AS windows, CAST(sum(users) AS BIGINT) AS users, "
    "max(users) AS most_users, min(users) AS least_users, CAST(sum(n) AS BIGINT) AS n "
    f"FROM (SELECT event_type, w, count(DISTINCT user_id) AS users, count(*) AS n FROM {_covering(36000, 60)} c "
    "GROUP BY event_type, w) g GROUP BY event_type, date_trunc('day', w)",
)
register(
    "agg_session",
    _run(_rule({"type": "session", "gapSeconds": 1800}, _SUMS, keys=("user_id",))),
    f"SELECT user_id, {_ZERO_SQL}, min(ts) AS window_start, max(ts) + INTERVAL 1800 SECOND AS window_end "
    f"FROM {_sessions('user_id', 1800)} s GROUP BY user_id, sid",
)
register(
    "agg_session_null_key",
    _run(_rule({"type": "session", "gapSeconds": 600}, _SUMS)),
    f"SELECT event_type, {_ZERO_SQL}, min(ts) AS window_start, max(ts) + INTERVAL 600 SECOND AS window_end "
    f"FROM {_sessions('event_type', 600)} s GROUP BY event_type, sid",
)
register(
    "agg_session_distinct",
    _run(_rule({"type": "session", "gapSeconds": 600}, _DISTINCT)),
    "SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n, min(ts) AS window_start, "
    f"max(ts) + INTERVAL 600 SECOND AS window_end FROM {_sessions('event_type', 600)} s GROUP BY event_type, sid",
)
register(
    "agg_null_as_zero",
    _run(_rule({"sizeSeconds": 86400}, _SUMS, emit_window=False)),
    f"SELECT event_type, {_ZERO_SQL} FROM {SPARSE} e GROUP BY event_type, {_floor(86400)}",
)
register(
    "agg_nulls_skipped",
    _run(_rule({"sizeSeconds": 86400}, _SUMS, nulls="skip")),
    f"SELECT event_type, {_SKIP_SQL}, {_bounds(_floor(86400), 86400)} FROM {SPARSE} e GROUP BY event_type, {_floor(86400)}",
)
register(
    "agg_sliding_nulls_skipped",
    _run(_rule({"type": "sliding", "sizeSeconds": 7200, "slideSeconds": 3600}, _SUMS, nulls="skip")),
    f"SELECT event_type, {_SKIP_SQL}, {_bounds('w', 7200)} FROM {_covering(7200, 3600)} c GROUP BY event_type, w",
)
register(
    "agg_count_distinct",
    _run(_rule({"sizeSeconds": 86400}, _DISTINCT)),
    f"SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n, {_bounds(_floor(86400), 86400)} "
    f"FROM {SPARSE} e GROUP BY event_type, {_floor(86400)}",
)
register(
    "agg_global",
    _run(_rule({"sizeSeconds": 21600}, _SUMS, keys=())),
    f"SELECT {_ZERO_SQL}, {_bounds(_floor(21600), 21600)} FROM {SPARSE} e GROUP BY {_floor(21600)}",
)
register(
    "agg_no_input",
    _run(_rule({"sizeSeconds": 86400}, [{"output": "total", "op": "sum"}, {"output": "n", "op": "count", "input": "value"}])),
    f"SELECT event_type, 0.0::DOUBLE AS total, count(*) AS n, {_bounds(_floor(86400), 86400)} "
    f"FROM {SPARSE} e GROUP BY event_type, {_floor(86400)}",
)


@check(
    "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n, max(l_discount) AS best, "
    "count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag, (epoch_us(l_shipdate) // 86400000000) // 7"
)
def agg_weekly_revenue(spark, sf):
    rule = AggregateRule.from_json(
        {
            "key_fields": ["l_returnflag"],
            "time_field": "l_shipdate",
            "window": {"type": "tumbling", "size_seconds": 7 * 86400},
            "aggregations": [
                {"output": "revenue", "op": "sum", "input": "l_extendedprice"},
                {"output": "n", "op": "count"},
                {"output": "best", "op": "max", "input": "l_discount"},
                {"output": "suppliers", "op": "count_distinct", "input": "l_suppkey"},
            ],
        }
    )
    return rounded(aggregate_rows(table(spark, sf, "lineitem"), rule), 2, "revenue")


@check(
    "WITH hourly AS (SELECT event_type, user_id, count(*) AS n, epoch_us(ts) // 3600000000 AS h FROM events GROUP BY ALL) "
    "SELECT event_type, count(*) AS active, max(CAST(n AS DOUBLE)) AS busiest, "
    "make_timestamp((h // 24) * 86400000000) AS window_start, make_timestamp((h // 24 + 1) * 86400000000) AS window_end "
    "FROM hourly GROUP BY event_type, h // 24"
)
def agg_of_aggregates(spark, sf):
    """A second aggregation takes its time from the first one's windows."""
    hourly = AggregateRule.from_json(
        {
            "key_fields": ["event_type", "user_id"],
            "time_field": "ts",
            "window": {"size_seconds": 3600},
            "aggregations": [{"output": "n", "op": "count"}],
        }
    )
    daily = AggregateRule.from_json(
        {
            "key_fields": ["event_type"],
            "window": {"size_seconds": 86400},
            "aggregations": [{"output": "active", "op": "count"}, {"output": "busiest", "op": "max", "input": "n"}],
            "emit_window": True,
        }
    )
    return aggregate_rows(aggregate_rows(table(spark, sf, "events"), hourly, keep_window=True), daily)
