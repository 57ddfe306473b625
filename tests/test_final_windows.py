"""Streams whose windows are given out once, against the same rule on a batch."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.base import CHECKS
from checks import final_streams  # noqa: F401, registers its checks
from sluice import AggregateRule, ConfigError, aggregate_rows
from sluice.streaming.processors import STORE

SUMS = [
    {"output": "total", "op": "sum", "input": "v"},
    {"output": "n", "op": "count"},
    {"output": "held", "op": "count", "input": "v"},
    {"output": "mean", "op": "avg", "input": "v"},
    {"output": "low", "op": "min", "input": "v"},
    {"output": "high", "op": "max", "input": "v"},
]
DISTINCT = [{"output": "users", "op": "count_distinct", "input": "u"}, {"output": "words", "op": "count_distinct", "input": "w"}]
SCHEMA = "at timestamp_ntz, k string, v double, u int, w string"
ONCE = {"availableNow": True}


def rows_of_quarter(n, rng, count=50):
    start = f"TIMESTAMP_NTZ '2024-01-01 00:{15 * n:02d}:00'"
    return [
        (f"{start} + INTERVAL {rng.randint(0, 899_999)} MILLISECONDS", rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1.0, 2.5, -3.0]),
         rng.randint(0, 4), rng.choice([None, "x", "y"]))
        for _ in range(count)
    ]


def put(spark, folder, name, rows):
    values = ", ".join("(" + ", ".join([at, *(_sql(x) for x in rest)]) + ")" for at, *rest in rows)
    columns = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in SCHEMA.split(", "))
    made = spark.sql(f"SELECT {columns} FROM VALUES {values} AS t(at, k, v, u, w)")
    made.coalesce(1).write.parquet(f"{folder}/{name}")


def _sql(value):
    return "NULL" if value is None else repr(value)


@pytest.fixture
def timers(spark):
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    yield
    spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


def rule(window, aggs, keys=("k",), **rest):
    return AggregateRule.from_json(
        {"key_fields": list(keys), "time_field": "at", "window": window, "aggregations": aggs, "emit_window": True, "final": True, "watermark": "1 minute", **rest}
    )


def run(spark, how, tmp_path):
    """What is given out over two runs of one query, the second one going on where the first was stopped."""
    rng, progress = random.Random(7), []
    for turn in (0, 1):
        for n in (2 * turn, 2 * turn + 1):
            put(spark, tmp_path / "in", f"q{n}", rows_of_quarter(n, rng))
        if turn:
            put(spark, tmp_path / "in", "z", [("TIMESTAMP_NTZ '2024-01-02 00:00:00'", "z", None, 9, None)])
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        out = aggregate_rows(stream, how).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        query = out.option("checkpointLocation", f"{tmp_path}/ck").trigger(**ONCE).start()
        query.awaitTermination()
        progress += query.recentProgress
    upto = F.col("window_end") < F.lit("2024-01-01 23:00:00").cast("timestamp_ntz")
    got = spark.read.parquet(f"{tmp_path}/out").filter(upto).collect()
    batch = aggregate_rows(spark.read.parquet(f"{tmp_path}/in/*"), how).filter(upto).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, batch), key=repr) and len(got) > 3
    return progress


@pytest.mark.parametrize(
    "window, aggs, rest",
    [
        ({"sizeSeconds": 60}, SUMS + DISTINCT, {}),
        ({"sizeSeconds": 300}, DISTINCT[1:], {"keys": ()}),
        ({"type": "sliding", "sizeSeconds": 90, "slideSeconds": 60}, SUMS + DISTINCT[:1], {"nulls": "skip"}),
        ({"type": "sliding", "sizeSeconds": 120, "slideSeconds": 30}, SUMS, {"keys": ("k", "u")}),
    ],
)
def test_windows_equal_the_batchs(spark, tmp_path, window, aggs, rest):
    run(spark, rule(window, aggs, **rest), tmp_path)


@pytest.mark.parametrize("rest", [{}, {"keys": (), "nulls": "skip"}])
def test_sessions_equal_the_batchs(spark, tmp_path, timers, rest):
    progress = run(spark, rule({"type": "session", "gapSeconds": 20}, SUMS, **rest), tmp_path)
    open_sessions = max(p["stateOperators"][0]["numRowsTotal"] for p in progress)
    # a value and a timer per key, whatever the rows
    assert open_sessions <= 2 * (4 if "keys" not in rest else 1)


def test_a_row_is_in_one_pane(spark, tmp_path):
    fine = rule({"type": "sliding", "sizeSeconds": 3600, "slideSeconds": 900}, SUMS, watermark="2 days")
    put(spark, tmp_path / "in", "q", rows_of_quarter(0, random.Random(1)))
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    out = aggregate_rows(stream, fine).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck").trigger(**ONCE).start()
    out.awaitTermination()
    windows, panes = (op["numRowsTotal"] for op in out.recentProgress[0]["stateOperators"])
    assert (windows, panes) == (0, 3)


def test_what_has_no_bounded_state_is_refused(spark, tmp_path):
    put(spark, tmp_path / "in", "q", rows_of_quarter(0, random.Random(1), 2))
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    for window, aggs in (({"type": "session", "gapSeconds": 9}, DISTINCT), ({"type": "sliding", "sizeSeconds": 5, "slideSeconds": 9}, SUMS)):
        with pytest.raises(ConfigError):
            aggregate_rows(stream, rule(window, aggs))


def test_sessions_open_for_days_are_given_out_at_the_end(spark, tmp_path):
    """One type in one session from the first event to the last, one with sessions that end before, one in the last day only."""
    at = lambda every, k: f"SELECT '{k}' AS event_type, TIMESTAMP_NTZ '2024-01-01' + id * INTERVAL {every} SECONDS AS ts, id FROM range({345600 // every})"
    rows = spark.sql(f"{at(600, 'a')} UNION ALL {at(3600, 'b')} UNION ALL SELECT 'c', ts, id FROM ({at(300, 'c')}) WHERE ts > TIMESTAMP_NTZ '2024-01-04'")
    made = rows.selectExpr("row_number() OVER (ORDER BY event_type, id) AS event_id", "ts", "id AS user_id", "event_type", "id / 8 AS value", "CAST(NULL AS STRING) AS props")
    made.coalesce(1).write.parquet(f"{tmp_path}/sf/events.parquet")
    found = CHECKS["stream_session_panes"]
    got = {tuple(r) for r in found.run(spark, f"{tmp_path}/sf").collect()}
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/sf/events.parquet/*.parquet'")
        want = set(duck.execute(found.sql).fetchall())
    assert got == want and {(k, n) for k, _, n, _ in got} == {("a", 576), ("b", 1)}
