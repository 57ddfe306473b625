import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from sluice import AggregateRule, ConfigError, aggregate_rows
from sluice.operators import aggregate

AGGS = [
    {"output": "total", "op": "sum", "input": "amount"},
    {"output": "n", "op": "count"},
    {"output": "mean", "op": "avg", "input": "amount"},
]


def rule(window=None, aggs=AGGS, keys=("user_id", "event_type"), **rest):
    return AggregateRule.from_json({"key_fields": list(keys), "time_field": "at", "window": window or {}, "aggregations": aggs, **rest})


@pytest.fixture(scope="module")
def rows(spark):
    data = [("10:00:10", 1, "click", 10.0), ("10:00:50", 1, "click", None), ("10:01:00", 1, "click", 4.0), ("10:00:20", None, "click", 1.0)]
    df = spark.createDataFrame([("2024-01-01 " + t, u, e, a) for t, u, e, a in data], "at string, user_id bigint, event_type string, amount double")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def result(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_documented_example(rows):
    out = aggregate_rows(rows, rule())
    assert out.columns == ["user_id", "event_type", "total", "n", "mean"]
    assert result(out, "user_id", F.desc("total")) == [
        (None, "click", 1.0, 1, 1.0),
        (1, "click", 10.0, 2, 5.0),
        (1, "click", 4.0, 1, 4.0),
    ]


def test_nulls_skipped(rows):
    out = aggregate_rows(rows.filter("user_id = 1"), rule({"sizeSeconds": 3600}, nulls="skip"))
    assert result(out, "user_id") == [(1, "click", 14.0, 3, 7.0)]


def test_sliding_windows_cover_each_row(rows):
    out = aggregate_rows(rows.filter("amount = 10"), rule({"type": "sliding", "sizeSeconds": 60, "slideSeconds": 30}, emit_window=True))
    starts = [str(r.window_start) for r in out.orderBy("window_start").collect()]
    assert starts == ["2024-01-01 09:59:30", "2024-01-01 10:00:00"]


def test_slide_longer_than_size_leaves_gaps(rows):
    out = aggregate_rows(rows, rule({"type": "sliding", "sizeSeconds": 30, "slideSeconds": 60}, keys=(), emit_window=True))
    got = [(r.total, r.n, str(r.window_start), str(r.window_end)) for r in out.orderBy("window_start").collect()]
    assert got == [
        (11.0, 2, "2024-01-01 10:00:00", "2024-01-01 10:00:30"),
        (4.0, 1, "2024-01-01 10:01:00", "2024-01-01 10:01:30"),
    ]


def test_no_input_and_no_keys(rows):
    aggs = [{"output": o, "op": o} for o in ("sum", "avg", "min", "max", "count", "count_distinct")]
    assert result(aggregate_rows(rows, rule({"sizeSeconds": 3600}, aggs, keys=())), "count") == [(0.0, 0.0, 0.0, 0.0, 4, 4)]


@pytest.mark.parametrize("gap", [1, 7, 60, 600, 5000])
def test_sessions_equal_the_built_in_ones(events, gap):
    """Session panes against Spark's own session window, distinct counts included."""
    aggs = [{"output": "n", "op": "count"}, {"output": "high", "op": "max", "input": "value"}, {"output": "users", "op": "count_distinct", "input": "user_id"}]
    spec = AggregateRule.from_json(
        {"key_fields": ["kind"], "time_field": "ts", "window": {"type": "session", "gapSeconds": gap}, "aggregations": aggs, "emit_window": True}
    )
    source = events.withColumn("kind", F.expr("nullif(event_type, 'error')"))
    built_in = source.groupBy("kind", F.session_window("ts", f"{gap} seconds").alias("w")).agg(
        F.count("*").alias("n"), F.max("value").alias("high"), F.size(F.collect_set("user_id")).cast("bigint").alias("users")
    )
    expected = built_in.select("kind", "n", "high", "users", "w.start", "w.end")
    got = aggregate_rows(source, spec)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_session_gap_is_inclusive(rows):
    out = aggregate_rows(rows.filter("user_id = 1"), rule({"type": "session", "gapSeconds": 10}))
    assert sorted(r.n for r in out.collect()) == [1, 2]


@pytest.mark.parametrize(
    "bad",
    [
        dict(aggs=[{"output": "m", "op": "median", "input": "amount"}]),
        dict(aggs=[{"output": "m", "op": "sum", "input": "missing"}]),
        dict(keys=("missing",)),
        dict(time_field="user_id"),
        dict(time_field="missing"),
        dict(time_field=None),
    ],
)
def test_bad_rules_fail_when_compiled(rows, bad):
    with pytest.raises(ConfigError):
        aggregate_rows(rows, rule(**bad))


def test_non_numeric_text_fails(rows):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        aggregate_rows(rows, rule(aggs=[{"output": "s", "op": "sum", "input": "event_type"}])).collect()


def test_plans_combine_before_the_shuffle(rows):
    tumbling = plan_of(aggregate_rows(rows, rule()))
    assert tumbling.count("Exchange") == 1 and "partial_sum" in tumbling
    sliding = plan_of(aggregate_rows(rows, rule({"type": "sliding", "sizeSeconds": 60, "slideSeconds": 10})))
    # the spread over windows comes after the panes are aggregated, not over the input rows
    assert sliding.index("Expand") < sliding.index("partial_count") and sliding.count("Exchange") == 2
    session = plan_of(aggregate_rows(rows, rule({"type": "session", "gapSeconds": 60})))
    assert "partial_sum" in session.split("Window [", 1)[1]  # below the windows, over panes


@pytest.mark.parametrize("keys", [["user_id"], []])
def test_sessions_over_borders_of_blocks(events, monkeypatch, keys):
    from sluice.operators import aggregate

    rule = AggregateRule.from_json(
        {"key_fields": keys, "time_field": "ts", "window": {"type": "session", "gapSeconds": 3600}, "emit_window": True,
         "aggregations": [{"output": "n", "op": "count"}, {"output": "users", "op": "count_distinct", "input": "user_id"}]}
    )
    whole = sorted(map(tuple, aggregate_rows(events, rule).collect()))
    monkeypatch.setattr(aggregate, "_BLOCK_GAPS", 2)
    assert sorted(map(tuple, aggregate_rows(events, rule).collect())) == whole and len(whole) > (1 if keys else 0)


ALL = [
    {"output": "total", "op": "sum", "input": "v"},
    {"output": "n", "op": "count"},
    {"output": "held", "op": "count", "input": "v"},
    {"output": "mean", "op": "avg", "input": "v"},
    {"output": "low", "op": "min", "input": "v"},
    {"output": "high", "op": "max", "input": "v"},
    {"output": "kinds", "op": "count_distinct", "input": "v"},
    {"output": "names", "op": "count_distinct", "input": "w"},
]


def sliding(size, slide, keys=("k",), aggs=ALL, **rest):
    return rule({"type": "sliding", "sizeSeconds": size, "slideSeconds": slide}, aggs, keys, emit_window=True, **rest)


def same_both_ways(df, how, monkeypatch):
    """Windows found by scans over panes, and by a row per pane and window."""
    found = []
    for most in (1, 10**9):
        monkeypatch.setattr(aggregate, "_MOST_SPREAD", most)
        out = aggregate_rows(df, how)
        found.append((out.schema.simpleString(), sorted((tuple(r) for r in out.collect()), key=repr)))
    assert found[0] == found[1]
    return found[0][1]


@pytest.mark.parametrize("size, slide, zone, nulls", [(90, 1, "timestamp_ntz", "zero"), (61, 3, "timestamp", "skip"), (100, 40, "timestamp_ntz", "skip"), (7, 2, "timestamp", "zero")])
def test_fine_sliding_windows(spark, monkeypatch, size, slide, zone, nulls):
    r = random.Random(size)
    data = [
        (f"19{r.choice([69, 70])}-0{r.choice([1, 1, 2])}-01 00:{r.randint(0, 6):02d}:{r.randint(0, 59):02d}.{r.randint(0, 999):03d}",
         r.choice(["a", "b", None]), r.choice([None, 1.0, 2.5, -3.0, 7.25, float("inf")]), r.choice([None, "x", "y", "z"]))
        for _ in range(150)
    ]
    df = spark.createDataFrame(data + data[:9], "at string, k string, v double, w string").withColumn("at", F.col("at").cast(zone))
    assert len(same_both_ways(df, sliding(size, slide, nulls=nulls), monkeypatch)) > 100


def test_fine_sliding_windows_without_keys_rows_or_aggregates(spark, rows, monkeypatch):
    df = rows.withColumnRenamed("user_id", "_block").withColumnRenamed("event_type", "_at")
    total = [{"output": "sum of all", "op": "sum", "input": "amount"}, {"output": "p0", "op": "count_distinct", "input": "_block"}]
    assert len(same_both_ways(df, sliding(60, 2, (), total), monkeypatch)) == 55
    assert len(same_both_ways(df, sliding(60, 2, (), []), monkeypatch)) == 55
    assert len(same_both_ways(df, sliding(60, 2, ("_block", "_at"), total[:1]), monkeypatch)) == 85
    assert same_both_ways(df.limit(0), sliding(60, 2, (), total), monkeypatch) == []


def test_fine_sliding_sums_do_not_cancel(spark, monkeypatch):
    data = [("2024-01-01 00:00:00", 1e20), ("2024-01-01 00:00:30", 1.0), ("2024-01-01 00:01:10", 2.0)]
    df = spark.createDataFrame(data, "at string, v double").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = same_both_ways(df, sliding(60, 1, (), [{"output": "s", "op": "sum", "input": "v"}]), monkeypatch)
    assert {r[0] for r in got} == {1e20, 1.0, 2.0, 3.0}


def test_fine_sliding_windows_take_no_row_per_window(spark):
    """The rows that are scanned are as many whatever the ratio; only the last step writes windows."""
    df = spark.range(2000).select((F.lit(1704067200) + F.col("id") * 7).cast("timestamp").alias("at"), (F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"), F.lit("x").alias("w"))
    for size in (600, 6000):
        plan = plan_of(aggregate_rows(df, sliding(size, 1)))
        assert "Expand" not in plan and plan.count("Generate explode(sequence") == 1
