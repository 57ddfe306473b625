"""Random rules over random rows against a small interpreter of the rule semantics."""

import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice import AggregateRule, FilterRule, TransformRule, aggregate_rows, filter_rows, transform_rows

TEXTS = [None, "", "a", "B", "10", "9", "9.5", "-1", "1e1", "click", "view", " 7"]
NUMBERS = [None, -1.5, 0.0, 1.0, 9.0, 10.0, 100.25]
WHOLES = [None, -1, 0, 1, 9, 10, 100]


def number(value):
    """The value as a decimal, if the ordering rule counts it as a number."""
    if isinstance(value, bool) or value is None:
        return None
    text = value if isinstance(value, str) else repr(value)
    if text != text.strip() or not text:
        return None
    try:
        parsed = Decimal(text)
    except ArithmeticError:
        return None
    return parsed if parsed.is_finite() else None


def compare(a, b):
    if a is None or b is None:
        return -1 if a is None else 1
    x, y = number(a), number(b)
    if x is not None and y is not None:
        return (x > y) - (x < y)
    x, y = as_text(a), as_text(b)
    return (x > y) - (x < y)


def as_text(value):
    return value if isinstance(value, str) else repr(value)


def equal(a, b):
    """Typed equality: a number column equals numeric text, a text column only the same text."""
    if a is None or b is None:
        return a is b
    if isinstance(a, str):
        return a == as_text(b)
    x, y = number(a), number(b)
    return x is not None and x == y


def holds(row, c):
    a, op, b, values = row[c["field"]], c["op"], c.get("value"), c.get("values")
    if op in ("gt", "gte", "lt", "lte"):
        order = compare(a, b)
        return {"gt": order > 0, "gte": order >= 0, "lt": order < 0, "lte": order <= 0}[op]
    if op in ("eq", "ne"):
        return equal(a, b) == (op == "eq")
    if op in ("in", "not_in"):
        return any(equal(a, v) for v in values or []) == (op == "in")
    if op in ("is_null", "not_null"):
        return (a is None) == (op == "is_null")
    return a is not None and {"contains": str.__contains__, "starts_with": str.startswith, "ends_with": str.endswith}[op](as_text(a), as_text(b))


@pytest.fixture(scope="module")
def grid(spark):
    rows = [(i, t, NUMBERS[(i * 3) % 7], WHOLES[(i * 5) % 7]) for i, t in enumerate(TEXTS * 7)]
    df = spark.createDataFrame(rows, "id int, t string, n double, w bigint").coalesce(1).cache()
    return df, [dict(zip(df.columns, r)) for r in rows]


literals = st.one_of(st.sampled_from(TEXTS), st.sampled_from(NUMBERS), st.sampled_from(WHOLES))
compared = st.fixed_dictionaries({"field": st.sampled_from("tnw"), "op": st.sampled_from(["eq", "ne", "gt", "gte", "lt", "lte"]), "value": literals})
members = st.fixed_dictionaries({"field": st.sampled_from("tnw"), "op": st.sampled_from(["in", "not_in"]), "values": st.lists(literals, max_size=4)})
texts = st.fixed_dictionaries(
    {"field": st.just("t"), "op": st.sampled_from(["contains", "starts_with", "ends_with"]), "value": st.sampled_from([t for t in TEXTS if t is not None])}
)
nulls = st.fixed_dictionaries({"field": st.sampled_from("tnw"), "op": st.sampled_from(["is_null", "not_null"])})
conditions = st.lists(st.one_of(compared, members, texts, nulls), max_size=3)
quick = settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))


@quick
@given(conditions=conditions, logic=st.sampled_from(["AND", "OR"]))
def test_filters(grid, conditions, logic):
    df, rows = grid
    got = {r.id for r in filter_rows(df, FilterRule.from_json({"logic": logic, "conditions": conditions})).select("id").collect()}
    join = any if logic == "OR" and conditions else all
    assert got == {r["id"] for r in rows if join(holds(r, c) for c in conditions)}


def transformed(row, m):
    op, value = m["op"], row.get(m.get("input"))
    if op in ("add", "sub", "mul", "divide"):
        if value is None or (op == "divide" and m["operand"] == 0):
            return None
        a, b = float(value), float(m["operand"])
        return {"add": lambda: a + b, "sub": lambda: a - b, "mul": lambda: a * b, "divide": lambda: a / b}[op]()
    if op == "concat":
        return m["separator"].join(row[i] or "" for i in m["inputs"])
    text = value or ""
    if op == "substring":
        return text[m["start"] : m["start"] + m["length"]]
    if op == "if_else":
        return m["then_value"] if holds(row, m["condition"]) else m["else_value"]
    return {"upper": text.upper, "lower": text.lower, "trim": text.strip, "rename": lambda: value}[op]()


mappings = st.lists(
    st.one_of(
        st.fixed_dictionaries({"op": st.sampled_from(["add", "sub", "mul", "divide"]), "input": st.sampled_from("nw"), "operand": st.sampled_from([0, 2, -0.5])}),
        st.fixed_dictionaries({"op": st.just("concat"), "inputs": st.lists(st.just("t"), min_size=1, max_size=3), "separator": st.sampled_from(["", "-"])}),
        st.fixed_dictionaries({"op": st.just("substring"), "input": st.just("t"), "start": st.integers(0, 6), "length": st.integers(0, 6)}),
        st.fixed_dictionaries({"op": st.sampled_from(["upper", "lower", "trim", "rename"]), "input": st.just("t")}),
        st.fixed_dictionaries({"op": st.just("if_else"), "condition": compared, "then_value": st.just("yes"), "else_value": st.sampled_from(["no", None])}),
    ),
    min_size=1,
    max_size=4,
)


@quick
@given(mappings=mappings, outputs=st.lists(st.sampled_from(["x", "y", "z"]), min_size=4, max_size=4))
def test_transforms(grid, mappings, outputs):
    df, rows = grid
    named = [{**m, "output": o} for m, o in zip(mappings, outputs)]
    out = transform_rows(df, TransformRule.from_json({"mappings": named}))
    last = {m["output"]: m for m in named}
    got = {r.id: r for r in out.collect()}
    for row in rows:
        for name, m in last.items():
            assert got[row["id"]][name] == transformed(row, m), (row, m)


@quick
@given(
    times=st.lists(st.tuples(st.integers(0, 400), st.sampled_from(["a", "b", None]), st.sampled_from(NUMBERS)), min_size=1, max_size=25),
    size=st.integers(1, 90),
    slide=st.integers(1, 90),
)
def test_sliding_windows(spark, times, size, slide):
    df = spark.createDataFrame([(s, k, v) for s, k, v in times], "s bigint, k string, v double").coalesce(1)
    df = df.withColumn("at", F.timestamp_seconds("s").cast("timestamp_ntz"))
    aggs = [{"output": o, "op": o, "input": "v"} for o in ("sum", "count", "avg", "min", "max")]
    rule = AggregateRule.from_json(
        {"key_fields": ["k"], "time_field": "at", "window": {"type": "sliding", "sizeSeconds": size, "slideSeconds": slide}, "aggregations": aggs, "emit_window": True}
    )
    out = aggregate_rows(df, rule).withColumn("start", F.unix_seconds(F.col("window_start").cast("timestamp")))
    got = {(r.k, r.start): (r["sum"], r["count"], r["avg"], r["min"], r["max"]) for r in out.collect()}
    expected: dict = {}
    for second, key, value in times:
        start = second // slide * slide
        while start > second - size:
            expected.setdefault((key, start), []).append(value or 0.0)
            start -= slide
    assert got.keys() == expected.keys()
    for window, values in expected.items():
        total, n, mean, low, high = got[window]
        assert (n, low, high) == (len(values), min(values), max(values))
        assert math.isclose(total, sum(values), abs_tol=1e-9) and math.isclose(mean, sum(values) / n, abs_tol=1e-9)


def test_grid_is_not_degenerate(grid):
    df, rows = grid
    assert len(rows) == 84 and df.select(F.row_number().over(Window.orderBy("id"))).count() == 84
