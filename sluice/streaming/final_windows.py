"""Windows of a stream that are given out once, when the watermark has passed them.

Since nothing is revised, state operators can be chained, and each holds less than one operator over all rows would:

* rows are first aggregated into panes, the greatest stretch that size and slide are multiples of, and windows are then
  made of finished panes: a row touches one state entry, not one per window that covers it;
* distinct counts are exact: each value is a key of its own until its window is complete, and complete ones are counted;
* sessions are joined from finished panes as long as the gap. Panes come in the order of time, so each key holds one open
  session, however many rows it has.

The query that runs them must be in append mode. Sessions need a state store that takes timers (RocksDB), which
:func:`sluice.streaming.runner.run_stream` sets.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schema import ref
from sluice.spec import AggregateRule, Aggregation, ConfigError
from sluice.streaming.processors import Sessions

_MERGE = {"min": F.min, "max": F.max}


def _number(a: Aggregation, nulls: str):
    if a.input is None:
        return F.lit(0.0)
    col = ref(a.input).cast("double")
    return F.coalesce(col, F.lit(0.0)) if nulls == "zero" else col


def _is_distinct(a: Aggregation) -> bool:
    return a.op == "count_distinct" and a.input is not None


def _partials(rule: AggregateRule) -> dict[str, tuple]:
    """Column -> (aggregate over rows, how two of them merge)."""
    out = {}
    for i, a in enumerate(rule.aggregations):
        rows = F.count(ref(a.input)) if rule.nulls == "skip" and a.input is not None else F.count(F.lit(1))
        if _is_distinct(a):
            continue
        if a.op in ("count", "count_distinct"):
            out[f"p{i}"] = (rows, "sum")
        elif a.op in _MERGE:
            out[f"p{i}"] = (_MERGE[a.op](_number(a, rule.nulls)), a.op)
        else:
            out[f"p{i}"] = (F.sum(_number(a, rule.nulls)), "sum")
            if a.op == "avg":
                out[f"q{i}"] = (rows, "sum")
    return out


def _result(i: int, a: Aggregation):
    return (F.try_divide(F.col(f"p{i}"), F.col(f"q{i}")) if a.op == "avg" else F.col(f"p{i}")).alias(a.output)


def _spread(df: DataFrame, rule: AggregateRule) -> tuple[DataFrame, list[str]]:
    """Rows once for the plain aggregates (``_g`` 0) and once for each distinct input, with its value and nothing else."""
    inputs = [a.input for a in rule.aggregations if _is_distinct(a)]
    if not inputs:
        return df, []
    kinds = [df.schema[name].dataType for name in inputs]
    one = lambda g: F.struct(
        F.lit(g).alias("_g"), *((ref(n) if j == g else F.lit(None)).cast(t).alias(f"_v{j}") for j, (n, t) in enumerate(zip(inputs, kinds), 1))
    )
    held = [F.when(ref(n).isNotNull(), one(j)) for j, n in enumerate(inputs, 1)]
    copies = F.filter(F.array(one(0), *held), lambda c: c.isNotNull())
    values = [f"_v{j}" for j in range(1, len(inputs) + 1)]
    return df.withColumn("_c", F.explode(copies)).select("*", "_c._g", *(f"_c.{v}" for v in values)).drop("_c"), ["_g", *values]


def windows(df: DataFrame, rule: AggregateRule, time: str, window_column: str) -> DataFrame:
    """``window_column``, keys and aggregates of the tumbling or sliding windows of a stream with a watermark on ``time``."""
    names = rule.key_fields
    df = df.withColumns({f"_k{i}": ref(k) for i, k in enumerate(names)})
    keys = [f"_k{i}" for i in range(len(names))]
    size = rule.window.size_seconds
    slide = rule.window.slide_seconds if rule.window.kind == "sliding" else size
    if slide > size:
        raise ConfigError("aggregate: final windows of a stream must not leave gaps")
    df, apart = _spread(df, rule)
    partials = _partials(rule)
    pane = F.window(time, f"{gcd(size, slide)} seconds").alias(window_column)
    some = [agg.alias(p) for p, (agg, _) in partials.items()] or [F.count(F.lit(1)).alias("_n")]
    out = df.groupBy(pane, *keys, *apart).agg(*some)
    merged = [_MERGE.get(op, F.sum)(p).alias(p) for p, (_, op) in partials.items()] or [F.sum("_n").alias("_n")]
    if slide < size:
        out = out.groupBy(F.window(window_column, f"{size} seconds", f"{slide} seconds").alias(window_column), *keys, *apart).agg(*merged)
    if apart:
        plain = F.col("_g") == 0
        sums = [_MERGE.get(op, F.sum)(F.when(plain, F.col(p))).alias(p) for p, (_, op) in partials.items()]
        counts = [F.count_if(F.col("_g") == j).alias(f"_d{j}") for j in range(1, len(apart))]
        out = out.groupBy(window_column, *keys).agg(*sums, *counts)
    distinct = iter(range(1, len(apart)))
    columns = [
        F.col(f"_d{next(distinct)}").alias(a.output) if _is_distinct(a) else _result(i, a) for i, a in enumerate(rule.aggregations)
    ]
    return out.select(window_column, *(F.col(k).alias(n) for k, n in zip(keys, names)), *columns)


def sessions(df: DataFrame, rule: AggregateRule, time: str, window_column: str) -> DataFrame:
    """``window_column``, keys and aggregates of the sessions of a stream with a watermark on ``time``."""
    if any(_is_distinct(a) for a in rule.aggregations):
        raise ConfigError("aggregate: distinct counts of final sessions have no bounded state; leave 'final' out to have a sketch")
    names = rule.key_fields
    df = df.withColumns({f"_k{i}": ref(k) for i, k in enumerate(names)}).withColumn("_all", F.lit(0))
    gap, partials = rule.window.gap, _partials(rule)
    # Without keys all sessions are one group, of a pane per gap.
    group, keys = [f"_k{i}" for i in range(len(names))] or ["_all"], [f"k{i}" for i in range(len(names))]
    pane = F.window(time, f"{gap} seconds").alias(window_column)
    some = [agg.alias(p) for p, (agg, _) in partials.items()]
    panes = df.groupBy(pane, *group).agg(F.min(time).alias("first"), F.max(time).alias("last"), *some)
    panes = panes.select(window_column, *(F.col(k).alias(k[1:]) for k in group), "first", "last", *partials)
    state = T.StructType([T.StructField(c, panes.schema[c].dataType) for c in ("first", "last", *partials)])
    made = T.StructType([*(T.StructField(k, panes.schema[k].dataType) for k in keys), *state.fields])
    processor = Sessions(gap, len(keys), {p: op for p, (_, op) in partials.items()}, state)
    found = panes.groupBy(*(k[1:] for k in group)).transformWithStateInPandas(processor, made, "append", "eventTime")
    ends = F.col("last") + F.expr(f"INTERVAL {gap} SECONDS")
    bounds = F.struct(F.col("first").alias("start"), ends.alias("end")).alias(window_column)
    columns = [_result(i, a) for i, a in enumerate(rule.aggregations)]
    return found.select(bounds, *(F.col(k).alias(n) for k, n in zip(keys, names)), *columns)
