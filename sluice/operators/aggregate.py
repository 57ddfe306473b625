"""Keyed window aggregation.

On a stream the window state is Spark's own, in chained operators where windows are final. On a batch the plan is chosen so that no key, however
hot, brings more than one pre-aggregated row per key and time pane to a task:

* tumbling: one ``groupBy``, combined map-side;
* sliding: aggregate once into panes, the stretches no window starts or ends in (at most two per
  slide), then spread the few pane rows over the windows that cover them, not every input row; where
  windows cover many slides, panes are scanned instead (see :mod:`sluice.operators.sliding`);
* session: aggregate into panes as long as the gap. Rows of one pane are always in one session, so
  sessions are found among pane rows, block by block of the time line, and joined over the borders of
  blocks; a hot key, or none at all, is so spread over tasks.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.operators.sliding import fine_windows
from sluice.schema import ref, require_column
from sluice.spec import AggregateRule, Aggregation, ConfigError
from sluice.streaming.final_windows import sessions, windows

# Carried through later steps so that a second aggregation can use this one's event time.
WINDOW_COLUMN = "_window"
_TIME = "_agg_time"
# Sessions are found within stretches of so many gaps.
_BLOCK_GAPS = 10_000
# Windows of more slides than this are found by scans over panes; with fewer, a row per pane and window is cheaper.
_MOST_SPREAD = 16


def _number(a: Aggregation, nulls: str) -> Column:
    if a.input is None:
        return F.lit(0.0)
    col = ref(a.input).cast("double")
    return F.coalesce(col, F.lit(0.0)) if nulls == "zero" else col


def _rows(a: Aggregation, nulls: str) -> Column:
    return F.count(ref(a.input)) if nulls == "skip" and a.input is not None else F.count(F.lit(1))


def _distinct(a: Aggregation, rule: AggregateRule, streaming: bool) -> Column:
    if a.input is None:
        return F.count(F.lit(1))
    # streams keep a sketch per key, since exact distinct sets have no bounded state
    return F.approx_count_distinct(ref(a.input), rule.rsd) if streaming else F.count_distinct(ref(a.input))


# op -> aggregate over input rows
_DIRECT = {
    "sum": lambda a, rule, s: F.sum(_number(a, rule.nulls)),
    "count": lambda a, rule, s: _rows(a, rule.nulls),
    "avg": lambda a, rule, s: F.avg(_number(a, rule.nulls)),
    "min": lambda a, rule, s: F.min(_number(a, rule.nulls)),
    "max": lambda a, rule, s: F.max(_number(a, rule.nulls)),
    "count_distinct": _distinct,
}

# op -> aggregate over the pane columns p{i} (and q{i}, the row count of an average)
_FROM_PANES = {
    "sum": lambda p, q: F.sum(p),
    "count": lambda p, q: F.sum(p),
    "avg": lambda p, q: F.try_divide(F.sum(p), F.sum(q)),
    "min": lambda p, q: F.min(p),
    "max": lambda p, q: F.max(p),
}


def _check(df: DataFrame, rule: AggregateRule) -> None:
    for key in rule.key_fields:
        require_column(df.schema, key, "aggregate key")
    for a in rule.aggregations:
        if a.op not in _DIRECT:
            raise ConfigError(f"aggregate: unknown op {a.op!r}; known: {', '.join(_DIRECT)}")
        if a.input is not None:
            require_column(df.schema, a.input, f"aggregate {a.op} -> {a.output}")


def _with_time(df: DataFrame, rule: AggregateRule) -> tuple[DataFrame, T.DataType]:
    """Add the time column: the rule's field, an earlier step's window, or, on a stream, now."""
    if rule.time_field is not None:
        dtype = require_column(df.schema, rule.time_field, "aggregate time_field").dataType
        time = ref(rule.time_field)
        if isinstance(dtype, T.StringType) or not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ConfigError(f"aggregate: time_field {rule.time_field!r} must be a date or a timestamp")
    elif WINDOW_COLUMN in df.columns:
        if df.isStreaming:
            return df.withColumn(_TIME, F.window_time(WINDOW_COLUMN)), T.TimestampNTZType()
        time, dtype = ref(WINDOW_COLUMN)["end"] - F.expr("INTERVAL 1 MICROSECOND"), T.TimestampNTZType()
    elif df.isStreaming:
        time, dtype = F.current_timestamp(), T.TimestampNTZType()
    else:
        raise ConfigError("aggregate: a batch run needs a time_field in the rule")
    if df.isStreaming:
        if rule.time_field is not None and rule.watermark is None:
            raise ConfigError("aggregate: on a stream a time_field needs a watermark, since later rows are dropped")
        # watermarks need the zoned type; the result goes back to the declared one
        return df.withColumn(_TIME, time.cast("timestamp")).withWatermark(_TIME, rule.watermark or "0 seconds"), dtype
    return df.withColumn(_TIME, time.cast("timestamp_ntz") if isinstance(dtype, T.DateType) else time), dtype


def _seconds(n: int) -> str:
    return f"{n} seconds"


def _keys(rule: AggregateRule) -> list[Column]:
    return [ref(k) for k in rule.key_fields]


def _direct(df: DataFrame, rule: AggregateRule, window: Column | str) -> DataFrame:
    """One groupBy over the input rows; ``window`` is a window function or a column of windows."""
    group = ref(window) if isinstance(window, str) else window.alias(WINDOW_COLUMN)
    aggs = [_DIRECT[a.op](a, rule, df.isStreaming).alias(a.output) for a in rule.aggregations]
    grouped = df.groupBy(group, *_keys(rule))
    return grouped.agg(*aggs) if aggs else grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def _pane_columns(rule: AggregateRule) -> list[Column]:
    out = []
    for i, a in enumerate(rule.aggregations):
        if a.op == "count_distinct" and a.input is not None:
            continue
        if a.op == "avg":
            out.append(F.sum(_number(a, rule.nulls)).alias(f"p{i}"))
            out.append(_rows(a, rule.nulls).alias(f"q{i}"))
        else:
            op = "count" if a.op == "count_distinct" else a.op
            out.append(_DIRECT[op](a, rule, False).alias(f"p{i}"))
    return out


def _merge_columns(rule: AggregateRule) -> list[Column]:
    out = []
    for i, a in enumerate(rule.aggregations):
        if a.op == "count_distinct":
            if a.input is not None:
                continue
            out.append(F.sum(f"p{i}").alias(a.output))
        else:
            out.append(_FROM_PANES[a.op](F.col(f"p{i}"), F.col(f"q{i}") if a.op == "avg" else None).alias(a.output))
    return out


def _panes(df: DataFrame, rule: AggregateRule, pane: Column) -> DataFrame:
    """(keys, pane) -> first and last time and the partial aggregates."""
    return df.groupBy(pane.alias("_pane"), *_keys(rule)).agg(
        F.min(_TIME).alias("_first"), F.max(_TIME).alias("_last"), *_pane_columns(rule)
    )


def _fine(paned: DataFrame, rule: AggregateRule) -> DataFrame:
    """Sliding windows of many slides, from the rows with their ``_pane``."""
    # Keys by number, so that no key has the name of a working column.
    names = rule.key_fields
    paned = paned.withColumns({f"_k{i}": ref(k) for i, k in enumerate(names)})
    rule = replace(rule, key_fields=tuple(f"_k{i}" for i in range(len(names))))
    parts = {}
    for i, a in enumerate(rule.aggregations):
        if a in _distincts(rule):
            continue
        parts[f"p{i}"] = a.op if a.op in ("min", "max") else "sum"
        if a.op == "avg":
            parts[f"q{i}"] = "sum"
    panes = _panes(paned, rule, ref("_pane")).drop("_first", "_last").withColumn("_n", F.lit(1))
    values = {
        f"d{i}": paned.select("_pane", *_keys(rule), ref(a.input).alias("_value")).filter("_value IS NOT NULL").distinct()
        for i, a in enumerate(_distincts(rule))
    }
    size, slide = rule.window.size_seconds, rule.window.slide_seconds
    out = fine_windows(panes, values, list(rule.key_fields), parts, size, slide)
    zone = paned.schema["_pane"].dataType
    at = lambda s: F.timestamp_seconds(s).cast(zone)
    window = F.struct(at(F.col("_start")).alias("start"), at(F.col("_start") + size).alias("end"))
    distinct = iter(values)
    columns = []
    for i, a in enumerate(rule.aggregations):
        if a in _distincts(rule):
            col = F.col(next(distinct))
        else:
            col = F.try_divide(F.col(f"p{i}"), F.col(f"q{i}")) if a.op == "avg" else F.col(f"p{i}")
        columns.append(col.alias(a.output))
    keys = (ref(k).alias(name) for k, name in zip(rule.key_fields, names))
    return out.select(window.alias(WINDOW_COLUMN), *keys, *columns)


def _sliding(df: DataFrame, rule: AggregateRule) -> DataFrame:
    size, slide = rule.window.size_seconds, rule.window.slide_seconds
    if slide > size:
        # gaps between windows: tumble by the slide and leave out what falls between
        df = df.withColumn("_w", F.window(_TIME, _seconds(slide)))
        df = df.filter(ref(_TIME) < ref("_w")["start"] + F.expr(f"INTERVAL {size} SECONDS"))
        if df.isStreaming:
            return _direct(df, rule, F.window(_TIME, _seconds(slide)))
        start = ref("_w")["start"]
        short = F.struct(start.alias("start"), (start + F.expr(f"INTERVAL {size} SECONDS")).alias("end"))
        return _direct(df.withColumn(WINDOW_COLUMN, short), rule, WINDOW_COLUMN)
    window = F.window(_TIME, _seconds(size), _seconds(slide))
    if df.isStreaming:
        return _direct(df, rule, window)
    start = F.window(_TIME, _seconds(slide))["start"]
    cut = start + F.expr(f"INTERVAL {size % slide} SECONDS")
    pane = F.when(ref(_TIME) < cut, start).otherwise(cut) if size % slide else start
    paned = df.withColumn("_pane", pane)
    if size > _MOST_SPREAD * slide:
        return _fine(paned, rule)
    panes = _panes(paned, rule, ref("_pane")).withColumn(_TIME, ref("_pane"))
    out = panes.groupBy(window.alias(WINDOW_COLUMN), *_keys(rule)).agg(F.count(F.lit(1)).alias("_panes"), *_merge_columns(rule))
    for a in _distincts(rule):
        # one row per pane and value is spread over the windows, not every input row
        values = paned.select(ref("_pane").alias(_TIME), *_keys(rule), ref(a.input).alias("_value")).distinct()
        counted = values.groupBy(window.alias(WINDOW_COLUMN), *_keys(rule)).agg(F.count_distinct("_value").alias(a.output))
        out = _null_safe_join(out, counted, [WINDOW_COLUMN, *rule.key_fields])
    return out.drop("_panes")


def _distincts(rule: AggregateRule) -> list[Aggregation]:
    return [a for a in rule.aggregations if a.op == "count_distinct" and a.input is not None]


def _session(df: DataFrame, rule: AggregateRule) -> DataFrame:
    gap = rule.window.gap
    if df.isStreaming:
        return _direct(df, rule, F.session_window(_TIME, _seconds(gap)))
    interval = F.expr(f"INTERVAL {gap} SECONDS")
    pane = F.window(_TIME, _seconds(gap))["start"]
    keys = list(rule.key_fields)
    panes = _sessions_of(_panes(df, rule, pane), keys, interval, gap * _BLOCK_GAPS)
    sessions = panes.groupBy("_session", *_keys(rule)).agg(F.max("_last").alias("_last"), *_merge_columns(rule))
    for a in _distincts(rule):
        sessions = _null_safe_join(sessions, _session_distinct(df, panes, pane, a, keys), ["_session", *keys])
    bounds = F.struct(F.col("_session").alias("start"), (F.col("_last") + interval).alias("end"))
    return sessions.select(bounds.alias(WINDOW_COLUMN), *_keys(rule), *(ref(a.output) for a in rule.aggregations))


def _sessions_of(panes: DataFrame, keys: list[str], interval: Column, block_seconds: int) -> DataFrame:
    """``panes`` with ``_session``, the start of the session they belong to.

    The time line is cut into blocks. Sessions are found within the blocks of each key, and then only the blocks, one
    row each, are put in order to join the sessions that go on over a border.
    """
    panes = panes.withColumn("_block", F.floor(F.unix_timestamp("_pane") / block_seconds))
    own = [*(ref(k) for k in keys), F.col("_block")]
    within = Window.partitionBy(*own).orderBy("_pane")
    seen = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        panes.withColumn("_prev", F.lag("_last").over(within))
        .withColumn("_open", F.when(F.col("_prev").isNull() | (F.col("_first") > F.col("_prev") + interval), F.col("_first")))
        .withColumn("_start", F.last("_open", ignorenulls=True).over(seen))
    )
    blocks = local.groupBy(*own).agg(
        F.min("_first").alias("_b_first"), F.max("_last").alias("_b_last"), F.max("_start").alias("_b_start")
    )
    along = Window.partitionBy(*(ref(k) for k in keys)).orderBy("_block")  # one row per block of the time line
    so_far = along.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("_b_first") <= F.lag("_b_last").over(along) + interval, F.lit(False))
    blocks = (
        blocks.withColumn("_on", goes_on)
        .withColumn("_own", F.when(~F.col("_on") | (F.col("_b_start") != F.col("_b_first")), F.col("_b_start")))
        .withColumn("_carried", F.when(F.col("_on"), F.last("_own", ignorenulls=True).over(so_far)))
        .drop("_own", "_on", "_b_last", "_b_start")
    )
    joined = _null_safe_join(local, blocks, [*keys, "_block"])
    carried = F.when(F.col("_start") == F.col("_b_first"), F.col("_carried"))
    return joined.withColumn("_session", F.coalesce(carried, "_start")).drop("_block", "_prev", "_open", "_start", "_b_first", "_carried")


def _session_distinct(df: DataFrame, panes: DataFrame, pane: Column, a: Aggregation, keys: list[str]) -> DataFrame:
    """Exact distinct count per session: distinct (pane, value) rows, then joined to their session."""
    value = ref(a.input).alias("_value")
    values = df.select(pane.alias("_pane"), *(ref(k) for k in keys), value).distinct()
    owner = panes.select("_pane", *(ref(k) for k in keys), "_session")
    joined = _null_safe_join(values, owner, ["_pane", *keys])
    return joined.groupBy("_session", *(ref(k) for k in keys)).agg(F.count_distinct("_value").alias(a.output))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null, keeping the left copy of each key."""
    renamed = right.select(*(ref(c).alias(f"_r_{c}") if c in keys else ref(c) for c in right.columns))
    on = [ref(k).eqNullSafe(ref(f"_r_{k}")) for k in keys]
    return left.join(renamed, on).drop(*(f"_r_{k}" for k in keys))


def aggregate_rows(df: DataFrame, rule: AggregateRule, keep_window: bool = False) -> DataFrame:
    """Group by the rule's keys and window: keys first, then the aggregates in rule order.

    Numbers are doubles and a null counts as 0.0 (``nulls: "skip"`` gives SQL semantics); ``count``
    counts rows. ``emit_window`` appends ``window_start`` and ``window_end``. On a stream ``final`` gives each window
    out once, when it is complete (see :mod:`sluice.streaming.final_windows`); a batch is complete anyway.
    """
    _check(df, rule)
    df, time_type = _with_time(df, rule)
    kind = rule.window.kind
    if df.isStreaming and rule.final:
        out = (sessions if kind == "session" else windows)(df, rule, _TIME, WINDOW_COLUMN)
    elif kind == "session":
        out = _session(df, rule)
    elif kind == "sliding":
        out = _sliding(df, rule)
    else:
        out = _direct(df, rule, F.window(_TIME, _seconds(rule.window.size_seconds)))
    cols = [*_keys(rule), *(ref(a.output) for a in rule.aggregations)]
    if rule.emit_window:
        bound_type = "timestamp" if isinstance(time_type, T.TimestampType) else "timestamp_ntz"
        end = ref(WINDOW_COLUMN)["end"]
        if df.isStreaming and kind == "sliding" and rule.window.slide_seconds > rule.window.size_seconds:
            end = ref(WINDOW_COLUMN)["start"] + F.expr(f"INTERVAL {rule.window.size_seconds} SECONDS")
        cols.append(ref(WINDOW_COLUMN)["start"].cast(bound_type).alias("window_start"))
        cols.append(end.cast(bound_type).alias("window_end"))
    if keep_window:
        cols.append(ref(WINDOW_COLUMN))
    return out.select(*cols)
