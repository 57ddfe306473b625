"""Sliding windows whose slide is a small part of their size, without a row per pane and window.

Windows are as long as a block of the time line, so each one is the end of one block and the beginning of the next. Two
scans over the panes of a block give the aggregates from every pane to the block's end, and from its beginning to every
pane; a window joins one of each. Between two panes' comings and goings all windows are alike: their aggregates are found
once per change, and windows are written out only at the very end. Distinct counts change where a value's next occurrence
takes over from the last: plus one where it comes into view, minus one where it leaves. The work grows with the panes,
whatever the ratio of size to slide, and a hot key is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.schema import ref

# Names of the working columns, which must differ from all keys.
_BLOCK, _AT, _TAIL, _HEAD, _CHANGE = "_block", "_at", "_tail", "_head", "_change"


def _seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def _merged(op: str, a: Column, b: Column) -> Column:
    """Two partial aggregates of which either may be missing."""
    if op == "min":
        return F.least(a, b)
    return F.greatest(a, b) if op == "max" else F.coalesce(a + b, a, b)


_SCAN = {"min": F.min, "max": F.max, "sum": F.sum}


def _changes_of_panes(panes: DataFrame, keys: list[str], parts: Mapping[str, str], size: int) -> DataFrame:
    """Where the aggregates of the windows that start in a block change: (keys, block, at) with the new ``_tail``, of the
    window's part in its own block, or ``_head``, of its part in the next."""
    start = _seconds(F.col("_pane"))
    rows = panes.withColumn(_AT, start).withColumn(_BLOCK, F.floor(start / size))
    own = [*(ref(k) for k in keys), F.col(_BLOCK)]
    up, down = Window.partitionBy(*own).orderBy(_AT), Window.partitionBy(*own).orderBy(F.desc(_AT))
    # Both scans run from their first row on: a frame that ends at the last row would be added up anew for each row.
    so_far = lambda along: along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scan = lambda along: F.struct(*(_SCAN[op](p).over(so_far(along)).alias(p) for p, op in parts.items()))
    rows = rows.select(*own, _AT, scan(up).alias(_HEAD), scan(down).alias(_TAIL), F.lag(_AT).over(up).alias("_before"), F.lead(_AT).over(up).alias("_after"))
    kind = rows.schema[_TAIL].dataType
    none, first = F.lit(None).cast(kind), F.col(_BLOCK) * size
    empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields)).cast(kind)
    change = lambda block, at, tail, head: F.struct(
        block.alias(_BLOCK), at.alias(_AT), tail.alias(_TAIL), head.alias(_HEAD)
    )
    changes = F.array(
        change(F.col(_BLOCK), F.coalesce(F.col("_before") + 1, first), F.col(_TAIL), none),
        change(F.col(_BLOCK) - 1, F.col(_AT) - size + 1, none, F.col(_HEAD)),
        F.when(F.col("_after").isNull(), change(F.col(_BLOCK), F.col(_AT) + 1, empty, none)),
    )
    out = rows.select(*(ref(k) for k in keys), F.explode(changes).alias(_CHANGE)).select(*(ref(k) for k in keys), f"{_CHANGE}.*")
    return out.filter(F.col(_AT) < (F.col(_BLOCK) + 1) * size)


def _changes_of_values(values: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Where the distinct count of the windows that start in a block changes, from 0 at the block's start: (keys, block, at)
    and by how much. ``values`` are distinct (keys, _pane, _value) without null values."""
    at = _seconds(F.col("_pane"))
    rows = values.withColumn(_AT, at).withColumn(_BLOCK, F.floor(at / size)).drop("_pane")
    own = [*(ref(k) for k in keys), F.col("_value"), F.col(_BLOCK)]
    # Only the last occurrence in the block before can be near enough to matter in a block.
    ghosts = rows.groupBy(*own).agg(F.max(_AT).alias(_AT)).withColumn(_BLOCK, F.col(_BLOCK) + 1).withColumn("_own", F.lit(False))
    both = rows.withColumn("_own", F.lit(True)).unionByName(ghosts)
    before = F.lag(_AT).over(Window.partitionBy(*own).orderBy(_AT))
    # Each start of a window belongs to the first occurrence at or after it.
    opens = F.greatest(F.col(_AT) - size, F.col("_before")) + 1
    found = both.withColumn("_before", before).filter("_own").withColumn("_opens", opens)
    first = F.col(_BLOCK) * size
    change = lambda block, at, by: F.struct(block.alias(_BLOCK), at.alias(_AT), F.lit(by).cast("long").alias("_by"))
    changes = F.array(
        F.when(F.col("_opens") < first, change(F.col(_BLOCK) - 1, F.col("_opens"), 1)),
        change(F.col(_BLOCK), F.greatest("_opens", first), 1),
        change(F.col(_BLOCK), F.col(_AT) + 1, -1),
    )
    out = found.select(*(ref(k) for k in keys), F.explode(changes).alias(_CHANGE)).select(*(ref(k) for k in keys), f"{_CHANGE}.*")
    return out.filter(F.col(_AT).isNotNull()).groupBy(*(ref(k) for k in keys), _BLOCK, _AT).agg(F.sum("_by").alias("_by"))


def fine_windows(
    panes: DataFrame, values: Mapping[str, DataFrame], keys: list[str], parts: Mapping[str, str], size: int, slide: int
) -> DataFrame:
    """One row per key and window (of ``size`` seconds, every ``slide``) that has rows: keys, ``_start`` (seconds), the columns
    ``parts`` merged over the window, and a distinct count per name of ``values``.

    ``panes`` are (keys, _pane, parts): rows of a time in which no window starts or ends, ``_pane`` being its start;
    ``parts`` says of each column how two of them merge (sum, min or max). ``values`` are (keys, _pane, _value), distinct.
    """
    changes = _changes_of_panes(panes, keys, {"_n": "sum", **parts}, size)
    for i, rows in enumerate(values.values()):
        changes = changes.unionByName(_changes_of_values(rows, keys, size).withColumnRenamed("_by", f"_by{i}"), allowMissingColumns=True)
    along = Window.partitionBy(*(ref(k) for k in keys), _BLOCK).orderBy(_AT)
    # Changes of one time are rows one after the other; all but the last of them last for no time.
    seen = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail, head = (F.last(c, ignorenulls=True).over(seen) for c in (_TAIL, _HEAD))
    counts = [F.coalesce(F.sum(f"_by{i}").over(seen), F.lit(0)).alias(name) for i, name in enumerate(values)]
    upto = F.lead(_AT).over(along)
    found = changes.select(
        *(ref(k) for k in keys), _AT, F.coalesce(upto, (F.col(_BLOCK) + 1) * size).alias("_upto"), tail.alias(_TAIL), head.alias(_HEAD), *counts
    )
    merged = {p: _merged(op, F.col(f"{_TAIL}.{p}"), F.col(f"{_HEAD}.{p}")) for p, op in {"_n": "sum", **parts}.items()}
    first, last = F.ceil(F.col(_AT) / slide) * slide, F.floor((F.col("_upto") - 1) / slide) * slide
    found = found.filter((merged["_n"] > 0) & (first <= last))
    starts = F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(slide).cast("long"))).alias("_start")
    columns = [merged[p].alias(p) for p in parts]
    return found.select(*(ref(k) for k in keys), *columns, *(ref(name) for name in values), starts)
