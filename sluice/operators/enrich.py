"""Lookup join, de-duplication and the latest-row-per-key rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schema import ref, require_column
from sluice.spec import ConfigError


# Counters of the sketch that finds heavy keys; a key's count is off by rows / counters at most.
_COUNTERS = 1 << 14


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = 1 / 64) -> list[int]:
    """Hashes of the keys (null ones too) that may hold more than ``share`` of the rows of a batch, for :func:`lookup_enrich`.

    One pass over the key columns that brings a sketch of bounded size per task together; fewer than 2 / ``share`` keys
    come back. A key that is named without being heavy, or shares its hash, changes only how it is joined.
    """
    most = min(int(2 / share), _COUNTERS // 4)
    hashed = df.select(_hash(keys).alias("h"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {most}, {_COUNTERS})").alias("top")).first()
    least = share * found["n"] - found["n"] / _COUNTERS
    return [t["item"] for t in found["top"] or [] if t["count"] > least]


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(ref(k) for k in keys))


def lookup_enrich(
    df: DataFrame, dim: DataFrame, on: Sequence[str] | dict[str, str], columns: Sequence[str], heavy: Sequence[int] = ()
) -> DataFrame:
    """Append ``columns`` of ``dim`` to each row by key; rows without a match get nulls.

    ``on`` names the key columns, or maps row columns to dim columns. One row per key is expected in
    ``dim`` (use :func:`latest_per_key` first where that is open). No side is forced to be broadcast:
    Spark does so only below its size threshold, and beyond it splits hot keys of the sort-merge join.

    On a stream Spark splits nothing. There name the ``heavy`` keys (:func:`heavy_keys` of the rows so far, or of the batch
    in ``foreachBatch``): their rows are joined where they are, with the few rows of ``dim`` that have those keys, and only
    the others are shuffled. The rows are read once for each. Both sides must have keys of the same types then.
    """
    pairs = dict(on) if isinstance(on, dict) else {k: k for k in on}
    for left, right in pairs.items():
        require_column(df.schema, left, "lookup key")
        require_column(dim.schema, right, "lookup table key")
    for name in columns:
        require_column(dim.schema, name, "lookup column")
        if name in df.columns:
            raise ConfigError(f"lookup: column {name!r} is already in the rows")
    side = dim.select(
        *(ref(right).alias(f"_key{i}") for i, right in enumerate(pairs.values())), *(ref(c) for c in columns)
    )
    side_keys = [f"_key{i}" for i in range(len(pairs))]
    match = [ref(left) == F.col(key) for left, key in zip(pairs, side_keys)]
    if not heavy:
        return df.join(side, match, "left").drop(*side_keys)
    if [df.schema[k].dataType for k in pairs] != [side.schema[k].dataType for k in side_keys]:
        raise ConfigError("lookup: heavy keys need the same types on both sides")
    is_heavy, few = _hash(list(pairs)).isin(*heavy), F.broadcast(side.filter(_hash(side_keys).isin(*heavy)))
    apart = df.filter(is_heavy).join(few, match, "left")
    return apart.unionByName(df.filter(~is_heavy).join(side, match, "left")).drop(*side_keys)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One whole row per key: the one with the highest ``order_by`` values.

    An aggregate (a sort aggregate, as its value is a struct) and no window: each task folds its own rows per key
    first, so a hot key reaches the shuffle as one row per task. Equal order values are settled by the rest of the row, which
    makes the result repeatable.
    """
    if not set(df.columns) - set(keys):
        return df.dropDuplicates(list(keys))
    order = {f"o{i}": o for i, o in enumerate(order_by)}
    # a column that decides the order is packed once, as part of it
    packed_as = {o: name for name, o in order.items() if isinstance(o, str) and o not in keys}
    rest = [c for c in df.columns if c not in keys and c not in packed_as]
    first = [(ref(o) if isinstance(o, str) else o).alias(name) for name, o in order.items()]
    best = df.groupBy(*(ref(k) for k in keys)).agg(F.max(F.struct(*first, *(ref(c).alias(f"c{i}") for i, c in enumerate(rest)))).alias("_best"))
    packed_as.update({c: f"c{i}" for i, c in enumerate(rest)})
    return best.select(*(ref(c) if c in keys else ref("_best")[packed_as[c]].alias(c) for c in df.columns))


def dedup(df: DataFrame, keys: Sequence[str], time_field: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """Drop repeated keys.

    On a stream with ``time_field`` the keys are remembered for ``delay`` of event time; the zone-less
    type of the field is restored afterwards.
    """
    for k in keys:
        require_column(df.schema, k, "dedup key")
    if not df.isStreaming or time_field is None:
        return df.dropDuplicates(list(keys))
    dtype = require_column(df.schema, time_field, "dedup time field").dataType
    timed = df.withColumn(time_field, ref(time_field).cast("timestamp")).withWatermark(time_field, delay)
    kept = timed.dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(time_field, ref(time_field).cast(dtype))
