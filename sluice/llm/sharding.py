"""Shards of bounded size by extendible hashing.

A directory starts as one bucket over all hash values; only buckets above the byte limit split, on their next
hash bit, until every bucket fits. The directory is grown a few bits at a time from sizes of hash prefixes, which
combine before they are shuffled, so that no pass moves more than one small row per prefix and task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ROW, held, written

#: Hash bits: the first 15 hexadecimal digits of an MD5 sum, so that any SQL engine can name the same shard.
BITS = 60
_STEP = 8


def row_hash() -> Column:
    key = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    )
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def text_bytes() -> Column:
    return F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")


def _prefix(hash_: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", hash_, F.lit(BITS).cast("int") - F.lit(depth) if isinstance(depth, int) else F.lit(BITS) - depth)


def directory(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """Buckets (depth, prefix, shard_bytes, shard_rows) over ``rows`` (``_hash``, ``_bytes``), written.

    Each is the shallowest on its path that fits; one whose rows all share a hash (a single long text, or
    repeated rows) can't be split and is taken as it is, above the limit or not.
    """
    total = rows.agg(F.sum("_bytes")).first()[0] or 0
    base, top = 0, min(BITS, max(1, math.ceil(math.log2(max(2, total / limit_bytes))) + 3))
    open_rows, sealed = rows, []
    while True:
        cells = open_rows.groupBy(_prefix(F.col("_hash"), top).alias("cell")).agg(
            F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("_hash").alias("low"), F.max("_hash").alias("high")
        )
        nodes = written(
            cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(top))))
            .groupBy("depth", F.call_function("shiftright", "cell", F.lit(top) - F.col("depth")).alias("prefix"))
            .agg(
                F.sum("bytes").alias("shard_bytes"),
                F.sum("n").alias("shard_rows"),
                ((F.sum("bytes") <= limit_bytes) | (F.min("low") == F.max("high")) | (F.col("depth") == BITS)).alias("fits"),
            ),
            "buckets",
        )
        too_large = nodes.filter(~F.col("fits")).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        fitting = nodes.filter("fits").withColumn("parent", F.call_function("shiftright", "prefix", F.lit(1)))
        below = fitting.filter(F.col("depth") > base).join(too_large, ["depth", "parent"], "left_semi")
        first = fitting.filter(F.col("depth") == base) if base == 0 else fitting.filter(F.lit(False))
        sealed.append(below.unionByName(first).select("depth", "prefix", "shard_bytes", "shard_rows"))
        full = nodes.filter((F.col("depth") == top) & ~F.col("fits")).select(F.col("prefix").alias("_full"))
        if full.isEmpty():
            break
        open_rows = written(
            open_rows.join(full, _prefix(F.col("_hash"), top) == F.col("_full"), "left_semi"), "unsettled"
        )
        base, top = top, min(BITS, top + _STEP)
    return written(reduce(DataFrame.unionByName, sealed), "directory")


def shard(docs: DataFrame, limit_bytes: int = 256 << 20) -> DataFrame:
    """``docs`` with ``shard`` (its prefix bits as text), ``depth``, ``shard_bytes`` and ``shard_rows``.

    Rows are placed by a hash of id and text, so a null id or text is a value like any other, equal rows share a
    shard, and the assignment depends on the rows alone. Input columns of these four names are replaced, all others stay. An empty
    table gives no rows; a shard above the limit holds rows of one hash only.
    """
    added = ["shard", "depth", "shard_bytes", "shard_rows"]
    own = held(docs, _hash=row_hash(), _bytes=text_bytes())
    buckets = directory(written(own.select("_hash", "_bytes"), "hashes"), limit_bytes)
    out = own.withColumn("_at", F.lit(None).cast("struct<depth:int,prefix:bigint,shard_bytes:bigint,shard_rows:bigint>"))
    for (depth,) in sorted(buckets.select("depth").distinct().collect()):  # at most one value per hash bit
        level = buckets.filter(F.col("depth") == depth).select(
            F.col("prefix").alias("_prefix"), F.struct("depth", "prefix", "shard_bytes", "shard_rows").alias("_found")
        )
        out = (
            out.join(level, _prefix(F.col("_hash"), depth) == F.col("_prefix"), "left")
            .withColumn("_at", F.coalesce("_at", "_found"))
            .drop("_prefix", "_found")
        )
    bits = F.lpad(F.bin("_at.prefix"), F.col("_at.depth"), "0")
    return out.select(
        *(F.col(f"{ROW}.`{c}`") for c in docs.columns if c.lower() not in added),
        F.when(F.col("_at.depth") == 0, "").otherwise(bits).alias("shard"),
        "_at.depth",
        "_at.shard_bytes",
        "_at.shard_rows",
    )
