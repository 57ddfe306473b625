"""Conversations rebuilt from shared openings, as the prefix trie of their turns.

A node is a distinct sequence of first turns. Equal conversations are merged before anything else. Prefixes through which
very many of them pass are upper nodes, shared by shards; their number is bounded. Below them the conversations are dealt
to shards by the first prefix that is not an upper one. Each shard packs a double-array trie, BASE and CHECK over dense ids
of its turns, and walks all of its conversations through it at once; the sums over subtrees go up along CHECK. What the
shards find below upper nodes is then merged into these.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import WORD, written

#: Upper nodes of one run are fewer than this, whatever the input.
MOST_UPPER = 1 << 16
#: Bytes of ids that one row brings to the checksum of a node's ends.
_CHUNK = 1 << 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_ROOT = hashlib.md5(b"", usedforsecurity=False).digest()


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order as (turn, key, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    read = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"),
    )
    # Nulls sort first in an array, as the order of turns has it.
    return read.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def opening_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, words): conversations with their first turns from the one their twenty start with."""
    own = written(_turns(conversations), "turns")
    base = own.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("opening"))
    of = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 20).withColumn("h", opening_turns(F.col("conv_id")))
    joined = of.join(base, "_base", "left").withColumn("opening", F.coalesce("opening", F.slice("turns", 1, 0)))
    turns = F.concat(F.slice("opening", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    return joined.select("conv_id", turns.alias("t")).select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def path(keys: list[bytes]) -> list[bytes]:
    """Digests of a conversation's prefixes, the empty one first."""
    out = [_ROOT]
    for key in keys:
        out.append(hashlib.md5(out[-1] + key, usedforsecurity=False).digest())
    return out


def _with_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [path(keys) for keys in batch.column(1).to_pylist()]
        columns = [*batch.columns, pa.array(paths, pa.list_(pa.binary())), pa.array([p[-1] for p in paths], pa.binary())]
        yield pa.record_batch(columns, names=["conv_id", "keys", "words", "path", "last"])


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(last, conv_id) in order to pieces (last, at, ids) of the joined ids of one prefix."""
    last, ids, size = None, [], 0
    done: list[tuple[bytes, int, str]] = []
    names = ["last", "at", "ids"]
    close = lambda: done.append((last, ids[0], ",".join(map(str, ids)))) if ids else None
    for batch in batches:
        for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != last or size > _CHUNK:
                close()
                last, ids, size = key, [], 0
            ids.append(conv_id)
            size += len(str(conv_id)) + 1
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], names=names)
            done.clear()
    close()
    if done:
        yield pa.record_batch([pa.array(c) for c in zip(*done)], names=names)


def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to (last, ends_sha256); a checksum goes on from piece to piece, so no list is ever whole."""
    last, state = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != last:
                if state is not None:
                    done.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], names=["last", "ends_sha256"])
            done.clear()
    if state is not None:
        yield pa.record_batch([pa.array([last]), pa.array([state.hexdigest()])], names=["last", "ends_sha256"])


def _ends(paths: DataFrame) -> DataFrame:
    """(last, ends_sha256) for each distinct whole conversation."""
    rows = paths.select("last", "conv_id").repartitionByRange("last", "conv_id").sortWithinPartitions("last", "conv_id")
    pieces = rows.mapInArrow(_chunks, "last binary, at long, ids string")
    pieces = pieces.repartition("last").sortWithinPartitions("last", "at")
    return pieces.mapInArrow(_checksums, "last binary, ends_sha256 string")


@dataclass
class DoubleArray:
    """A trie in two arrays: the child of state s by label c is t = base[s] + c, and then check[t] = s. State 0 is the root."""

    base: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    check: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    @classmethod
    def of(cls, rows: list[list[int]]) -> DoubleArray:
        """The trie of ``rows``, each a list of labels from 1 on."""
        made = cls()
        made._grow(sum(map(len, rows)) + max((max(r) for r in rows if r), default=0) + 2)
        made.check[0] = 0
        made._next = list(range(1, len(made.check) + 1))  # from a slot towards the next free one; slot 0 is taken
        # Nodes breadth first, each with the rows that pass through it.
        level = [(0, list(range(len(rows))))]
        depth = 0
        while level:
            below = []
            for state, through in level:
                children = defaultdict(list)
                for i in through:
                    if len(rows[i]) > depth:
                        children[rows[i][depth]].append(i)
                if children:
                    labels = sorted(children)
                    start = made._fit(labels)
                    made.base[state] = start
                    for label in labels:
                        made._take(start + label, state)
                        below.append((start + label, children[label]))
            level, depth = below, depth + 1
        return made

    def _grow(self, size: int) -> None:
        old = len(self.check)
        self.base = np.concatenate([self.base, np.zeros(size - old, np.int64)])
        self.check = np.concatenate([self.check, np.full(size - old, -1, np.int64)])
        if old == 1:
            self.check[0] = -1

    def _free(self, slot: int) -> int:
        """The first free slot from ``slot`` on; the arrays grow where there is none."""
        if slot >= len(self.check):
            self._extend(slot + 1)
        top = slot
        while top < len(self.check) and self.check[top] >= 0:
            top = self._next[top]
        if top >= len(self.check):
            self._extend(top + 1)
        while slot != top and self.check[slot] >= 0:
            self._next[slot], slot = top, self._next[slot]
        return top

    def _extend(self, size: int) -> None:
        old = len(self.check)
        self._grow(max(size, old + old // 2))
        self._next += range(old + 1, len(self.check) + 1)

    def _fit(self, labels: list[int]) -> int:
        """The least start from which the slots of all ``labels`` are free."""
        slot = labels[0]
        while True:
            slot = self._free(slot)
            start = slot - labels[0]
            if start + labels[-1] >= len(self.check):
                self._extend(start + labels[-1] + 1)
            if all(self.check[start + c] < 0 for c in labels[1:]):
                return start
            slot += 1

    def _take(self, slot: int, state: int) -> None:
        self.check[slot] = state

    def walk(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The states that ``states`` go to by ``labels``; -1 where there is no such child."""
        to = self.base[states] + labels
        held = (to > 0) & (to < len(self.check))
        return np.where(held & (self.check[np.where(held, to, 0)] == states), to, -1)


_NODES = "depth long, conv_id long, parent_conv_id long, up binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE_NAMES = [f.split()[0] for f in _NODES.split(", ")]


def _shard_nodes(rows: list[dict]) -> pa.RecordBatch:
    """All nodes of one shard; ``rows`` are its distinct conversations (conv_id, n, cut, keys, words, path, ends_sha256).

    ``cut`` is the depth of the first prefix below the upper nodes; that prefix is a child of the trie's root.
    """
    ids: dict[bytes, int] = {}
    labels = [[ids.setdefault(k, len(ids) + 1) for k in (r["path"][r["cut"]], *r["keys"][r["cut"] :])] for r in rows]
    trie = DoubleArray.of(labels)
    size, n_rows = len(trie.check), len(rows)
    lengths = np.array([len(x) for x in labels])
    conv_ids, copies = (np.array([r[c] for r in rows], np.int64) for c in ("conv_id", "n"))
    n_convs, words, depth, level = (np.zeros(size, np.int64) for _ in range(4))
    least = np.full(size, np.iinfo(np.int64).max)
    ends: dict[int, str] = {}
    up: dict[int, bytes | None] = {}
    states, active = np.zeros(n_rows, np.int64), np.arange(n_rows)
    for step in range(int(lengths.max())):
        active = active[lengths[active] > step]
        states = trie.walk(states, np.array([labels[i][step] for i in active]))
        np.add.at(n_convs, states, copies[active])
        np.minimum.at(least, states, conv_ids[active])
        for i, state in zip(active.tolist(), states.tolist()):
            r = rows[i]
            at = r["cut"] + step
            depth[state], level[state] = at, step + 1
            words[state] = r["words"][at - 1] if at else 0
            if step == 0:
                up[state] = r["path"][at - 1] if at else None
            if lengths[i] == step + 1:
                ends[state] = r["ends_sha256"]
        going = lengths[active] > step + 1
        states, active = states[going], active[going]
    nodes = np.flatnonzero(level)
    children = np.bincount(trie.check[nodes], minlength=size)
    leaves = ((children == 0) & (level > 0)).astype(np.int64)
    saved = (n_convs - 1) * words
    for step in range(int(level.max()), 1, -1):
        some = np.flatnonzero(level == step)
        np.add.at(leaves, trie.check[some], leaves[some])
        np.add.at(saved, trie.check[some], saved[some])
    top = level[nodes] == 1
    parents = pa.array(least[trie.check[nodes]], mask=top)
    columns = [
        pa.array(depth[nodes]), pa.array(least[nodes]), parents, pa.array([up.get(s) for s in nodes.tolist()], pa.binary()),
        pa.array(n_convs[nodes]), pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]),
        pa.array([ends.get(s, _NO_ENDS) for s in nodes.tolist()], pa.string()),
    ]
    return pa.record_batch(columns, names=_NODE_NAMES)


def _tries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A trie per shard, from rows in the order of shards."""
    shard, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                if rows:
                    yield _shard_nodes(rows)
                shard, rows = row["shard"], []
            rows.append(row)
    if rows:
        yield _shard_nodes(rows)


def _merged(spark: SparkSession, upper: list[dict], below: dict[bytes, dict], ends: dict[bytes, str]) -> list[tuple]:
    """Rows of the upper nodes, from the deepest up: their own numbers and those of what lies below."""
    known = {u["digest"]: u for u in upper}
    sums = {d: [0, 0, 0] for d in known}  # children, leaves, saved tokens
    rows = []
    for u in sorted(upper, key=lambda u: -u["depth"]):
        own, shards = sums[u["digest"]], below.get(u["digest"], {})
        for k, name in enumerate(("n_children", "n_leaves", "saved_tokens")):
            own[k] += shards.get(name, 0)
        own[1] += own[0] == 0
        own[2] += (u["n_convs"] - 1) * u["words"]
        parent = known.get(u["parent"])
        if parent is not None:
            total = sums[u["parent"]]
            total[0], total[1], total[2] = total[0] + 1, total[1] + own[1], total[2] + own[2]
        above = None if parent is None else parent["conv_id"]
        rows.append((u["depth"], u["conv_id"], above, u["n_convs"], *own, ends.get(u["digest"], _NO_ENDS)))
    return rows


def prefix_trie(conversations: DataFrame, shard_size: int = 4096) -> DataFrame:
    """All nodes of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text), one row per node.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``; (conv_id, depth) tells nodes apart. ``shard_size`` bounds how many distinct
    conversations a prefix may have below it before its node is an upper one, and so what a shard holds.

    A null role or text counts as empty, null turns come first; turns of one number, repeated rows among them, are ordered
    by the digest of role and text. Rows without a conv_id belong to no conversation. The turns of one conversation, some
    30 bytes each, are held together by a task; their texts are not. An empty table has no nodes, not even a root. Other
    columns are not looked at.
    """
    spark = conversations.sparkSession
    schema = "conv_id long, keys array<binary>, words array<int>, path array<binary>, last binary"
    paths = written(rebuilt(conversations).mapInArrow(_with_paths, schema), "paths")
    ends = written(_ends(paths), "ends")
    distinct = paths.groupBy("last").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("keys", "words", "path"))
    )
    distinct = written(distinct.join(ends.hint("merge"), "last"), "distinct")

    zipped = F.posexplode(F.arrays_zip("path", F.concat(F.array(F.lit(0)), "words").alias("words"), F.concat(F.array(F.lit(None)), "path").alias("above")))
    prefixes = distinct.select("conv_id", "n", zipped.alias("depth", "p")).groupBy("depth", F.col("p.path").alias("digest"), F.col("p.above").alias("parent"))
    nodes = prefixes.agg(
        F.count(F.lit(1)).alias("passing"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("p.words").alias("words")
    )
    # Each conversation passes through one node more than it has turns; so many rows have at most rows / limit nodes above it.
    passing = distinct.agg(F.sum(F.size("path"))).first()[0] or 0
    limit = max(shard_size, passing // MOST_UPPER)
    upper = written(nodes.filter(F.col("passing") > limit), "upper")
    tops = F.broadcast(upper.select("digest", F.lit(True).alias("is_upper")))

    # The first prefix of each conversation that is not an upper node; upper ones come without gaps from the root on.
    n_upper = distinct.select("last", F.explode("path").alias("digest")).join(tops, "digest").groupBy("last").agg(F.count(F.lit(1)).cast("int").alias("cut"))
    dealt = distinct.join(n_upper.hint("merge"), "last", "left").fillna(0, "cut").filter(F.col("cut") < F.size("path"))
    shards = max(1, 2 * distinct.count() // shard_size)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.get("path", F.col("cut"))), F.lit(shards)))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    parts = written(dealt.select("shard", "conv_id", "n", "cut", "keys", "words", "path", "ends_sha256").mapInArrow(_tries, _NODES), "nodes")

    top_rows = [r.asDict() for r in upper.collect()]  # fewer than MOST_UPPER
    sums = parts.filter("up IS NOT NULL").groupBy("up").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    below = {bytes(r["up"]): r.asDict() for r in sums.collect()}
    top_ends = {bytes(r["last"]): r["ends_sha256"] for r in ends.join(tops, ends["last"] == F.col("digest")).collect()}
    for row in top_rows:
        row["digest"], row["parent"] = bytes(row["digest"]), row["parent"] and bytes(row["parent"])
    names = [n for n in _NODE_NAMES if n != "up"]
    merged = spark.createDataFrame(
        _merged(spark, top_rows, below, top_ends), ", ".join(f for f in _NODES.split(", ") if not f.startswith("up "))
    )
    above = F.broadcast(upper.select(F.col("digest").alias("up"), F.col("conv_id").alias("_above")))
    found = parts.join(above, "up", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*names)
    out = found.unionByName(merged)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
