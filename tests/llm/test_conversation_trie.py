import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes by their whole sequences of turns, each subtree walked on its own."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else -(-c - -c % 20)  # as SQL has it
        made[c] = (*own.get(base, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        kids = [below(k) for k in children[node]]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        return sum(k[0] for k in kids) or 1, sum(k[1] for k in kids) + (len(members[node]) - 1) * words

    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if made[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), *below(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **how):
    return sorted((tuple(r) for r in ct.prefix_trie(df, **how).collect()), key=repr)


def many(seed, n=160):
    """Conversations with common openings, copies, gaps in turns and some that lose all of their turns."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        opening = [("system", "You are helpful")] * rng.choice([0, 1, 1]) + [("user", rng.choice(["hi", "hi there", "", None]))] * rng.choice([0, 1])
        rest = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "yes\tno  x", "é☃", None, "long " * 9])) for _ in range(rng.randint(0, 5))]
        turns = (opening + rest) or [(None, None)]
        rows += [(c, 10 * i if rng.random() > 0.02 else None, role, text) for i, (role, text) in enumerate(turns)]
    hot = [("system", "You are helpful"), ("user", "hi"), ("assistant", "a b")]
    rows += [(20 * c + 1000, i, role, text) for c in range(60) for i, (role, text) in enumerate(hot)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, shard_size", [(1, 4096), (2, 3), (3, 25), (4, 1)])
def test_equals_brute_force(spark, seed, shard_size):
    rows = many(seed)
    assert got(spark.createDataFrame(rows, SCHEMA), shard_size=shard_size) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, 1, "user", "base"), (0, 2, "user", "two"), (0, 2, "user", "two"), (0, None, None, None), (1, 5, "user", "own"),
        (1, 6, "user", "x " * 5000), (None, 1, "user", "lost"), (None, None, None, None), (25, 1, "user", "no base"), (25, 1, "user", ""),
        (-3, 1, "user", "below zero"), (19, 1, "assistant", "base"), (7, 1, "ab", "c"), (8, 1, "a", "bc"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(7) for n in ("keys", "words", "depth", "digest", "up", "n", "_base", "h", "last")})
    assert got(df) == got(df, shard_size=2) == brute(rows)


def test_a_long_conversation(spark):
    rows = [(c, i, "user", f"turn {i}") for c in (40, 60) for i in range(2000 + c)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == got(spark.createDataFrame(rows, SCHEMA), shard_size=1)


def test_ids_of_ends_are_hashed_piece_by_piece(spark, monkeypatch):
    rows = [(20 * c, 0, "user", "the same") for c in range(500)]
    whole = got(spark.createDataFrame(rows, SCHEMA))
    assert len(whole) == 2 and whole == brute(rows)
    monkeypatch.setattr(ct, "_CHUNK", 64)
    pieces = list(ct._chunks(iter(_batches([(b"k", 20 * c) for c in range(500)], 7, ["last", "conv_id"]))))
    assert sum(p.num_rows for p in pieces) > 30
    (done,) = [r for b in ct._checksums(iter(pieces)) for r in b.to_pylist()]
    assert done["ends_sha256"] in {r[-1] for r in whole}


def _batches(rows, size, names):
    import pyarrow as pa

    for at in range(0, len(rows), size):
        yield pa.record_batch([pa.array(c) for c in zip(*rows[at : at + size])], names=names)


def test_double_array_holds_its_rows_and_no_others():
    rng = random.Random(5)
    rows = [[rng.randint(1, 40) for _ in range(rng.randint(1, 6))] for _ in range(300)] + [[1000], [1000, 1]]
    trie = ct.DoubleArray.of(rows)
    prefixes = {tuple(r[:d]) for r in rows for d in range(1, len(r) + 1)}
    states = {}
    for row in prefixes | {tuple(rng.randint(1, 41) for _ in range(rng.randint(1, 4))) for _ in range(500)}:
        state = 0
        for label in row:
            state = int(trie.walk(np.array([state]), np.array([label]))[0])
            if state < 0:
                break
        assert (state >= 0) == (row in prefixes)
        if state >= 0:
            states[row] = state
    assert len(set(states.values())) == len(prefixes) == int((trie.check >= 0).sum()) - 1


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
