import hashlib
import random

import numpy as np
import pytest

from sluice.llm import suffix_dedup as sd


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(120):
        n, letters = rng.randint(0, 300), rng.choice([1, 2, 3, 256])
        data = np.array([rng.randint(0, letters) for _ in range(n)], np.int64)
        order = sd.suffix_array(data)
        suffixes = [tuple(data[i:]) for i in order]
        assert suffixes == sorted(suffixes) and sorted(order.tolist()) == list(range(n))
        found = sd.common_prefixes(data, order, 50, lanes=rng.choice([1, 4, 4096]))
        for k in range(1, n):
            a, b = suffixes[k - 1], suffixes[k]
            same = next((h for h, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert found[k] == min(same, 50)


def test_binary_search():
    rng = np.random.default_rng(2)
    rows = np.unique(rng.integers(0, 3, (200, 4)).astype(np.uint64), axis=0)
    wanted = rng.integers(0, 3, (300, 4)).astype(np.uint64)
    at = {tuple(r): k for k, r in enumerate(rows.tolist())}
    assert sd.find_rows(rows, wanted).tolist() == [at.get(tuple(w), -1) for w in wanted.tolist()]


def brute(rows):
    """By row: bytes, removed, spans, digest of the rest."""
    first, out = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data, rank = (text or "").encode(), float("inf") if i is None else i
        covered = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 49):
            if first.setdefault(data[k : k + 50], rank) < rank:
                covered[k : k + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(int)))))
        kept = bytes(np.frombuffer(data, np.uint8)[~covered[:-1]])
        spans = tuple(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def check(df, **options):
    got = [
        (r.doc_id, r.n_bytes, r.n_removed, tuple(map(tuple, r.spans)), r.kept_sha256, bytes(r.kept))
        for r in sd.remove_repeats(df, **options).collect()
    ]
    assert sorted(got, key=str) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 20_000, "part_bytes": 50_000, "array_bytes": 2000}])
def test_documents(given, options):
    """With small arrays, strings of one shard are found across its arrays by binary search."""
    check(given, **options)


def test_odd_rows(odd, nothing):
    check(odd)
    assert sd.remove_repeats(nothing).count() == 0


def test_overlaps_borders_and_repetitive_texts(spark):
    a = "".join(random.Random(7).choice("abcd") for _ in range(400))
    rows = [
        (9, a), (3, a[100:149]), (4, a[100:150]), (5, "x" + a[80:160] + "y"), (6, a[300:] + a[:60]), (7, "z" * 500), (8, "z" * 49),
        (10, "z" * 51), (11, "ab" * 100), (12, "ba" * 90), (13, "\x00" * 60), (14, "\x00" * 70), (15, a[:25] + a[375:]), (16, "é" * 60), (17, "é" * 30),
    ]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    check(spark.createDataFrame([(1, a)] * 3 + [(None, a), (None, a + "q")], "doc_id long, text string"))
