import random
import re
import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.llm import minhash
from sluice.llm.common import slices

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    """Least reachable id per id, comparing all pairs that share a shingle."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sharing = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            sharing[x].add(k)
    pairs = {(a, b) for ks in sharing.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        common = len(s & t)
        if 100 * common >= percent * (len(s) + len(t) - common):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: find(i) for i in parent}, {i: len(s) for i, s in sets}


def check(df, size):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(df, minhash.MinHash(words=size)).collect()
    assert len(got) == len(rows)
    groups, sizes = brute(rows, size)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (groups[r.doc_id], sizes[r.doc_id], groups[r.doc_id] == r.doc_id), r


def test_word_pairs(given):
    check(given, 2)


def test_a_star_of_edited_copies_and_its_outsiders(spark):
    """Copies of one text with 0 to 20 % of words changed: some are linked to others only through third ones."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for k in range(150):
        own = list(words)
        for _ in range(k // 4):
            own[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_odd_rows(odd, nothing):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    at = {r.doc_id: r for r in got}
    assert at[-5].n_shingles == at[-4].n_shingles == at[-3].n_shingles == 0 and at[-3].component_id == -3
    assert at[-1].component_id == -2 and not at[-1].kept and at[-2].n_shingles == 1
    assert at[10_002].component_id == 10_001 and at[10_004].component_id == 10_003
    left = minhash.one_of_each(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == [-5, -4, -3, -2, 10_001, 10_003, 10_005]
    assert minhash.near_duplicates(nothing).count() == 0 and minhash.one_of_each(nothing).count() == 0


def test_sketches_keep_pairs_at_the_threshold(spark):
    """Pairs of a similarity of exactly 0.8, of all sizes: none is dropped; unlike pairs mostly are."""
    rng, how = random.Random(3), minhash.MinHash(words=1)
    rows, kinds = [], []
    for n in (9, 45, 450, 4500, 27_000):
        for k in range(60 if n < 5000 else 15):
            words = [f"{n}-{k}-{i}" for i in range(n)]
            unlike = k % 3 == 0
            gone = n // 3 if unlike else n // 9
            texts = [" ".join(words), " ".join(words[gone:] + [f"{n}+{k}+{i}" for i in range(gone)])]
            rng.shuffle(texts)
            rows += texts
            kinds.append((n, unlike))
    parts = [minhash._signed(p, how) for p in slices(pa.array(rows), gap=10)]
    sizes, sketch = np.concatenate([p[0] for p in parts]), np.concatenate([p[3] for p in parts])
    pairs = [
        (n, unlike, int(sizes[2 * i]), int(sizes[2 * i + 1]), sketch[2 * i].tolist(), sketch[2 * i + 1].tolist())
        for i, (n, unlike) in enumerate(kinds)
    ]
    df = spark.createDataFrame(pairs, "n int, unlike boolean, n_a long, n_b long, s_a array<long>, s_b array<long>")
    differ = minhash.sketch_distance(F.col("s_a"), F.col("s_b"), how.bits // 64)
    kept = df.select("n", "unlike", (differ <= how.most_bits(F.col("n_a"), F.col("n_b"))).alias("kept")).collect()
    assert all(r.kept for r in kept if not r.unlike)
    assert not any(r.kept for r in kept if r.unlike and 100 < r.n < 5000)


def test_pairs_just_below_the_threshold_are_dropped_where_they_meet(spark, monkeypatch):
    """Many copies of one text, most pairs of which are at 0.7 to 0.8: sketches let them pass, and only links may be written."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(80):
        words = list(base)
        for k in rng.sample(range(150), 5):
            words[k] = f"c{i}x{k}"
        rows.append((i, " ".join(words)))
    counts, confirm = [], minhash._Search.confirm

    def counted(self, pairs):
        counts.append(pairs.count())
        confirm(self, pairs)

    monkeypatch.setattr(minhash._Search, "confirm", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, 2)
    sets = [shingles(t, 2) for _, t in rows]
    at = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    links = sum(j >= 0.8 for j in at)
    assert sum(0.7 <= j < 0.8 for j in at) > 1000 and len(counts) == 3 and counts[2] <= links
