import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from sluice.llm import resampling
from sluice.llm.resampling import Resample, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [crc32(run.encode()) % buckets for run in runs]


def brute(docs, target, how):
    """(doc_id, n_features, weight, score, rank) by the definition, whole texts at once."""
    found = [(i, *features(text, how.buckets)) for i, text in docs]
    corpus = Counter(b for _, _, fs in found for b in fs)
    aim = Counter(b for text in target for b in features(text, how.buckets)[1])
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = [
        math.floor(1000 * math.log((aim[b] + 1) * (s_all + how.buckets) / ((corpus[b] + 1) * (t_all + how.buckets))))
        for b in range(how.buckets)
    ]
    rows = []
    for i, n_words, fs in found:
        weight = sum(gain[b] for b in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(fs), weight, score, None, n_words])
    able = sorted((r for r in rows if r[5] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: how.percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(docs, target, how):
    return sorted((tuple(r) for r in resample(docs, target, how).collect()), key=repr)


@pytest.mark.parametrize("how", [Resample(), Resample(buckets=97, least_words=3, percent=60, seed=1)])
def test_equals_brute_force(spark, given, how):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in given.collect()]
    assert got(given, target, how) == brute(texts, [r.text for r in target.collect()], how)


def test_odd_rows(spark, odd):
    target = odd.select("text").limit(7)
    how = Resample(buckets=1000, least_words=2, percent=50)
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(odd, target, how) == brute(texts, [r.text for r in target.collect()], how)


def test_lines_of_all_kinds(spark, monkeypatch):
    # common lines go another way than rare ones: both are met
    monkeypatch.setattr(resampling, "_COMMON", 1 / 20)
    lines = ["same line in all", "", "  ", "Été ça Va", "12 x-y_z", "a", "\t", "one\rtwo", "A b\x00c"]
    texts = [(i, "\n".join([lines[0]] * (i % 3) + [lines[(i * j) % len(lines)] for j in range(i % 7)] + [f"own {i}"])) for i in range(40)]
    texts += [(7, "own 7"), (None, "own none here"), (41, "\n\n"), (42, None), (43, "last\n"), (44, "\nfirst")]
    target = ["été ça", "same line", None, "in\nall own 3"]
    how = Resample(buckets=50, least_words=2, percent=40)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(docs, aims, how) == brute(texts, target, how)


def test_each_distinct_line_is_hashed_once(spark):
    docs = spark.createDataFrame([(i, f"shared words here\nline {i % 2}\nshared words here") for i in range(20)], "doc_id long, text string")
    made = resampling.Features(docs, 1000)
    assert {r.times for r in made.lines.collect()} == {40, 10} and made.lines.count() == 3
    assert made.counts().sum() == 20 * (8 + 7)


def test_empty_tables(given, nothing):
    assert resample(nothing, given.select("text")).count() == 0
    assert resample(nothing, nothing.select("text")).count() == 0
    plain = resample(given, nothing.select("text"))
    assert plain.count() == given.count() and plain.filter(F.col("rank").isNotNull()).count() > 0
