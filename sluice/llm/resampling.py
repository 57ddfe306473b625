"""Documents drawn by how much their words resemble a target's: importance weights over hashed word features.

Features are runs of one and two words, hashed into buckets. A bucket's gain is the logarithm of how much more frequent it
is in the target than in the corpus; a document's weight is the mean gain of its features; Gumbel noise of the document's
id makes the highest scores a draw by weight without replacement.

Newlines separate words, so a text is a sequence of lines, and lines repeat. The features inside of lines are hashed once per
distinct line and multiplied by its occurrences; the pairs of words across a line break are counted beside, document by
document. Weights come the same way: the gains of each distinct line are added up once, and documents add up their lines.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import list_array, written
from sluice.llm.numbering import numbered

#: Words over A-Z lower-cased: ASCII letters and digits, and whatever is not ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lines that make up more than this share of all line rows are sent to every task, so there are fewer than 1 / share of them.
_COMMON = 1 / 4096


@dataclass(frozen=True)
class Resample:
    """The draw: buckets of features, documents of ``least_words`` or more take part, ``percent`` of them are drawn."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def line_words(line: bytes) -> list[bytes]:
    return _WORD.findall(line.lower())


def _hashed(words: list[bytes]) -> list[int]:
    """Checksums of the features inside of one line: its words, then its pairs."""
    ones = list(map(crc32, words))
    return ones + [crc32(b" " + b, a) for a, b in zip(ones, words[1:])]


def _key(line: bytes) -> bytes:
    return hashlib.md5(line, usedforsecurity=False).digest()


def _counts_of(values: np.ndarray, times: np.ndarray, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    np.add.at(out, values, times)
    return out


def _lines(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(line, times) to (key, times, features): the buckets of each distinct line's features."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            keys, sizes, found = [], [], []
            for line in batch.column(0).cast(pa.large_binary()).to_pylist():
                hashed = _hashed(line_words(line))
                keys.append(_key(line))
                sizes.append(len(hashed))
                found += hashed
            values = (np.array(found, np.uint32) % np.uint32(buckets)).astype(np.int32)
            yield pa.record_batch(
                [pa.array(keys, pa.binary()), batch.column(1), list_array(values, np.array(sizes, np.int64), pa.int32())],
                names=["key", "times", "features"],
            ).filter(pa.array(np.array(sizes) > 0))


_DOCS = "doc_id long, n_words long, across array<int>, keys array<binary>, times array<long>"


def _documents(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to its number of words, the features across its line breaks and its distinct lines with words."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            n_words, across, sizes, keys, times = [], [], [], [], []
            for text in batch.column(1).cast(pa.large_binary()).fill_null(b"").to_pylist():
                n, before, own, pairs = 0, None, Counter(), 0
                for line in text.split(b"\n"):
                    words = line_words(line)
                    if not words:
                        continue
                    if before is not None:
                        across.append(crc32(before + b" " + words[0]))
                        pairs += 1
                    n, before = n + len(words), words[-1]
                    own[line] += 1
                n_words.append(n)
                sizes.append(pairs)
                keys.append([_key(line) for line in own])
                times.append(list(own.values()))
            values = (np.array(across, np.uint32) % np.uint32(buckets)).astype(np.int32)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    list_array(values, np.array(sizes, np.int64), pa.int32()),
                    pa.array(keys, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_words", "across", "keys", "times"],
            )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column laid end to end, and how many each row has."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[at[0] : at[-1]], np.diff(at)


def _tally(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(times, features) of many rows to one row per bucket that this task met."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        values, sizes = _flat(batch.column(1))
        total += _counts_of(values, np.repeat(batch.column(0).to_numpy(), sizes), buckets)
    met = np.flatnonzero(total)
    yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])


def _gained(batches: Iterable[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(..., features) to (..., n, gain): the number of features and the sum of their gains."""
    for batch in batches:
        values, sizes = _flat(batch.column(batch.num_columns - 1))
        running = np.zeros(len(values) + 1, np.int64)
        np.cumsum(gains[values], out=running[1:])
        ends = np.cumsum(sizes)
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        names = batch.schema.names[:-1]
        yield pa.record_batch([*kept, pa.array(sizes), pa.array(running[ends] - running[ends - sizes])], names=[*names, "n", "gain"])


class Features:
    """Hashed features of whole texts: distinct lines once, and what lies across lines by document."""

    def __init__(self, docs: DataFrame, buckets: int):
        self.buckets = buckets
        read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        made = read.mapInArrow(lambda b: _documents(b, buckets), _DOCS).withColumn("uid", F.monotonically_increasing_id())
        self.docs = written(made, "documents")
        lines = read.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
        self.lines = written(lines.mapInArrow(lambda b: _lines(b, buckets), "key binary, times long, features array<int>"), "lines")

    def counts(self) -> np.ndarray:
        """How often each bucket is met."""
        buckets = self.buckets
        rows = self.lines.select("times", "features").unionByName(self.docs.select(F.lit(1).cast("long").alias("times"), F.col("across").alias("features")))
        found = rows.mapInArrow(lambda b: _tally(b, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        out = np.zeros(buckets, np.int64)
        for row in found.collect():  # at most one row per bucket
            out[row["bucket"]] = row["n"]
        return out

    def weighed(self, gains: np.ndarray) -> DataFrame:
        """(uid, doc_id, n_words, n, gain): each document's number of features and the sum of their gains."""
        lines = written(self.lines.mapInArrow(lambda b: _gained(b, gains), "key binary, times long, n long, gain long"), "line-gains")
        held = self.docs.select("uid", F.explode(F.arrays_zip("keys", "times")).alias("l"))
        held = held.select("uid", F.col("l.keys").alias("key"), F.col("l.times").alias("held"))
        total = lines.agg(F.sum("times")).first()[0] or 0
        # A line in many documents would bring them all to one task; of such lines there are few.
        common = F.broadcast(lines.filter(F.col("times") > total * _COMMON).select("key", "n", "gain"))
        rest = lines.filter(F.col("times") <= total * _COMMON).select("key", "n", "gain")
        added = held.join(common, "key").unionByName(held.join(common.select("key"), "key", "left_anti").join(rest.hint("merge"), "key"))
        added = added.select("uid", (F.col("n") * F.col("held")).alias("n"), (F.col("gain") * F.col("held")).alias("gain"))
        own = self.docs.select("uid", "doc_id", "n_words", "across").mapInArrow(
            lambda b: _gained(b, gains), "uid long, doc_id long, n_words long, n long, gain long"
        )
        none = F.lit(None).cast("long")
        rows = own.unionByName(added.select("uid", none.alias("doc_id"), none.alias("n_words"), "n", "gain"))
        return rows.groupBy("uid").agg(*(F.max(c).alias(c) for c in ("doc_id", "n_words")), *(F.sum(c).alias(c) for c in ("n", "gain")))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the target's share over the corpus' share) of each bucket, every count raised by one."""
    buckets, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    out = [
        math.floor(1000 * math.log(float(t + 1) * float(all_corpus + buckets) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array(out, np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, how: Resample = Resample()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (null: not drawn), all long.

    ``target`` (text) says what to resemble. Words are ASCII letters (A-Z as a-z), digits and all that is not ASCII. ``weight``
    is the floored mean gain of all features, 0 without any; ``score`` adds the noise of the id. Of the rows with
    ``least_words`` words the highest scores are drawn, ties to the smaller id, then to the row read first.

    A null text has no features. A null id takes the noise of an empty one and comes after others of its score; repeated
    rows and ids are rows of their own, with equal noise. An empty table gives no rows, an empty target gains from counts of
    none. Other columns are not looked at.
    """
    corpus = Features(docs, how.buckets)
    aim = Features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), how.buckets)
    gains = bucket_gains(corpus.counts(), aim.counts())
    mean = F.when(F.col("n") > 0, F.expr("CAST((gain - pmod(gain, n)) / n AS LONG)")).otherwise(0)
    weighed = corpus.weighed(gains).withColumn("weight", mean.cast("long"))
    scored = written(weighed.withColumn("score", (F.col("weight") + _noise(F.col("doc_id"), how.seed)).cast("long")), "scores")
    able = scored.filter(F.col("n_words") >= how.least_words)
    drawn = how.percent * able.count() // 100
    ranked = numbered(able, "rank", F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    out = ranked.unionByName(scored.filter(F.col("n_words") < how.least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", F.col("n").alias("n_features"), "weight", "score", "rank")
