"""Near-duplicate documents by MinHash with odd sketches.

A document is the set of its distinct word shingles. Documents of equal sets form a class first, and only one of
a class goes on. Bands of MinHash samples name candidates. A second set of samples, the least shingle hash in each of 2048
bins, is folded into an odd sketch: a bitmap in which each sample flips one bit. The bits in which two sketches differ
tell how many samples differ, and most precisely where few do; candidates below the threshold by more than chance
allows are dropped by it, and the rest is confirmed on the full sets. In a bucket candidates are tied to a pivot and not to
each other; the pivot is the member that shares most buckets, which is near to most. What is then still outside of a bucket's
largest component is compared with the members of other components, in the first bucket that both are in: links are
complete for all candidates, and no group of copies is expanded into its pairs. Full sets of ordinary size go along there,
so that pairs just below the threshold, which sketches cannot tell from links, are dropped where they meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import hashing
from sluice.llm.common import Slice, list_array, only, slices, written
from sluice.llm.components import components


@dataclass(frozen=True)
class MinHash:
    """``words`` a shingle; linked from a similarity of ``percent`` on. At 0.8, 35 bands of 5 rows miss one pair in a million,
    and sketches, which allow for 4.5 deviations of each kind of noise, fewer than that."""

    words: int = 5
    percent: int = 80
    bands: int = 35
    rows: int = 5
    bins: int = 2048
    bits: int = 2048

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def most_bits(self, n_a: Column, n_b: Column) -> Column:
        """Differing bits that sets of these sizes exceed by chance only if they are less similar than ``percent``."""
        j, k, b = self.percent / 100, float(self.bins), float(self.bits)
        union = (n_a + n_b) / (1 + j)
        filled = k * (1 - F.exp(-union / k))
        other = 1 - F.exp(-F.greatest(n_a, n_b) / k)  # that a bin with a differing least has more of the other set
        sampling = filled * j * (1 - j) * (1 - filled / union) * (1 + other) * (1 + other)
        noise = F.sqrt(F.greatest(F.lit(0.0), sampling) + filled * (1 - j) * other * (1 - other))
        flips = filled * (1 - j) * (1 + other) + 4.5 * noise + 2
        once, twice = F.pow(F.lit(1 - 2 / b), flips), F.pow(F.lit(1 - 4 / b), flips)
        spread = b / 4 * (1 - once * once) + b * (b - 1) / 4 * (twice - once * once)
        return b / 2 * (1 - once) + 4.5 * F.sqrt(F.greatest(F.lit(0.0), spread)) + 1


def _shingle_sets(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, sorted, laid end to end; and their numbers."""
    starts, ends, first = hashing.words(part)
    h = hashing.hashes(hashing.sums(part.data, fold=True), starts, ends)
    sets = []
    for k in range(len(part.starts)):
        of = h[first[k] : first[k + 1]]
        n = len(of)
        if n == 0:
            sets.append(of)
            continue
        width = min(size, n)
        shingle = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            shingle = hashing.mix(shingle * np.uint64(0x2545F4914F6CDD1D) + of[j : n - width + 1 + j])
        if n < size:
            shingle = hashing.mix(shingle + np.uint64(n))  # a short whole text is no shingle of another
        sets.append(np.unique(shingle))
    return np.concatenate(sets), np.array([len(s) for s in sets], np.int64)


def _signed(part: Slice, how: MinHash):
    """Per row of ``part``: set size, two set digests, band keys and sketch words."""
    values, sizes = _shingle_sets(part, how.words)
    n = len(sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    some = np.flatnonzero(sizes)
    digests = np.zeros((2, n), np.uint64)
    bands = np.zeros((n, how.bands), np.int64)
    sketch = np.zeros((n, how.bits // 64), np.int64)
    if len(some):
        at = starts[some]
        digests[0, some] = np.add.reduceat(hashing.mix(values), at)
        digests[1, some] = np.add.reduceat(hashing.mix(values ^ np.uint64(0xA5A5A5A5DEADBEEF)), at)
        short = (values >> np.uint64(32)).astype(np.uint32)
        rng = np.random.default_rng(how.samples)
        a = rng.integers(0, 1 << 31, how.samples, np.uint32) * np.uint32(2) + np.uint32(1)
        b = rng.integers(0, 1 << 32, how.samples, np.uint32)
        key = np.zeros(len(some), np.uint64)
        for i in range(how.samples):
            least = np.minimum.reduceat(short * a[i] ^ b[i], at).astype(np.uint64)
            key = hashing.mix(key * np.uint64(0x2545F4914F6CDD1D) + least)
            if i % how.rows == how.rows - 1:
                bands[some, i // how.rows] = key.view(np.int64)
                key = np.full(len(some), i + 1, np.uint64)
        # Values are sorted within a row, so the least of a bin (its top bits) comes first.
        row = np.repeat(np.arange(len(some)), sizes[some])
        spot = row * how.bins + (values >> np.uint64(64 - (how.bins - 1).bit_length())).astype(np.int64)
        least = np.ones(len(values), bool)
        least[1:] = spot[1:] != spot[:-1]
        bit = hashing.mix(values[least] ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(how.bits)
        odd = np.bincount(row[least] * how.bits + bit.astype(np.int64), minlength=len(some) * how.bits) & 1
        sketch[some] = np.packbits(odd.astype(np.uint8).reshape(len(some), how.bits), axis=1).view(np.int64)
    return sizes, digests.view(np.int64), bands, sketch


# Sets of so many shingles are compared where documents meet; of larger ones the sketch alone is there.
_CARRIED = 1024


_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"


def _sign(batches: Iterable[pa.RecordBatch], how: MinHash) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1), gap=10):
            sizes, digests, bands, sketch = _signed(part, how)
            n = len(sizes)
            width = lambda rows: np.full(n, rows.shape[1])
            yield pa.record_batch(
                [
                    batch.column(0).slice(part.first, n),
                    pa.array(sizes),
                    pa.array(digests[0]),
                    pa.array(digests[1]),
                    list_array(bands.ravel(), width(bands), pa.int64()),
                    list_array(sketch.ravel(), width(sketch), pa.int64()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"],
            )


def _sets(batches: Iterable[pa.RecordBatch], how: MinHash) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1), gap=10):
            values, sizes = _shingle_sets(part, how.words)
            yield pa.record_batch(
                [batch.column(0).slice(part.first, len(sizes)), list_array(values.view(np.int64), sizes, pa.int64())],
                names=["id", "shingles"],
            )


def sketch_distance(a: Column, b: Column, words: int) -> Column:
    """Bits in which two sketches differ."""
    return reduce(lambda x, y: x + y, (F.bit_count(F.get(a, F.lit(j)).bitwiseXOR(F.get(b, F.lit(j)))) for j in range(words)))


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, sorted full sets of both) that are similar enough."""
    for batch in batches:
        sides = []
        for column in (batch.column(2), batch.column(3)):
            sides.append((column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)))
        (at_a, of_a), (at_b, of_b) = sides
        held = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            x, y = of_a[at_a[k] : at_a[k + 1]], of_b[at_b[k] : at_b[k + 1]]
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
            held[k] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
        yield pa.record_batch([batch.column(0), batch.column(1)], schema=_PAIR).filter(pa.array(held))


class _Search:
    """Links among the classes ``reps`` (id, n, bands, sketch) of ``read`` (doc_id, text)."""

    def __init__(self, read: DataFrame, reps: DataFrame, how: MinHash):
        self.how = how
        self.reps = reps
        keys = reps.select("id", F.posexplode("bands").alias("band", "key")).select("id", "band", F.xxhash64("band", "key").alias("bucket"))
        # Dealt once: counting the members of a bucket and finding them again read the same shuffle.
        keys = keys.repartition("bucket")
        shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        self.members = written(keys.join(shared, "bucket"), "buckets")
        total = self.members.groupBy("id").agg(F.sum("m").alias("met"))
        self.met = written(self.members.select("id", "bucket").join(total, "id"), "met")
        # The full sets of all documents that share a bucket, in one second pass over the texts.
        texts = only(read, written(self.members.select(F.col("id").alias("doc_id")).distinct(), "ids"), "doc_id")
        self.sets = written(texts.mapInArrow(lambda b: _sets(b, how), "id long, shingles array<long>"), "sets")
        self.labels: DataFrame | None = None

    def _of_pivot(self) -> DataFrame:
        """(a, a_c, b, b_c, met): each member with the pivot of each of its buckets, and the components of both.

        The pivot is the member that meets most others in its buckets, as the text that near copies were made of does.
        """
        members = self._named(self.met, "id")
        best = F.max_by(F.struct("id", "id_c", "met"), F.struct("met", -F.col("id"))).alias("p")
        pivots = members.groupBy("bucket").agg(best)
        pairs = members.select("bucket", F.col("id").alias("a"), F.col("id_c").alias("a_c")).join(pivots, "bucket")
        return pairs.select("a", "a_c", F.col("p.id").alias("b"), F.col("p.id_c").alias("b_c"), F.col("p.met").alias("met")).filter("a <> b")

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that sketches don't rule out."""
        return self._with_sketch(self._with_sketch(pairs, "a"), "b").filter(self._possible).select("a", "b")

    def _named(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the component of ``name`` as ``name_c``."""
        if self.labels is None:
            return rows.withColumn(f"{name}_c", F.col(name))
        found = self.labels.select(F.col("node").alias(name), F.col("component").alias("_c"))
        return rows.join(found, name, "left").withColumn(f"{name}_c", F.coalesce("_c", name)).drop("_c")

    def _with_sketch(self, rows: DataFrame, name: str, *more: str) -> DataFrame:
        side = self.reps.select(
            F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in more)
        )
        return rows.join(side, name)

    @property
    def _possible(self) -> Column:
        """What sizes and sketches say of a pair with (n_a, s_a, n_b, s_b)."""
        least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        differ = sketch_distance(F.col("s_a"), F.col("s_b"), self.how.bits // 64)
        return (100 * least >= self.how.percent * most) & (differ <= self.how.most_bits(F.col("n_a"), F.col("n_b")))

    def confirm(self, pairs: DataFrame) -> None:
        """Join the components that ``pairs`` (a, b) link, as far as they hold on the full sets."""
        side = lambda x: self.sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
        percent = self.how.percent
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
        links = written(both.mapInArrow(lambda b: _confirm(b, percent), "a long, b long"), "confirmed")
        if links.isEmpty():
            return
        if self.labels is None:
            self.labels = components(links)
            return
        # Only the components found so far are joined further, by the few links among them.
        among = self._named(self._named(links, "a"), "b").select(F.col("a_c").alias("a"), F.col("b_c").alias("b"))
        joined = components(written(among.filter("a <> b").distinct(), "links-among"))
        further = joined.select(F.col("node").alias("component"), F.col("component").alias("_to"))
        moved = self.labels.join(further, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
        self.labels = written(moved.unionByName(joined), "labels")

    def run(self) -> DataFrame | None:
        """Components (node, component) of all links, or none."""
        # A document's best pivot first; most of its other pivots are in the same component after that.
        self.confirm(self._near(self._of_pivot().groupBy("a").agg(F.max_by("b", F.struct("met", -F.col("b"))).alias("b"))))
        self.confirm(self._near(self._of_pivot().filter("a_c <> b_c").select("a", "b").distinct()))
        named = self._named(self.members.select("bucket", "band", "id"), "id")
        sizes = named.groupBy("bucket", "id_c").agg(F.count(F.lit(1)).alias("m"))
        largest = F.max_by("id_c", F.struct("m", -F.col("id_c"))).alias("main")
        apart = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), largest).filter("parts > 1")
        left = named.join(apart.select("bucket", "main"), "bucket")
        # A document is in as many buckets as there are bands at most; its sketch is fetched once for all of them.
        spots = left.groupBy(F.col("id").alias("b"), F.col("id_c").alias("b_c")).agg(F.collect_list(F.struct("bucket", "band", "main")).alias("spots"))
        size = F.size("shingles")
        sets = self.sets.select(F.col("id").alias("b"), size.alias("n_b"), F.when(size <= _CARRIED, F.col("shingles")).alias("set_b"))
        left = self._with_sketch(spots, "b", "bands").join(sets, ["b", "n_b"]).select("*", F.inline("spots")).drop("spots")
        left = written(left, "open-buckets")
        others = left.filter("b_c <> main")
        if others.isEmpty():
            return self.labels
        # What is outside of a bucket's largest component against all that is in another one. Compared where they meet, so
        # that a pair that sketches rule out is never written, and in the first of its common buckets only.
        names = {"b": "a", "b_c": "a_c", "n_b": "n_a", "s_b": "s_a", "bands_b": "bands_a", "set_b": "set_a"}
        ours = others.select("bucket", *(F.col(c).alias(name) for c, name in names.items()))
        meets = F.col("x.bucket") == F.col("y.bucket")
        # Two outside of the largest meet from both sides; one is enough.
        once = F.expr("a_c <> b_c") & ((F.col("b_c") == F.col("y.main")) | F.expr("a > b"))
        band = F.array_position(F.zip_with("bands_a", "bands_b", lambda p, q: p == q), F.lit(True)) - 1
        common, percent = F.size(F.array_intersect("set_a", "set_b")), self.how.percent
        similar = F.expr("set_a IS NULL OR set_b IS NULL") | ((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b")))
        met = ours.alias("x").join(left.alias("y"), meets & once & self._possible & (band == F.col("y.band")) & similar)
        self.confirm(met.select("a", "b"))
        return self.labels


def near_duplicates(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and ``kept``.

    Words are separated by ASCII white space, A-Z count as a-z. A text of fewer words than a shingle is one shingle; a
    text without words, or null, has none and is linked with nothing. ``component_id`` is the smallest id reachable
    over links, ``kept`` says that it is the row's own. Rows without an id are linked with nothing and kept; rows that share
    an id are one document, linked where any of its texts is. Other columns are not looked at.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(read.mapInArrow(lambda b: _sign(b, how), _SIGNED), "signatures")
    some = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(some.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = some.join(classes, ["n_shingles", "d1", "d2"]).filter("doc_id = rep")
    reps = reps.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "bands", "sketch").dropDuplicates(["id", "n", "bands"])
    labels = _Search(read, reps, how).run()
    found = classes
    if labels is not None:
        found = classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
            "rep", F.coalesce("component", "rep")
        )
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(
        found.select("n_shingles", "d1", "d2", "rep"), ["n_shingles", "d1", "d2"], "left"
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id; rows without an id stay."""
    kept = near_duplicates(docs, how).filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = written(kept, "kept-ids")
    first = only(docs.filter("doc_id IS NOT NULL"), kept.select("doc_id"), "doc_id")
    if not kept.filter("n > 1").isEmpty():
        first = first.dropDuplicates(["doc_id"])
    return first.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)
