"""Exact substring de-duplication with suffix arrays.

A byte goes if a 50-byte string over it also starts in a document of a smaller id. Each 50-byte string has an anchor: of
its 26-byte pieces the one of least hash, the same wherever the string occurs. Anchors, and not strings, are compared
between documents first; strings around an anchor that two documents share go, with the bytes they cover, to the
shard of that anchor. A shard builds suffix arrays by Larsson-Sadakane refinement, takes common prefixes by Kasai's
rule, and so knows for each string the least document that has it. A shard that is too large for one array builds
several, whose strings are found in one another by binary search.

Documents travel in batches of some megabytes. A batch sends compact lists and gets bit masks in the same order back, as
it can work out its own anchors again; so what is shuffled is small, no task holds more than a batch or a shard, and a
passage that many documents share costs one copy per batch that has it. Equal whole texts are found by digest beforehand.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import hashing
from sluice.llm.common import sized, slices, written

LENGTH = 50
PIECE = 26
REACH = LENGTH - PIECE + 1  # pieces in a string, and so strings of an anchor at most
NO_ID = (1 << 63) - 1
_CODE_BYTES = 6
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- suffix arrays


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of ``symbols`` (0 to 510) in order.

    Larsson and Sadakane: sort by a first key, then refine only the groups that are not single yet, by the ranks one
    sorted prefix further on, which doubles the sorted depth each time. All ties are resolved, as Kasai's rule needs.
    """
    n = len(symbols)
    width = 7  # symbols of 9 bits in a first key
    padded = np.concatenate((symbols.astype(np.int64) + 1, np.zeros(width, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(width):
        key = (key << 9) | padded[j : n + j]
    order = np.argsort(key, kind="stable")
    rank = _ranks(np.zeros(n + 1, np.int64), order, np.arange(n), key[order])
    while True:
        sorted_rank = rank[order]
        multiple = np.zeros(n, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        multiple[1:] |= same
        multiple[:-1] |= same
        slots = np.flatnonzero(multiple)
        if not len(slots):
            return order
        at = order[slots]
        pair = rank[at] * (n + 1) + rank[np.minimum(at + width, n)]
        refined = np.argsort(pair, kind="stable")
        order[slots] = at[refined]
        rank = _ranks(rank, order[slots], slots, pair[refined])
        width *= 2


def _ranks(rank: np.ndarray, positions: np.ndarray, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``rank`` with, for ``positions`` in the ``slots`` they hold, the first slot of their group of equal ``keys``, from 1
    on; 0 is the rank of the end."""
    if len(slots):
        first = np.ones(len(slots), bool)
        first[1:] = keys[1:] != keys[:-1]
        rank = rank.copy()
        rank[positions] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))] + 1
    return rank


def common_prefixes(symbols: np.ndarray, order: np.ndarray, most: int, lanes: int = 4096) -> np.ndarray:
    """For each place of ``order`` the common prefix with the place before, up to ``most``.

    Kasai's rule: from one position of the text to the next the value falls by one at most. Lanes of consecutive
    positions apply it side by side, each from zero on.
    """
    n = len(symbols)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    text = np.concatenate((symbols.astype(np.int16), np.full(most + 1, -1, np.int16)))
    span = -(-n // lanes)
    at = np.arange(0, n, span)
    end = np.minimum(at + span, n)
    h = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        more = (other >= 0) & (h < most)
        more[more] = text[at[more] + h[more]] == text[other[more] + h[more]]
        more &= np.maximum(at, other) + h < n
        h[more] += 1
        rest = ~more
        out[place[at[rest]]] = np.where(other[rest] >= 0, h[rest], 0)
        h[rest] = np.maximum(h[rest] - 1, 0)
        at = at + rest
        live = at < end
        if not live.all():
            at, end, h = at[live], end[live], h[live]
    return out


def _packed_rows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The strings at ``at`` as rows of big-endian words, which compare as the bytes do."""
    wide = np.zeros((len(at), -(-LENGTH // 8) * 8), np.uint8)
    for j in range(LENGTH):
        wide[:, j] = data[at + j]
    return wide.view(">u8").astype(np.uint64)


def find_rows(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each of ``wanted`` its place among the sorted distinct ``rows``, or -1: a binary search for all at once."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(rows), np.int64)
    for _ in range(len(rows).bit_length()):
        mid = np.minimum((low + high) // 2, len(rows) - 1)
        differ = rows[mid] != wanted
        word = differ.argmax(axis=1)
        pick = np.arange(len(wanted))
        less = differ.any(axis=1) & (rows[mid, word] < wanted[pick, word])
        searching = low < high
        low = np.where(searching & less, mid + 1, low)
        high = np.where(searching & ~less, mid, high)
    inside = low < len(rows)
    hit = inside.copy()
    hit[inside] = (rows[low[inside]] == wanted[inside]).all(axis=1)
    return np.where(hit, low, -1)


def least_documents(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, most: int) -> np.ndarray:
    """For contexts ``data[starts:ends]`` of ``docs``: by context and string in it, the least document with that string.

    Arrays are built over at most about ``most`` bytes each and merged by binary search.
    """
    out = np.full((len(starts), REACH), NO_ID, np.int64)
    lengths = ends - starts
    part = np.cumsum(lengths + 1) // most if len(starts) else np.zeros(0, np.int64)
    lists = []
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        size = lengths[own] + 1
        first = np.cumsum(size) - size
        source = np.repeat(starts[own] - first, size) + np.arange(size.sum())
        symbols = np.zeros(size.sum(), np.int64)
        inside = np.ones(size.sum(), bool)
        inside[first + size - 1] = False  # a mark after each context
        symbols[inside] = data[source[inside]].astype(np.int64) + 1
        context = np.repeat(np.arange(len(own)), size)
        offset = np.arange(len(symbols)) - first[context]
        whole = offset + LENGTH <= size[context] - 1
        order = suffix_array(symbols)
        prefix = common_prefixes(symbols, order, LENGTH)
        fresh = prefix < LENGTH  # a new string begins
        kept = whole[order]
        group = np.cumsum(fresh)[kept]
        order = order[kept]
        if not len(order):
            continue
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.minimum.reduceat(docs[own][context[order]], heads)
        at = source[order[heads]]
        cell = (own[context[order]], offset[order], np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order)))))
        lists.append([at, least, cell])
    if len(lists) > 1:
        rows = [_packed_rows(data, at) for at, _, _ in lists]
        merged = [least.copy() for _, least, _ in lists]
        for i in range(len(lists)):
            for j in range(i):
                found = find_rows(rows[j], rows[i])
                hit = found >= 0
                both = np.minimum(lists[i][1][hit], lists[j][1][found[hit]])
                merged[i][hit] = np.minimum(merged[i][hit], both)
                merged[j][found[hit]] = np.minimum(merged[j][found[hit]], both)
        for entry, least in zip(lists, merged, strict=True):
            entry[1] = least
    for _, least, (context, offset, group) in lists:
        out[context, offset] = least[group]
    return out


# --- batches and their anchors


def _pack(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Documents (id, text) as batches: a number, ids, byte sizes, and the bytes compressed, each text with a gap byte."""
    for batch in batches:
        for part in slices(batch.column(1), gap=0, most=most):
            ids = batch.column(0).slice(part.first, len(part.starts)).fill_null(NO_ID)
            raw = part.data.tobytes()
            name = hashlib.blake2b(raw + np.array(ids).tobytes(), digest_size=8).digest()
            packed = pa.compress(raw, codec="zstd", asbytes=True)
            yield pa.record_batch(
                [
                    pa.array([int.from_bytes(name, "big", signed=True)]),
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([(part.ends - part.starts).tolist()], pa.list_(pa.int64())),
                    pa.array([packed], pa.binary()),
                ],
                names=["batch", "ids", "sizes", "packed"],
            )


_BATCH = "batch long, ids array<long>, sizes array<long>, packed binary"


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, since each is a batch of documents."""
    for at in range(batch.num_rows):
        yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}


class _Anchored:
    """A batch with its runs: strings that start one after another and have one anchor. All in a fixed order."""

    def __init__(self, row: dict):
        self.ids = np.array(row["ids"], np.int64)
        sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        n = int(sizes.sum()) + len(sizes)
        self.data = np.frombuffer(pa.decompress(row["packed"], n, codec="zstd", asbytes=True), np.uint8)
        self.running = hashing.sums(self.data, fold=False)
        room = sizes >= LENGTH
        lengths = np.where(room, sizes - LENGTH + 1, 0)
        first = np.repeat(self.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())  # where strings start
        if not len(first):
            self.hash, self.first, self.count, self.doc = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        else:
            at = np.arange(n - PIECE + 1)
            piece = hashing.hashes(self.running, at, at + PIECE)
            least = (piece & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
            width = 1
            while 2 * width <= REACH:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :]) if width < REACH else least
            anchor = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            new = np.ones(len(first), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1)
            runs = np.flatnonzero(new)
            self.hash, self.first = piece[anchor[runs]], first[runs]
            self.count = np.diff(np.append(runs, len(first)))
            self.doc = np.searchsorted(self.starts, self.first, "right") - 1
        self.anchors, self.anchor_of = np.unique(self.hash, return_inverse=True)

    def shared_in_batch(self) -> np.ndarray:
        """Of each distinct anchor, whether two documents of this batch have it."""
        if not len(self.anchors):
            return np.zeros(0, bool)
        by = np.argsort(self.anchor_of, kind="stable")
        heads = np.searchsorted(self.anchor_of[by], np.arange(len(self.anchors)))
        return np.minimum.reduceat(self.doc[by], heads) != np.maximum.reduceat(self.doc[by], heads)

    def contexts(self, masks: dict[int, bytes], buckets: int, shards: int):
        """Runs whose anchor is marked, and their distinct contexts: (runs, context of each, shard, first, end, least id)."""
        bucket = _part(self.anchors >> np.uint64(32), buckets)
        marked = np.zeros(len(self.anchors), bool)
        for b, n in zip(*np.unique(bucket, return_counts=True), strict=True):
            begin = np.searchsorted(bucket, b)
            if b in masks:
                marked[begin : begin + n] = np.unpackbits(np.frombuffer(masks[b], np.uint8), count=n).astype(bool)
        runs = np.flatnonzero(marked[self.anchor_of])
        begin, end = self.first[runs], self.first[runs] + self.count[runs] + LENGTH - 1
        shard = _part(self.hash[runs] & np.uint64(0xFFFFFFFF), shards)
        key = np.rec.fromarrays([shard, self.hash[runs], hashing.hashes(self.running, begin, end), end - begin])
        order = np.lexsort((key.f3, key.f2, key.f1, key.f0))
        key = key[order]
        new = np.ones(len(runs), bool)
        new[1:] = key[1:] != key[:-1]
        of = np.empty(len(runs), np.int64)
        of[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        some = order[heads]
        least = np.minimum.reduceat(self.ids[self.doc[runs[order]]], heads) if len(heads) else np.zeros(0, np.int64)
        return runs, of, shard[some], begin[some], end[some], least


def _part(bits: np.ndarray, parts: int) -> np.ndarray:
    """Thirty-two bits as one of ``parts`` ranges, in order."""
    return ((bits * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _send_anchors(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            found = _Anchored(row)
            code = (found.anchors << np.uint64(1)) | found.shared_in_batch().astype(np.uint64)
            flat = np.ascontiguousarray(code.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :_CODE_BYTES]
            bucket = _part(found.anchors >> np.uint64(32), buckets)
            some, first = np.unique(bucket, return_index=True)
            cut = dict(zip(some.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(bucket)])))
            some = list(cut)
            yield pa.record_batch(
                [
                    pa.array(some, pa.int32()),
                    pa.array([row["batch"]] * len(some), pa.int64()),
                    pa.array([flat[slice(*cut[b])].tobytes() for b in some], pa.binary()),
                ],
                names=["bucket", "batch", "codes"],
            )


def _mark_anchors(rows: pa.Table) -> pa.Table:
    """Of each batch's anchors in a bucket, which another batch or document has too."""
    blobs = rows.column("codes").to_pylist()
    sizes = np.array([len(b) // _CODE_BYTES for b in blobs])
    wide = np.zeros((int(sizes.sum()), 8), np.uint8)
    wide[:, :_CODE_BYTES] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, _CODE_BYTES)
    code = wide.view("<u8").ravel()
    order = np.argsort(code >> np.uint64(1), kind="stable")
    value = code[order] >> np.uint64(1)
    same = value[1:] == value[:-1]
    shared = (code[order] & np.uint64(1)).astype(bool)
    shared[1:] |= same
    shared[:-1] |= same
    # Where one batch says that two of its documents have it, no other batch has it or ``same`` holds for all.
    marks = np.empty(len(code), bool)
    marks[order] = shared
    masks = [np.packbits(m).tobytes() for m in np.split(marks, np.cumsum(sizes)[:-1])]
    return pa.table(
        {"bucket": rows.column("bucket"), "batch": rows.column("batch"), "mask": pa.array(masks, pa.binary())},
        schema=pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("mask", pa.binary())]),
    )


def _masks(row: dict) -> dict[int, bytes]:
    return {m["bucket"]: m["mask"] for m in row["masks"] or ()}


def _send_contexts(batches: Iterable[pa.RecordBatch], buckets: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            found = _Anchored(row)
            _, _, shard, begin, end, least = found.contexts(_masks(row), buckets, shards)
            some, first = np.unique(shard, return_index=True)
            texts, sizes, docs = [], [], []
            for own in map(slice, first.tolist(), [*first[1:].tolist(), len(shard)]):
                length = end[own] - begin[own]
                source = np.repeat(begin[own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                texts.append(pa.compress(found.data[source].tobytes(), codec="zstd", asbytes=True))
                sizes.append(length.astype(np.uint8).tobytes())
                docs.append(least[own].tobytes())
            yield pa.record_batch(
                [
                    pa.array(some.astype(np.int32)),
                    pa.array([row["batch"]] * len(some), pa.int64()),
                    pa.array(sizes, pa.binary()),
                    pa.array(docs, pa.binary()),
                    pa.array(texts, pa.binary()),
                ],
                names=["shard", "batch", "sizes", "docs", "packed"],
            )


def _judge_contexts(rows: pa.Table, most: int) -> pa.Table:
    """Of each context of each batch, which of its strings a smaller document has, as bits of a 32-bit number."""
    sizes = [np.frombuffer(s, np.uint8).astype(np.int64) for s in rows.column("sizes").to_pylist()]
    docs = np.concatenate([np.frombuffer(d, np.int64) for d in rows.column("docs").to_pylist()])
    data = np.frombuffer(
        b"".join(
            pa.decompress(p, int(s.sum()), codec="zstd", asbytes=True)
            for p, s in zip(rows.column("packed").to_pylist(), sizes, strict=True)
        ),
        np.uint8,
    )
    counts = np.array([len(s) for s in sizes])
    length = np.concatenate(sizes)
    end = np.cumsum(length)
    begin = end - length
    key = hashing.hashes(hashing.sums(data, fold=False), begin, end) + length.astype(np.uint64)
    order = np.lexsort((docs, key))
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    of = np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    some = order[new]  # of equal contexts that of the least document
    least = least_documents(data, begin[some], end[some], docs[some], most)
    bits = (least[of] < docs[:, None]) & (np.arange(REACH) < (length - LENGTH + 1)[:, None])
    flags = (bits.astype(np.uint32) << np.arange(REACH, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    flags = [f.tobytes() for f in np.split(flags, np.cumsum(counts)[:-1])]
    return pa.table(
        {"shard": rows.column("shard"), "batch": rows.column("batch"), "flags": pa.array(flags, pa.binary())},
        schema=pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("flags", pa.binary())]),
    )


_CUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary"
_CUT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
    ]
)


def _cut_out(batches: Iterable[pa.RecordBatch], buckets: int, shards: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            found = _Anchored(row)
            runs, of, shard, _, _, least = found.contexts(_masks(row), buckets, shards)
            flags = np.zeros(len(shard), np.uint32)
            for f in row["flags"] or ():
                at = np.searchsorted(shard, f["shard"])
                own = np.frombuffer(f["flags"], np.uint32)
                flags[at : at + len(own)] = own
            later = found.ids[found.doc[runs]] > least[of]  # a smaller document of this batch has the whole context
            step = np.arange(REACH)
            gone = (later[:, None] | ((flags[of][:, None] >> step.astype(np.uint32)) & 1).astype(bool)) & (step < found.count[runs][:, None])
            at = (found.first[runs][:, None] + step)[gone]
            n = len(found.data)
            change = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + LENGTH, minlength=n + 1)[: n + 1]
            covered = np.cumsum(change)[:n] > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
            rows = []
            for k, (begin, end) in enumerate(zip(found.starts.tolist(), found.ends.tolist(), strict=True)):
                lo, hi = np.searchsorted(edge, [begin, end + 1])
                cuts = (edge[lo:hi] - begin).tolist()
                spans = [{"start": a, "end": b} for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
                text = found.data[begin:end]
                kept = (text[~covered[begin:end]] if spans else text).tobytes()
                rows.append(
                    {
                        "doc_id": None if found.ids[k] == NO_ID else int(found.ids[k]),
                        "n_bytes": end - begin,
                        "n_removed": end - begin - len(kept),
                        "spans": spans,
                        "kept_sha256": hashlib.sha256(kept).hexdigest(),
                        "kept": kept if texts else None,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, _CUT_ARROW)


def remove_repeats(
    docs: DataFrame, texts: bool = True, batch_bytes: int = 1 << 20, part_bytes: int = 2 << 20, array_bytes: int = 4 << 20
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, spans (start, end in bytes), kept_sha256 and, with
    ``texts``, the bytes kept.

    A null text counts as empty. Rows without an id come after all ids and are not smaller than one another; nor are rows
    that share an id. ``batch_bytes`` is what a batch holds (a longer text comes alone), ``part_bytes`` how much
    text makes a bucket and a shard, ``array_bytes`` what one suffix array covers. None of them changes the result.
    """
    content = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content.alias("text"))
    digests = written(read.select("doc_id", F.octet_length("text").alias("n"), F.unhex(F.sha2("text", 256)).alias("digest")), "digests")
    place = F.coalesce("doc_id", F.lit(NO_ID))
    several = digests.filter(F.col("n") >= LENGTH).groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("m"))
    copies = digests.join(several.filter("m > 1").select("digest", "first"), "digest").filter("doc_id > first")
    copies = written(copies.select("doc_id", F.col("n").cast("long").alias("n_bytes"), "digest"), "copies")
    total = digests.agg(F.sum("n")).first()[0] or 0
    parts = min(1 << 31, max(8, math.ceil(total / part_bytes)))
    repeated = sized(written(copies.select("doc_id", "digest").distinct(), "repeated"))
    own = read.withColumn("digest", F.unhex(F.sha2("text", 256))).join(repeated, ["doc_id", "digest"], "left_anti")
    packed = written(own.select("doc_id", "text").mapInArrow(lambda b: _pack(b, batch_bytes), _BATCH), "batches")

    codes = packed.mapInArrow(lambda b: _send_anchors(b, parts), "bucket int, batch long, codes binary")
    marks = written(codes.groupBy("bucket").applyInArrow(_mark_anchors, "bucket int, batch long, mask binary"), "anchor-marks")
    masks = marks.groupBy("batch").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))  # one per bucket
    marked = packed.join(masks, "batch", "left")
    contexts = marked.mapInArrow(
        lambda b: _send_contexts(b, parts, parts), "shard int, batch long, sizes binary, docs binary, packed binary"
    )
    judged = written(
        contexts.groupBy("shard").applyInArrow(lambda t: _judge_contexts(t, array_bytes), "shard int, batch long, flags binary"),
        "context-flags",
    )
    flags = judged.groupBy("batch").agg(F.collect_list(F.struct("shard", "flags")).alias("flags"))
    cut = marked.join(flags, "batch", "left").mapInArrow(lambda b: _cut_out(b, parts, parts, texts), _CUT)
    whole = copies.select(
        "doc_id",
        "n_bytes",
        F.col("n_bytes").alias("n_removed"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"),
        F.lit(_EMPTY).alias("kept_sha256"),
        F.when(F.lit(texts), F.lit(b"")).alias("kept"),
    )
    return cut.unionByName(whole)
