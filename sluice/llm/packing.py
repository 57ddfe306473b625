"""Documents packed into training sequences, shortest pack first over the histogram of lengths.

Documents are tokenised once and cut into items of at most a sequence's length. Only the histogram of item lengths, one
count per length, comes to the driver. There lengths are placed longest first: a whole lot of equal items at a time goes
on top of the shortest pack that it fits on, packs of one filling being a range of sequence ids, so that a step costs the
same for one sequence or a billion. As many sequences are opened as the tokens fill, the rest of them going to sequences
of powers of two; an item that fits nowhere then is cut, and what remains of it is a shorter item. So nothing is padded.
The steps are joined back to the items by rank: the items of one length are numbered over the whole corpus.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import written
from sluice.llm.numbering import numbered

#: Words a worker remembers in each of two generations; a bound on memory only.
REMEMBERED = 700_000
#: Ranks that one row of the plan covers before it is dealt out further.
_STRETCH = 1 << 16


#: Words that the tokenizer cuts in two at least: letters that every Unicode version has, then ASCII signs.
_HALVES = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")


class Words:
    """Token ids of words as bytes; words unknown in a batch go to the tokenizer together.

    Used where the tokenizer drops white space and never merges across it. Letters and the signs after them are
    separate to it as well, so "word." and "word!" are one look-up more, not one encoding more. Words seen lately are remembered: when the
    young generation is full it becomes the old one, and the old one is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = _drops_blanks(spec)
        self.special = [t["content"].lower().encode() for t in spec["added_tokens"]]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _plain(self, text: bytes) -> bool:
        return not any(s in text for s in self.special)

    def _learn(self, words: set[bytes]) -> None:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        unknown = set()
        joint = []
        for word in words.difference(self.young):
            ids = self.old.get(word)
            if ids is not None:
                self.young[word] = ids
            elif (halves := _HALVES.fullmatch(word.decode())) is None or not self._plain(word):
                unknown.add(word)
            else:
                halves = [half.encode() for half in halves.groups()]
                joint.append((word, *halves))
                unknown.update(half for half in halves if half not in self.young)
        self._encode(list(unknown))
        for word, letters, signs in joint:
            self.young[word] = self.young[letters] + self.young[signs]

    def _encode(self, unknown: list[bytes]) -> None:
        for at in range(0, len(unknown), 20_000):
            some = unknown[at : at + 20_000]
            got = self.tokenizer.encode([w.decode() for w in some], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, self.type)
            # A word may have no token at all; ids come in the order of words.
            ends = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(some)), "right").tolist()
            raw, width, start = ids.tobytes(), self.type.itemsize, 0
            for word, end in zip(some, ends):
                self.young[word] = raw[start * width : end * width]
                start = end

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return [np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, self.type).tobytes() for t in texts]
        # Letters are lower-cased anyway; special tokens are looked for before that.
        words = [(low if self._plain(low := t.lower()) else t).split() for t in texts]
        self._learn(set().union(*words))
        known = self.young.__getitem__
        return [b"".join(map(known, some)) for some in words]


def _drops_blanks(spec: dict) -> bool:
    """Whether text is cut at white space, which is dropped, before any other step could see it."""
    cleaned = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if cleaned != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return False
    how, level = splits
    return bool(how["invert"] and how["behavior"] == "Removed" and not level["use_regex"] and not level["add_prefix_space"])


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _tokenised(batches: Iterable[pa.RecordBatch], path: str, end: int | None) -> Iterator[pa.RecordBatch]:
    words = _words(path)
    last = b"" if end is None else np.array([end], words.type).tobytes()
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            texts = [t.as_py() for t in batch.column(1).cast(pa.large_binary()).fill_null(b"")]
            ids = [x + last for x in words.ids(texts)]
            n = np.array([len(x) for x in ids], np.int64) // words.type.itemsize
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(ids, pa.binary())], names=["doc_id", "n", "ids"])


class Step(NamedTuple):
    """Items ``first`` .. ``first + count - 1`` (numbered longest first): their tokens from ``start`` on, ``length`` of them,
    go to sequences ``sequence`` .. ``sequence + count - 1``, each at ``offset``."""

    first: int
    count: int
    start: int
    length: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], size: int) -> list[Step]:
    """Where the items of ``histogram`` (count per length, lengths of 1 to ``size``) go.

    Placed longest first, on the shortest pack they fit on; the sequences hold exactly the tokens there are.
    """
    total = sum(length * n for length, n in histogram.items())
    # Sequences not opened yet, largest first: (capacity, first id, how many).
    closed = [(size, 0, total // size)] if total >= size else []
    rest, next_id = total % size, total // size
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            closed.append((1 << bit, next_id, 1))
            next_id += 1
    closed.reverse()
    lots: list[tuple[int, int, int, int]] = []  # (-length, first item, count, start within the item)
    first = 0
    for length in sorted(histogram, reverse=True):
        if histogram[length]:
            lots.append((-length, first, histogram[length], 0))
            first += histogram[length]
    heapq.heapify(lots)
    packs: list[tuple[int, int, int, int]] = []  # open ones with room: (-room, first sequence, count, capacity)
    steps = []
    while lots:
        minus, first, count, start = heapq.heappop(lots)
        length = -minus
        room = -packs[0][0] if packs else 0
        if room < length and closed and closed[-1][0] > room:
            capacity, sequence, n = closed.pop()
            opened = min(n, count)
            if opened < n:
                closed.append((capacity, sequence + opened, n - opened))
            heapq.heappush(packs, (-capacity, sequence, opened, capacity))
            room = capacity
        minus_room, sequence, n, capacity = heapq.heappop(packs)
        taken, piece = min(n, count), min(length, room)
        steps.append(Step(first, taken, start, piece, sequence, capacity - room))
        if taken < n:
            heapq.heappush(packs, (minus_room, sequence + taken, n - taken, capacity))
        if room > piece:
            heapq.heappush(packs, (piece - room, sequence, taken, capacity))
        if taken < count:
            heapq.heappush(lots, (minus, first + taken, count - taken, start))
        if piece < length:
            heapq.heappush(lots, (piece - length, first, taken, start + piece))
    return steps


def _steps(spark: SparkSession, steps: list[Step]) -> DataFrame:
    """The plan as rows, one per item and piece, dealt out in two turns so that no task makes them all."""
    columns = np.array(steps, np.int64).reshape(-1, len(Step._fields))
    rows = written(spark.createDataFrame(pa.table(dict(zip(Step._fields, columns.T)))), "plan")
    blocks = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("count") - 1, F.lit(_STRETCH))).alias("_from"))
    blocks = blocks.repartition(F.xxhash64("first", "start", "_from"))
    upto = F.least(F.col("count"), F.col("_from") + _STRETCH) - 1
    each = blocks.select("*", F.explode(F.sequence("_from", upto)).alias("_i"))
    return each.select(
        (F.col("first") + F.col("_i")).alias("item"), F.col("start").alias("within"), F.col("length"),
        (F.col("sequence") + F.col("_i")).alias("sequence_id"), F.col("offset"),
    )


_PIECE = "struct<start: long, length: long, sequence_id: long, offset: long>"
_PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's pieces with their ids as little-endian unsigned 32-bit numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256).to_pydict()
            out: dict[str, list] = {f.split()[0]: [] for f in _PACKED.split(", ")}
            for doc_id, n, ids, pieces in zip(rows["doc_id"], rows["n"], rows["ids"], rows["pieces"]):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()
                for p in pieces:
                    out["doc_id"].append(doc_id)
                    out["ids"].append(wide[4 * p["start"] : 4 * (p["start"] + p["length"])])
                    out["doc_tokens"].append(n)
                    for name, value in p.items():
                        out[name].append(value)
            kinds = {name: pa.binary() if name == "ids" else pa.int64() for name in out}
            yield pa.record_batch([pa.array(v, kinds[k]) for k, v in out.items()], names=list(out))


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end: int | None = 2) -> DataFrame:
    """``docs`` (doc_id, text) as pieces of sequences of at most ``size`` tokens (a power of two), one row per piece.

    Columns: ``doc_id``, ``start`` (tokens of the document before the piece), ``length``, ``ids`` (little-endian unsigned
    32-bit numbers), ``doc_tokens``, ``sequence_id`` (from 0, without gaps), ``offset`` (of the piece in its sequence).
    A document is what ``tokenizer``, a file for the tokenizers library, makes of its whole text without added special
    tokens, followed by ``end`` (None: by nothing). Each token lies in one piece, pieces lie one after the other without
    gaps, and sequences are full but for at most one of each smaller power of two, which is full too.

    A null text counts as empty and is its ``end`` alone (without one it has no piece). Repeated rows and ids, and rows
    without an id, are packed each on its own; equal lengths are ordered as the rows were read. An empty table gives no
    pieces; other columns are not looked at.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = read.mapInArrow(lambda batches: _tokenised(batches, tokenizer, end), "doc_id long, n long, ids binary")
    done = written(done.filter("n > 0").withColumn("uid", F.monotonically_increasing_id()), "tokens")

    starts = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(size))).alias("start")
    items = done.select("uid", "n", starts).select("uid", "start", F.least(F.lit(size), F.col("n") - F.col("start")).alias("n"))
    # At most one row per length.
    histogram = {row["n"]: row["count"] for row in items.groupBy("n").count().collect()}
    ranked = numbered(items, "item", F.desc("n"), F.asc("uid"), F.asc("start"))
    # The plan is small but its steps are as many as the items: never a side to broadcast.
    placed = ranked.join(_steps(spark, plan(histogram, size)).hint("merge"), "item").groupBy("uid").agg(
        F.collect_list(
            F.struct((F.col("start") + F.col("within")).alias("start"), "length", "sequence_id", "offset").cast(_PIECE)
        ).alias("pieces")
    )
    return done.join(placed, "uid").select("doc_id", "n", "ids", "pieces").mapInArrow(_cut, _PACKED)
