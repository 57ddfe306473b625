"""Benchmark decontamination on templates, so that questions with other numbers and names are found too.

A text becomes a sequence of tokens in which every number, name (a run of capitalised words) and unit after a number is a
typed placeholder, and a second one of plain words without regard to case. Windows of eight tokens are joined by hash with those of the benchmark. Along one alignment of a document
and an item the placeholders must agree: each value of the item stands for one value of the document throughout; windows
with a value that does not are left out. A document is contaminated by an item if what is left covers 13 tokens in a row
(or the whole of a shorter item), or half of the item's windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import hashing
from sluice.llm.common import Slice, let, slices, written


@dataclass(frozen=True)
class Templates:
    window: int = 8
    literals: int = 4  # a window needs as many tokens that are no placeholders, or half of a shorter window
    run: int = 13
    percent: int = 50
    most_broadcast: int = 1 << 21  # hashes sent to tasks at once; a larger benchmark takes more passes


#: Words that are units after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees mph kmh w kw v hz"
).split()

_GAP, _LETTER, _UPPER, _DIGIT, _MARK = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[:33] = _GAP
_CLASS[97:123] = _LETTER
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _LETTER
_IN_NUMBER = np.zeros(256, bool)
_IN_NUMBER[list(b".,:/-")] = True
_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (11, 12, 13))
_ROLL = np.uint64(0xD6E8FEB86659FD93)


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hashing.hashes(hashing.sums(data, True), np.array([0]), np.array([len(data)]))[0])


_UNIT_HASHES = np.array(sorted(_word_hash(w) for w in UNITS), np.uint64)


class _Tokens:
    """Template tokens of a slice: hash, byte span, whether a placeholder, and the first token of each row."""

    def __init__(self, part: Slice, plain: bool):
        kind = _CLASS[part.data]
        n = len(kind)
        if n > 2:
            digit = kind == _DIGIT
            kind[1:-1][_IN_NUMBER[part.data[1:-1]] & digit[:-2] & digit[2:]] = _DIGIT
        group = np.zeros(n + 2, np.uint8)  # 0 nothing, 1 letters, 2 digits
        group[1:-1] = np.where(kind == _DIGIT, 2, (kind == _LETTER) | (kind == _UPPER))
        change = np.flatnonzero(group[1:] != group[:-1])
        starts = change[group[change + 1] > 0]
        ends = change[group[change] > 0]
        h = hashing.hashes(hashing.sums(part.data, True), starts, ends)
        number = group[starts + 1] == 2
        if plain:
            number = np.zeros(len(starts), bool)
        two = np.append(part.data, [0])[starts + 1]
        accented = (part.data[starts] == 0xC3) & (two >= 0x80) & (two <= 0x9E) if n else np.zeros(0, bool)
        name = np.zeros(len(starts), bool) if plain else (kind[starts] == _UPPER) | accented
        row = np.searchsorted(part.starts, starts, "right") - 1
        after = np.zeros(len(starts), bool)  # whether the token before is of the same row
        after[1:] = row[1:] == row[:-1]
        before = lambda flags: np.concatenate(([False], flags[:-1])) & after if len(flags) else flags
        unit = before(number) & ~number
        unit[unit] = np.isin(h[unit], _UNIT_HASHES)
        h[number], h[name], h[unit] = _NUMBER, _NAME, _UNIT
        keep = ~(name & before(name))  # a run of names is one placeholder
        last = np.append(np.flatnonzero(keep)[1:], len(keep)) - 1
        self.hash, self.start, self.end = h[keep], starts[keep], ends[last] if len(last) and len(keep) else ends[:0]
        self.slot = (number | name | unit)[keep]
        self.first = np.searchsorted(row[keep], np.arange(len(part.starts) + 1))


def _windows(tokens: _Tokens, width: int, plain: bool, how: Templates) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` tokens, by first token, and which are inside a row and have enough literals."""
    n = len(tokens.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.full(n, 2 * width + plain, np.uint64)
    literals = np.zeros(n, np.int16)
    for j in range(width):
        h = h * _ROLL + tokens.hash[j : n + j]
        literals += ~tokens.slot[j : n + j]
    lengths = np.diff(tokens.first)
    row_end = np.repeat(tokens.first[1:], lengths)[:n]
    inside = np.arange(n) + width <= row_end
    return hashing.mix(h), inside & (literals >= min(how.literals, (width + 1) // 2))


_FOUND = pa.schema(
    [
        ("id", pa.int64()),
        ("plain", pa.bool_()),
        ("width", pa.int32()),
        ("window", pa.int64()),
        ("at", pa.int32()),
        ("n_tokens", pa.int32()),
        ("slots", pa.list_(pa.string())),
    ]
)
_FOUND_SQL = "id long, plain boolean, width int, window long, at int, n_tokens int, slots array<string>"


def _found(batches: Iterable[pa.RecordBatch], widths: list[int] | None, wanted, how: Templates) -> Iterator[pa.RecordBatch]:
    """Template windows of the rows (id, text): those in ``wanted``, or all of each row's own width if that is none."""
    hashes = None if wanted is None else wanted.value
    if hashes is not None:
        marks = np.zeros(1 << 22, bool)
        marks[(hashes >> np.uint64(42)).astype(np.int64)] = True
    for batch in batches:
        for part, plain in ((p, plain) for p in slices(batch.column(1), gap=10) for plain in (False, True)):
            tokens = _Tokens(part, plain)
            ids = batch.column(0).slice(part.first, len(part.starts)).to_pylist()
            lengths = np.diff(tokens.first)
            row = np.repeat(np.arange(len(lengths)), lengths)
            for width in widths if widths is not None else range(1, how.window + 1):
                h, fits = _windows(tokens, width, plain, how)
                if hashes is not None:
                    at = np.flatnonzero(fits & marks[(h >> np.uint64(42)).astype(np.int64)])
                    at = at[np.isin(h[at], hashes)]
                else:
                    at = np.flatnonzero(fits & (np.minimum(lengths, how.window)[row[: len(h)]] == width))
                for begin in range(0, len(at), 4096):
                    some = at[begin : begin + 4096]
                    rows = []
                    for k in some.tolist():
                        r = int(row[k])
                        spans = [i for i in range(k, k + width) if tokens.slot[i]]
                        text = [part.data[tokens.start[i] : tokens.end[i]].tobytes().decode("utf-8", "replace") for i in spans]
                        rows.append(
                            {"id": ids[r], "plain": plain, "width": width, "window": int(h[k].view(np.int64)), "at": k - int(tokens.first[r]),
                             "n_tokens": int(lengths[r]), "slots": text}
                        )
                    yield pa.RecordBatch.from_pylist(rows, _FOUND)


def _longest(positions: Column) -> Column:
    """The longest run of consecutive numbers in a sorted array."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(x == a["last"] + 1, a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(positions, start, step)["best"]


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Templates = Templates()) -> DataFrame:
    """Pairs of a contaminated document and an item it holds: doc_id, item_id, matched and n_windows (of the item),
    run_tokens (the longest stretch) and ``changed`` (whether values differ).

    Null and empty texts and rows without an id match nothing; rows that share an id count as one document. An
    item with too few literal tokens for any window cannot be found. Other columns are not looked at.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter("id IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    items = items.filter("id IS NOT NULL").mapInArrow(lambda b: _found(b, None, None, how), _FOUND_SQL)
    items = written(items.distinct(), "templates")
    wanted = items.select("window").distinct()
    widths = sorted(w for (w,) in items.select("width").distinct().collect())  # eight at most
    parts = max(1, -(-wanted.count() // how.most_broadcast))
    hits = None
    for k in range(parts):
        here = wanted.filter(F.pmod("window", F.lit(parts)) == k).collect()  # at most about ``most_broadcast`` numbers
        sent = spark.sparkContext.broadcast(np.sort(np.array([w for (w,) in here], np.int64).view(np.uint64)))
        found = read.mapInArrow(lambda b, sent=sent: _found(b, widths, sent, how), _FOUND_SQL)
        hits = found if hits is None else hits.unionByName(found)
    hits = written(hits, "template-hits")
    side = items.select(
        "plain", "width", "window", F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), F.col("n_tokens").alias("item_tokens")
    )
    total = items.groupBy(F.col("id").alias("item_id"), "plain").agg(F.count_distinct("at").alias("n_windows"))
    joined = hits.join(side, ["plain", "width", "window"])
    pair = F.arrays_zip(F.col("item_slots").alias("b"), F.col("slots").alias("d"))
    lined = joined.groupBy(
        F.col("id").alias("doc_id"), "item_id", "plain", "item_tokens", "width", (F.col("at") - F.col("item_at")).alias("shift")
    ).agg(F.collect_set(F.struct(F.col("item_at").alias("at"), pair.alias("pairs"))).alias("found"))  # an item's windows at most

    def consistent(found: Column) -> Column:
        """Positions of windows whose values agree along the whole alignment."""
        return let(
            F.array_distinct(F.flatten(F.transform(found, lambda w: w["pairs"]))),
            lambda all_pairs: F.array_sort(
                F.array_distinct(
                    F.transform(
                        F.filter(
                            found,
                            lambda w: F.forall(
                                w["pairs"], lambda s: F.size(F.filter(all_pairs, lambda p: p["b"] == s["b"])) == 1
                            ),
                        ),
                        lambda w: w["at"],
                    )
                )
            ),
        )

    changed = F.exists("found", lambda w: F.exists(w["pairs"], lambda s: s["b"] != s["d"]))
    runs = lined.select(
        "doc_id", "item_id", "plain", "item_tokens", "width", changed.alias("changed"), consistent(F.col("found")).alias("held")
    ).withColumn("run", _longest(F.col("held")))
    per_item = (
        runs.select("doc_id", "item_id", "plain", "item_tokens", "width", "changed", "run", F.explode("held").alias("at"))
        .groupBy("doc_id", "item_id", "plain")
        .agg(
            F.count_distinct("at").alias("matched"),
            (F.max("run") + F.first("width") - 1).cast("long").alias("run_tokens"),
            F.first("item_tokens").alias("item_tokens"),
            F.min("changed").alias("changed"),
        )
        .join(total, ["item_id", "plain"])
    )
    enough = (F.col("run_tokens") >= F.least(F.lit(how.run), F.col("item_tokens"))) | (
        100 * F.col("matched") >= how.percent * F.col("n_windows")
    )
    best = F.max(F.struct("run_tokens", "matched", "n_windows")).alias("best")
    pairs = per_item.filter(enough).groupBy("doc_id", "item_id").agg(best, F.min("changed").alias("changed"))
    return pairs.select("doc_id", "item_id", "best.matched", "best.n_windows", "best.run_tokens", "changed")


def clean(docs: DataFrame, benchmark: DataFrame, how: Templates = Templates()) -> DataFrame:
    """``docs`` without the contaminated ones, otherwise unchanged."""
    found = written(contaminated(docs, benchmark, how).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
