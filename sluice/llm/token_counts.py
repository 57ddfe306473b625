"""Exact token counts at every word end of a text, from one pass over it.

A byte-pair tokenizer never merges across white space, so the count of a prefix that ends at a word end is
the count of the prefix before plus the cost of the word: ``tokens[k] = tokens[k - 1] + cost(word k)``. The
costs come from the tokenizer itself and are remembered per word, so most words are encoded once per worker.
The stored prefix arrays answer truncation and budget questions without encoding a text again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import list_array

#: Words a worker remembers before it starts over; a bound on memory only.
REMEMBERED = 400_000
SCHEMA = "doc_id long, n_bytes long, ends array<int>, tokens array<int>"
_GAPS = np.zeros(256, bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True


class WordCosts(dict):
    """Tokens per word (bytes); missing words are encoded on demand.

    A word made of plain Latin characters is cut into the tokenizer's own pieces first, whose costs are remembered
    too: "Word", "word," and "word." share one. Any other word goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._pieces: dict[str, int] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._split = _piece_pattern(spec)
        self._specials = [t["content"] for t in spec["added_tokens"]]

    def _encoded(self, word: str) -> int:
        return len(self._tokenizer.encode(word, add_special_tokens=False).ids)

    def _cost(self, word: str) -> int:
        if self._split is None or not _PLAIN.fullmatch(word) or any(s in word for s in self._specials):
            return self._encoded(word)
        total = 0
        for piece in self._split.findall(word.lower()):
            cost = self._pieces.get(piece)
            if cost is None:
                cost = self._pieces[piece] = self._encoded(piece)
            total += cost
        return total

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        if len(self._pieces) > REMEMBERED:
            self._pieces.clear()
        cost = self._cost(word.decode("utf-8", "replace"))
        if len(word) <= 64:
            self[word] = cost
        return cost


#: Characters that neither normalisation nor lower-casing treats in a special way, and that all Unicode versions class alike.
_PLAIN = regex.compile(r"[!-~¡-ÿ]+")


def _piece_pattern(spec: dict) -> regex.Pattern | None:
    """The tokenizer's split pattern, where its normaliser and splitter are of the kind described above."""
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return None
    how, level = splits
    if not how["invert"] or how["behavior"] != "Removed" or level["use_regex"] or level["add_prefix_space"]:
        return None
    return regex.compile(how["pattern"]["Regex"])


@lru_cache(maxsize=2)
def _costs(path: str) -> WordCosts:
    return WordCosts(path)


def _counted(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    costs = _costs(path)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            sizes, ends, tokens, lengths = [], [], [], []
            for text in batch.column(1).cast(pa.large_binary()).fill_null(b""):
                raw = text.as_py()
                words = raw.split()
                tokens.append(np.cumsum(np.fromiter(map(costs.__getitem__, words), np.int32, len(words)), dtype=np.int32))
                gaps = _GAPS[np.frombuffer(raw + b" ", np.uint8)]
                ends.append((np.flatnonzero(gaps[1:] & ~gaps[:-1]) + 1).astype(np.int32))
                sizes.append(len(raw))
                lengths.append(len(words))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    list_array(np.concatenate(ends), np.array(lengths), pa.int32()),
                    list_array(np.concatenate(tokens), np.array(lengths), pa.int32()),
                ],
                names=["doc_id", "n_bytes", "ends", "tokens"],
            )


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, and for each word its ``ends`` (byte offset) and ``tokens`` up to there.

    Counts equal those of ``tokenizer`` (a file for the tokenizers library) without begin, end or other added
    tokens; special strings inside a text count as the library counts them. A null text counts as empty, an empty
    one has empty arrays, null ids and repeated rows are kept as they are, other columns are not looked at.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(lambda batches: _counted(batches, tokenizer), SCHEMA)


def total_tokens(tokens: Column) -> Column:
    """The whole text's count."""
    return F.coalesce(F.try_element_at(tokens, F.lit(-1)), F.lit(0)).cast("long")


def tokens_within(ends: Column, tokens: Column, n_bytes: Column | int) -> Column:
    """The count of the longest run of whole words inside the first ``n_bytes`` bytes."""
    words = F.size(F.filter(ends, lambda end: end <= n_bytes))
    return F.when(words > 0, F.get(tokens, words - 1)).otherwise(0)


def bytes_within(ends: Column, tokens: Column, budget: Column | int) -> Column:
    """Where to cut the text so that whole words of at most ``budget`` tokens remain."""
    words = F.size(F.filter(tokens, lambda n: n <= budget))
    return F.when(words > 0, F.get(ends, words - 1)).otherwise(0)


def over_budget(tokens: Column, budget: Column | int) -> Column:
    return total_tokens(tokens) > budget
