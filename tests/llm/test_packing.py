import public_tokenizers
import pytest
from hypothesis import given as example
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from zlib import crc32

from sluice.llm import packing
from sluice.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "It's <|endoftext|> done<|startoftext|>, isn't it?  we'Re '",
    "café café İstanbul ΣΣ σς K ﬁ ẞ",
    "a b c\x1cd\x85e​f ☃️ \U0001f600\U0001f468‍\U0001f469",
    "x" * 5000 + " " + "1234567890" * 30,
    "", None, "\x00\x01 tab\there\r\n\x0b\x0c", "你好，世界 สวัสดี नमस्ते", "\x7f ​ ́ ﻿",
]


def library(path, end):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])


@settings(max_examples=60, deadline=None)
@example(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
def test_plan_fills_sequences(histogram):
    items, sequences = {}, {}
    for step in packing.plan(histogram, 64):
        for i in range(step.count):
            items.setdefault(step.first + i, []).append((step.start, step.length))
            sequences.setdefault(step.sequence + i, []).append((step.offset, step.length))
    lengths = [n for n in sorted(histogram, reverse=True) for _ in range(histogram[n])]
    assert sorted(items) == list(range(len(lengths)))
    assert sorted(sequences) == list(range(len(sequences)))

    def end(pieces):
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        return at

    assert all(end(pieces) == lengths[i] for i, pieces in items.items())
    fills = sorted((end(pieces) for pieces in sequences.values()), reverse=True)
    short = [n for n in fills if n < 64]
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)


def test_the_shortest_pack_comes_first():
    # 3 packs for 24 tokens: 6, 5 and 4 open one each; the 3 goes to the emptiest, then the twos
    steps = packing.plan({6: 1, 5: 1, 4: 1, 3: 1, 2: 3}, 8)
    assert [(s.length, s.sequence) for s in steps] == [(6, 0), (5, 1), (4, 2), (3, 2), (2, 1), (2, 0), (1, 1), (1, 2)]


def test_the_plan_does_not_grow_with_the_documents():
    small = {n: 1 + 4096 // n for n in range(1, 4097)}
    large = {n: c * 10**6 for n, c in small.items()}
    assert len(packing.plan(large, 4096)) < 2 * len(packing.plan(small, 4096)) < 100_000


def verify(packed, texts, encode, size):
    """Every piece against the library's ids; texts by row, whatever their id."""
    wanted = sorted((repr(i), tuple(encode(t))) for i, t in texts)
    by_doc, by_sequence = {}, {}
    for r in packed.collect():
        ids = tuple(int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4))
        assert len(ids) == r.length > 0
        by_doc.setdefault((repr(r.doc_id), r.doc_tokens), []).append((r.start, ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, pieces in by_doc.items():
        same = [ids for i, ids in wanted if (i, len(ids)) == key]
        assert sum(len(ids) for _, ids in pieces) == sum(map(len, same))
        if len(same) == 1:
            assert tuple(x for _, ids in sorted(pieces) for x in ids) == same[0]
            assert [s for s, _ in sorted(pieces)][0] == 0
    assert sum(len(ids) for _, ids in wanted) == sum(len(ids) for p in by_doc.values() for _, ids in p)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == size or at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("path, end, size", [(PATH, 2, 4096), (PATH, None, 64), (BYTES, 0, 256)])
def test_pieces_hold_the_librarys_ids(spark, given, odd, path, end, size):
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (given, odd, hard) if size != 256 else (odd, hard):
        texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        verify(packing.pack(df, path, size, end), texts, library(path, end), size)


def test_words_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    words, encode = packing.Words(PATH), library(PATH, None)
    for i in range(40):
        text = f"word{i} word{i // 2} again word{i - 1}"
        assert list(memoryview(words.ids([text.encode()])[0]).cast("H")) == encode(text)
        assert len(words.young) <= 10 and len(words.old) <= 10


def test_query_gives_checksums(spark):
    encode, sf = library(PATH, 2), "/root/testdata/sf0.001"
    texts = {r.doc_id: encode(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op13_packing"](spark, sf).collect():
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == crc32(b"".join(x.to_bytes(4, "little") for x in ids)) and r.doc_tokens == len(texts[r.doc_id])


def test_empty_table(nothing):
    assert packing.pack(nothing, PATH).count() == 0
    assert packing.pack(nothing.withColumn("text", F.lit("")), PATH, end=None).count() == 0


def test_size_is_a_power_of_two(given):
    with pytest.raises(ValueError):
        packing.pack(given, PATH, 100)
