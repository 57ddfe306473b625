import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import token_counts as tc

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "It's <|endoftext|> done<|startoftext|>, isn't it?  we'Re '",
    "café café İstanbul ΣΣ σς K ﬁ ẞ",
    "a b c\x1cd\x85e​f ☃️ \U0001f600\U0001f468‍\U0001f469",
    "x" * 5000 + " " + "1234567890" * 30,
    "",
    None,
    "\x00\x01 tab\there\r\n\x0b\x0c",
    "你好，世界 สวัสดี नमस्ते",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_librarys(given, odd, library, spark):
    hard = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for df in (given, odd, hard):
        texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = tc.prefix_counts(df, PATH).select("doc_id", "n_bytes", tc.total_tokens(F.col("tokens")).alias("n")).collect()
        key = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(((r.doc_id, r.n_bytes, r.n) for r in got), key=key) == sorted(((i, len((t or "").encode()), library(t)) for i, t in texts), key=key)


def test_prefixes_answer_budgets_without_encoding(spark, library):
    text = " ".join(TEXTS[:3]) + "\nlast words"
    df = tc.prefix_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).cache()
    row, raw = df.first(), text.encode()
    assert len(row.ends) == len(raw.split())
    for end, n in zip(row.ends, row.tokens):
        assert n == library(raw[:end].decode())
    for budget in (0, 1, 7, 20, 10_000):
        cut = df.select(tc.bytes_within(F.col("ends"), F.col("tokens"), budget)).first()[0]
        assert library(raw[:cut].decode()) <= budget and cut in (0, *row.ends)
        assert all(library(raw[:end].decode()) > budget for end in row.ends if end > cut)
    within = df.select(tc.tokens_within(F.col("ends"), F.col("tokens"), 25), tc.over_budget(F.col("tokens"), 10)).first()
    assert within[0] == max(n for end, n in zip(row.ends, row.tokens) if end <= 25) and within[1]


def test_memory_of_words_is_bounded(monkeypatch, library):
    monkeypatch.setattr(tc, "REMEMBERED", 5)
    costs = tc.WordCosts(PATH)
    assert [costs[f"word{i}".encode()] for i in range(50)] == [library(f"word{i}") for i in range(50)]
    assert len(costs) <= 7


def test_empty_table(nothing):
    assert tc.prefix_counts(nothing, PATH).count() == 0
