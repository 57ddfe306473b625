import pytest
from pyspark.sql import functions as F

from sluice.llm import mixing


@pytest.mark.parametrize("share", [0.3, 0.4, 0.6])
def test_sources_of_long_documents_come_near_their_targets(spark, share):
    rows = [(k, " ".join(["w"] * (1280 + 16 * (k % 7))), s) for k, s in enumerate(["a"] * 40 + ["b"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs, block_words=64, weights=(1,), share=share).groupBy("source").agg(F.sum(mixing.word_count()).alias("n"))
    words = {r.source: r.n for r in got.collect()}
    for s in "ab":
        target = share * sum(len(t.split()) for _, t, own in rows if own == s)
        assert abs(words.get(s, 0) - target) <= 0.05 * target


def test_rows_without_an_id_and_with_one_id_are_drawn(spark):
    rows = [(None, f"w {'x ' * (k % 3)}", "a") for k in range(6)] + [(1, "one two", "a"), (1, "two one", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs, weights=(1,), share=2.0)  # twice each, the most there may be
    assert sorted(map(str, got.collect())) == sorted(2 * list(map(str, docs.collect())))
