import re

import pytest

from sluice.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"
QUESTION = (
    "Alice bought 12 apples and gave 5 of them to her friend Bob who paid 12 dollars for each of the apples he got in 5 days"
)


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def caught(docs, items, **options):
    return {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items, dc.Templates(**options)).collect()}


def test_passages_of_the_benchmark(spark, given):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    texts = {r.item_id: plain(r.text) for r in items.collect()}
    expected = {(r.doc_id, k) for r in given.collect() for k, t in texts.items() if t in plain(r.text)}
    assert expected and caught(given, items) == expected
    assert caught(given, items, most_broadcast=100) == expected  # in several passes
    left = dc.clean(given, items)
    assert left.columns == given.columns and left.count() == given.count() - len({d for d, _ in expected})


@pytest.mark.parametrize(
    "text, found",
    [
        (QUESTION, True),
        ("Intro here. " + QUESTION.replace("Alice", "Mary Jane").replace("12", "31").replace("5", "9").replace("Bob", "Carl") + " and more", True),
        (QUESTION.replace("12 dollars", "1,250.75 miles").replace("12 apples", "1,250.75 apples"), True),
        (QUESTION.replace("12 apples", "31 apples").replace("12 dollars", "44 dollars"), False),  # one value stands for two
        (QUESTION.lower(), True),
        (QUESTION.upper(), True),
        (" ".join(QUESTION.split()[:7]) + " nothing else of it", False),
        ("Completely other words with 12 apples and 5 days in them for Bob and Alice who paid nothing at all today", False),
    ],
)
def test_other_values_in_the_same_places(spark, given, text, found):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert bool(caught(docs, bench(spark, QUESTION, "another question altogether that is asked about nothing in particular"))) == found


def test_odd_rows(spark, odd, nothing, given):
    items = bench(spark, None, "", "12 34 56", "the same words in two rows of a table, with one id")
    got = caught(odd, items)
    assert got == {(10_001, 3), (10_002, 3)}
    left = dc.clean(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 3
    assert caught(nothing, items) == set() and caught(odd, items.limit(0)) == set()
    assert dc.clean(odd, items.limit(0)).count() == odd.count()


def test_an_item_shorter_than_a_window(spark, given):
    docs = spark.createDataFrame([(1, "so they asked: Why is the sky blue? Again"), (2, "why is the sea blue")], "doc_id long, text string")
    assert caught(docs, bench(spark, "Why is the sky blue?")) == {(1, 0)}
