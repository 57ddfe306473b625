import pytest
from pyspark.sql import functions as F

from clashes import CLASHING
from sluice.llm.common import prepare

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 911} tail{i % 13}" for i in range(30_000))

@pytest.fixture(scope="session")
def given(spark):
    """The documents of the smallest size."""
    prepare(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark, given):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns with names the operators use."""
    rows = [
        (-5, None, None, None),
        (-4, "", "en", "b"),
        (-3, " \n\t ", "en", "b"),
        (-2, "one", "en", None),
        (-1, "one", "en", "a"),
        (10_001, "The same words in two rows of a table, with one id and another.", "en", "a"),
        (10_001, "The same words in two rows of a table, with one id and another.", "en", "a"),
        (10_002, "the SAME words in two rows of a table, with one id and another.", None, "a"),
        (None, "The same words in two rows of a table, with one id and another.", "en", "a"),
        (None, None, None, None),
        (10_003, LONG, "en", "b"),
        (10_004, LONG + " end", "en", "b"),
        (10_005, "snow ☃ naïve \U0001f600 Été\x0b\x0c\r\n x", "fr", "é"),
    ]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return made.withColumns({n: F.lit(7) for n in CLASHING})


@pytest.fixture(scope="session")
def nothing(given):
    return given.limit(0)


def by_id(df):
    """Rows by id; every id once."""
    rows = df.collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found
