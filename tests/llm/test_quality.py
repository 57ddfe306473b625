import re
from collections import Counter

from pyspark.sql import functions as F

from clashes import unharmed
from sluice.llm import quality

SF = "/root/testdata/sf0.001"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_base_counts_and_verdicts(spark, given, odd):
    for df in (given, odd):
        rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)
        got = quality.judged(df, labels(spark)).collect()
        key = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert sorted(map(key, got), key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)
        assert not any(r.kept and r.base_failed for r in got)


def test_rules_tell_held_out_documents(spark, given):
    """Learned on half of the labels, held against the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = F.col("doc_id") % 2 == 0
    judged = quality.judged(docs, marks.filter(half)).join(marks.filter(~half), "doc_id").filter("NOT base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 2 and counts.get((0, True), 0) <= 0.15 * sum(n for (q, _), n in counts.items() if q == 0)


def test_a_planted_conjunction_is_found(spark):
    """Bad rows are those of two statistics together; one alone is good."""
    rows = spark.range(4000).select(
        F.array(*(F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(100)) / 100.0 for k in range(len(quality.FEATURES)))).alias("features"), "id"
    )
    bad = (F.get("features", F.lit(2)) >= 0.6) & (F.get("features", F.lit(4)) < 0.3)
    labelled = rows.select("features", bad.alias("bad"), (F.col("id") % 3 > 0).alias("grow"))
    rules = quality.Learner().learn(labelled)
    wrong = labelled.filter(quality.verdict(rules, F.col("features")) == F.col("bad")).count()
    assert wrong < 80 and {c.feature for c in rules[0]} == {2, 4}


def test_without_use_of_labels(spark, odd, nothing):
    none = labels(spark).limit(0)
    assert all(r.kept != r.base_failed for r in quality.judged(odd, none).collect())
    assert quality.judged(nothing, labels(spark)).count() == 0
    unlabelled = spark.createDataFrame([(1, None), (None, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    kept = quality.keep_good(odd, unlabelled)
    assert kept.columns == odd.columns and kept.filter("doc_id = 10001").count() == 2 and unharmed(kept)
    assert quality.keep_good(nothing, none).count() == 0
    assert str(quality.Condition(0, True, 3.0, 1)) == "n_words >= 3"
