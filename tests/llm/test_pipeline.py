import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clashes import unharmed
from sluice.llm import decontaminate, minhash, mixing, quality
from sluice.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_on_another(spark, given):
    from test_minhash import brute

    docs, kept = given, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "stage-test")
        kept[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == given.columns
    before, after = kept["quality rules"]
    good = {r.doc_id for r in quality.judged(before, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()}
    assert {r.doc_id for r in after.collect()} == good and 0 < len(good) < before.count()
    before, after = kept["near-duplicates"]
    groups, _ = brute([(r.doc_id, r.text) for r in before.collect()], minhash.MinHash().words)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, g in groups.items() if i == g)
    before, after = kept["decontamination"]
    leaks = {r.doc_id for r in decontaminate.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect() if r.doc_id not in leaks)
    before, after = kept["mixing"]
    words = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(mixing.word_count()).alias("n")).collect()}
    assert sum(words(after).values()) > 1.3 * sum(words(before).values())
    before, after = kept["sharding"]
    assert after.count() == before.count() and {*before.columns, "shard"} <= {*after.columns}


def test_run_and_registration(spark, given, monkeypatch):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "decontamination", "mixing", "sharding"]
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_take_empty_and_odd_tables(spark, given, odd, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage-test")
    assert docs.count() == 0 and {*given.columns, "shard"} <= {*docs.columns}
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "stage-test")
        if name == "sharding":
            assert docs.count() == before.count() and unharmed(docs, "shard", "depth")
        else:
            assert docs.columns == odd.columns and unharmed(docs)
            assert docs.exceptAll(before).isEmpty() or name == "mixing"
        if name == "quality rules":
            # Null, empty and short texts go; of the rows that are equal, both stay.
            assert docs.filter("text IS NULL OR length(text) < 20").isEmpty() and docs.filter("doc_id = 10001").count() == 2
        if name == "near-duplicates":
            assert docs.filter("doc_id = 10001").count() == 1 and docs.filter("doc_id = 10002").isEmpty()
