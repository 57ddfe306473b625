import json
import time
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice import ConfigError, InferenceSpec, TableSchema, build_requests, infer, parse_responses, register_scorer
from sluice.operators import payloads
from sluice.operators.inference import http_scorer, scorer_factory, with_retry

SCORED = TableSchema.from_json({"table": "s", "fields": [{"name": "score", "type": "DOUBLE"}, {"name": "rank", "type": "LONG"}]})


def spec(**rest):
    values = {"function_id": "f", "function_type": "http", "input_fields": ("a", "b"), "output_fields": ("score",)}
    return InferenceSpec(**{**values, **rest})


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 200, 1, 2).select(F.col("id").alias("a"), (F.col("id") / 2).alias("b"), F.lit("keep").alias("note"))


def scorer_of(function):
    return lambda _spec: function


def test_batches_fill_up_within_a_partition(rows):
    out = infer(rows, spec(batch_size=64), scorer_of(lambda p: [{"score": len(p)}] * len(p)), SCORED)
    sizes = {r.score: r.n for r in out.groupBy("score").agg(F.count("*").alias("n")).collect()}
    # two partitions of 100 rows: 64 and 36 each
    assert sizes == {64.0: 128, 36.0: 72}


def test_small_arrow_batches_are_joined(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        out = infer(rows, spec(batch_size=64), scorer_of(lambda p: [{"score": len(p)}] * len(p)), SCORED)
        assert {r.score for r in out.select("score").distinct().collect()} == {64.0, 36.0}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_input_fields_reach_the_scorer(rows):
    out = infer(rows, spec(), scorer_of(lambda p: [{"score": len(p.columns)}] * len(p)), SCORED)
    assert out.columns == ["a", "b", "note", "score"] and out.select("score").distinct().collect() == [(2.0,)]


def test_short_results_leave_nulls_and_surplus_is_ignored(rows):
    few = infer(rows, spec(batch_size=50), scorer_of(lambda p: [{"score": 1}] * 10), SCORED)
    assert (few.count(), few.filter("score is not null").count()) == (200, 40)
    many = infer(rows, spec(batch_size=50), scorer_of(lambda p: pd.DataFrame({"score": [1.0] * 99})), SCORED)
    assert (many.count(), many.filter("score = 1").count()) == (200, 200)


def failing():
    def score(batch):
        if (batch["a"] == 10).any():
            raise ValueError("down")
        return [{"score": 1.0}] * len(batch)

    return scorer_of(score)


def test_failure_strategies(rows):
    kept = infer(rows, spec(batch_size=20, failure_strategy="PASS_THROUGH"), failing(), SCORED)
    assert (kept.count(), kept.filter("score is null").count()) == (200, 20)
    skipped = infer(rows, spec(batch_size=20, failure_strategy="SKIP"), failing(), SCORED)
    assert skipped.count() == 180 and skipped.filter("a = 10").count() == 0 and skipped.filter("a = 20").count() == 1
    with pytest.raises(Exception, match="batch of 20 rows failed"):
        infer(rows, spec(batch_size=20, failure_strategy="FAIL"), failing(), SCORED).count()


def test_values_are_read_as_the_declared_type(rows):
    out = infer(rows, spec(output_fields=("score", "rank")), scorer_of(lambda p: [{"score": "1.5", "rank": "7"}] * len(p)), SCORED)
    assert tuple(out.select("score", "rank").first()) == (1.5, 7)
    bad = infer(rows, spec(output_fields=("rank",)), scorer_of(lambda p: [{"rank": "seven"}] * len(p)), SCORED)
    assert bad.filter("rank is null").count() == 200


def test_whole_numbers_stay_exact_beside_nulls(spark):
    df = spark.createDataFrame([(9007199254740993, 1.0), (None, 2.0)], "a bigint, b double").coalesce(1)
    out = infer(df, spec(output_fields=("a",)), scorer_of(lambda p: pd.DataFrame({"a": p["a"]})))
    assert [r.a for r in out.collect()] == [9007199254740993, None]


def test_registered_scorers_overlap_their_calls(spark):
    def factory(_spec):
        def score(batch):
            time.sleep(0.2)
            return [{"score": float(v)} for v in batch["a"]]

        return score

    register_scorer("Sleepy", factory)
    df = spark.range(0, 20, 1, 1).select(F.col("id").alias("a"), F.lit(0.0).alias("b"))
    start = time.time()
    out = infer(df, spec(function_type="sleepy", batch_size=1, async_capacity=20), declared=SCORED)
    assert [r.score for r in out.orderBy("a").collect()] == [float(i) for i in range(20)]
    assert time.time() - start < 0.2 * 20


def test_calls_that_overrun_count_as_failures(spark):
    def factory(_spec):
        def score(batch):
            time.sleep(1.0 if batch["a"].iloc[0] == 2 else 0.0)
            return [{"score": 1.0}]

        return score

    register_scorer("stuck", factory)
    df = spark.range(0, 4, 1, 1).select(F.col("id").alias("a"), F.lit(0.0).alias("b"))
    out = infer(df, spec(function_type="stuck", batch_size=1, async_capacity=4, async_timeout_ms=300), declared=SCORED)
    assert {r.a: r.score for r in out.collect()} == {0: 1.0, 1: 1.0, 2: None, 3: 1.0}


def test_bad_functions_fail_when_compiled(rows):
    with pytest.raises(ConfigError):
        infer(rows, spec(input_fields=("missing",)), failing())
    with pytest.raises(ConfigError):
        scorer_factory(spec(function_type="grpc"))
    with pytest.raises(ConfigError):
        http_scorer(spec())


def test_retry_waits():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("refused")
        return "ok"

    assert with_retry(call, sleep=waits.append) == "ok" and waits == [0.1, 0.2, 0.4]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(lambda: (_ for _ in ()).throw(OSError()), sleep=waits.append)


BATCH = pd.DataFrame({"a": pd.array([1, 3], dtype="Int64"), "b": [2.0, None]})


@pytest.mark.parametrize(
    "service_type, request_doc, answer, expected",
    [
        (
            "triton",
            {"inputs": [{"name": "input", "shape": [2, 2], "datatype": "FP32", "data": [1.0, 2.0, 3.0, 0.0]}]},
            {"outputs": [{"data": [0.5, 1.0, 0.25]}]},
            [{"score": 0.5, "rank": 1.0}, {"score": 0.25}],
        ),
        ("triton", None, {}, [{}, {}]),
        ("torchserve", {"instances": [{"a": 1, "b": 2.0}, {"a": 3, "b": None}]}, {"predictions": [{"score": 1, "x": 2}]}, [{"score": 1, "rank": None}]),
        ("torchserve", None, [{"rank": 2}], [{"score": None, "rank": 2}]),
        (None, {"model": "m", "inputs": [{"a": 1, "b": 2.0}, {"a": 3, "b": None}]}, {"results": [{"score": 1, "rank": 3}]}, [{"score": 1, "rank": 3}]),
        ("other", {"model": "m", "inputs": [{"a": 1, "b": 2.0}, {"a": 3, "b": None}]}, {"none": []}, []),
    ],
)
def test_http_payloads(service_type, request_doc, answer, expected):
    sent = []

    def post(url, body, timeout, headers):
        sent.append((url, json.loads(body), timeout, headers))
        return json.dumps(answer)

    s = spec(service_type=service_type, service_url="http://m", model_name="m", output_fields=("score", "rank"), extra_config={"headers": {"K": "v"}})
    assert http_scorer(s, post)(BATCH) == expected
    if request_doc is not None:
        assert sent == [("http://m", request_doc, 5.0, {"K": "v"})]


@pytest.mark.parametrize("service_type", ["triton", "torchserve", None])
def test_spark_requests_equal_the_single_batch_ones(spark, service_type):
    s = spec(service_type=service_type, model_name="m")
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a bigint, b double")
    made = build_requests(df, s, ["a"], buckets=1).first()
    assert json.loads(made.request) == json.loads(payloads.encode_batch(BATCH, s))
    assert [r.a for r in made.rows] == [1, 3]


def test_spark_requests_are_cut_and_numbered(rows):
    made = build_requests(rows, spec(batch_size=32), ["a"], buckets=3).select("bucket", "batch_no", F.size("rows").alias("n")).collect()
    assert sum(r.n for r in made) == 200 and max(r.n for r in made) == 32
    for bucket in range(3):
        numbers = sorted(r.batch_no for r in made if r.bucket == bucket)
        assert numbers == list(range(len(numbers)))


def test_copies_are_spread_and_kept_whole(spark):
    df = spark.range(20000).select(F.lit(7).cast("bigint").alias("a"), F.lit(1.0).alias("b")).union(spark.range(50).select("id", F.lit(None).cast("double")))
    made = build_requests(df, spec(batch_size=64), ["a"], buckets=8)
    back = made.select(F.explode("rows").alias("r")).select("r.a", "r.b")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    sizes = made.groupBy("bucket").agg(F.sum(F.size("rows")).alias("n"), F.max(F.size("rows")).alias("high"), F.count("*").alias("batches")).collect()
    assert max(r.n for r in sizes) <= 2 * 4096 + 50 and max(r.high for r in sizes) == 64
    assert all(r.batches == -(-r.n // 64) for r in sizes)


@pytest.mark.parametrize(
    "service_type, response, expected",
    [
        ("torchserve", '{"predictions":[{"score":"0.5","rank":1}]}', [(1, 0.5, 1), (3, None, None)]),
        ("torchserve", '[{"score":0.5},{"score":0.7,"rank":2},{"score":9}]', [(1, 0.5, None), (3, 0.7, 2)]),
        (None, '{"results":[{"rank":4},{}]}', [(1, None, 4), (3, None, None)]),
        ("triton", '{"outputs":[{"data":[0.5,1,0.7]}]}', [(1, 0.5, 1), (3, 0.7, None)]),
        ("triton", "{}", [(1, None, None), (3, None, None)]),
        (None, None, [(1, None, None), (3, None, None)]),
    ],
)
def test_responses(spark, service_type, response, expected):
    s = spec(service_type=service_type, output_fields=("score", "rank"))
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a bigint, b double")
    batches = build_requests(df, s, ["a"], buckets=1).withColumn("response", F.lit(response).cast("string"))
    out = parse_responses(batches, s, SCORED).orderBy("a").select("a", "score", "rank")
    assert [tuple(r) for r in out.collect()] == expected


def test_triton_inputs_must_be_numeric(rows):
    with pytest.raises(ConfigError):
        build_requests(rows, spec(service_type="triton", input_fields=("note",)), ["a"])


@pytest.mark.parametrize("capacity", [1, 2])
def test_a_slow_call_holds_up_no_other(spark, capacity):
    def factory(spec):
        import time

        def score(batch):
            if batch["a"].iloc[0] in (0, 2):
                time.sleep(3)
            return [{"out": float(v)} for v in batch["a"]]

        return score

    df = spark.range(12).select(F.col("id").alias("a")).coalesce(1)
    made = spec(input_fields=("a",), output_fields=("out",), batch_size=1, async_capacity=capacity, async_timeout_ms=400)
    if capacity == 1:
        out = infer(df, made, factory)
    else:
        register_scorer("sleepy", factory)
        out = infer(df, replace(made, function_type="sleepy"), None)
    assert [r.a for r in out.filter("out IS NULL").orderBy("a").collect()] == [0, 2]
