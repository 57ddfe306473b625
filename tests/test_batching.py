"""Model batches that fill up over micro-batches, and how many calls run at once."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from sluice import InferenceSpec, TableSchema, infer
from sluice.operators import inference
from sluice.operators.inference import http_scorer, with_retry
from sluice.streaming.processors import STORE

OUT = TableSchema.from_json({"table": "s", "fields": [{"name": "size", "type": "LONG"}, {"name": "key", "type": "LONG"}]})
ONCE = {"availableNow": True}


def spec(**rest):
    values = {"function_id": "f", "function_type": "http", "input_fields": ("id",), "output_fields": ("size", "key")}
    return InferenceSpec(**{**values, **rest})


@pytest.fixture
def store(spark):
    no_data = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(*STORE)
    spark.conf.set(no_data, "false")
    yield
    spark.conf.unset(STORE[0])
    spark.conf.unset(no_data)


def sizes():
    """A factory that travels by value, since workers cannot import the tests."""
    return lambda _spec: lambda batch: [{"size": len(batch), "key": None if batch["id"].isna().any() else min(batch["id"])}] * len(batch)


def micro_batches(spark, tmp_path, files):
    """A file, and so a micro-batch, per list of ids; ids are too large for a double."""
    for n, ids in files.items():
        rows = spark.createDataFrame([(2**60 + i if i is not None else None, f"t{i}") for i in ids], "id long, text string")
        rows.select("id", "text", F.lit(None).cast("timestamp").alias("_at"), F.lit("1.50").cast("decimal(9,2)").alias("d")).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        time.sleep(0.01)


def run(spark, tmp_path, made):
    stream = spark.readStream.schema("id long, text string, _at timestamp, d decimal(9,2)").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = infer(stream, made, sizes(), OUT).writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query = out.option("checkpointLocation", f"{tmp_path}/ck").trigger(**ONCE).start()
    assert query.awaitTermination(60)
    return query


def test_batches_fill_up_over_micro_batches_and_a_restart(spark, tmp_path, store):
    made = spec(batch_size=4, max_wait_ms=3_600_000, extra_config={"carry": True})
    micro_batches(spark, tmp_path, {f"a{i}": [i] for i in range(6)})
    run(spark, tmp_path, made)
    first = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.id - 2**60, r.size, r.key - 2**60) for r in sorted(first)] == [(i, 4, 0) for i in range(4)]
    assert {(r.text, r._at, str(r.d)) for r in first} == {(f"t{i}", None, "1.50") for i in range(4)}
    micro_batches(spark, tmp_path, {f"b{i}": [i] for i in range(6, 9)})
    run(spark, tmp_path, made)
    # the two rows that waited come first, none is scored twice, and the ninth waits
    both = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.id - 2**60, r.size) for r in both) == [(i, 4) for i in range(8)]


def test_what_waited_long_enough_goes_short(spark, tmp_path, store):
    made = spec(batch_size=4, max_wait_ms=1, extra_config={"carry": True})
    micro_batches(spark, tmp_path, {"a": [0, 1, None], "b": [3]})
    run(spark, tmp_path, made)
    time.sleep(0.1)
    micro_batches(spark, tmp_path, {"c": [4]})
    run(spark, tmp_path, made)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {r.text for r in got} >= {"t0", "t1", "tNone", "t3"} and len(got) == len({r.text for r in got})


def test_lanes_share_the_rows(spark, tmp_path, store):
    made = spec(batch_size=5, max_wait_ms=3_600_000, extra_config={"carry": True, "lanes": 2})
    micro_batches(spark, tmp_path, {"a": [7] * 23})
    query = run(spark, tmp_path, made)
    (full,) = spark.read.parquet(f"{tmp_path}/out").groupBy("size").count().collect()
    assert full["size"] == 5 and full["count"] in (15, 20)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] > 0


def test_no_task_has_all_rows_of_a_lane(spark, tmp_path, store):
    """Full batches of a file are spread over tasks in blocks; what is left of it, and of the next one, fills up in the lane."""

    def where(_spec):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        return lambda batch: [{"size": len(batch), "key": task}] * len(batch)

    made = spec(batch_size=7, max_wait_ms=3_600_000, extra_config={"carry": True})
    for n, rows in {"a": 40_000, "b": 3, "c": 7}.items():
        spark.range(rows).selectExpr("IF(id % 5 = 0, NULL, id + (1L << 60)) AS id", f"'{n}' || id AS text", "CURRENT_TIMESTAMP() AS _at", "1.5BD AS d").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        time.sleep(0.01)
    stream = spark.readStream.schema("id long, text string, _at timestamp, d decimal(9,2)").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = infer(stream, made, where, OUT).writeStream.format("parquet").option("path", f"{tmp_path}/out")
    assert out.option("checkpointLocation", f"{tmp_path}/ck").trigger(**ONCE).start().awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(got) == 40_010 // 7 * 7 and {r.size for r in got} == {7}
    texts = {r.text: r.id for r in got}
    assert len(texts) == len(got) and all(i == (None if int(t[1:]) % 5 == 0 else int(t[1:]) + 2**60) for t, i in texts.items())
    tasks = [r.key for r in got]
    assert max(map(tasks.count, set(tasks))) < 30_000


def test_a_batch_run_carries_nothing(spark):
    df = spark.range(10).coalesce(1)
    out = infer(df, spec(batch_size=4, extra_config={"carry": True}), sizes(), OUT)
    assert {r["size"] for r in out.collect()} == {4, 2}


def test_calls_alive_are_bounded():
    """Twelve calls of one length at capacity four take three rounds, also for scorers that are passed in."""
    alive, most, lock, rounds = [0], [0], threading.Lock(), time.monotonic()
    places = inference._Places(4, 5)

    def score(batch):
        with lock:
            alive[0] += 1
            most[0] = max(most[0], alive[0])
        time.sleep(0.3)
        with lock:
            alive[0] -= 1
        return batch

    calls = [inference._Call(score, n, 5, places) for n in range(12)]
    assert [c.result() for c in calls] == list(range(12))
    assert most[0] == 4 and 0.85 < time.monotonic() - rounds < 1.8


def test_passed_in_scorers_run_side_by_side(spark):
    def slow(_spec):
        def score(batch):
            time.sleep(0.3)
            return [{"size": 1}] * len(batch)

        return score

    df = spark.range(12).coalesce(1)
    infer(df.limit(1), spec(batch_size=1), slow, OUT).collect()
    start = time.monotonic()
    assert infer(df, spec(batch_size=1, async_capacity=4), slow, OUT).filter("size = 1").count() == 12
    assert 0.85 < time.monotonic() - start < 3


def test_calls_given_up_keep_their_place(monkeypatch):
    monkeypatch.setattr(inference, "_PATIENCE", 2)
    places, go = inference._Places(1, 0.1), threading.Event()
    stuck = inference._Call(lambda b: go.wait(10), 1, 0.1, places)
    with pytest.raises(TimeoutError, match="too long"):
        stuck.result()
    with pytest.raises(TimeoutError, match="hold all places"):
        inference._Call(lambda b: b, 2, 0.1, places).result()
    go.set()
    assert inference._Call(lambda b: b, 3, 1, places).result() == 3


def test_attempts_share_one_deadline():
    times = []

    def post(url, body, timeout, headers):
        times.append(timeout)
        time.sleep(0.15)
        raise OSError("down")

    import pandas as pd

    score = http_scorer(spec(service_url="http://x.test", service_type="generic", async_timeout_ms=400), post)
    start = time.monotonic()
    with pytest.raises(OSError):
        score(pd.DataFrame({"id": [1]}))
    assert time.monotonic() - start < 0.6 and times[0] <= 0.4 and times == sorted(times, reverse=True) and len(times) == 2
    with pytest.raises(OSError):
        with_retry(lambda: post(None, None, 1, None), deadline=time.monotonic())
