import time
from datetime import datetime

import pytest
from helpers import (
    SAMPLE_MESSAGES,
    SAMPLE_SCHEMA,
    SAMPLE_STEPS,
    config_tables,
    rating_scorer,
    function_row,
    job_row,
    step_rows,
)
from pyspark.sql import functions as F

from sluice import Chain, ConfigError, TableSchema, decode_json, dedup, ensure_table, lookup_enrich, read_files, run_batch, run_job, run_reloading, run_stream, start_quarantine
from sluice.plans.job import batch_result, table_of
from sluice.sinks import ddl
from sluice.sources.messages import kafka_options
from sluice.spec import JobSpec, KafkaSpec, LakeSpec, StepSpec

ONCE = {"availableNow": True}
AT = datetime(2024, 1, 1, 10, 0, 0)


@pytest.fixture
def config(spark, tmp_path):
    return config_tables(spark, [job_row(warehouse=tmp_path / "wh")], step_rows(), [function_row()])


def put(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(messages) + "\n")


def table_rows(spark, job):
    return sorted((r.sensor_id, r.reading, r.site, r.alarm, r.severity) for r in table_of(spark, job).read().collect())


# --- config tables ----------------------------------------------------------------------------


def test_load(spark, config):
    job = config.load("sensors")
    assert [s.type for s in job.steps] == ["filter", "transform", "ai-inference"]
    assert job.steps[2].function.input_fields == ("sensor_id", "reading", "site")
    assert job.kafka == KafkaSpec("kafka.test:9092", "readings", "g", "latest")
    assert (job.parallelism, job.lake.table_properties["bucket"], job.schema.primary_keys) == (2, "4", ("sensor_id", "measured_at"))


@pytest.mark.parametrize(
    "jobs, steps, functions",
    [
        ([job_row(name="other")], step_rows(), [function_row()]),
        ([job_row(status=0)], step_rows(), [function_row()]),
        ([job_row()], step_rows(), [function_row("another")]),
        ([job_row()], step_rows(), [function_row(status=0)]),
        ([job_row()], step_rows(steps=[("ai-inference", None, None)]), [function_row()]),
        ([job_row()], step_rows(steps=[("join", None, "{}")]), [function_row()]),
        ([job_row()], step_rows(), [function_row(strategy="RETRY")]),
        ([job_row(schema={**SAMPLE_SCHEMA, "fields": [{"name": "sensor_id", "type": "BLOB"}]})], step_rows(), [function_row()]),
    ],
)
def test_load_refuses(spark, jobs, steps, functions):
    with pytest.raises(ConfigError):
        config_tables(spark, jobs, steps, functions).load("sensors")


def test_disabled_steps_are_left_out(spark):
    steps = [(*row[:-1], 0 if row[2] == 1 else 1) for row in step_rows()]
    job = config_tables(spark, [job_row()], steps, [function_row()]).load("sensors")
    assert [s.type for s in job.steps] == ["transform", "ai-inference"]


def test_function_types_without_a_scorer_fail_when_compiled(spark):
    job = config_tables(spark, [job_row()], step_rows(), [function_row(function_type="mcp")]).load("sensors")
    with pytest.raises(ConfigError):
        Chain.from_job(job)
    assert len(Chain.from_job(job, {"rate-reading": rating_scorer()}).steps) == 3


def test_kafka_options():
    base = {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "kafka.group.id": "g"}
    assert kafka_options(KafkaSpec("b:1", "t", "g")) == {**base, "startingOffsets": "latest"}
    assert kafka_options(KafkaSpec("b:1", "t", "g", "earliest"), 4) == {**base, "startingOffsets": "earliest", "minPartitions": "4"}
    assert kafka_options(KafkaSpec("b:1", "t", "g", "timestamp", 17), 1) == {**base, "startingTimestamp": "17", "startingOffsetsByTimestampStrategy": "latest"}
    assert kafka_options(KafkaSpec("b:1", "t", "g"), group="bad")["kafka.group.id"] == "g-bad"


# --- batch ------------------------------------------------------------------------------------


def test_sample_job_in_batch(spark, config, tmp_path):
    put(tmp_path / "in", "a.txt", *SAMPLE_MESSAGES)
    job = config.load("sensors")
    out = run_batch(spark, job, read_files(spark, str(tmp_path / "in")), {"rate-reading": rating_scorer()})
    assert sorted(map(tuple, out.collect())) == [
        (1, 100.0, "north", AT, False, 0.1),
        (4, 50.0, "", datetime(2024, 1, 1, 10, 0, 3), False, 0.05),
    ]


def test_replays_are_their_own_runs(spark, tmp_path):
    tables = [job_row(warehouse=tmp_path, **{"changelog-producer": "input"})]
    job = config_tables(spark, tables, step_rows(steps=SAMPLE_STEPS[:2]), [function_row()]).load("sensors")
    for message in SAMPLE_MESSAGES[:2] + SAMPLE_MESSAGES[4:]:
        out = run_batch(spark, job, spark.createDataFrame([(message,)], "value string"))
    assert sorted((r.sensor_id, r.reading) for r in out.collect()) == [(1, 100.0), (4, 50.0)]
    assert spark.read.parquet(table_of(spark, job).changelog_path).count() == 3


def test_required_fields_and_bad_records(spark, config):
    job = config.load("sensors")
    scorers = {"rate-reading": rating_scorer()}
    broken = spark.createDataFrame([("{bad",), (SAMPLE_MESSAGES[0],)], "value string")
    with pytest.raises(Exception, match="malformed"):
        batch_result(job, broken, scorers).collect()
    assert batch_result(job, broken, scorers, on_bad_record="drop").count() == 1
    nobody = spark.createDataFrame([('{"sensor_id":null,"reading":5,"measured_at":"2024-01-01T10:00:04"}',)], "value string")
    with pytest.raises(Exception, match="NOT NULL"):
        batch_result(job, nobody, scorers).collect()


def test_a_chain_takes_any_function(spark):
    chain = Chain().add(lambda df: df.filter("id > 1")).add_all([lambda df: df.withColumn("twice", F.col("id") * 2)])
    out = chain.apply(spark.range(4).withColumn("_src", F.lit(1)))
    assert out.columns == ["id", "twice"] and out.count() == 2
    assert Chain().apply(spark.range(3)).count() == 3


def test_append_without_a_key(spark, tmp_path):
    schema = {k: v for k, v in SAMPLE_SCHEMA.items() if k != "primaryKeys"} | {"partitionKeys": ["site"]}
    job = JobSpec("append", TableSchema.from_json(schema), lake=LakeSpec(str(tmp_path)))
    messages = spark.createDataFrame([(m,) for m in SAMPLE_MESSAGES], "value string")
    assert run_batch(spark, job, messages).count() == 5
    assert run_batch(spark, job, messages).count() == 10
    assert len(list((tmp_path / "default.db" / "readings_rated").glob("_run=*/_batch=0/_p_site=vNorth"))) == 2
    again = [run_batch(spark, job, messages, batch_id=1, run_id="again").count() for _ in range(2)]
    assert again == [15, 15]


def test_registered_table(spark, config, tmp_path):
    job = config.load("sensors")
    name = ensure_table(spark, job)
    table = table_of(spark, job, name)
    rows = spark.createDataFrame([(1, 5.0, "A", AT, True, 0.5)], "sensor_id bigint, reading double, site string, measured_at timestamp_ntz, alarm boolean, severity double")
    table.upsert(rows, 0)
    table.upsert(rows.withColumn("reading", F.lit(6.0)), 1)
    assert [r.reading for r in spark.table(name).collect()] == [6.0]
    assert ensure_table(spark, job) == name
    spark.sql(f"DROP TABLE {name}")


# --- streams ----------------------------------------------------------------------------------


def test_stream_restarts_without_duplicates(spark, config, tmp_path):
    source, scorers = tmp_path / "in", {"rate-reading": rating_scorer()}

    def run():
        query = run_job(
            spark, "sensors", config, str(tmp_path / "ck"), source=read_files(spark, str(source), streaming=True), scorers=scorers, trigger=ONCE
        )
        query.awaitTermination()

    before = spark.conf.get("spark.sql.shuffle.partitions")
    put(source, "a.txt", *SAMPLE_MESSAGES)
    run()
    job = config.load("sensors")
    assert table_rows(spark, job) == [(1, 100.0, "north", False, 0.1), (4, 50.0, "", False, 0.05)]
    run()
    assert len(table_rows(spark, job)) == 2
    put(source, "b.txt", '{"sensor_id":4,"reading":700,"site":"Mid","measured_at":"2024-01-01T10:00:03"}')
    run()
    assert table_rows(spark, job) == [(1, 100.0, "north", False, 0.1), (4, 700.0, "mid", True, 0.7)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_stream_equals_batch(spark, events, tmp_path):
    message = F.struct(F.col("user_id").alias("sensor_id"), F.col("value").alias("reading"), F.col("event_type").alias("site"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("measured_at"))
    events.repartition(3).select(F.to_json(message).alias("value")).write.text(str(tmp_path / "in"))
    steps = tuple(StepSpec(kind, rule) for kind, _, rule in SAMPLE_STEPS[:2])
    job = JobSpec("equal", TableSchema.from_json(SAMPLE_SCHEMA), lake=LakeSpec(str(tmp_path / "wh")), steps=steps)
    stream = read_files(spark, str(tmp_path / "in"), streaming=True, ordered=False, maxFilesPerTrigger="1")
    run_stream(spark, job, str(tmp_path / "ck"), source=stream, trigger=ONCE).awaitTermination()
    got, expected = table_of(spark, job).read(), batch_result(job, read_files(spark, str(tmp_path / "in")))
    assert got.count() == expected.count() > 900 and got.exceptAll(expected).isEmpty()


def test_append_stream(spark, tmp_path):
    put(tmp_path / "in", "a.txt", *SAMPLE_MESSAGES, "{bad")
    schema = {k: v for k, v in SAMPLE_SCHEMA.items() if k != "primaryKeys"} | {"partitionKeys": ["site"]}
    job = JobSpec("append", TableSchema.from_json(schema), lake=LakeSpec(str(tmp_path / "wh")))
    source = read_files(spark, str(tmp_path / "in"), streaming=True)
    for _ in range(2):
        run_stream(spark, job, str(tmp_path / "ck"), source=source, trigger=ONCE, on_bad_record="quarantine").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "wh/default.db/readings_rated")).count() == 5
    start_quarantine(spark, job, source, str(tmp_path / "bad"), str(tmp_path / "ck2"), ONCE).awaitTermination()
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["{bad"]


def window_job(tmp_path, **rest):
    schema = TableSchema.from_json(
        {
            "table": "sums",
            "fields": [
                {"name": "sensor_id", "type": "LONG"},
                {"name": "reading", "type": "DOUBLE"},
                {"name": "measured_at", "type": "TIMESTAMP"},
                {"name": "total", "type": "DOUBLE"},
                {"name": "n", "type": "LONG"},
                {"name": "window_start", "type": "TIMESTAMP"},
            ],
        }
    )
    rule = {"key_fields": ["sensor_id"], "aggregations": [{"output": "total", "op": "sum", "input": "reading"}, {"output": "n", "op": "count"}], **rest}
    return JobSpec("windows", schema, lake=LakeSpec(str(tmp_path / "wh")), steps=(StepSpec("aggregate", rule),))


def messages(*rows):
    return ['{"sensor_id":%d,"reading":%s,"measured_at":"2024-01-01T%s"}' % r for r in rows]


def emitted(spark, tmp_path):
    df = spark.read.parquet(str(tmp_path / "wh/default.db/sums"))
    return sorted((r.sensor_id, r.total, r.n, r.window_start and r.window_start.strftime("%H:%M:%S")) for r in df.collect())


@pytest.mark.parametrize("window", [{"sizeSeconds": 60}, {"type": "session", "gapSeconds": 30}, {"type": "sliding", "sizeSeconds": 60, "slideSeconds": 120}])
def test_measured_at_windows_drop_late_rows(spark, tmp_path, window):
    job = window_job(tmp_path, time_field="measured_at", window=window, emit_window=True, watermark="0 seconds")
    source = tmp_path / "in"

    def run(name, *rows):
        put(source, name, *messages(*rows))
        stream = read_files(spark, str(source), streaming=True, ordered=False)
        run_stream(spark, job, str(tmp_path / "ck"), source=stream, trigger=ONCE).awaitTermination()

    run("a.txt", (1, 5, "10:00:10"), (1, 6, "10:00:20"), (2, 1, "10:00:30"))
    run("b.txt", (1, 7, "10:10:00"))
    run("c.txt", (1, 99, "10:00:15"), (1, 8, "10:20:00"))
    starts = {"session": ("10:00:10", "10:00:30", "10:10:00")}.get(window.get("type"), ("10:00:00", "10:00:00", "10:10:00"))
    assert emitted(spark, tmp_path)[:3] == [(1, 7.0, 1, starts[2]), (1, 11.0, 2, starts[0]), (2, 1.0, 1, starts[1])]


def test_processing_time_windows(spark, tmp_path):
    job = window_job(tmp_path, window={"sizeSeconds": 1})
    source = tmp_path / "in"
    for i in range(3):
        put(source, f"{i}.txt", *messages((1, i + 1, "10:00:00"), (1, i + 1, "10:00:00")))
        stream = read_files(spark, str(source), streaming=True, ordered=False)
        run_stream(spark, job, str(tmp_path / "ck"), source=stream, trigger=ONCE).awaitTermination()
        time.sleep(1.1)
    # the last window stays open until another batch moves the clock
    assert emitted(spark, tmp_path)[:2] == [(1, 2.0, 2, None), (1, 4.0, 2, None)]


@pytest.mark.parametrize("keys", [["sensor_id"], []])
def test_rules_are_read_again_for_each_batch(spark, tmp_path, keys):
    state, schema = {"least": 0}, {**SAMPLE_SCHEMA, "primaryKeys": keys}

    def load(session):
        rule = '{"conditions":[{"field":"reading","op":"gt","value":%d}]}' % state["least"]
        return config_tables(session, [job_row(warehouse=tmp_path / "wh", schema=schema)], step_rows(steps=[("filter", None, rule)]), [function_row()])

    def run(name, *rows):
        put(tmp_path / "in", name, *messages(*rows))
        stream = read_files(spark, str(tmp_path / "in"), streaming=True)
        run_reloading(spark, "sensors", load, stream, str(tmp_path / "ck"), trigger=ONCE).awaitTermination()

    run("a.txt", (1, 5, "10:00:00"))
    state["least"] = 10
    run("b.txt", (2, 5, "10:00:00"), (3, 15, "10:00:00"))
    job = load(spark).load("sensors")
    table = table_of(spark, job).read() if keys else spark.read.parquet(ddl.table_path(job.lake, job.schema))
    assert sorted(r.sensor_id for r in table.collect()) == [1, 3]


def test_second_aggregation_on_a_stream(spark, tmp_path):
    schema = TableSchema.from_json(
        {
            "table": "sums",
            "fields": [
                {"name": "sensor_id", "type": "LONG"},
                {"name": "reading", "type": "DOUBLE"},
                {"name": "measured_at", "type": "TIMESTAMP"},
                {"name": "total", "type": "DOUBLE"},
                {"name": "n", "type": "LONG"},
                {"name": "window_start", "type": "TIMESTAMP"},
            ],
        }
    )
    minute = {"key_fields": ["sensor_id"], "time_field": "measured_at", "watermark": "0 seconds", "window": {"sizeSeconds": 60}, "aggregations": [{"output": "total", "op": "sum", "input": "reading"}]}
    hour = {"window": {"sizeSeconds": 3600}, "emit_window": True, "aggregations": [{"output": "total", "op": "max", "input": "total"}, {"output": "n", "op": "count"}]}
    job = JobSpec("twice", schema, lake=LakeSpec(str(tmp_path / "wh")), steps=(StepSpec("aggregate", minute), StepSpec("aggregate", hour)))
    put(tmp_path / "in", "a.txt", *messages((1, 5, "10:00:10"), (1, 6, "10:00:20"), (2, 1, "10:00:30"), (1, 2, "10:30:00")))
    for name, at in (("b.txt", "12:00:00"), ("c.txt", "14:00:00")):
        put(tmp_path / "in", name, *messages((9, 1, at)))
        stream = read_files(spark, str(tmp_path / "in"), streaming=True, ordered=False, maxFilesPerTrigger="1")
        run_stream(spark, job, str(tmp_path / "ck"), source=stream, trigger=ONCE).awaitTermination()
    df = spark.read.parquet(str(tmp_path / "wh/default.db/sums"))
    first = df.orderBy("window_start").first()
    assert (first.total, first.n, first.window_start) == (11.0, 3, AT)
    batch = Chain.from_job(job).apply(decode_json(read_files(spark, str(tmp_path / "in")), schema))
    assert batch.columns == ["total", "n", "window_start", "window_end"]
    assert (first.total, first.n) in [(r.total, r.n) for r in batch.collect()]


def test_lookup_and_dedup_on_a_stream(spark, tmp_path):
    schema = TableSchema.from_json({"table": "t", "fields": [{"name": "sensor_id", "type": "LONG"}, {"name": "reading", "type": "DOUBLE"}, {"name": "measured_at", "type": "TIMESTAMP"}]})
    put(tmp_path / "in", "a.txt", *messages((1, 5, "10:00:10"), (1, 5, "10:00:12"), (2, 1, "10:00:30")))
    stream = decode_json(read_files(spark, str(tmp_path / "in"), streaming=True, ordered=False), schema)
    names = spark.createDataFrame([(1, "one")], "sensor_id bigint, name string")
    out = lookup_enrich(dedup(stream, ["sensor_id"], "measured_at", "1 minute"), names, ["sensor_id"], ["name"])
    assert dict(out.dtypes)["measured_at"] == "timestamp_ntz"
    query = out.select("sensor_id", "name").writeStream.format("memory").queryName("looked_up").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("looked_up").collect())) == [(1, "one"), (2, None)]
