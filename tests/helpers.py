"""Shared fixtures of the tests: the sample job's schema, steps and config tables."""

import json

import pandas as pd

SAMPLE_SCHEMA = {
    "table": "readings_rated",
    "fields": [
        {"name": "sensor_id", "type": "LONG", "nullable": False},
        {"name": "reading", "type": "DOUBLE"},
        {"name": "site", "type": "STRING"},
        {"name": "measured_at", "type": "TIMESTAMP"},
        {"name": "alarm", "type": "BOOLEAN"},
        {"name": "severity", "type": "DOUBLE"},
    ],
    "primaryKeys": ["sensor_id", "measured_at"],
}
SAMPLE_STEPS = [
    ("filter", None, '{"conditions":[{"field":"reading","op":"gte","value":0.5}]}'),
    ("transform", None, '{"mappings":[{"output":"site","input":"site","op":"lower"}]}'),
    ("ai-inference", "rate-reading", None),
]
# The columns of the config tables, an interface that jobs share.
JOB_COLUMNS = "job_name string, parallelism int, kafka_config string, paimon_config string, schema_config string, status int"
STEP_COLUMNS = "id bigint, job_name string, step_order int, processor_type string, function_id string, processor_config string, status int"
FUNCTION_COLUMNS = (
    "function_id string, function_name string, function_type string, service_url string, service_type string, model_name string, "
    "input_fields string, output_fields string, batch_size int, max_wait_ms int, async_capacity int, failure_strategy string, "
    "extra_config string, status int"
)


def job_row(name="sensors", warehouse="/warehouse", status=1, parallelism=2, schema=SAMPLE_SCHEMA, **properties):
    kafka = {"bootstrapServers": "kafka.test:9092", "topic": "readings", "groupId": "g", "startupMode": "LATEST"}
    lake = {"warehouse": str(warehouse), "database": "plant", "tableProperties": {"bucket": "4", **properties}}
    return (name, parallelism, json.dumps(kafka), json.dumps(lake), json.dumps(schema), status)


def step_rows(name="sensors", steps=SAMPLE_STEPS):
    """Stored out of order on purpose."""
    rows = [(i, name, i, kind, function, config, 1) for i, (kind, function, config) in enumerate(steps, 1)]
    return rows[::-1]


def function_row(function_id="rate-reading", status=1, function_type="http", strategy="PASS_THROUGH", extra=None):
    return (
        function_id, "rating", function_type, "http://rater.test/rate", "triton", "rater",
        '["sensor_id","reading","site"]', '["alarm","severity"]', 64, 100, 100, strategy, extra, status,
    )


def config_tables(spark, jobs, steps, functions):
    from sluice import ConfigTables

    return ConfigTables(
        spark.createDataFrame(jobs, JOB_COLUMNS),
        spark.createDataFrame(steps, STEP_COLUMNS),
        spark.createDataFrame(functions, FUNCTION_COLUMNS),
    )


def rating_scorer():
    """A factory whose scorer travels by value, since workers cannot import the tests."""

    def factory(spec):
        def score(batch):
            value = batch["reading"].astype("float64") / 1000
            return pd.DataFrame({"severity": value, "alarm": value > 0.5})

        return score

    return factory


SAMPLE_MESSAGES = [
    '{"sensor_id":1,"reading":900.0,"site":"North","measured_at":"2024-01-01T10:00:00"}',
    '{"sensor_id":1,"reading":100.0,"site":"North","measured_at":"2024-01-01T10:00:00"}',
    '{"sensor_id":2,"reading":0,"site":"East","measured_at":"2024-01-01T10:00:01"}',
    '{"sensor_id":3,"site":"East","measured_at":"2024-01-01T10:00:02"}',
    '{"sensor_id":4,"reading":"50","measured_at":"2024-01-01T10:00:03"}',
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
