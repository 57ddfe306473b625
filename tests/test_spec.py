import pytest

from sluice.spec import (
    AggregateRule,
    ConfigError,
    FilterRule,
    InferenceSpec,
    KafkaSpec,
    LakeSpec,
    StepSpec,
    TableSchema,
    TransformRule,
)


def test_camel_and_snake_case_mean_the_same():
    camel = TransformRule.from_json('{"mappings":[{"output":"a","op":"if_else","condition":{"field":"x","op":"gt","value":1},"thenValue":1,"elseValue":2,"targetType":"INT"}]}')
    snake = TransformRule.from_json('{"mappings":[{"output":"a","op":"if_else","condition":{"field":"x","operator":"gt","value":1},"then_value":1,"else_value":2,"target_type":"INT"}]}')
    assert camel == snake


def test_aggregate_defaults_and_keys():
    rule = AggregateRule.from_json('{"keyFields":["a"],"window":{},"aggregations":[{"output":"n","op":"count"}]}')
    assert (rule.window.kind, rule.window.size_seconds, rule.window.slide_seconds) == ("tumbling", 60, 10)
    assert rule == AggregateRule.from_json({"key_fields": ["a"], "aggregations": [{"output": "n", "op": "count"}]})
    assert AggregateRule.from_json({"window": {"type": "hopping"}}).window.kind == "tumbling"
    assert AggregateRule.from_json({"window": {"type": "SLIDING"}}).window.kind == "sliding"


@pytest.mark.parametrize(
    "build",
    [
        lambda: FilterRule.from_json('{"conditons":[]}'),
        lambda: FilterRule.from_json('{"conditions":[{"field":"a","op":"gt","val":1}]}'),
        lambda: FilterRule.from_json('{"conditions":[{"op":"gt"}]}'),
        lambda: FilterRule.from_json({"conditions": [{"field": "a", "op": "in", "values": "abc"}]}),
        lambda: AggregateRule.from_json({"keyFields": "user_id"}),
        lambda: FilterRule.from_json("[1]"),
        lambda: FilterRule.from_json("{"),
        lambda: AggregateRule.from_json({"aggregations": [{"output": "x", "op": "sum"}, {"output": "x", "op": "count"}]}),
        lambda: AggregateRule.from_json({"window": {"sizeSeconds": 0}}),
        lambda: AggregateRule.from_json({"nulls": "ignore"}),
        lambda: TableSchema.from_json({"table": "t", "fields": [{"name": "a", "type": "TEXT"}]}),
        lambda: TableSchema.from_json({"table": "t", "fields": [{"name": "a", "type": "INT"}], "primaryKeys": ["b"]}),
        lambda: TableSchema.from_json({"table": "t", "fields": [{"name": "a", "type": "INT"}, {"name": "a", "type": "INT"}]}),
        lambda: TableSchema.from_json({"table": "t", "fields": [{"name": "a", "type": "INT"}, {"name": "d", "type": "DATE"}], "primaryKeys": ["a"], "partitionKeys": ["d"]}),
        lambda: KafkaSpec.from_json({"topic": "t"}),
        lambda: KafkaSpec.from_json({"bootstrapServers": "b", "topic": "t", "startingOffset": "middle"}),
        lambda: KafkaSpec.from_json({"bootstrapServers": "b", "topic": "t", "startingOffset": "timestamp"}),
        lambda: LakeSpec.from_json({"database": "d"}),
        lambda: StepSpec("join"),
        lambda: InferenceSpec.from_row({"function_id": "f", "function_type": "http", "failure_strategy": "RETRY"}),
        lambda: InferenceSpec.from_row({"function_id": "f", "function_type": None}),
    ],
)
def test_bad_config_is_refused(build):
    with pytest.raises(ConfigError):
        build()


def test_schema_document():
    schema = TableSchema.from_json(
        {"table": "t", "fields": [{"name": "a", "type": "DECIMAL", "precision": 12, "scale": 3}, {"name": "b", "type": "DECIMAL"}, {"name": "c", "type": "INT", "nullable": False}], "primaryKeys": ["a"]}
    )
    assert [(f.precision, f.scale) for f in schema.fields] == [(12, 3), (10, 2), (10, 2)]
    assert [schema.required(f) for f in schema.fields] == [True, False, True]


def test_function_row_defaults():
    spec = InferenceSpec.from_row(
        {"function_id": "f", "function_type": "http", "input_fields": '["a","b"]', "output_fields": "[]", "extra_config": '{"asyncTimeoutMs":250,"headers":{"X-Key":1}}'}
    )
    assert (spec.batch_size, spec.max_wait_ms, spec.async_capacity, spec.failure_strategy) == (64, 100, 100, "PASS_THROUGH")
    assert spec.input_fields == ("a", "b") and spec.async_timeout_ms == 250 and spec.headers == {"X-Key": "1"}


def test_kafka_aliases_and_lake_defaults():
    assert KafkaSpec.from_json({"bootstrapServers": "b", "topic": "t", "startupMode": "EARLIEST"}).starting_offset == "earliest"
    assert KafkaSpec.from_json({"bootstrap_servers": "b", "topic": "t"}).starting_offset == "latest"
    lake = LakeSpec.from_json({"warehouse": "/w", "tableProperties": {"bucket": 8, "x": "y"}})
    assert (lake.catalog_name, lake.database, lake.table_properties) == ("paimon_catalog", "default", {"bucket": "8", "x": "y"})
