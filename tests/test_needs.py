"""Fields that a job does not look at are not decoded, and nothing else changes."""

import re

import pytest
from helpers import SAMPLE_SCHEMA, plan_of
from pyspark.sql import functions as F

from sluice import Chain, JobSpec, StepSpec, TableSchema
from sluice.plans.job import rows_of
from sluice.plans.needs import needed_fields
from sluice.sources.decode import decode_json
from sluice.spec import InferenceSpec

SCHEMA = TableSchema.from_json({**SAMPLE_SCHEMA, "primaryKeys": []})
ALL = {f.name for f in SCHEMA.fields}
FUNCTION = InferenceSpec("rate", "http", ("reading",), ("alarm", "severity"))


def job(*steps):
    return JobSpec("j", SCHEMA, steps=tuple(StepSpec(kind, config if kind != "ai-inference" else None, config if kind == "ai-inference" else None) for kind, config in steps))


def where(field):
    return ("filter", {"conditions": [{"field": field, "op": "not_null"}]})


def mapped(output, op, **rest):
    return ("transform", {"mappings": [{"output": output, "op": op, **rest}]})


def summed(*keys, op="sum", **rest):
    return ("aggregate", {"keyFields": list(keys), "aggregations": [{"output": "severity", "op": op, "input": "reading"}], **rest})


@pytest.mark.parametrize(
    "steps, needed",
    [
        ([], ALL),
        ([where("site")], ALL),
        ([("ai-inference", FUNCTION)], ALL - {"alarm", "severity"}),
        ([where("alarm"), ("ai-inference", FUNCTION)], ALL - {"severity"}),
        ([mapped("site", "literal", value="x")], ALL - {"site"}),
        ([mapped("site", "concat", inputs=["alarm", "site"])], ALL),
        ([mapped("site", "if_else", condition={"field": "reading", "op": "gt", "value": 1}, then_value="a")], ALL - {"site"}),
        ([summed("site", timeField="measured_at")], {"site", "reading", "measured_at"}),
        ([where("alarm"), summed()], {"alarm", "reading"}),
        ([mapped("reading", "expr", expression="severity * 2"), summed()], ALL),
        ([mapped("extra", "upper", input="site"), summed("extra")], {"site", "reading"}),
        ([("ai-inference", FUNCTION), summed("alarm")], {"reading"}),
    ],
)
def test_needed_fields(steps, needed):
    assert needed_fields(job(*steps)) == needed


MESSAGES = [
    '{"sensor_id":1,"reading":1.5,"site":"a","measured_at":"2024-01-01T10:00:00","alarm":true,"severity":3}',
    '{"sensor_id":1,"reading":"2","site":{"x":[1]},"measured_at":"2024-01-01T10:00:20","alarm":0}',
    '{"sensor_id":2,"site":"a","measured_at":"2024-01-01T10:02:00","other":[1,2]}',
]
BROKEN = ['{"sensor_id":1,"reading":1.5,"site":"a"', '{"site":tru}', '{"site":"a" "reading":1}', "[]", ""]


@pytest.fixture
def messages(spark, tmp_path):
    # read from a file, so that the optimizer cannot see through to the literals
    spark.createDataFrame([(m,) for m in MESSAGES], "value string").write.text(str(tmp_path / "m"))
    return spark.read.text(str(tmp_path / "m"))


def test_less_is_parsed_and_nothing_changes(messages):
    windows = job(where("reading"), summed("site", timeField="measured_at", window={"sizeSeconds": 60}))
    pruned = rows_of(windows, messages)
    whole = Chain.from_job(windows).apply(decode_json(messages, SCHEMA))
    assert sorted(pruned.collect()) == sorted(whole.collect()) and pruned.schema == whole.schema
    parsed = [set(re.findall(r"StructField\((\w+),", p)) for p in re.findall(r"from_json\((.*?)\)\), ", plan_of(pruned))]
    assert parsed and all(p == {"site", "reading", "measured_at", "_bad_record"} for p in parsed)


def test_a_chain_of_ones_own_may_look_at_all(messages):
    own = Chain().add(lambda df: df.filter("severity = 3"))
    assert rows_of(job(summed()), messages, chain=own).count() == 1


@pytest.mark.parametrize("fields", [None, {"reading"}, set()])
def test_malformed_messages_are_found_all_the_same(spark, fields):
    df = spark.createDataFrame([(m,) for m in MESSAGES + BROKEN], "value string")
    kept = decode_json(df, SCHEMA, "keep", fields=fields)
    assert kept.filter(F.col("_bad_record").isNotNull()).count() == len(BROKEN)
    assert decode_json(df, SCHEMA, "drop", fields=fields).count() == len(MESSAGES)
    with pytest.raises(Exception, match="malformed message"):
        decode_json(df, SCHEMA, fields=fields).collect()
