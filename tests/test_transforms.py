import datetime

import pytest
from helpers import plan_of

from sluice import ConfigError, TableSchema, TransformRule, transform_rows


def apply(df, *mappings, **options):
    return transform_rows(df, TransformRule.from_json({"mappings": list(mappings)}), **options)


def one(spark, ddl, value, /, **mapping):
    df = spark.createDataFrame([(value,)], f"x {ddl}")
    return apply(df, {"output": "y", "input": "x", **mapping}).first().y


def test_mappings_read_the_input_row(spark):
    data = [
        (36.0, "N", "17", "2024-01-02T03:04:05", "0.5"),
        (9.0, None, "17", None, None),
        (None, "N", None, "2024-12-31T23:59:59", "1e2"),
    ]
    df = spark.createDataFrame(data, "celsius double, wing string, room string, at string, drift string")
    out = apply(
        df.selectExpr("celsius", "wing", "room", "cast(at as timestamp_ntz) as seen", "drift"),
        {"output": "fifths", "input": "celsius", "op": "mul", "operand": 1.8},
        {"output": "door", "inputs": ["wing", "room"], "op": "concat", "separator": "-"},
        {"output": "alert", "op": "if_else", "condition": {"field": "celsius", "op": "gt", "value": 30}, "then_value": 2, "else_value": 0},
        {"output": "month", "input": "seen", "op": "date_format", "format": "yyyy/MM"},
        {"output": "drift", "input": "drift", "op": "type_cast", "target_type": "FLOAT"},
    )
    rows = out.select("fifths", "door", "alert", "month", "drift").collect()
    assert [tuple(r) for r in rows] == [
        (64.8, "N-17", 2, "2024/01", 0.5),
        (16.2, "-17", 0, None, None),
        (None, "N-", 0, "2024/12", 100.0),
    ]


@pytest.mark.parametrize(
    "ddl, value, mapping, expected",
    [
        ("bigint", 5, {"op": "add", "operand": 1}, 6.0),
        ("string", "5.5", {"op": "sub", "operand": 1}, 4.5),
        ("double", None, {"op": "mul", "operand": 2}, None),
        ("double", 3.0, {"op": "mul"}, None),
        ("double", 3.0, {"op": "divide", "operand": 0}, None),
        ("string", "hello", {"op": "substring", "start": 1, "length": 3}, "ell"),
        ("string", "hello", {"op": "substring", "start": 3}, "lo"),
        ("string", "hello", {"op": "substring", "start": 9, "length": 2}, ""),
        ("string", "hello", {"op": "substring", "length": 2}, "he"),
        ("string", None, {"op": "substring", "start": 0}, ""),
        ("bigint", 12345, {"op": "substring", "start": 1, "length": 2}, "23"),
        ("string", None, {"op": "upper"}, ""),
        ("string", "aB", {"op": "upper"}, "AB"),
        ("string", "aB", {"op": "lower"}, "ab"),
        ("string", "\t a b \r\n", {"op": "trim"}, "a b"),
        ("string", None, {"op": "trim"}, ""),
        ("string", None, {"op": "date_format"}, None),
        ("string", "2024-01-02 10:11:12", {"op": "date_format"}, "2024-01-02"),
        ("string", "2024-1-2", {"op": "date_format"}, "2024-01-02"),
        ("string", "20240102", {"op": "date_format", "format": "yyyyMMdd"}, "20240102"),
        ("string", "soon", {"op": "date_format"}, "soon"),
        ("string", "5 Jan 2024", {"op": "date_format", "format": "d MMM yyyy"}, "5 Jan 2024"),
        ("bigint", 1704164645000, {"op": "date_format", "format": "yyyy-MM-dd HH:mm:ss"}, "2024-01-02 03:04:05"),
        ("date", datetime.date(2024, 1, 2), {"op": "date_format", "format": "yyyy/MM"}, "2024/01"),
        ("double", 1.9, {"op": "type_cast", "targetType": "INT"}, 1),
        ("string", "7", {"op": "type_cast", "targetType": "long"}, 7),
        ("double", 1.5, {"op": "type_cast"}, "1.5"),
        ("double", 1.5, {"op": "type_cast", "targetType": "BLOB"}, "1.5"),
        ("string", "yes", {"op": "type_cast", "targetType": "BOOLEAN"}, False),
        ("string", "TRUE", {"op": "type_cast", "targetType": "BOOLEAN"}, True),
        ("bigint", 1, {"op": "type_cast", "targetType": "BOOLEAN"}, False),
        ("string", None, {"op": "type_cast", "targetType": "BOOLEAN"}, None),
        ("string", "2024-01-02", {"op": "type_cast", "targetType": "DATE"}, datetime.date(2024, 1, 2)),
        ("string", "Ab1-", {"op": "mask"}, "Xxn-"),
        ("string", "a", {"op": "hash"}, "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"),
        ("bigint", 4, {"op": "expr", "expression": "x * x"}, 16),
        ("bigint", 4, {"op": "literal", "value": None}, None),
        ("bigint", 4, {"op": "literal", "value": [1, 2]}, "[1, 2]"),
    ],
)
def test_operations(spark, ddl, value, mapping, expected):
    assert one(spark, ddl, value, **mapping) == expected


def test_strict_casts_fail(spark):
    for mapping in ({"op": "type_cast", "targetType": "INT"}, {"op": "add", "operand": 1}):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(spark, "string", "1.5x", **mapping)


def test_mappings_read_the_input_row_and_the_last_write_wins(spark):
    df = spark.createDataFrame([("a", "b")], "p string, q string")
    out = apply(
        df,
        {"output": "p", "op": "rename", "input": "q"},
        {"output": "q", "op": "rename", "input": "p"},
        {"output": "r", "op": "literal", "value": 1},
        {"output": "r", "op": "upper", "input": "p"},
    )
    assert out.columns == ["p", "q", "r"] and tuple(out.first()) == ("b", "a", "A")


def test_output_schema_and_declared_types(spark):
    schema = TableSchema.from_json({"table": "t", "fields": [{"name": "b", "type": "INT"}, {"name": "a", "type": "STRING"}, {"name": "z", "type": "DATE"}]})
    df = spark.createDataFrame([("x", 1.0)], "a string, other double")
    mappings = ({"output": "b", "op": "literal", "value": 3}, {"output": "gone", "op": "literal", "value": 1})
    out = apply(df, *mappings, output_schema=schema)
    assert out.dtypes == [("b", "int"), ("a", "string"), ("z", "date")] and tuple(out.first()) == (3, "x", None)
    assert dict(apply(df, *mappings, declared=schema).dtypes) == {"a": "string", "other": "double", "b": "int", "gone": "bigint"}


@pytest.mark.parametrize(
    "mapping",
    [
        {"output": "y", "op": "reverse", "input": "x"},
        {"output": "y", "op": "upper", "input": "missing"},
        {"output": "y", "op": "upper"},
        {"output": "y", "op": "concat", "inputs": ["x", "missing"]},
        {"output": "y", "op": "concat"},
        {"output": "y", "op": "substring", "input": "x", "start": -1},
        {"output": "y", "op": "date_format", "input": "x", "format": "YYYY-ww"},
        {"output": "y", "op": "if_else"},
        {"output": "y", "op": "expr"},
    ],
)
def test_bad_mappings_fail_when_compiled(spark, mapping):
    with pytest.raises(ConfigError):
        apply(spark.createDataFrame([("a",)], "x string"), mapping)


def test_steps_collapse_and_prune(events):
    out = apply(events, {"output": "double_value", "op": "mul", "input": "value", "operand": 2})
    out = apply(out, {"output": "kind", "op": "upper", "input": "event_type"}).select("double_value", "kind")
    plan = plan_of(out)
    assert plan.count("Project") == 1 and "Python" not in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
