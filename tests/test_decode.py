import datetime
from decimal import Decimal

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from sluice import TableSchema, decode_json


def schema(**types):
    return TableSchema.from_json({"table": "t", "fields": [{"name": n, "type": t} for n, t in types.items()]})


def decode(spark, *messages, mode="fail", **types):
    return decode_json(spark.createDataFrame([(m,) for m in messages], "value string"), schema(**types), mode)


@pytest.mark.parametrize(
    "json_value, expected",
    [
        ("12", (12, 12, 12.0, True, "12")),
        ("1.9", (1, 1, 1.9, False, "1.9")),
        ("1e3", (1000, 1000, 1000.0, False, "1e3")),
        ('"12"', (12, 12, 12.0, True, "12")),
        ('"x"', (0, 0, 0.0, False, "x")),
        ('"-7"', (-7, -7, -7.0, True, "-7")),
        ("true", (1, 1, 0.0, True, "true")),
        ("false", (0, 0, 0.0, False, "false")),
        ("0", (0, 0, 0.0, False, "0")),
        ('{"k":1}', (0, 0, 0.0, False, '{"k":1}')),
        ("null", (None, None, None, None, None)),
    ],
)
def test_coercion(spark, json_value, expected):
    message = "{" + ",".join(f'"{n}":{json_value}' for n in "ilrbs") + "}"
    row = decode(spark, message, i="INT", l="LONG", r="DOUBLE", b="BOOLEAN", s="STRING").first()
    expected_text = "1000.0" if json_value == "1e3" else expected[4]
    assert tuple(row)[:4] == expected[:4]
    assert row.s in (expected[4], expected_text)


def test_long_values_keep_their_digits(spark):
    row = decode(spark, '{"l":9007199254740993}', l="LONG", f="FLOAT").first()
    assert row.l == 9007199254740993 and row.f is None


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("DECIMAL", "12.34", Decimal("12.34")),
        ("DATE", "2024-01-02", datetime.date(2024, 1, 2)),
        ("TIMESTAMP", "2024-01-02T10:00", datetime.datetime(2024, 1, 2, 10)),
        ("TIMESTAMP", "2024-01-02T10:00:01", datetime.datetime(2024, 1, 2, 10, 0, 1)),
        ("TIMESTAMP", "2024-01-02T10:00:01.5", datetime.datetime(2024, 1, 2, 10, 0, 1, 500000)),
        ("TIMESTAMP", "2024-01-02T10:00:01.123456", datetime.datetime(2024, 1, 2, 10, 0, 1, 123456)),
        ("TIMESTAMP", "2024-01-02T10:00:01.123456789", datetime.datetime(2024, 1, 2, 10, 0, 1, 123456)),
    ],
)
def test_strict_types(spark, kind, text, expected):
    assert decode(spark, f'{{"x":"{text}"}}', x=kind).first().x == expected


@pytest.mark.parametrize(
    "kind, text",
    [
        ("DECIMAL", "x"),
        ("DATE", "02/01/2024"),
        ("DATE", "2024-02-30"),
        ("TIMESTAMP", "2024-01-02T10:00:01Z"),
        ("TIMESTAMP", "2024-01-02 10:00:01"),
        ("TIMESTAMP", "2024-01-02"),
        ("TIMESTAMP", "2024-01-02T25:00:00"),
    ],
)
def test_strict_types_fail_on_bad_text(spark, kind, text):
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|PARSE"):
        decode(spark, f'{{"x":"{text}"}}', x=kind).collect()


BAD = ['{"a":', "", None, "[1]", "5", "null", "text"]


def test_bad_records(spark):
    with pytest.raises(Exception, match="malformed message"):
        decode(spark, '{"a":1}', "{bad", a="INT").count()
    assert [r.a for r in decode(spark, '{"a":1}', *BAD, mode="drop", a="INT").collect()] == [1]
    kept = decode(spark, '{"a":1}', *BAD, mode="keep", a="INT")
    assert kept.filter(F.col("_bad_record").isNotNull()).count() == len(BAD)
    with pytest.raises(ValueError):
        decode(spark, "{}", mode="skip", a="INT")


def test_extra_keys_missing_keys_and_field_order(spark):
    out = decode(spark, '{"z":1,"b":2}', a="STRING", b="INT")
    assert out.columns == ["a", "b"] and tuple(out.first()) == (None, 2)


def test_field_names_with_dots(spark):
    out = decode(spark, '{"a.b":2}', **{"a.b": "INT"})
    assert out.first()[0] == 2


def test_binary_values_and_kept_columns(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'), 7)], "value binary, _src bigint")
    assert tuple(decode_json(df, schema(a="INT")).first()) == (1, 7)


def test_each_message_is_parsed_once(spark):
    # written and read back, so that the optimizer cannot see through to the literals
    df = spark.range(3).select(F.to_json(F.struct("id", F.lit("x").alias("s"))).alias("value"))
    out = decode_json(df, schema(id="LONG", s="STRING")).filter("id > 1").select(F.upper("s"))
    assert plan_of(out).count("from_json(") == 1
