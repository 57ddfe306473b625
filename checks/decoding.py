"""Decoder checks. The messages are made from table columns, so the oracle reads the columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, table
from sluice import TableSchema, decode_json


def _schema(name: str, **types: str) -> TableSchema:
    return TableSchema.from_json({"table": name, "fields": [{"name": n, "type": t} for n, t in types.items()]})


_TYPED = _schema("typed", event_id="LONG", user="INT", value="DOUBLE", ratio="FLOAT", kind="STRING", busy="BOOLEAN", day="DATE", ts="TIMESTAMP", price="DECIMAL", absent="STRING")


@check(
    "SELECT event_id, CAST(user_id AS INTEGER) AS \"user\", value, CAST(value AS FLOAT) AS ratio, event_type AS kind, value > 100 AS busy, "
    "CAST(ts AS DATE) AS day, ts, CAST(value AS DECIMAL(10, 2)) AS price, CAST(NULL AS VARCHAR) AS absent FROM events"
)
def decode_json_types(spark, sf):
    message = F.struct(
        "event_id",
        F.col("user_id").alias("user"),
        "value",
        F.col("value").alias("ratio"),
        F.col("event_type").alias("kind"),
        (F.col("value") > 100).alias("busy"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        F.col("value").cast("decimal(10,2)").alias("price"),
        F.lit("not declared").alias("surplus"),
    )
    return decode_json(table(spark, sf, "events").select(F.to_json(message).alias("value")), _TYPED)


_COERCED = _schema("coerced", event_id="LONG", whole="INT", cut="LONG", wide="LONG", word="INT", flag_number="INT", number_text="DOUBLE", word_number="DOUBLE", odd="BOOLEAN", yes="BOOLEAN", part="BOOLEAN", label="STRING", nested="STRING", none="DOUBLE")


@check(
    "SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole, CAST(trunc(value) AS BIGINT) AS cut, 9007199254740993 + event_id AS wide, "
    "0 AS word, CASE WHEN value > 100 THEN 1 ELSE 0 END AS flag_number, value AS number_text, 0.0::DOUBLE AS word_number, "
    "user_id % 2 <> 0 AS odd, value > 100 AS yes, false AS part, CAST(user_id AS VARCHAR) AS label, "
    "'{\"k\":' || CAST(user_id AS VARCHAR) || '}' AS nested, CAST(NULL AS DOUBLE) AS none FROM events"
)
def decode_json_coerce(spark, sf):
    value, user = F.col("value"), F.col("user_id")
    message = F.struct(
        "event_id",
        value.cast("string").alias("whole"),
        value.alias("cut"),
        (F.lit(9007199254740993) + F.col("event_id")).alias("wide"),
        F.col("event_type").alias("word"),
        (value > 100).alias("flag_number"),
        value.cast("string").alias("number_text"),
        F.col("event_type").alias("word_number"),
        (user % 2).alias("odd"),
        (value > 100).alias("yes"),
        F.lit(1.5).alias("part"),
        user.alias("label"),
        F.struct(user.alias("k")).alias("nested"),
        F.lit(None).cast("string").alias("none"),
    )
    text = F.to_json(message, {"ignoreNullFields": "false"})
    return decode_json(table(spark, sf, "events").select(text.alias("value")), _COERCED)


_PLAIN = _schema("plain", event_id="LONG", kind="STRING")


def _damaged(spark, sf):
    """Every third message is cut short, every fifth is an array, every seventh is empty."""
    n = F.col("event_id")
    good = F.to_json(F.struct("event_id", F.col("event_type").alias("kind")))
    text = (
        F.when(n % 3 == 0, F.concat(F.lit('{"event_id":'), n.cast("string")))
        .when(n % 5 == 0, F.concat(F.lit("["), good, F.lit("]")))
        .when(n % 7 == 0, F.lit(""))
        .otherwise(good)
    )
    return table(spark, sf, "events").select(text.alias("value"))


@check("SELECT event_id, event_type AS kind FROM events WHERE event_id % 3 <> 0 AND event_id % 5 <> 0 AND event_id % 7 <> 0")
def decode_json_drop_bad(spark, sf):
    return decode_json(_damaged(spark, sf), _PLAIN, "drop")


@check(
    "SELECT CASE WHEN event_id % 3 = 0 THEN 'cut' WHEN event_id % 5 = 0 THEN 'array' WHEN event_id % 7 = 0 THEN 'empty' ELSE 'good' END AS state, "
    "count(*) AS n FROM events GROUP BY 1"
)
def decode_json_quarantine(spark, sf):
    bad = F.col("_bad_record")
    state = F.when(bad.isNull(), "good").when(bad == "", "empty").when(bad.startswith("["), "array").otherwise("cut")
    return decode_json(_damaged(spark, sf), _PLAIN, "keep").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
