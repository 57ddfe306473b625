"""Field mapping checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import SPARSE, check, sparse_events, table
from sluice import TableSchema, TransformRule, transform_rows


def _apply(df, *mappings: dict, **options):
    return transform_rows(df, TransformRule.from_json({"mappings": list(mappings)}), **options)


def _m(output: str, op: str, **rest) -> dict:
    return {"output": output, "op": op, **rest}


@check(
    f"SELECT event_id, value + 1.5 AS plus, value - 1.5 AS minus, value * 2 AS twice, value / 7.3::DOUBLE AS part, "
    f"CAST(user_id AS DOUBLE) + 1 AS next_user FROM {SPARSE} e"
)
def tf_arith(spark, sf):
    out = _apply(
        sparse_events(spark, sf),
        _m("plus", "add", input="value", operand=1.5),
        _m("minus", "sub", input="value", operand=1.5),
        _m("twice", "mul", input="value", operand=2),
        _m("part", "divide", input="value", operand=7.3),
        _m("next_user", "add", input="user_id", operand=1),
    )
    return out.select("event_id", "plus", "minus", "twice", "part", "next_user")


@check("SELECT event_id, CAST(NULL AS DOUBLE) AS nothing FROM events")
def tf_divide_zero(spark, sf):
    return _apply(table(spark, sf, "events"), _m("nothing", "divide", input="value", operand=0)).select("event_id", "nothing")


@check(
    f"SELECT event_id, coalesce(event_type, '') || '-' || coalesce(CAST(user_id AS VARCHAR), '') || '-' || coalesce(event_type, '') AS joined, "
    f"coalesce(event_type, '') || coalesce(props, '') AS plain FROM {SPARSE} e"
)
def tf_concat(spark, sf):
    out = _apply(
        sparse_events(spark, sf),
        _m("joined", "concat", inputs=["event_type", "user_id", "event_type"], separator="-"),
        _m("plain", "concat", inputs=["event_type", "props"]),
    )
    return out.select("event_id", "joined", "plain")


@check(
    f"SELECT event_id, substr(coalesce(event_type, ''), 2, 3) AS middle, substr(coalesce(event_type, ''), 3) AS tail, "
    f"'' AS beyond, substr(coalesce(event_type, ''), 1, 2) AS head FROM {SPARSE} e"
)
def tf_substring(spark, sf):
    out = _apply(
        sparse_events(spark, sf),
        _m("middle", "substring", input="event_type", start=1, length=3),
        _m("tail", "substring", input="event_type", start=2),
        _m("beyond", "substring", input="event_type", start=50, length=3),
        _m("head", "substring", input="event_type", length=2),
    )
    return out.select("event_id", "middle", "tail", "beyond", "head")


@check(f"SELECT event_id, upper(coalesce(event_type, '')) AS up, lower(coalesce(props, '')) AS low FROM {SPARSE} e")
def tf_case(spark, sf):
    out = _apply(sparse_events(spark, sf), _m("up", "upper", input="event_type"), _m("low", "lower", input="props"))
    return out.select("event_id", "up", "low")


@check(f"SELECT event_id, coalesce(event_type, '') AS clean FROM {SPARSE} e")
def tf_trim(spark, sf):
    padded = F.concat(F.lit("\t  "), F.col("event_type"), F.lit(" \r\n"))
    rows = sparse_events(spark, sf).withColumn("padded", padded)
    return _apply(rows, _m("clean", "trim", input="padded")).select("event_id", "clean")


@check(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y/%m') AS month, "
    "strftime(o_orderdate, '%Y-%m-%d') AS from_text, strftime(o_orderdate, '%Y%m%d %H') AS from_millis, "
    "o_orderpriority AS kept FROM orders"
)
def tf_date_format(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("text"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("millis"),
    )
    out = _apply(
        rows,
        _m("day", "date_format", input="o_orderdate"),
        _m("month", "date_format", input="o_orderdate", format="yyyy/MM"),
        _m("from_text", "date_format", input="text", format="yyyy-MM-dd"),
        _m("from_millis", "date_format", input="millis", format="yyyyMMdd HH"),
        _m("kept", "date_format", input="o_orderpriority", format="yyyy-MM-dd"),
    )
    return out.select("o_orderkey", "day", "month", "from_text", "from_millis", "kept")


@check(
    f"SELECT event_id, CASE WHEN value >= 100 THEN 'vip' ELSE 'normal' END AS level, "
    f"CASE WHEN value IS NULL OR value < 10 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS small, "
    f"CASE WHEN event_type = 'click' THEN true END AS clicked FROM {SPARSE} e"
)
def tf_if_else(spark, sf):
    out = _apply(
        sparse_events(spark, sf),
        _m("level", "if_else", condition={"field": "value", "op": "gte", "value": 100}, then_value="vip", elseValue="normal"),
        _m("small", "if_else", condition={"field": "value", "op": "lt", "value": 10}, thenValue=1, else_value=0),
        _m("clicked", "if_else", condition={"field": "event_type", "op": "eq", "value": "click"}, then_value=True),
    )
    return out.select("event_id", "level", "small", "clicked")


@check("SELECT event_id, 'web' AS channel, CAST(7 AS BIGINT) AS version, 0.5::DOUBLE AS weight, true AS live FROM events")
def tf_literal(spark, sf):
    out = _apply(
        table(spark, sf, "events"),
        _m("channel", "literal", value="web"),
        _m("version", "literal", value=7),
        _m("weight", "literal", value=0.5),
        _m("live", "literal", value=True),
    )
    return out.select("event_id", "channel", "version", "weight", "live")


@check(
    "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS key_text, CAST(l_linenumber AS BIGINT) AS line_long, "
    "CAST(trunc(l_quantity) AS INTEGER) AS whole, CAST(l_linenumber AS DOUBLE) AS line_double, "
    "CAST(l_extendedprice AS DECIMAL(10, 2)) AS price, CAST(l_shipdate AS DATE) AS shipped, "
    "l_returnflag = 'true' AS flag FROM lineitem"
)
def tf_cast(spark, sf):
    out = _apply(
        table(spark, sf, "lineitem"),
        _m("key_text", "type_cast", input="l_orderkey"),
        _m("line_long", "type_cast", input="l_linenumber", target_type="long"),
        _m("whole", "type_cast", input="l_quantity", targetType="INT"),
        _m("line_double", "type_cast", input="l_linenumber", targetType="Double"),
        _m("price", "type_cast", input="l_extendedprice", targetType="DECIMAL"),
        _m("shipped", "type_cast", input="l_shipdate", targetType="DATE"),
        _m("flag", "type_cast", input="l_returnflag", targetType="BOOLEAN"),
    )
    return out.select("l_orderkey", "l_linenumber", "key_text", "line_long", "whole", "line_double", "price", "shipped", "flag")


@check("SELECT c_custkey, c_name, c_name AS customer, c_mktsegment AS segment FROM customer")
def tf_rename(spark, sf):
    out = _apply(
        table(spark, sf, "customer"),
        _m("customer", "rename", input="c_name"),
        _m("segment", "rename", input="c_mktsegment"),
    )
    return out.select("c_custkey", "c_name", "customer", "segment")


@check(
    "SELECT c_custkey, upper(c_mktsegment) AS c_name, c_name AS c_mktsegment, c_acctbal + 1 AS c_acctbal FROM customer"
)
def tf_input_snapshot(spark, sf):
    """Mappings swap two columns and write one twice: all read the input row, the last write wins."""
    out = _apply(
        table(spark, sf, "customer"),
        _m("c_name", "upper", input="c_mktsegment"),
        _m("c_mktsegment", "rename", input="c_name"),
        _m("c_acctbal", "mul", input="c_acctbal", operand=100),
        _m("c_acctbal", "add", input="c_acctbal", operand=1),
    )
    return out.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


_NARROW = TableSchema.from_json(
    {
        "table": "narrow",
        "fields": [
            {"name": "c_custkey", "type": "LONG"},
            {"name": "label", "type": "STRING"},
            {"name": "level", "type": "INT"},
            {"name": "unfilled", "type": "DOUBLE"},
        ],
    }
)


@check(
    "SELECT c_custkey, coalesce(c_name, '') || '/' || coalesce(c_mktsegment, '') AS label, "
    "CASE WHEN c_acctbal > 0 THEN 2 ELSE 1 END AS level, CAST(NULL AS DOUBLE) AS unfilled FROM customer"
)
def tf_output_schema(spark, sf):
    return _apply(
        table(spark, sf, "customer"),
        _m("label", "concat", inputs=["c_name", "c_mktsegment"], separator="/"),
        _m("level", "if_else", condition={"field": "c_acctbal", "op": "gt", "value": 0}, thenValue=2, elseValue=1),
        _m("not_declared", "literal", value="dropped"),
        output_schema=_NARROW,
    )


@check(
    "SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS hidden, "
    "sha256(c_name) AS digest FROM customer"
)
def tf_mask_and_hash(spark, sf):
    out = _apply(table(spark, sf, "customer"), _m("hidden", "mask", input="c_name"), _m("digest", "hash", input="c_name"))
    return out.select("c_custkey", "hidden", "digest")


@check("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem")
def tf_expr(spark, sf):
    out = _apply(table(spark, sf, "lineitem"), _m("revenue", "expr", expression="l_extendedprice * (1 - l_discount)"))
    return out.select("l_orderkey", "l_linenumber", "revenue")
