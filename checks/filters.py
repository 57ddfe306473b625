"""Filter rule checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import SPARSE, check, register, sparse_events, table
from sluice import FilterRule, filter_rows


def _rule(*conditions: dict, logic: str = "AND") -> FilterRule:
    return FilterRule.from_json({"logic": logic, "conditions": list(conditions)})


def _events(name: str, rule: FilterRule, where: str) -> None:
    register(
        name,
        lambda spark, sf: filter_rows(sparse_events(spark, sf), rule).select("event_id", "user_id", "event_type", "value"),
        f"SELECT event_id, user_id, event_type, value FROM {SPARSE} e WHERE {where}",
    )


def _parts(name: str, rule: FilterRule, where: str) -> None:
    register(
        name,
        lambda spark, sf: filter_rows(table(spark, sf, "part"), rule).select("p_partkey", "p_name"),
        f"SELECT p_partkey, p_name FROM part WHERE {where}",
    )


def _lines(name: str, rule: FilterRule, where: str) -> None:
    register(
        name,
        lambda spark, sf: filter_rows(table(spark, sf, "lineitem"), rule).select("l_orderkey", "l_linenumber", "l_quantity"),
        f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {where}",
    )


_events("filter_eq", _rule({"field": "event_type", "op": "eq", "value": "purchase"}), "event_type IS NOT DISTINCT FROM 'purchase'")
_events("filter_ne", _rule({"field": "event_type", "op": "ne", "value": "purchase"}), "event_type IS DISTINCT FROM 'purchase'")
_events("filter_eq_null", _rule({"field": "event_type", "op": "eq", "value": None}), "event_type IS NULL")
_events("filter_gt", _rule({"field": "value", "op": "gt", "value": 50}), "value > 50")
_events("filter_gte", _rule({"field": "value", "op": "gte", "value": 50}), "value >= 50")
_events("filter_lt", _rule({"field": "value", "op": "lt", "value": 50}), "value IS NULL OR value < 50")
_events("filter_lte", _rule({"field": "value", "op": "lte", "value": 50}), "value IS NULL OR value <= 50")
_events("filter_gt_null_literal", _rule({"field": "value", "op": "gt", "value": None}), "value IS NOT NULL")
_events("filter_in", _rule({"field": "event_type", "op": "in", "values": ["click", "signup"]}), "coalesce(event_type IN ('click', 'signup'), false)")
_events("filter_not_in", _rule({"field": "event_type", "op": "not_in", "values": ["click", "signup"]}), "NOT coalesce(event_type IN ('click', 'signup'), false)")
_events("filter_in_with_null", _rule({"field": "event_type", "op": "in", "values": ["click", None]}), "event_type IS NULL OR event_type = 'click'")
_events("filter_null", _rule({"field": "event_type", "op": "is_null"}), "event_type IS NULL")
_events("filter_not_null", _rule({"field": "event_type", "op": "not_null"}), "event_type IS NOT NULL")
_events("filter_text_form", _rule({"field": "user_id", "op": "contains", "value": 7}), "contains(CAST(user_id AS VARCHAR), '7')")
_events(
    "filter_and",
    _rule(
        {"field": "value", "op": "gte", "value": 20},
        {"field": "event_type", "op": "ne", "value": "view"},
        {"field": "ts", "op": "lt", "value": "2024-01-20T00:00:00"},
    ),
    "value >= 20 AND event_type IS DISTINCT FROM 'view' AND (ts IS NULL OR ts < TIMESTAMP '2024-01-20 00:00:00')",
)
_events(
    "filter_or",
    _rule({"field": "value", "op": "gt", "value": 100}, {"field": "event_type", "operator": "is_null"}, logic="or"),
    "value > 100 OR event_type IS NULL",
)
_events("filter_no_conditions", _rule(), "true")
_events("filter_time_order", _rule({"field": "ts", "op": "gte", "value": "2024-01-10T00:00:00"}), "ts >= TIMESTAMP '2024-01-10 00:00:00'")

_lines("filter_in_typed", _rule({"field": "l_linenumber", "op": "in", "values": [1, "2", 3.0, 4.5, "x"]}), "l_linenumber IN (1, 2, 3)")
_lines(
    "filter_whole_number_bounds",
    _rule({"field": "l_linenumber", "op": "gt", "value": 2.5}, {"field": "l_linenumber", "op": "lte", "value": "5.5"}),
    "l_linenumber > 2.5 AND l_linenumber <= 5.5",
)

_parts("filter_contains", _rule({"field": "p_name", "op": "contains", "value": "ed w"}), "contains(p_name, 'ed w')")
_parts("filter_starts_with", _rule({"field": "p_brand", "op": "starts_with", "value": "Brand#1"}), "starts_with(p_brand, 'Brand#1')")
_parts("filter_ends_with", _rule({"field": "p_brand", "op": "ends_with", "value": "3"}), "ends_with(p_brand, '3')")
_parts("filter_regex", _rule({"field": "p_brand", "op": "regex", "value": "#[1-3][0-9]*$"}), "regexp_matches(p_brand, '#[1-3][0-9]*$')")


@check(
    "SELECT p_partkey, code FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'b' || CAST(p_size AS VARCHAR) "
    "ELSE CAST(p_size AS VARCHAR) END AS code FROM part) p "
    "WHERE CASE WHEN TRY_CAST(code AS DOUBLE) IS NOT NULL THEN TRY_CAST(code AS DOUBLE) > 9 ELSE code > '9' END"
)
def filter_numeric_text_order(spark, sf):
    size = F.col("p_size").cast("string")
    coded = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("b"), size)).otherwise(size)
    rows = table(spark, sf, "part").select("p_partkey", coded.alias("code"))
    return filter_rows(rows, _rule({"field": "code", "op": "gt", "value": 9}))
