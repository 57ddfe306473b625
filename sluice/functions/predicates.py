"""Filter rules as Catalyst predicates.

A predicate made here is true for the rows the rule keeps and false *or null* for the others.
That is all ``filter`` and ``when`` need, and it leaves the comparisons bare so that they reach
the scan as pushed filters.
"""

from __future__ import annotations

import operator
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import literals as L
from sluice.schema import ref, require_column
from sluice.spec import Condition, ConfigError, FilterRule

_ORDER = {"gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}


def _text(col: Column, dtype: T.DataType) -> Column:
    return col if isinstance(dtype, T.StringType) else col.cast("string")


def _equals(col: Column, dtype: T.DataType, value: Any) -> Column:
    """Null-safe equality: typed when the literal fits the column, else on text."""
    if value is None:
        return col.isNull()
    literal = L.typed(value, dtype)
    if literal is None:
        return _text(col, dtype).eqNullSafe(L.text(value))
    return col.eqNullSafe(literal)


def _integral_order(col: Column, dtype: T.DataType, op: str, number: Decimal) -> Column:
    # move a fractional bound to the whole number on the same side, so the column is never cast
    bound = int(number.to_integral_value(ROUND_FLOOR if op in ("gt", "lte") else ROUND_CEILING))
    low, high = L.integral_range(dtype)
    if low <= bound <= high:
        return _ORDER[op](col, F.lit(bound).cast(dtype))
    always = _ORDER[op](0, bound)
    return col.isNotNull() if always else F.lit(False)


def _string_order(col: Column, op: str, value: Any, number: Decimal) -> Column:
    """Text column, numeric literal: numbers compare as numbers, everything else as text."""
    compare = _ORDER[op]
    double = col.try_cast("double")
    numeric = compare(double, F.lit(float(number)))
    exact = L.decimal_literal(number)
    if exact is not None:
        # exact where the decimal holds the number; a tiny one would be rounded away
        decimal = col.try_cast("decimal(38,18)")
        numeric = F.when(decimal.cast("double") == double, compare(decimal, exact)).otherwise(numeric)
    return F.when(col.rlike(L.NUMBER_PATTERN), numeric).otherwise(compare(col, L.text(value)))


def _ordered(col: Column, dtype: T.DataType, op: str, value: Any) -> Column:
    compare = _ORDER[op]
    if isinstance(dtype, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        literal = L.typed(value, dtype)
        if literal is None and isinstance(dtype, T.DateType):
            literal = L.typed(value, T.TimestampNTZType())
        return compare(_text(col, dtype), L.text(value)) if literal is None else compare(col, literal)
    number = L.as_number(value)
    if number is None or isinstance(dtype, T.BooleanType):
        return compare(_text(col, dtype), L.text(value))
    if isinstance(dtype, T.StringType):
        return _string_order(col, op, value, number)
    if L.is_integral(dtype):
        return _integral_order(col, dtype, op, number)
    literal = L.typed(value, dtype)
    return compare(col, F.lit(float(number)) if literal is None else literal)


def _order_condition(col: Column, dtype: T.DataType, op: str, value: Any) -> Column:
    """gt/gte leave null fields out, lt/lte keep them; a null literal sorts below every value."""
    if op in ("gt", "gte"):
        return col.isNotNull() if value is None else _ordered(col, dtype, op, value)
    return col.isNull() if value is None else col.isNull() | _ordered(col, dtype, op, value)


def _member(col: Column, dtype: T.DataType, values: tuple) -> Column:
    typed, texts = [], []
    for value in values:
        if value is not None:
            literal = L.typed(value, dtype)
            (texts.append(L.text(value)) if literal is None else typed.append(literal))
    parts = []
    if typed:
        parts.append(col.isin(*typed))
    if texts:
        parts.append(_text(col, dtype).isin(*texts))
    return reduce(operator.or_, parts, F.lit(False)) if parts else F.lit(False)


def _in(col: Column, dtype: T.DataType, values: tuple | None) -> Column:
    if not values:
        return F.lit(False)
    hit = _member(col, dtype, values)
    return hit | col.isNull() if None in values else hit


def _not_in(col: Column, dtype: T.DataType, values: tuple | None) -> Column:
    if not values:
        return F.lit(True)
    miss = ~_member(col, dtype, values)
    return col.isNotNull() & miss if None in values else col.isNull() | miss


_CONDITIONS = {
    "eq": lambda col, t, c: _equals(col, t, c.value),
    "ne": lambda col, t, c: ~_equals(col, t, c.value),
    "gt": lambda col, t, c: _order_condition(col, t, "gt", c.value),
    "gte": lambda col, t, c: _order_condition(col, t, "gte", c.value),
    "lt": lambda col, t, c: _order_condition(col, t, "lt", c.value),
    "lte": lambda col, t, c: _order_condition(col, t, "lte", c.value),
    "in": lambda col, t, c: _in(col, t, c.values),
    "not_in": lambda col, t, c: _not_in(col, t, c.values),
    "is_null": lambda col, t, c: col.isNull(),
    "not_null": lambda col, t, c: col.isNotNull(),
    "contains": lambda col, t, c: _text(col, t).contains(L.text(c.value)),
    "starts_with": lambda col, t, c: _text(col, t).startswith(L.text(c.value)),
    "ends_with": lambda col, t, c: _text(col, t).endswith(L.text(c.value)),
    "regex": lambda col, t, c: _text(col, t).rlike(str(c.value)),
}


def condition(c: Condition, schema: T.StructType) -> Column:
    build = _CONDITIONS.get(c.op)
    if build is None:
        raise ConfigError(f"filter: unknown operator {c.op!r}; known: {', '.join(_CONDITIONS)}")
    if c.op == "regex" and not isinstance(c.value, str):
        raise ConfigError("filter: regex needs a pattern in 'value'")
    column = require_column(schema, c.field, f"filter {c.op}")
    return build(ref(c.field), column.dataType, c)


def predicate(rule: FilterRule, schema: T.StructType) -> Column:
    """The rule as one boolean column; no conditions keep every row."""
    parts = [condition(c, schema) for c in rule.conditions]
    if not parts:
        return F.lit(True)
    return reduce(operator.or_ if rule.logic.upper() == "OR" else operator.and_, parts)
