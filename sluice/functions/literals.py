"""JSON scalars as Spark literals: typed to a column where that is exact, else as text."""

from __future__ import annotations

import json
import math
import re
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the decimal text both sides of an ordering test must have to compare as numbers.
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"

_NUMBER = re.compile(NUMBER_PATTERN)
_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def is_integral(dtype: T.DataType) -> bool:
    return type(dtype) in _INTEGRAL_BITS


def integral_range(dtype: T.DataType) -> tuple[int, int]:
    top = 1 << (_INTEGRAL_BITS[type(dtype)] - 1)
    return -top, top - 1


def as_number(value: Any) -> Decimal | None:
    """The value as a decimal if it is a number or numeric text; booleans are not numbers."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, float):
        return Decimal(repr(value)) if math.isfinite(value) else None
    if isinstance(value, int):
        return Decimal(value)
    if isinstance(value, str) and _NUMBER.match(value):
        return Decimal(value)
    return None


def text(value: Any) -> Column:
    """The text form of a JSON value, as Spark prints the same value."""
    if value is None:
        return F.lit("null")
    if isinstance(value, str):
        return F.lit(value)
    if isinstance(value, float):
        return F.lit(value).cast("string")
    return F.lit(json.dumps(value))


def scalar(value: Any) -> Column:
    """A JSON scalar under its natural Spark type; lists and objects become JSON text."""
    if isinstance(value, int) and not isinstance(value, bool):
        return F.lit(value).cast("bigint") if -(1 << 63) <= value < (1 << 63) else F.lit(str(value)).cast("decimal(38,0)")
    if value is None or isinstance(value, (str, bool, float)):
        return F.lit(value)
    return text(value)


def decimal_literal(number: Decimal) -> Column | None:
    """An exact decimal literal, or None when 38 digits cannot hold the number."""
    _, digits, exponent = number.as_tuple()
    scale = max(-exponent, 0)
    precision = max(len(digits) + max(exponent, 0), scale)
    if precision > 38:
        return None
    return F.lit(format(number, "f")).cast(T.DecimalType(max(precision, 1), scale))


def _parse_date(value: Any) -> date | None:
    try:
        return date.fromisoformat(value) if isinstance(value, str) and len(value) == 10 else None
    except ValueError:
        return None


def _parse_timestamp(value: Any) -> datetime | None:
    try:
        parsed = datetime.fromisoformat(value) if isinstance(value, str) and len(value) >= 10 else None
    except ValueError:
        return None
    return parsed if parsed is not None and parsed.tzinfo is None else None


def typed(value: Any, dtype: T.DataType) -> Column | None:
    """``value`` as a literal of ``dtype``, or None when it has no exact counterpart there."""
    if isinstance(dtype, T.StringType):
        return text(value)
    if isinstance(dtype, T.BooleanType):
        name = value if isinstance(value, str) else json.dumps(value)
        return {"true": F.lit(True), "false": F.lit(False)}.get(name)
    if isinstance(dtype, T.DateType):
        parsed = _parse_date(value)
        return None if parsed is None else F.lit(parsed.isoformat()).cast(dtype)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        parsed = _parse_timestamp(value)
        return None if parsed is None else F.lit(parsed.isoformat(sep=" ")).cast(dtype)
    number = as_number(value)
    if number is None:
        return None
    if is_integral(dtype):
        low, high = integral_range(dtype)
        return F.lit(int(number)).cast(dtype) if number == int(number) and low <= number <= high else None
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit(float(number)).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return decimal_literal(number)
    return None
