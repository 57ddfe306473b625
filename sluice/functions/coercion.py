"""Lenient conversion of JSON scalar text to the declared types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schema import spark_type
from sluice.spec import Field

# ISO date and zone-less ISO date-time, with seconds and fraction optional. The formats
# raise on anything else; text of the given shape takes the faster cast, which checks the ranges.
DATE_FORMAT = "yyyy-MM-dd"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss]"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?$"

# A failing try_cast costs far more than a good one, so text without a digit is not even tried
# (the letters begin Infinity and NaN), nor is a fraction as a whole number.
_WHOLE_SHAPE = r"^ *[+-]?[0-9]+ *$"
_NUMBER_HINT = "[0-9IN]"


def _double(s: Column) -> Column:
    return F.when(s.rlike(_NUMBER_HINT), s.try_cast("double"))


def _whole(s: Column, dtype: T.DataType) -> Column:
    # the integer parse comes first, so long values never pass through a double
    return F.coalesce(
        F.when(s.rlike(_WHOLE_SHAPE), s.try_cast(dtype)),
        _double(s).try_cast(dtype),
        F.when(F.lower(s) == "true", F.lit(1).cast(dtype)),
        F.lit(0).cast(dtype),
    )


def _boolean(s: Column) -> Column:
    number = F.when(s.rlike(_WHOLE_SHAPE), F.coalesce(s.try_cast("bigint") != 0, F.lit(False)))
    return F.when(s == "true", True).when(s == "false", False).otherwise(F.coalesce(number, F.lit(False)))


def coerce(s: Column, f: Field) -> Column:
    """The text ``s`` as a value of the field's type; null stays null.

    Numbers and booleans fall back to 0 / 0.0 / false on text they cannot read, while DECIMAL, DATE
    and TIMESTAMP fail the job.
    """
    dtype = spark_type(f)
    if f.type == "STRING":
        return s
    if f.type == "DECIMAL":
        return s.cast(dtype)
    if f.type == "DATE":
        return F.when(s.rlike(DATE_SHAPE), s.cast("date")).otherwise(F.to_date(s, DATE_FORMAT))
    if f.type == "TIMESTAMP":
        shaped = F.when(s.rlike(TIMESTAMP_SHAPE), s.cast("timestamp_ntz"))
        return shaped.otherwise(F.to_timestamp_ntz(s, F.lit(TIMESTAMP_FORMAT)))
    if f.type in ("INT", "LONG"):
        value = _whole(s, dtype)
    elif f.type == "BOOLEAN":
        value = _boolean(s)
    else:
        value = F.coalesce(_double(s), F.lit(0.0)).cast(dtype)
    return F.when(s.isNotNull(), value)
