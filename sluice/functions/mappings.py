"""Field mappings as Catalyst expressions. Every mapping reads the step's input row only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import literals as L
from sluice.functions.predicates import condition
from sluice.schema import named_type, ref, require_column
from sluice.spec import FIELD_TYPES, ConfigError, FieldMapping, TableSchema

# Pattern letters Spark refuses when formatting, with the calendar week they stood for.
_WEEK_LETTERS = "YwWue"
# Fixed value: the characters trim strips from both ends (everything up to the space).
_TRIM_PATTERN = r"^[\x00-\x20]+|[\x00-\x20]+$"
# Letter runs that always read the same number of digits.
_FIXED_WIDTH = re.compile(r"yyyy|MM|dd|HH|mm|ss|S+|[^A-Za-z']")


def _shape(fmt: str) -> str | None:
    """A regular expression for the text a fixed-width date pattern reads, if it is one."""
    runs = _FIXED_WIDTH.findall(fmt)
    if "".join(runs) != fmt:
        return None
    return "^" + "".join(f"[0-9]{{{len(r)}}}" if r[0].isalpha() else re.escape(r) for r in runs)


class _Context:
    """What a mapping may look at: the input schema and the declared type of its output."""

    def __init__(self, m: FieldMapping, schema: T.StructType, out_type: T.DataType | None):
        self.m, self.schema, self.out_type = m, schema, out_type
        self.where = f"transform {m.op} -> {m.output}"

    def dtype(self, name: str | None) -> T.DataType:
        return require_column(self.schema, name, self.where).dataType

    def input(self) -> Column:
        self.dtype(self.m.input)
        return ref(self.m.input)

    def text_or_empty(self, name: str | None) -> Column:
        dtype = self.dtype(name)
        col = ref(name)
        return F.coalesce(col if isinstance(dtype, T.StringType) else col.cast("string"), F.lit(""))

    def fail(self, message: str):
        raise ConfigError(f"{self.where}: {message}")


def _arithmetic(combine):
    def build(ctx: _Context) -> Column:
        col = ctx.input()
        if ctx.m.operand is None:
            return F.lit(None).cast("double")
        return combine(col.cast("double"), F.lit(float(ctx.m.operand)))

    return build


def _concat(ctx: _Context) -> Column:
    if not ctx.m.inputs:
        ctx.fail("'inputs' is required")
    return F.concat_ws(ctx.m.separator, *(ctx.text_or_empty(n) for n in ctx.m.inputs))


def _substring(ctx: _Context) -> Column:
    start, length = ctx.m.start, ctx.m.length
    if start < 0 or (length is not None and length < 0):
        ctx.fail("start and length must not be negative")
    text = ctx.text_or_empty(ctx.m.input)
    return F.substring(text, start + 1, 2**31 - 1 if length is None else length)


def _date_format(ctx: _Context) -> Column:
    fmt = ctx.m.format
    plain = re.sub(r"'[^']*'", "", fmt)
    bad = sorted(set(plain) & set(_WEEK_LETTERS))
    if bad:
        ctx.fail(f"week-based pattern letters are not supported: {', '.join(bad)}")
    col, dtype = ctx.input(), ctx.dtype(ctx.m.input)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, fmt)
    if isinstance(dtype, T.LongType):
        return F.date_format(F.timestamp_millis(col), fmt)
    text = col if isinstance(dtype, T.StringType) else col.cast("string")
    # A parse that fails is slow, so each is tried only on text that looks the part. Text that goes on
    # after a fixed-width pattern still parses.
    shape = _shape(fmt)
    if shape is not None:
        parsed = F.when(text.rlike(shape), F.try_to_timestamp(F.substring(text, 1, len(fmt)), F.lit(fmt)))
    else:
        parsed = F.when(text.rlike("[0-9]"), F.try_to_timestamp(text, F.lit(fmt)))
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]"), text.try_cast("timestamp_ntz").cast("timestamp"))
    return F.coalesce(F.date_format(F.coalesce(parsed, iso), fmt), text)


def _if_else(ctx: _Context) -> Column:
    if ctx.m.condition is None:
        ctx.fail("'condition' is required")
    then, other = L.scalar(ctx.m.then_value), L.scalar(ctx.m.else_value)
    if ctx.out_type is not None:
        then, other = then.cast(ctx.out_type), other.cast(ctx.out_type)
    elif isinstance(ctx.m.then_value, str) != isinstance(ctx.m.else_value, str):
        # text beside a number or a boolean: text is the type both have
        then, other = then.cast("string"), other.cast("string")
    return F.when(condition(ctx.m.condition, ctx.schema), then).otherwise(other)


def _literal(ctx: _Context) -> Column:
    value = L.scalar(ctx.m.value)
    return value if ctx.out_type is None else value.cast(ctx.out_type)


def _type_cast(ctx: _Context) -> Column:
    col, target = ctx.input(), ctx.m.target_type.upper()
    if target == "BOOLEAN":
        return F.lower(col.cast("string")) == "true"
    if target == "DECIMAL" and isinstance(ctx.out_type, T.DecimalType):
        return col.cast(ctx.out_type)  # the output's own precision and scale
    return col.cast(named_type(target if target in FIELD_TYPES else "STRING"))


def _expression(ctx: _Context) -> Column:
    if not ctx.m.expression:
        ctx.fail("'expression' is required")
    return F.expr(ctx.m.expression)


_OPERATIONS = {
    "rename": lambda ctx: ctx.input(),
    "add": _arithmetic(lambda a, b: a + b),
    "sub": _arithmetic(lambda a, b: a - b),
    "mul": _arithmetic(lambda a, b: a * b),
    "divide": _arithmetic(F.try_divide),
    "concat": _concat,
    "substring": _substring,
    "upper": lambda ctx: F.upper(ctx.text_or_empty(ctx.m.input)),
    "lower": lambda ctx: F.lower(ctx.text_or_empty(ctx.m.input)),
    "trim": lambda ctx: F.regexp_replace(ctx.text_or_empty(ctx.m.input), _TRIM_PATTERN, ""),
    "date_format": _date_format,
    "if_else": _if_else,
    "literal": _literal,
    "type_cast": _type_cast,
    "mask": lambda ctx: F.mask(ctx.input().cast("string")),
    "hash": lambda ctx: F.sha2(ctx.input().cast("string"), 256),
    "expr": _expression,
}


def mapping(m: FieldMapping, schema: T.StructType, declared: TableSchema | None = None) -> Column:
    """One mapping as a column, reading ``schema``; ``declared`` types the constants."""
    build = _OPERATIONS.get(m.op)
    if build is None:
        raise ConfigError(f"transform: unknown operation {m.op!r}; known: {', '.join(_OPERATIONS)}")
    target = declared.field(m.output) if declared else None
    out_type = named_type(target.type, target.precision, target.scale) if target else None
    return build(_Context(m, schema, out_type))
