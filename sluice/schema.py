"""Declared flat schemas as Spark types, and conformance of a DataFrame to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.spec import ConfigError, Field, TableSchema

# Declared type name -> Spark type (DECIMAL carries its own precision and scale).
_SPARK_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
}


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column by its exact top-level name, dots and all."""
    return F.col(quote(name))


def spark_type(f: Field) -> T.DataType:
    if f.type == "DECIMAL":
        return T.DecimalType(f.precision, f.scale)
    return _SPARK_TYPES[f.type]


def named_type(name: str, precision: int = 10, scale: int = 2) -> T.DataType:
    return spark_type(Field("_", name, True, precision, scale))


def struct_type(schema: TableSchema) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f), not schema.required(f)) for f in schema.fields])


def require_column(schema: T.StructType, name: str | None, where: str) -> T.StructField:
    if name is None:
        raise ConfigError(f"{where}: a field name is required")
    if name not in schema.names:
        raise ConfigError(f"{where}: unknown field {name!r}; the step's input has {', '.join(schema.names)}")
    return schema[name]


def _sink_value(df: DataFrame, f: Field) -> Column:
    if f.name not in df.columns:
        return F.lit(None).cast(spark_type(f))
    col = ref(f.name)
    if f.type == "TIMESTAMP":
        return F.date_trunc("MILLISECOND", col.cast("timestamp")).cast("timestamp_ntz")
    return col if df.schema[f.name].dataType == spark_type(f) else col.cast(spark_type(f))


def null_violations(df: DataFrame, schema: TableSchema) -> Column:
    """True for a row that leaves a required field empty."""
    tests = [ref(f.name).isNull() for f in schema.fields if schema.required(f)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


ON_NULL = ("fail", "drop", "quarantine")


def check_on_null(on_null: str) -> None:
    if on_null not in ON_NULL:
        raise ConfigError(f"on_null: unknown word {on_null!r}; known: {', '.join(ON_NULL)}")


def conform(df: DataFrame, schema: TableSchema, on_null: str = "fail", keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to the declared names and types, in declared order.

    Extra columns are dropped (but for those named in ``keep``), absent nullable ones become
    typed nulls. A null in a required field fails the job; with ``on_null="drop"`` the row is
    left out. ``"quarantine"`` is for callers that have set such rows aside (:func:`null_violations`)
    before; what is left of them here fails the job all the same.
    """
    check_on_null(on_null)
    for f in schema.fields:
        if f.name not in df.columns and schema.required(f):
            raise ConfigError(f"sink {schema.table!r}: required field {f.name!r} is missing from the rows")
    if on_null == "drop":
        df = df.filter(~null_violations(df, schema))
    out = []
    for f in schema.fields:
        col = _sink_value(df, f)
        if on_null != "drop" and schema.required(f):
            message = f"NOT NULL violated: field {f.name} of table {schema.table}"
            col = F.coalesce(col, F.raise_error(F.lit(message)).cast(spark_type(f)))
        out.append(col.alias(f.name))
    return df.select(*out, *(ref(k) for k in keep if k in df.columns))
