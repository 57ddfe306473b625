"""JSON message text -> rows of the declared schema."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.coercion import coerce
from sluice.schema import quote, ref, spark_type
from sluice.spec import TableSchema

BAD_RECORD = "_bad_record"
_MODES = ("fail", "drop", "keep")


def decode_json(
    df: DataFrame, schema: TableSchema, on_bad_record: str = "fail", value: str = "value", fields: Collection[str] | None = None
) -> DataFrame:
    """Decode the ``value`` column; other columns (the ``_src`` position) are kept behind the fields.

    All fields are first read as text and then coerced, since a typed read turns a number in quotes
    into null. The parse sits inside a generator: a filter on a decoded field would otherwise be
    pushed below it and parse each message a second time.

    A bad record is one that is not a JSON object. ``fail`` raises, ``drop`` leaves it out, ``keep``
    passes it on with its text in ``_bad_record`` (null for good rows). Messages are read to their end either way.

    Only ``fields`` are taken out of the messages (None: all declared ones); the others are null.
    """
    if on_bad_record not in _MODES:
        raise ValueError(f"on_bad_record must be one of {_MODES}, not {on_bad_record!r}")
    raw = ref(value).cast("string")
    taken = [f.name for f in schema.fields if fields is None or f.name in fields]
    ddl = ", ".join(f"{quote(name)} STRING" for name in (*taken, BAD_RECORD))
    parsed = F.from_json(raw, ddl, {"columnNameOfCorruptRecord": BAD_RECORD})
    others = [c for c in df.columns if c != value]
    # empty and null messages parse to a null struct, which inline would show as a row of nulls
    text = F.coalesce(raw, F.lit(""))
    missing = F.struct(*(F.lit(None).cast("string").alias(name) for name in taken), text.alias(BAD_RECORD))
    rows = df.select(*(ref(c) for c in others), F.inline(F.array(F.coalesce(parsed, missing))))
    bad = ref(BAD_RECORD)
    if on_bad_record == "fail":
        message = F.concat(F.lit("malformed message: "), F.substring(bad, 1, 200))
        rows = rows.filter(F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    elif on_bad_record == "drop":
        rows = rows.filter(bad.isNull())
    made = [coerce(ref(f.name), f) if f.name in taken else F.lit(None).cast(spark_type(f)) for f in schema.fields]
    kept = [bad] if on_bad_record == "keep" else []
    return rows.select(*(c.alias(f.name) for c, f in zip(made, schema.fields)), *(ref(c) for c in others), *kept)
