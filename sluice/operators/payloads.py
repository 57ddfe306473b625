"""Model service request and response documents.

``build_requests`` and ``parse_responses`` are Spark jobs over whole tables: rows are numbered and
grouped into requests by Spark and the documents are made by Catalyst. ``encode_batch`` and
``decode_answer`` do the same for the one batch an HTTP scorer holds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.schema import quote, ref, require_column, spark_type
from sluice.spec import ConfigError, InferenceSpec, TableSchema

# The list a JSON answer carries its results in, by service type.
_RESULT_KEY = {"torchserve": "predictions"}
_GENERIC_RESULT_KEY = "results"
# Exact copies of a row kept together when copies are spread over buckets.
_BUCKET_BYTES = 64 << 20
_MOST_BUCKETS = 1 << 20  # as numbers; what a bucket holds is not limited
_SLICE = 4096


def _result_key(spec: InferenceSpec) -> str:
    return _RESULT_KEY.get(spec.service_type or "", _GENERIC_RESULT_KEY)


# --- whole tables -----------------------------------------------------------------------------


def _request(spec: InferenceSpec, rows: Column, schema: T.StructType) -> Column:
    names = list(spec.input_fields)
    keep_nulls = {"ignoreNullFields": "false"}

    def items(r: Column) -> Column:
        return F.struct(*(r[n].alias(n) for n in names))

    if spec.service_type == "triton":
        for n in names:
            if not isinstance(schema[n].dataType, (T.NumericType, T.BooleanType)):
                raise ConfigError(f"function {spec.function_id!r}: triton input {n!r} must be numeric")
        flat = F.flatten(
            F.transform(rows, lambda r: F.array(*(F.coalesce(r[n].cast("double"), F.lit(0.0)) for n in names)))
        )
        tensor = F.struct(
            F.lit("input").alias("name"),
            F.array(F.size(rows), F.lit(len(names))).alias("shape"),
            F.lit("FP32").alias("datatype"),
            flat.alias("data"),
        )
        return F.to_json(F.struct(F.array(tensor).alias("inputs")))
    if spec.service_type == "torchserve":
        return F.to_json(F.struct(F.transform(rows, items).alias("instances")), keep_nulls)
    model = F.lit(spec.model_name or "").alias("model")
    return F.to_json(F.struct(model, F.transform(rows, items).alias("inputs")), keep_nulls)


def _with_positions(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """``_bucket, _at, row``: rows numbered from 0 in key order inside hash buckets of the whole row.

    Copies of a row all hash alike, so they are counted first (combined map-side) and spread over buckets in slices, so that a group of
    copies, however large, is neither shuffled whole nor numbered by one task.
    """
    columns = [ref(c) for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    last_slice = F.expr(f"(_n - 1) div {_SLICE}")
    sliced = counted.select(*columns, "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_slice)).alias("_slice"))
    placed = sliced.select(
        F.pmod(F.xxhash64(*columns, F.col("_slice")), F.lit(buckets)).cast("int").alias("_bucket"),
        F.struct(*columns).alias("row"),
        F.least(F.lit(_SLICE).cast("bigint"), F.col("_n") - F.col("_slice") * _SLICE).alias("_copies"),
        "_slice",
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(*(F.col("row")[k] for k in key), F.xxhash64("row"), "_slice")
    before = F.sum("_copies").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_copies")
    copies = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)
    numbered = placed.withColumn("_before", before).select("_bucket", "row", "_before", F.explode(copies).alias("_copy"))
    return numbered.select("_bucket", "row", (F.col("_before") + F.col("_copy")).alias("_at"))


def build_requests(
    df: DataFrame, spec: InferenceSpec, key: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """``bucket, batch_no, rows, request``: one request document per ``spec.batch_size`` rows.

    Rows are numbered in ``key`` order inside ``buckets`` hash buckets, so the numbering is spread over
    tasks and comes out the same when a task runs again; a group holds at most one batch. ``rows``
    keeps the whole input rows in request order. The number of buckets follows the size of the input; rows that
    repeat are counted and spread in slices, so no bucket is much larger than another.
    """
    for name in (*spec.input_fields, *key):
        require_column(df.schema, name, f"function {spec.function_id!r} request")
    # several buckets per shuffle partition, so that their hash spreads evenly, and none too large to sort
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = buckets or max(least, min(_MOST_BUCKETS, size // _BUCKET_BYTES))
    numbered = _with_positions(df, key, count)
    batch_no = F.expr(f"_at div {spec.batch_size}").alias("batch_no")
    grouped = numbered.groupBy(F.col("_bucket").alias("bucket"), batch_no).agg(
        F.sort_array(F.collect_list(F.struct("_at", "row"))).alias("_rows")
    )
    with_rows = grouped.select("bucket", "batch_no", F.transform("_rows", lambda r: r["row"]).alias("rows"))
    return with_rows.withColumn("request", _request(spec, F.col("rows"), df.schema))


def _answers(spec: InferenceSpec, response: Column) -> Column:
    """The results of a response as an array of structs of text, one field per output."""
    item = "STRUCT<" + ", ".join(f"{quote(n)}: STRING" for n in spec.output_fields) + ">"
    key = _result_key(spec)
    bare = F.from_json(response, f"ARRAY<{item}>")
    wrapped = F.from_json(response, f"STRUCT<{quote(key)}: ARRAY<{item}>>")[key]
    found = F.when(F.ltrim(response).startswith("["), bare).otherwise(wrapped)
    return F.coalesce(found, F.array().cast(f"ARRAY<{item}>"))


def _every(numbers: Column, width: int, first: int) -> Column:
    """The numbers at positions ``first``, ``first + width``, ..."""
    return F.filter(numbers, lambda _, i: i % width == first)


def parse_responses(
    batches: DataFrame, spec: InferenceSpec, declared: TableSchema | None = None, response: str = "response"
) -> DataFrame:
    """Rows of ``batches`` (``rows`` and a response document) with the outputs appended by position.

    A short response leaves null outputs, surplus results are ignored. Outputs take their declared
    type, without one double for ``triton`` and text otherwise; they overwrite input columns of the
    same name.
    """
    doc, rows, count = ref(response), ref("rows"), F.size("rows")
    width = len(spec.output_fields)
    if spec.service_type == "triton":
        # read as text, so that one quoted number does not void the others
        tensor = F.from_json(doc, "STRUCT<outputs: ARRAY<STRUCT<data: ARRAY<STRING>>>>")
        texts = F.coalesce(F.get(tensor["outputs"], F.lit(0))["data"], F.array().cast("array<string>"))
        data = F.transform(texts, lambda x: x.try_cast("double"))
        lists = [_every(data, width, j) for j in range(width)]
    else:
        lists = [_answers(spec, doc)]
    # zipped before they are opened, so that a row carries its own answer and not the whole list
    answers = [F.slice(values, 1, count).alias(f"a{j}") for j, values in enumerate(lists)]
    opened = batches.select(F.explode(F.arrays_zip(rows.alias("row"), *answers)).alias("_pair")).select("_pair.*")
    made = {}
    for j, name in enumerate(spec.output_fields):
        value = F.col(f"a{j}") if spec.service_type == "triton" else F.col("a0")[name]
        field = declared.field(name) if declared else None
        if field is not None:
            value = value.cast(spark_type(field))
        made[name] = value.alias(name)
    inputs = [f.name for f in batches.schema["rows"].dataType.elementType.fields]
    kept = [F.col("row")[c].alias(c) for c in inputs if c not in made]
    return opened.select(*kept, *made.values())


# --- one batch --------------------------------------------------------------------------------


def _json_value(value: Any) -> Any:
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    value = value.item() if hasattr(value, "item") else value
    return value if isinstance(value, (bool, int, float, str)) else str(value)


def encode_batch(batch: pd.DataFrame, spec: InferenceSpec) -> str:
    """The request document for one batch of input columns."""
    names = list(spec.input_fields)
    rows = [[_json_value(v) for v in row] for row in zip(*(batch[n].tolist() for n in names))]
    if spec.service_type == "triton":
        data = [0.0 if v is None else float(v) for row in rows for v in row]
        return json.dumps({"inputs": [{"name": "input", "shape": [len(rows), len(names)], "datatype": "FP32", "data": data}]})
    items = [dict(zip(names, row)) for row in rows]
    if spec.service_type == "torchserve":
        return json.dumps({"instances": items})
    return json.dumps({"model": spec.model_name or "", "inputs": items})


def decode_answer(answer: str, spec: InferenceSpec, rows: int) -> list[dict[str, Any]]:
    """One result per row of the batch from a response document."""
    doc, names = json.loads(answer), spec.output_fields
    if spec.service_type == "triton":
        outputs = doc.get("outputs") or []
        data = outputs[0].get("data", []) if outputs else []
        width = len(names)
        return [dict(zip(names, data[i * width : (i + 1) * width])) for i in range(rows)]
    items = doc.get(_result_key(spec), []) if isinstance(doc, dict) else doc
    return [{n: item.get(n) for n in names} for item in items]
