"""Batched model scoring as a DataFrame step.

Rows stay in Arrow from end to end; only the scorer's input columns are turned into pandas, batch by
batch, and its outputs are appended (or overwrite columns of the same name). Batches are cut inside a
partition, so the step adds no shuffle; ``repartition`` first to change how many tasks call the model.
"""

from __future__ import annotations

import json
import threading
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sluice.operators import payloads
from sluice.schema import require_column, spark_type
from sluice.session import ship_package
from sluice.spec import ConfigError, InferenceSpec, TableSchema
from sluice.streaming.batching import collect_batches

# One batch in, one result per row out, in the same order; short results leave nulls.
Scorer = Callable[[pd.DataFrame], "pd.DataFrame | list[dict[str, Any]]"]
# Makes the scorer once per task, so that clients and models are set up where they are used.
ScorerFactory = Callable[[InferenceSpec], Scorer]

# Retries after the first call, and the first wait (doubled each time).
RETRIES = 3
FIRST_WAIT_SECONDS = 0.1

# So many times its own timeout a call waits for a place; only calls that never end make it wait so long.
_PATIENCE = 10

# Nullable pandas types keep whole numbers exact beside nulls.
_PANDAS = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.bool_(): pd.BooleanDtype(),
}

_REGISTRY: dict[str, ScorerFactory] = {}


def register_scorer(function_type: str, factory: ScorerFactory) -> None:
    """Offer ``factory`` for functions of this type (any case)."""
    _REGISTRY[function_type.lower()] = factory


def scorer_factory(spec: InferenceSpec) -> ScorerFactory:
    factory = _REGISTRY.get(spec.function_type.lower())
    if factory is None:
        raise ConfigError(
            f"function {spec.function_id!r}: no scorer for type {spec.function_type!r}; "
            f"known: {', '.join(sorted(_REGISTRY))}"
        )
    return factory


# --- calling a service ------------------------------------------------------------------------


def with_retry(
    call: Callable[[], Any], retries: int = RETRIES, wait: float = FIRST_WAIT_SECONDS, sleep=time.sleep, deadline: float | None = None
) -> Any:
    """Call, and on failure call again after ``wait``, twice that, and so on; never later than ``deadline`` (monotonic time)."""
    for attempt in range(retries + 1):
        pause = wait * 2**attempt
        try:
            return call()
        except Exception:
            if attempt == retries or (deadline is not None and time.monotonic() + pause >= deadline):
                raise
            sleep(pause)


def post_json(url: str, body: str, timeout: float, headers: dict[str, str]) -> str:
    """POST a JSON body; anything but a 2xx answer raises."""
    request = urllib.request.Request(
        url, data=body.encode(), headers={"Content-Type": "application/json", **headers}, method="POST"
    )
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode()


def http_scorer(spec: InferenceSpec, post=post_json) -> Scorer:
    """Send each batch to the function's service URL in its payload format.

    A batch has ``async_timeout_ms`` for all its attempts, so a call that is given up ends soon after.
    """
    if not spec.service_url:
        raise ConfigError(f"function {spec.function_id!r}: service_url is required")

    def score(batch: pd.DataFrame) -> list[dict[str, Any]]:
        body = payloads.encode_batch(batch, spec)
        allowed = spec.async_timeout_ms / 1000
        deadline = time.monotonic() + allowed
        tried = False

        def attempt() -> str:
            nonlocal tried
            left = deadline - time.monotonic() if tried else allowed
            tried = True
            if left <= 0:
                raise TimeoutError("no time is left for another attempt")
            return post(spec.service_url, body, left, spec.headers)

        answer = with_retry(attempt, deadline=deadline)
        return payloads.decode_answer(answer, spec, len(batch))

    return score


register_scorer("http", http_scorer)


class _Places:
    """How many calls may be alive at once, those given up among them, since they still burden the service."""

    def __init__(self, capacity: int, timeout: float):
        self._free = threading.BoundedSemaphore(capacity)
        self._patience = _PATIENCE * timeout

    def take(self) -> bool:
        """Wait for a place; false where calls that were given up hold all of them and do not end."""
        return self._free.acquire(timeout=self._patience)

    def leave(self) -> None:
        self._free.release()


class _Call:
    """A call on a thread of its own, which may be given up. Its time counts from its own start.

    A call given up keeps its place until it really ends.
    """

    def __init__(self, score: Scorer, batch: pd.DataFrame, timeout: float, places: _Places):
        self._outcome: list = []
        self._ended = threading.Event()
        if not places.take():
            self._end(None, TimeoutError("calls that were given up hold all places"))
            return
        self._deadline = time.monotonic() + timeout
        threading.Thread(target=self._run, args=(score, batch, places), daemon=True).start()

    def _end(self, value: Any, error: Exception | None) -> None:
        self._outcome.append((value, error))
        self._ended.set()

    def _run(self, score: Scorer, batch: pd.DataFrame, places: _Places) -> None:
        value = error = None
        try:
            value = score(batch)
        except Exception as e:  # handed to whoever asks for the result
            error = e
        places.leave()
        self._end(value, error)

    def result(self) -> Any:
        if not self._ended.is_set() and not self._ended.wait(max(self._deadline - time.monotonic(), 0)):
            raise TimeoutError("the call took too long")
        value, error = self._outcome[0]
        if error is not None:
            raise error
        return value


# --- the step ---------------------------------------------------------------------------------


def _chunks(frames: Iterator[pa.RecordBatch], size: int, batch_by: str | None) -> Iterator[tuple[pa.Table, list]]:
    """Arrow batches as (rows, where to cut them into model batches of ``size``).

    Rows that do not fill a batch move on to the next chunk, so that only a partition's last batch
    is short. With ``batch_by`` a batch holds one value of that column only: rows of a chunk are
    taken value by value, and nothing is moved on.
    """
    if batch_by is not None:
        for frame in frames:
            rows: dict[Any, list[int]] = {}
            for i, key in enumerate(frame.column(frame.schema.get_field_index(batch_by)).to_pylist()):
                rows.setdefault(key, []).append(i)
            cuts, at = [], 0
            for group in rows.values():
                cuts += [(at + i, at + min(i + size, len(group))) for i in range(0, len(group), size)]
                at += len(group)
            yield pa.Table.from_batches([frame]).take([i for group in rows.values() for i in group]), cuts
        return
    held: pa.Table | None = None
    for frame in frames:
        table = pa.Table.from_batches([frame])
        if held is not None:
            table = pa.concat_tables([held, table])
        whole = table.num_rows - table.num_rows % size
        if whole:
            yield table.slice(0, whole), [(i, i + size) for i in range(0, whole, size)]
        held = table.slice(whole) if whole < table.num_rows else None
    if held is not None:
        yield held, [(0, held.num_rows)]


def _collected(frames: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, list]]:
    """The same for rows that were collected on a stream: a batch's follow each other under one lane and number, and may
    go on in the next frame."""
    held: pa.Table | None = None
    for frame in frames:
        table = pa.Table.from_batches([frame])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        lane, number = (table.column(i).to_numpy() for i in (0, 1))
        starts = [0, *(np.flatnonzero((lane[1:] != lane[:-1]) | (number[1:] != number[:-1])) + 1).tolist()]
        last, held = starts[-1], table.slice(starts[-1])
        if last:
            yield table.slice(0, last).select(range(2, table.num_columns)).rename_columns(names), list(zip(starts, starts[1:]))
    if held is not None:
        yield held.select(range(2, held.num_columns)).rename_columns(names), [(0, held.num_rows)]


def _part(inputs: pd.DataFrame, start: int, stop: int) -> pd.DataFrame:
    return inputs.iloc[start:stop].reset_index(drop=True)


def _plain(value: Any) -> Any:
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


def _as_type(value: Any, target: pa.DataType) -> Any:
    """A scorer's value as the declared type; text from a service is read, not rejected."""
    value = _plain(value)
    if value is None:
        return None
    if pa.types.is_string(target):
        return value if isinstance(value, str) else json.dumps(value) if isinstance(value, (bool, list, dict)) else str(value)
    if pa.types.is_boolean(target):
        return value.strip().lower() == "true" if isinstance(value, str) else bool(value)
    if pa.types.is_integer(target):
        return int(value) if not isinstance(value, str) or value.lstrip("+-").isdigit() else int(float(value))
    if pa.types.is_floating(target):
        return float(value)
    if pa.types.is_decimal(target):
        return Decimal(str(value))
    return pd.Timestamp(value).to_pydatetime() if pa.types.is_timestamp(target) else value


def _results(raw: Any, fields: tuple[str, ...]) -> dict[str, Any]:
    """Scorer output as one list or series per field."""
    if isinstance(raw, pd.DataFrame):
        return {f: raw[f] if f in raw.columns else [] for f in fields}
    return {f: [r.get(f) for r in raw] for f in fields}


def _arrow_column(values: Any, rows: int, target: pa.DataType) -> pa.Array:
    """Padded with nulls and cut to the batch, as the declared type."""
    if isinstance(values, pd.Series):
        if len(values) == rows and values.dtype.kind in "biuf" and not pa.types.is_string(target):
            return pa.Array.from_pandas(values).cast(target, safe=False)
        values = values.tolist()
    filled = values[:rows] + [None] * (rows - len(values))
    return pa.array([_as_type(v, target) for v in filled], target)


def _output_schema(df: DataFrame, spec: InferenceSpec, declared: TableSchema | None) -> T.StructType:
    made = {}
    for name in spec.output_fields:
        field = declared.field(name) if declared else None
        if field is not None:
            made[name] = spark_type(field)
        else:
            made[name] = df.schema[name].dataType if name in df.columns else T.StringType()
    kept = [T.StructField(f.name, made.get(f.name, f.dataType), True) for f in df.schema.fields]
    new = [T.StructField(n, t, True) for n, t in made.items() if n not in df.columns]
    return T.StructType(kept + new)


def infer(
    df: DataFrame,
    spec: InferenceSpec,
    scorer: ScorerFactory | None = None,
    declared: TableSchema | None = None,
    batch_by: str | None = None,
) -> DataFrame:
    """Score ``df`` in batches of ``spec.batch_size`` and append the output fields.

    Outputs take the type ``declared`` gives them, else that of a column they overwrite, else text.
    A batch whose scorer raises or overruns its time is left out (SKIP), kept with null outputs
    (PASS_THROUGH) or fails the job (FAIL). ``scorer`` defaults to the one registered for the function's type. A task
    runs up to ``async_capacity`` calls at a time, so a scorer must bear calls from several threads. Each call has
    its own time from its start; one that overruns it is given up, but counts until it ends.

    On a stream a function that ``carries`` its rows over micro-batches gets full batches, or what there is after
    ``max_wait_ms``; the query must be in append mode.
    """
    for name in spec.input_fields:
        require_column(df.schema, name, f"function {spec.function_id!r} input")
    if batch_by is not None:
        require_column(df.schema, batch_by, f"function {spec.function_id!r} batch_by")
    factory = scorer if scorer is not None else scorer_factory(spec)
    out_schema = _output_schema(df, spec, declared)
    targets = {n: to_arrow_type(out_schema[n].dataType) for n in spec.output_fields}
    arrow_schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out_schema.fields])
    names = df.columns
    carried = df.isStreaming and spec.carries and batch_by is None

    def columns_of(rows: int, outcome: Callable[[], Any]) -> dict[str, pa.Array] | None:
        """One batch's outputs; None to leave its rows out."""
        try:
            # a value the declared type cannot hold is the scorer's failure too
            made = _results(outcome(), spec.output_fields)
            return {n: _arrow_column(values, rows, targets[n]) for n, values in made.items()}
        except Exception as e:
            if spec.failure_strategy == "FAIL":
                raise RuntimeError(f"function {spec.function_id}: batch of {rows} rows failed") from e
            return None if spec.failure_strategy == "SKIP" else {n: pa.nulls(rows, t) for n, t in targets.items()}

    def out_of(table: pa.Table, cuts: list, results: list[dict | None]) -> Iterator[pa.RecordBatch]:
        kept = [cut for cut, made in zip(cuts, results) if made is not None]
        if len(kept) < len(cuts):
            table = pa.concat_tables([table.slice(0, 0), *(table.slice(a, b - a) for a, b in kept)])
        made = {n: pa.chunked_array([r[n] for r in results if r is not None], t) for n, t in targets.items()}
        arrays = [made[f.name] if f.name in made else table.column(f.name).cast(f.type) for f in arrow_schema]
        yield from pa.Table.from_arrays(arrays, schema=arrow_schema).combine_chunks().to_batches()

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = factory(spec)
        timeout = spec.async_timeout_ms / 1000
        places = _Places(spec.async_capacity, timeout)
        waiting: deque[tuple[list, int, _Call]] = deque()  # calls on the way, across chunks
        chunks: deque[tuple[pa.Table, list, list]] = deque()

        def settle() -> None:
            results, rows, call = waiting.popleft()
            results.append(columns_of(rows, call.result))

        def finished() -> Iterator[pa.RecordBatch]:
            while chunks and len(chunks[0][1]) == len(chunks[0][2]):
                yield from out_of(*chunks.popleft())

        for table, cuts in _collected(frames, names) if carried else _chunks(frames, spec.batch_size, batch_by):
            inputs = table.select(list(spec.input_fields)).to_pandas(types_mapper=_PANDAS.get)
            results: list[dict | None] = []
            chunks.append((table, cuts, results))
            for start, stop in cuts:
                while len(waiting) >= spec.async_capacity:
                    settle()
                waiting.append((results, stop - start, _Call(score, _part(inputs, start, stop), timeout, places)))
            yield from finished()
        while waiting:
            settle()
        yield from finished()

    ship_package(df.sparkSession)
    return (collect_batches(df, spec) if carried else df).mapInArrow(run, out_schema)
