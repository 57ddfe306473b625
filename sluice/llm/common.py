"""What the operators share: table access, written intermediate results, word rules, byte buffers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import apply_conf, shared_dir, ship_package

#: A word, as the contracts define it; the six separators are ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings and the package's code on the workers."""
    apply_conf(spark)
    # Rows of texts vary in size by thousands of times, so batches to Python are bounded in bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder in the area that all executors share."""
    return f"{shared_dir(spark)}/sluice-llm/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` computed once into the shared area and read back, so that lost executors cost no rework."""
    folder = new_folder(df.sparkSession, what)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Keys that a task may hold as a whole (some ten megabytes); with more, both sides of a join are shuffled.
MOST_BROADCAST = 1 << 20


def sized(rows: DataFrame) -> DataFrame:
    """``rows`` (small ones, written) to be sent to all tasks if they are few, and as they are otherwise."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def only(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` with a ``key`` (a long) among the distinct ``ids``, which are written: counted first, and sent to all
    tasks only if there are few."""
    return df.join(sized(ids), key, "left_semi")


#: The whole input row as one column, so that none of its names can meet those an operator adds beside it.
ROW = "row"


def held(docs: DataFrame, **beside: Column) -> DataFrame:
    """``docs`` with each row whole in the struct column ``ROW``, and the columns ``beside`` it, which are made of the row's."""
    return docs.select(F.struct("*").alias(ROW), *(c.alias(name) for name, c in beside.items()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: inside lambdas Catalyst may inline it otherwise."""
    return F.transform(F.array(value), body)[0]


class Slice(NamedTuple):
    """Whole texts side by side: ``data[starts[i]:ends[i]]`` is row ``first + i``; one gap byte follows each."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def slices(texts: pa.Array, gap: int, most: int = 2 << 20) -> Iterator[Slice]:
    """The UTF-8 bytes of ``texts`` (null: empty) in slices of about ``most`` bytes; a longer text comes alone."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, at, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        last = min(last, n)
        lengths = np.diff(at[first : last + 1])
        k = last - first
        starts = at[first:last] - at[first] + np.arange(k)
        whole = np.full(int(at[last] - at[first]) + k, gap, np.uint8)
        keep = np.ones(len(whole), bool)
        keep[starts + lengths] = False
        whole[keep] = raw[at[first] : at[last]]
        yield Slice(first, whole, starts, starts + lengths)
        first = last


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a list column from their values laid end to end."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
