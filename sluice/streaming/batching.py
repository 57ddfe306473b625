"""Model batches of a stream that fill up over micro-batches.

A micro-batch's partitions are cut into full batches where they are, which go on in blocks of a few thousand rows. Only the
rows that do not fill a batch of their partition are dealt to the lanes of a stream, each of which collects them until a
batch is full or its first row has waited long enough; so no lane, and no task, has more than a batch of each partition
beside its share of the blocks. The clock is looked at whenever a micro-batch runs, so a batch may wait for the trigger's interval beyond its time.
The query needs the state store that :data:`sluice.streaming.processors.STORE` names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schema import ref
from sluice.spec import InferenceSpec
from sluice.streaming.processors import BatchCollector


# A block has about so many rows, and at least one batch.
_BLOCK_ROWS = 4096


def _blocks(frames: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows with their ``block``: the number of its first batch, counted in the partition; null where they fill no batch."""
    number, most = TaskContext.get().partitionId() << 40, max(1, _BLOCK_ROWS // size) * size
    held: pa.Table | None = None

    def marked(rows: pa.Table, block: int | None) -> list[pa.RecordBatch]:
        column = pa.array([block] * rows.num_rows, pa.int64())
        return rows.append_column("block", column).combine_chunks().to_batches()

    for frame in frames:
        table = pa.Table.from_batches([frame])
        if held is not None:
            table = pa.concat_tables([held, table])
        whole = table.num_rows - table.num_rows % size
        for at in range(0, whole, most):
            block = table.slice(at, min(most, whole - at))
            yield from marked(block, number)
            number += block.num_rows // size
        held = table.slice(whole)
    if held is not None:
        yield from marked(held, None)


def collect_batches(df: DataFrame, spec: InferenceSpec) -> DataFrame:
    """The rows of ``df`` batch by batch: ``lane`` (-1 for batches of one partition), ``number`` (of the batch, different
    for each that is given out in a lane) and the columns as ``c0``, ``c1``, ... in their order. At most
    ``spec.batch_size`` rows follow each other under one number."""
    row = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(df.schema.fields)])
    dealt = df.select(*(ref(name).alias(f"c{i}") for i, name in enumerate(df.columns)))
    size, block = spec.batch_size, T.StructField("block", T.LongType())
    dealt = dealt.mapInArrow(lambda frames: _blocks(frames, size), T.StructType([*row.fields, block]))
    # Drawn by a fixed seed, not by the row, so that repeated rows do not meet in one lane.
    lane = F.when(F.col("block").isNull(), F.floor(F.rand(17) * spec.lanes)).otherwise(-1).cast("int").alias("lane")
    dealt = dealt.select(lane, F.coalesce("block", F.lit(0)).alias("block"), *row.names)
    made = T.StructType([T.StructField("lane", T.IntegerType()), T.StructField("number", T.LongType()), *row.fields])
    collector = BatchCollector(spec.batch_size, spec.max_wait_ms, row)
    return dealt.groupBy("lane", "block").transformWithState(collector, made, "append", "processingTime")
