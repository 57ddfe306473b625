"""Message sources: a Kafka topic, or text files with one message per line.

Both give ``value`` and ``_src``, a struct that orders messages of one source partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import ship_package
from sluice.spec import KafkaSpec

SOURCE_COLUMN = "_src"


def kafka_options(spec: KafkaSpec, min_partitions: int | None = None, group: str = "") -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": spec.bootstrap_servers,
        "subscribe": spec.topic,
        "kafka.group.id": f"{spec.group_id}-{group}" if group else spec.group_id,
    }
    if spec.starting_offset == "timestamp":
        options["startingTimestamp"] = str(spec.starting_timestamp)
        options["startingOffsetsByTimestampStrategy"] = "latest"  # past the newest record: wait for the next one
    else:
        options["startingOffsets"] = spec.starting_offset
    if min_partitions is not None and min_partitions > 1:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, spec: KafkaSpec, min_partitions: int | None = None, group: str = "") -> DataFrame:
    """Endless stream of message values; needs the Kafka connector on the class path.

    ``group`` sets a second reader of one topic apart from the first.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(spec, min_partitions, group)).load()
    return raw.select("value", F.struct("offset", "partition").alias(SOURCE_COLUMN))


def _number_lines(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = 0
    for frame in frames:
        yield frame.append_column("line", pa.array(range(at, at + frame.num_rows), pa.int64()))
        at += frame.num_rows


def read_files(spark: SparkSession, path: str, streaming: bool = False, ordered: bool = True, **options: str) -> DataFrame:
    """One message per line, as a stream of arriving files or as a batch replay.

    Messages are ordered by file time, file, and place in the file. A stream has no built-in row
    counter, so the lines of its tasks pass through Python in Arrow batches to be counted. Where the order of
    one file's lines decides nothing (no key, or a ``sequence.field``), ``ordered=False`` spares that.
    """
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("text").options(**options).load(path)
    place = ["time", "file", "block"]
    rows = raw.select(
        "value",
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    if ordered:
        place.append("line")
        if streaming:
            ship_package(spark)
            rows = rows.mapInArrow(_number_lines, T.StructType([*rows.schema.fields, T.StructField("line", T.LongType())]))
        else:
            rows = rows.withColumn("line", F.monotonically_increasing_id())
    return rows.select("value", F.struct(*place).alias(SOURCE_COLUMN))
