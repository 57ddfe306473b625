"""Tables kept at one row per primary key, on plain Parquet folders.

An upsert replaces whole rows by key and rewrites only the folders (partition keys and key bucket)
the batch touches. It works in three steps so that a lost executor or driver never loses rows:

1. the batch is evaluated once and written beside the table, one row per key;
2. the touched folders are merged with it into a staging folder beside the table;
3. each merged folder is moved to the place of the live one, which writes nothing again. If a run
   died here, ``read`` takes the folders still in staging from there, and the next upsert (or
   ``recover``) moves them.

Folders of a text partition key are named by a marked copy of it, ``_p_<key>``, since Spark stores an empty
text as no text there; the key itself is a column of the files. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.enrich import latest_per_key
from sluice.schema import check_on_null, conform, null_violations, ref, spark_type, struct_type
from sluice.session import path_exists, remove_path, replace_folder, subfolders
from sluice.spec import ConfigError, TableSchema

BUCKET_COLUMN = "_bucket"
_NEW = "_incoming"
# Folders moved at a time; each move is a few calls to the file system.
_MOVES = 16


def folder_column(schema: TableSchema, key: str) -> str:
    """The column that names the folders of a partition key."""
    return f"_p_{key}" if isinstance(spark_type(schema.field(key)), T.StringType) else key


def with_folders(df: DataFrame, schema: TableSchema) -> DataFrame:
    """``df`` with the folder columns of text partition keys."""
    for key in schema.partition_keys:
        if (name := folder_column(schema, key)) != key:
            df = df.withColumn(name, F.concat(F.lit("v"), ref(key)))
    return df


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], sequence: Sequence[str] = ()) -> DataFrame:
    """``existing`` with the rows of ``incoming`` put in place by key; both have one row per key.

    With ``sequence`` fields the row of the higher sequence stays, whichever batch it came in; an equal one is replaced.
    """
    if sequence:
        both = existing.withColumn(_NEW, F.lit(0)).unionByName(incoming.withColumn(_NEW, F.lit(1)))
        return latest_per_key(both, keys, [*sequence, _NEW]).drop(_NEW)
    untouched = existing.join(incoming.select(*(ref(k) for k in keys)), list(keys), "left_anti")
    return untouched.unionByName(incoming)


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    schema: TableSchema
    buckets: int = 8
    changelog: bool = False
    name: str | None = None  # set when the table is registered in the session catalog
    sequence: tuple[str, ...] = ()  # fields that order the rows of a key, across batches too

    def __post_init__(self):
        if not self.schema.primary_keys:
            raise ConfigError(f"table {self.schema.table!r}: an upsert needs a primary key")
        for name in self.sequence:
            if name not in self.schema.names:
                raise ConfigError(f"table {self.schema.table!r}: sequence field {name!r} is not a declared field")

    @property
    def layout(self) -> list[str]:
        return [*(folder_column(self.schema, k) for k in self.schema.partition_keys), BUCKET_COLUMN]

    def _beside(self, what: str) -> str:
        return f"{self.path.rstrip('/')}__{what}"

    @property
    def changelog_path(self) -> str:
        return self._beside("changelog")

    @property
    def _staging(self) -> str:
        return self._beside("staged")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*(ref(k) for k in self.schema.primary_keys)), F.lit(self.buckets))
        return with_folders(df, self.schema).withColumn(BUCKET_COLUMN, bucket.cast("int"))

    @property
    def _stored(self) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType, True) for f in struct_type(self.schema).fields]
        marks = [T.StructField(n, T.StringType()) for n in self.layout if n.startswith("_p_") and n not in self.schema.names]
        return T.StructType([*fields, *marks, T.StructField(BUCKET_COLUMN, T.IntegerType())])

    def _read_folder(self, path: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(path)

    def _same_folder(self, a: str, b: str) -> Column:
        return reduce(lambda x, y: x & y, (F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in self.layout))

    def _in_folders(self, rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
        """``rows`` in (``left_semi``) or not in (``left_anti``) the folders that ``of`` has rows for."""
        folders = of.select(*(ref(c) for c in self.layout)).distinct()
        return rows.alias("r").join(folders.alias("f"), self._same_folder("r", "f"), how)

    def _staged(self) -> list[str]:
        """Complete staging folders of an interrupted upsert."""
        if not path_exists(self.spark, self._staging):
            return []
        names = [f"{self._staging}/{batch}" for batch in subfolders(self.spark, self._staging, 2)]
        return [n for n in names if path_exists(self.spark, f"{n}/_SUCCESS")]

    def read(self) -> DataFrame:
        """The current rows, one per key."""
        rows = self._read_folder(self.path)
        for staged in self._staged():
            waiting = self._read_folder(staged)
            rows = self._in_folders(rows, waiting, "left_anti").unionByName(waiting)
        return rows.select(*(ref(n) for n in self.schema.names))

    # --- folders ------------------------------------------------------------------------------

    def _check_layout(self) -> None:
        """The bucket count is fixed when the table is first written, since it decides where a key is."""
        path = self._beside("layout")
        if path_exists(self.spark, path):
            found = self.spark.read.schema("buckets int").json(path).first()[0]
            if found != self.buckets:
                raise ConfigError(f"table {self.schema.table!r} was written with {found} buckets, not {self.buckets}")
        else:
            self.spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.json(path)

    def _fold(self, incoming: DataFrame, staged: str) -> None:
        """Put rows, one per key, into the folders they belong to.

        The touched folders are picked by a join with the batch's own, which prunes partitions where that side is small
        enough to be broadcast, and works alike at any size.
        """
        if incoming.isEmpty():
            return
        stored = self._in_folders(self._read_folder(self.path), incoming.filter(ref(BUCKET_COLUMN) >= 0), "left_semi")
        self._stage_merged(merge_rows(stored, incoming, self.schema.primary_keys, self.sequence), staged)
        self._publish(staged)
        remove_path(self.spark, staged)

    def _stage_merged(self, merged: DataFrame, path: str) -> None:
        # rebalance: one task per folder, but a big folder is split over several
        even = merged.hint("rebalance", *(ref(c) for c in self.layout))
        even.write.mode("overwrite").partitionBy(*self.layout).parquet(path)

    def _publish(self, staged: str) -> None:
        """Move every staged folder to the place of the live one."""
        folders = subfolders(self.spark, staged, len(self.layout))

        def move(folder: str) -> bool:
            return replace_folder(self.spark, f"{staged}/{folder}", f"{self.path.rstrip('/')}/{folder}")

        with ThreadPoolExecutor(_MOVES) as pool:
            new = list(pool.map(move, folders))
        if self.name is None:
            self.spark.catalog.refreshByPath(self.path)
            return
        if any(new):
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def upsert(
        self,
        rows: DataFrame,
        batch_id: int | str,
        run_id: str = "batch",
        order_by: Sequence[str | Column] = (),
        on_null: str = "fail",
    ) -> None:
        """Put the batch's latest row per key into the table; repeating a batch changes nothing.

        ``run_id`` tells runs apart in the change log and among rejected rows. ``order_by`` decides between rows of
        one key in the batch. A row with an empty required field fails the batch, is dropped
        (``on_null="drop"``) or set aside under ``<path>__rejected`` (``"quarantine"``).
        """
        check_on_null(on_null)
        self._check_layout()
        self.recover()
        incoming = self._beside("incoming")
        if path_exists(self.spark, incoming):
            remove_path(self.spark, incoming)  # of a run that did not end
        here = f"{incoming}/{uuid.uuid4().hex}"
        self._write_incoming(rows, f"{here}/latest", here, batch_id, run_id, order_by, on_null)
        self._fold(self._read_folder(f"{here}/latest"), f"{self._staging}/{run_id}/{batch_id}")
        remove_path(self.spark, incoming)

    def recover(self) -> None:
        """Finish what an interrupted upsert had merged but not yet moved; every upsert starts so."""
        if not path_exists(self.spark, self._staging):
            return
        for batch in subfolders(self.spark, self._staging, 2):
            staged = f"{self._staging}/{batch}"
            if path_exists(self.spark, f"{staged}/_SUCCESS"):
                self._publish(staged)
            remove_path(self.spark, staged)

    def _write_incoming(self, rows, target, stage, batch_id, run_id, order_by, on_null) -> None:
        """Evaluate the batch once: checked, one row per key, with its bucket."""
        names = [o for o in order_by if isinstance(o, str)]
        extra = tuple(n for n in names if n not in self.schema.names)
        if on_null == "quarantine":
            rows = set_aside(rows, self.schema, self.path, stage, batch_id, run_id)
        accepted = conform(rows, self.schema, "drop" if on_null == "drop" else "fail", keep=extra)
        if self.changelog:
            accepted = self._log(accepted, batch_id, run_id)
        latest = latest_per_key(accepted, self.schema.primary_keys, order_by)
        self._bucketed(latest.select(*(ref(n) for n in self.schema.names))).write.mode("overwrite").parquet(target)

    def _log(self, accepted: DataFrame, batch_id, run_id) -> DataFrame:
        """Append the accepted rows to the change log and go on from the written copy."""
        write_batch(accepted, self.changelog_path, batch_id, run_id)
        folder = f"{self.changelog_path}/_run={run_id}/_batch={batch_id}"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], accepted.schema)
        return self.spark.read.schema(accepted.schema).parquet(folder)


def set_aside(rows: DataFrame, schema: TableSchema, path: str, stage: str, batch_id, run_id) -> DataFrame:
    """Store the rows that leave a required field empty under ``<path>__rejected`` and return the others."""
    # evaluated once into staging, then split
    rows.write.mode("overwrite").parquet(f"{stage}/rows")
    rows = rows.sparkSession.read.schema(rows.schema).parquet(f"{stage}/rows")
    bad = null_violations(rows, schema)
    write_batch(rows.filter(bad), path.rstrip("/") + "__rejected", batch_id, run_id)
    return rows.filter(~bad)


def write_batch(df: DataFrame, path: str, batch_id, run_id, partitions: Sequence[str] = ()) -> None:
    """Write one batch's folders; writing it again replaces them."""
    spark, folder = df.sparkSession, f"{path.rstrip('/')}/_run={run_id}/_batch={batch_id}"
    if path_exists(spark, folder):
        remove_path(spark, folder)
    tagged = df.withColumn("_run", F.lit(str(run_id))).withColumn("_batch", F.lit(str(batch_id)))
    tagged.write.mode("append").partitionBy("_run", "_batch", *partitions).parquet(path)
