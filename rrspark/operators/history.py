"""Distinct records against all that was stored before (A1): a bucketed history table.

The history is a Parquet table bucketed by a digest of the whole record. A batch is reduced to its distinct
records, shuffled into the same buckets and anti-joined; the history itself is read bucket by bucket and never shuffled,
however large it is. The unseen records are added to it in the same buckets and returned.

A ``large`` batch is not shuffled either: every task writes its records into the buckets of a table of their own, and both
tables are then compared a range of keys at a time. Both are sorted by key in every file, so a range reads little of the others.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, scratch_scope, shuffles_removed, small_splits, staged
from ..sinks.hadoop import Folder
from .records import drop_ttl

KEY = "__key"
BUCKETS = 64
# Records of a bucket that a task compares at a time, about, where a batch is large.
SLICE_RECORDS = 1_000_000
# How tables of records are stored. Keys have nothing in common but their beginnings, which delta encoding leaves out.
STORED = {"compression": "zstd", "parquet.writer.version": "v2", f"parquet.enable.dictionary#{KEY}": "false", "parquet.block.size": 16 << 20}


def record_key(columns: list[str]) -> Column:
    """SHA-256 of the record's text form, absent fields left out."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])), 256)


class RecordHistory:
    """History of records of ``schema`` under ``path``; ``buckets`` holds for a new one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        folder = Folder(spark, self.path)
        folder.create("_buckets", str(buckets))
        self.buckets = int(folder.read("_buckets"))
        # the table is only this session's view of the folder: its definition comes from here, its files from there
        self.name = f"rrspark_history_{hashlib.sha1(self.path.encode()).hexdigest()[:16]}"
        self.folder = folder
        if not spark.catalog.tableExists(self.name):
            self._create(self.name, f"{self.path}/records")

    def _create(self, name: str, path: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*self.schema.fields, T.StructField(KEY, T.StringType())])
        options = ", ".join(f"'{k}' '{v}'" for k, v in STORED.items())
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({options}) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(name)

    def _table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def records(self) -> DataFrame:
        return self._table().drop(KEY)

    def _batch(self, batch: DataFrame, ignore_ttl: bool) -> DataFrame:
        batch = drop_ttl(batch) if ignore_ttl and "ttl" in batch.columns else batch
        if sorted(batch.columns) != sorted(self.schema.names):
            raise ValueError(f"the history holds {self.schema.names}, the batch {batch.columns}")
        return batch.select(*self.schema.names)

    def unseen(self, batch: DataFrame, ignore_ttl: bool = True) -> DataFrame:
        """The distinct records of ``batch`` that the history doesn't hold, with their key."""
        # staged, for Spark would join before it takes equal records together, and a hot record meet in one task
        keyed = staged(self._batch(batch, ignore_ttl).distinct().withColumn(KEY, record_key(self.schema.names)), "history-batch")
        # the batch goes to the buckets; without the hint a small history might be sent to every task instead
        return keyed.join(self._table().select(KEY).hint("merge"), KEY, "left_anti")

    def _write_unseen(self, batch: DataFrame, ignore_ttl: bool, place: str) -> None:
        """The records of ``unseen`` and their key to ``place``, without a shuffle."""
        keyed = self._batch(batch, ignore_ttl).withColumn(KEY, record_key(self.schema.names))
        name, path = f"rrspark_batch_{uuid.uuid4().hex}", scratch_path(self.spark, "history-batch")
        self._create(name, path)
        try:
            with small_splits(self.spark):
                self._append(keyed, name)
            records, known = self.spark.table(name), self._table().select(KEY).hint("merge")
            slices = max(1, -(-records.count() // (SLICE_RECORDS * self.buckets)))
            ends = [f"{(i << 16) // slices:04x}" for i in range(1, slices)]  # of keys, which are hex digits
            for low, high in zip([None, *ends], [*ends, None]):
                within = (F.col(KEY) >= low if low else F.lit(True)) & (F.col(KEY) < high if high else F.lit(True))
                found = records.where(within).distinct().join(known.where(within), KEY, "left_anti")
                found.write.mode("append").options(**STORED).parquet(place)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def add(self, batch: DataFrame, ignore_ttl: bool = True, large: bool = False) -> DataFrame:
        """Add the unseen records of ``batch`` and return them. Spark's committer shows them whole or not at all, so a
        batch that died is simply added again. One batch at a time. ``large`` is for a batch whose shuffle files the disks
        should not have to hold; a task then adds a file to each bucket that it has records of."""
        place = f"added/{uuid.uuid4().hex}"
        with scratch_scope(self.spark), shuffles_removed(self.spark):
            if large:
                self._write_unseen(batch, ignore_ttl, f"{self.path}/{place}")
            else:
                self.unseen(batch, ignore_ttl).write.options(**STORED).parquet(f"{self.path}/{place}")
        added = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(KEY, T.StringType())])).parquet(f"{self.path}/{place}")
        before = set(self.folder.names("records"))
        with small_splits(self.spark), shuffles_removed(self.spark):
            self._append(added if large else added.repartition(self.buckets, KEY), self.name)  # a task a bucket, so a batch adds a file a bucket
        self.folder.delete(place)
        files = [f"{self.path}/records/{n}" for n in self.folder.names("records") if n.endswith(".parquet") and n not in before]
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)
