"""Helpers shared by the corpus operators: reading tables, staging, Arrow stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rrspark.session import ship_package
from rrspark.session import staged as stage  # noqa: F401  used by the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(fn: Run) -> Run:
    """``fn``, and at its end what it freed goes back: a worker goes on to other stages, beside an executor that needs it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def arrow_map(df: DataFrame, fn: Run, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(giving_back(fn), schema)


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id written as decimal text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scalar_int(value: object) -> int:
    return int(value) if value is not None else 0
