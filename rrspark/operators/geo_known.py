"""Addresses looked up once and kept (J4): a stored address table per version of the range tables.

A batch of records brings mostly addresses seen before. Those are read back from the store, only the others are looked
up, and what these give is added. The store is Parquet by version, a fingerprint of the range tables' rows, so
other ranges never meet old answers; every batch adds a folder that Spark's committer shows whole or not at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import GEO_FIELDS
from ..session import staged
from ..sinks.hadoop import Folder
from .geo import enrich_geo

KNOWN = T.StructType([T.StructField(c, T.StringType()) for c in ("addr", *GEO_FIELDS)])


def range_version(*tables: DataFrame | None) -> str:
    """The same for tables of the same rows, whatever their order: their number and the sum and the exclusive or of
    their hashes, column by column name."""
    parts = []
    for t in tables:
        if t is not None:
            h = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(t.columns)])
            n, total, mixed = t.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first()
            parts.append(f"{n}-{(total or 0) & 0xFFFFFFFFFFFF:x}-{(mixed or 0) & 0xFFFFFFFFFFFFFFFF:x}")
        else:
            parts.append("none")
    return "_".join(parts)


class KnownAddresses:
    """The store under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, self.path)

    def read(self, version: str) -> DataFrame:
        """Address and its fields; an address that two batches added side by side may be there twice."""
        batches = [n for n in self.folder.names(version) if self.folder.exists(f"{version}/{n}/_SUCCESS")]
        if not batches:
            return self.spark.createDataFrame([], KNOWN)
        return self.spark.read.schema(KNOWN).parquet(*[f"{self.path}/{version}/{n}" for n in batches])

    def add(self, rows: DataFrame, version: str) -> DataFrame:
        """``rows`` stored, and read back."""
        place = f"{self.path}/{version}/{uuid.uuid4().hex}"
        rows.select(*KNOWN.names).write.option("compression", "zstd").parquet(place)
        return self.spark.read.schema(KNOWN).parquet(place)

    def forget(self, keep: str) -> None:
        """Delete all versions but one."""
        for name in self.folder.names():
            if name != keep:
                self.folder.delete(name)


def enrich_geo_known(df: DataFrame, blocks: DataFrame, store: KnownAddresses, asn: DataFrame | None = None,
                     version: str | None = None, **limits) -> DataFrame:
    """``enrich_geo`` with the addresses of earlier batches taken from ``store``. ``version`` names the range tables;
    by default it is made of their rows, which costs a pass over them.

    The batch is staged, as its addresses are needed first. The store is only joined with the batch's distinct addresses:
    where these are few they are broadcast to it, or Spark's runtime filter keeps the rest of it from
    the shuffle.
    """
    version = version or range_version(blocks, asn)
    cols = df.columns
    for f in GEO_FIELDS:
        if f not in cols:
            df = df.withColumn(f, F.lit(None).cast("string"))
    df = staged(df, "geo-batch")
    with_addr = df.where("addr IS NOT NULL")
    asked = staged(with_addr.select("addr").distinct(), "geo-addresses")
    seen = staged(store.read(version).join(asked, "addr", "left_semi").dropDuplicates(["addr"]), "geo-seen")
    unseen = asked.join(seen.select("addr"), "addr", "left_anti")
    new = store.add(enrich_geo(unseen, blocks, asn=asn, **limits), version)
    found = seen.unionByName(new).select("addr", *[F.col(f).alias(f"__{f}") for f in GEO_FIELDS])
    joined = with_addr.join(found, "addr", "left").withColumns({f: F.coalesce(f"__{f}", f) for f in GEO_FIELDS})
    out = [*cols, *[f for f in GEO_FIELDS if f not in cols]]
    return joined.select(*out).unionByName(df.where("addr IS NULL").select(*out))
