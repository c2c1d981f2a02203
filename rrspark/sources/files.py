"""Sources (S1-S5): domain lists, raw responses, JSON records, geo and owner range tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.records import conform, records_from_json
from ..schema import ENRICHED_SCHEMA
from .sequence import read_sequence

RESPONSE_SCHEMA = T.StructType([T.StructField("question", T.StringType()), T.StructField("wire", T.BinaryType())])


def read_domains(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Domain list: one line per row (column ``domain``), blank lines kept. Files are split
    by block like any text input, so one large list still spreads over many tasks."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).withColumnRenamed("value", "domain")


def read_responses(spark: SparkSession, path: str, format: str = "parquet", glob: str | None = None) -> DataFrame:
    """Raw responses ``question string, wire binary``: a file, a directory or a path pattern, with
    ``glob`` only the files whose names match. ``format="sequence"`` reads Hadoop SequenceFiles of
    (Text question, BytesWritable wire), split at their sync markers."""
    if format == "parquet":
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        return reader.schema(RESPONSE_SCHEMA).parquet(path)
    if format == "sequence":
        found = read_sequence(spark, f"{path.rstrip('/')}/{glob}" if glob else path)
        return found.select(F.col("key").alias("question"), F.col("value").alias("wire"))
    raise ValueError(f"unknown format {format!r}")


def read_json_lines(spark: SparkSession, path: str, format: str = "json", glob: str | None = None, column: str = "value") -> DataFrame:
    """Column ``json``: text lines, or one ``column`` (``key`` or ``value``) of SequenceFiles of (Text, Text). With ``glob``
    only the files whose names match."""
    if format in ("json", "text"):
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        return reader.text(path).withColumnRenamed("value", "json")
    if format == "sequence":
        found = read_sequence(spark, f"{path.rstrip('/')}/{glob}" if glob else path, binary=False)
        return found.select(F.col(column).alias("json"))
    raise ValueError(f"unknown format {format!r}")


def read_records(spark: SparkSession, path: str, format: str = "parquet", on_bad: str = "fail",
                 observation: Observation | None = None, glob: str | None = None) -> DataFrame:
    """Records: Parquet (the engine's own form), JSON text lines or JSON in SequenceFiles. Every field of
    the record schema is there, NULL where the data lack it, also ``type`` of a ``type=MX``
    directory. ``observation`` takes the counts of ``on_bad="count"``."""
    if format == "parquet":
        parent, _, last = path.rstrip("/").rpartition("/")
        reader = spark.read.option("basePath", parent) if last.startswith("type=") else spark.read
        reader = reader.option("pathGlobFilter", glob) if glob else reader
        return conform(reader.parquet(path), ENRICHED_SCHEMA)
    return records_from_json(read_json_lines(spark, path, format, glob), "json", on_bad=on_bad, observation=observation)


def read_ranges(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """Location or owner range table (``start_ip``, ``end_ip`` as longs plus fields); ``pathGlobFilter`` and other
    reader settings are options."""
    df = spark.read.format(format).options(**options).load(path)
    return df.withColumns({"start_ip": F.col("start_ip").cast("long"), "end_ip": F.col("end_ip").cast("long")})
