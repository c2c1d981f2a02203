"""Record-level operators: deduplication (A1), TTL dropping (P8), JSON text in and out (K2, S3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENRICHED_SCHEMA, RR_SCHEMA


def drop_ttl(df: DataFrame) -> DataFrame:
    return df.drop("ttl")


def distinct_records(df: DataFrame, ignore_ttl: bool = True, partitions: int | None = None) -> DataFrame:
    """Distinct records (parse-stage semantics). One hash aggregate with a partial
    (map-side) step, so repeated records collapse before the shuffle; a hot record that
    makes up a third of the input leaves each map task as a single row.

    ``partitions`` is for many records that are mostly different: the partial step of a task that reads millions of them
    collapses little, and merging its spills takes more than a small heap. Then the records are shuffled as they are
    into that many partitions, and each is made distinct by itself; a hot record's copies meet in one task, as one group."""
    if ignore_ttl:
        df = drop_ttl(df)
    if partitions:
        df = df.repartition(partitions, *df.columns)
    return df.distinct()


def records_to_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Each record as one JSON object; NULL fields are left out (absent key)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(column))


def records_from_json(
    df: DataFrame,
    column: str = "json",
    schema: T.StructType | None = None,
    on_bad: str = "fail",
    observation: Observation | None = None,
) -> DataFrame:
    """Parse JSON record text into the fixed record schema.

    ``on_bad="fail"`` raises on the first malformed line (geo/filter/extract behaviour);
    ``"drop"`` skips such lines; ``"count"`` skips them and counts ``bad_records`` /
    ``records`` into ``observation`` in the same pass (storage behaviour); ``"keep"`` keeps
    them with all fields NULL and a ``_corrupt`` column holding the text.
    """
    schema = schema or ENRICHED_SCHEMA
    if on_bad not in ("fail", "drop", "count", "keep"):
        raise ValueError("on_bad must be 'fail', 'drop', 'count' or 'keep'")
    if on_bad == "count" and observation is None:
        raise ValueError("on_bad='count' needs an Observation")
    # One parse; malformed text lands in the corrupt-record field (or gives NULL).
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    r = F.from_json(F.col(column), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.select(r.alias("r"), F.col(column).alias("_text"))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    fields = [F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    if on_bad == "count":
        out = out.withColumn("__bad", bad).observe(
            observation, F.count_if(F.col("__bad")).alias("bad_records"), F.count_if(~F.col("__bad")).alias("records"))
        return out.where(~F.col("__bad")).select(*fields)
    if on_bad == "drop":
        return out.where(~bad).select(*fields)
    if on_bad == "fail":  # a filter, so the check stays even where no field is used
        refuse = F.raise_error(F.concat(F.lit("malformed record: "), F.substring("_text", 1, 200))).cast("boolean")
        return out.where(F.when(bad, refuse).otherwise(F.lit(True))).select(*fields)
    return out.select(*fields, F.when(bad, F.col("_text")).alias("_corrupt"))


def conform(df: DataFrame, schema: T.StructType = RR_SCHEMA) -> DataFrame:
    """Add any missing record field as a typed NULL column, keeping the existing ones."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def last_of_each_key(fields: Column) -> Column:
    """A map read from JSON, in which a repeated key keeps its last value only."""
    keys = F.array_distinct(F.map_keys(fields))
    backwards = F.reverse(F.map_entries(fields))
    last = F.transform(keys, lambda k: F.struct(k.alias("key"), F.filter(backwards, lambda e: e["key"] == k)[0]["value"].alias("value")))
    return F.when(F.size(keys) < F.size(fields), F.map_from_entries(last)).otherwise(fields)


def fields_from_json(lines: DataFrame, column: str = "json") -> DataFrame:
    """Records with any keys: ``fields map<string,string>`` per line (NULL for a line that is no JSON
    object; of a repeated key the last value counts) and ``failed``, an object with an explicit null, which
    no store can print."""
    m = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    out = lines.select(m.alias("fields")).select(last_of_each_key(F.col("fields")).alias("fields"))
    return out.withColumn("failed", F.coalesce(F.exists(F.map_values("fields"), lambda v: v.isNull()), F.lit(False)))


def partition_sorted(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in the order of ``cols``, in about equal partitions, each sorted (stage outputs sorted by key, per output
    file and over all of them). The splitters are sampled over the key and the row's place, so a
    key that holds a third of the rows takes several partitions in a row instead of one. Off by default: it costs
    a shuffle that no result needs."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    return placed.repartitionByRange(n, *cols, "__place").drop("__place").sortWithinPartitions(*cols)
