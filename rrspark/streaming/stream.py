"""The same operators over unbounded input (Structured Streaming).

Decode, filter, geo enrichment (against a static, broadcast range table), extraction and
cell generation are per-record and run unchanged on a streaming DataFrame. Deduplication
needs state: records have no event time, so an arrival time is added and duplicates are
dropped within a watermark delay, which bounds the state kept per key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cells import Generator, generate_cells
from ..operators.decode import decode_responses
from ..operators.filters import filter_records
from ..operators.geo import enrich_geo
from ..session import named_path
from ..sinks.store import CellStore
from ..sources.files import RESPONSE_SCHEMA

ARRIVAL = "arrival"


def read_response_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of raw responses (``question, wire``) under ``path``."""
    reader = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_arrival(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Stamp records with their processing time and set a watermark on it."""
    return df.withColumn(ARRIVAL, F.current_timestamp()).withWatermark(ARRIVAL, delay)


def dedupe_stream(records: DataFrame, delay: str = "1 hour", ignore_ttl: bool = True) -> DataFrame:
    """Distinct records of a stream: a record seen again within ``delay`` of its first
    arrival is dropped; state for a key is released once the watermark passes."""
    if ignore_ttl and "ttl" in records.columns:
        records = records.drop("ttl")
    keys = [c for c in records.columns if c != ARRIVAL]
    if ARRIVAL not in records.columns:
        records = with_arrival(records, delay)
    return records.dropDuplicatesWithinWatermark(keys)


def record_stream(raw: DataFrame, blocks: DataFrame | None = None, filter_expr: str | None = None,
                  delay: str = "1 hour", txt_mode: str = "record") -> DataFrame:
    """raw responses -> decoded -> deduplicated (within ``delay``) -> enriched -> filtered."""
    recs = dedupe_stream(decode_responses(raw, txt_mode=txt_mode), delay)
    if blocks is not None:
        recs = enrich_geo(recs, blocks)  # static side
    if filter_expr:
        recs = filter_records(recs, filter_expr)
    return recs


def start_parquet_sink(stream: DataFrame, path: str, checkpoint: str | None = None,
                       available_now: bool = True, name: str = "rrspark") -> StreamingQuery:
    """Append the stream to Parquet; progress is kept in ``checkpoint`` (by default a folder of
    this ``name`` and output path under the session's shared checkpoint dir), so a restarted query
    resumes where it was."""
    spark = stream.sparkSession
    place = hashlib.sha1(path.encode()).hexdigest()[:12]
    checkpoint = checkpoint or named_path(spark, f"stream-{name}-{place}")
    w = stream.drop(ARRIVAL) if ARRIVAL in stream.columns else stream
    writer = w.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(path)


def run_sink(store: CellStore, name: str, compact_every: int = 0) -> Callable[[DataFrame, int], None]:
    """A sink for ``start_cell_store``: each micro-batch is a run of the keyed store, so a batch that is
    repeated after a restart is stored and counted once. Compacts after every ``compact_every`` batches."""
    def sink(cells: DataFrame, batch_id: int) -> None:
        store.add(cells, f"{name}-{batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact()
    return sink


def start_cell_store(records: DataFrame, generators: Sequence[Generator],
                     sink: Callable[[DataFrame, int], None], checkpoint: str | None = None,
                     available_now: bool = True, name: str = "rrspark-cells") -> StreamingQuery:
    """Storage step on a stream: each micro-batch's cells go to ``sink(cells, batch_id)``
    (``foreachBatch``); make the sink idempotent per ``batch_id`` for exactly-once output, as
    ``run_sink`` is. Progress is kept by ``name``, which must be the query's own."""
    spark = records.sparkSession
    checkpoint = checkpoint or named_path(spark, f"stream-{name}")
    recs = records.drop(ARRIVAL) if ARRIVAL in records.columns else records

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(generate_cells(batch, generators), batch_id)

    w = recs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
