"""Streaming forms give the batch results on the same input."""

import os

from pyspark.sql import functions as F

from rrspark.operators.cells import event_generator
from rrspark.operators.decode import decode_responses
from rrspark.operators.geo import enrich_geo
from rrspark.operators.records import distinct_records
from rrspark.plans.fixtures import fixture
from rrspark.plans.wire_fixtures import record_responses
from rrspark.session import scratch_path
from rrspark.streaming.stream import read_response_stream, record_stream, start_cell_store, start_parquet_sink


def test_stream_matches_batch(spark, sf_dir):
    src = scratch_path(spark, "stream-src")
    record_responses(fixture(spark, sf_dir, "rr")).repartition(4).write.parquet(src)
    blocks = fixture(spark, sf_dir, "blocks")

    raw = read_response_stream(spark, src, max_files_per_trigger=2)
    out = scratch_path(spark, "stream-out")
    q = start_parquet_sink(record_stream(raw, blocks, "type = 'A'"), out, name="matches-batch")
    q.awaitTermination(300)
    got = spark.read.parquet(out)

    batch = enrich_geo(distinct_records(decode_responses(spark.read.parquet(src))), blocks).where("type = 'A'")
    cols = sorted(batch.columns)
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert batch.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_stream_cell_store(spark, sf_dir):
    src = scratch_path(spark, "stream-src2")
    record_responses(fixture(spark, sf_dir, "rr").where("type = 'MX'")).write.parquet(src)
    out = scratch_path(spark, "stream-cells-out")

    def sink(cells, batch_id):
        cells.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = start_cell_store(record_stream(read_response_stream(spark, src)), [event_generator("ev", "dns")], sink,
                         name=os.path.basename(out))
    q.awaitTermination(300)
    cells = spark.read.parquet(out)
    assert cells.count() > 0 and {r.cq for r in cells.select("cq").distinct().collect()} >= {"NAME", "TYPE", "TARGET"}


def test_stream_geo_above_the_broadcast_limit(spark, sf_dir):
    src = scratch_path(spark, "stream-src3")
    record_responses(fixture(spark, sf_dir, "rr").where("type = 'A'")).write.parquet(src)
    blocks = fixture(spark, sf_dir, "blocks")
    out = scratch_path(spark, "stream-out3")
    streamed = enrich_geo(decode_responses(read_response_stream(spark, src)), blocks, broadcast_rows=1)
    start_parquet_sink(streamed, out, name="above-the-limit").awaitTermination(300)
    batch = enrich_geo(decode_responses(spark.read.parquet(src)), blocks)
    assert sorted(map(str, spark.read.parquet(out).select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_restarted_stream_writes_nothing_twice(spark, sf_dir):
    src, out = scratch_path(spark, "stream-src4"), scratch_path(spark, "stream-out4")
    raw = record_responses(fixture(spark, sf_dir, "rr").where("type = 'MX'"))
    raw.limit(100).write.parquet(src)

    def run():
        stream = decode_responses(read_response_stream(spark, src))
        start_parquet_sink(stream, out, name="restarted").awaitTermination(300)
        return spark.read.parquet(out).count()

    assert run() == 100
    assert run() == 100
    raw.limit(10).write.mode("append").parquet(src)
    assert run() == 110
