"""Sources, sinks, storage and resolving where the data are not tidy."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rrspark.functions.wire import walk
from rrspark.operators.cells import event_cells, event_generator, map_event_generator
from rrspark.operators.resolve import resolve, resolve_with, valid_name
from rrspark.session import ensure_checkpoint_dir, scratch_path, scratch_scope, staged
from rrspark.operators.filters import observe_filter
from rrspark.sinks.files import (
    read_counters, store, store_json, write_by_type, write_cells, write_counted, write_records, write_responses,
)
from rrspark.sources.files import read_records, read_responses


def json_lines(spark, lines):
    path = scratch_path(spark, "json-lines")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    return path


def test_bad_lines_fail_count_or_go(spark):
    path = json_lines(spark, ['{"name":"a."}', "no json", '{"name":"b.","other":1}'])
    with pytest.raises(PySparkException):
        read_records(spark, path, "json").count()
    seen = Observation("bad")
    assert read_records(spark, path, "json", on_bad="count", observation=seen).count() == 2
    assert seen.get == {"bad_records": 1, "records": 2}
    assert read_records(spark, path, "json", on_bad="drop").where("cc IS NULL").count() == 2


def test_read_records_has_every_field(spark):
    path = scratch_path(spark, "conform")
    write_by_type(spark.createDataFrame([("a.", "MX"), ("b.", "A")], "name string, type string"), path)
    mx = read_records(spark, f"{path}/type=MX")
    assert [r["name"] for r in mx.where("type = 'MX' AND cc IS NULL").collect()] == ["a."]


def test_json_in_sequence_files(spark):
    path = scratch_path(spark, "json-seq")
    spark.sparkContext.parallelize([("k", '{"name":"a.","type":"A"}')]).saveAsNewAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.Text", valueClass="org.apache.hadoop.io.Text")
    assert [(r["name"], r["type"]) for r in read_records(spark, path, "sequence").collect()] == [("a.", "A")]


def test_counters_are_committed_with_the_output(spark):
    path = scratch_path(spark, "counted")
    df = spark.range(10).select(F.col("id").cast("string").alias("name"))
    for n in (4, 7):  # the second replaces the first
        kept, seen = observe_filter(df, f"name < {n}")
        got = write_counted(spark, path, lambda p: write_records(kept, p), lambda: seen.get)
        assert got == {"matched": n, "non_matched": 10 - n} == read_counters(spark, path)
        assert spark.read.parquet(path).count() == n

    def lost():
        raise OSError("the driver goes before the commit")

    with pytest.raises(OSError):
        write_counted(spark, path, lambda p: write_records(df, p), lost)
    assert spark.read.parquet(path).count() == 7 and read_counters(spark, path) == {"matched": 7, "non_matched": 3}


def test_sequence_output_honours_its_mode(spark):
    path = scratch_path(spark, "seq-mode")
    df = spark.createDataFrame([("q", bytearray(b"abc")), ("n", None)], "question string, wire binary")
    for _ in range(2):
        write_responses(df, path, format="sequence", mode="overwrite")
    assert read_responses(spark, path, "sequence").count() == 2
    with pytest.raises(FileExistsError):
        write_responses(df, path, format="sequence", mode="append")


def test_responses_by_pattern(spark):
    base = scratch_path(spark, "glob")
    df = spark.createDataFrame([("q", bytearray(b"abc"))], "question string, wire binary")
    write_responses(df, f"{base}/a")
    write_responses(df, f"{base}/b")
    assert read_responses(spark, f"{base}/*").count() == 2
    assert read_responses(spark, f"{base}/a", glob="*.none").count() == 0


def test_a_type_goes_to_few_files(spark):
    path = scratch_path(spark, "few-files")
    df = spark.range(8000, numPartitions=40).select(
        F.when(F.col("id") % 3 > 0, F.lit("A")).otherwise(F.concat(F.lit("T"), (F.col("id") % 5).cast("string"))).alias("type"),
        F.col("id").cast("string").alias("name"))
    write_by_type(df, path)
    files = [f for _, _, names in os.walk(path.replace("file:", "")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 12
    assert spark.read.parquet(path).count() == 8000


def test_storing_twice_changes_nothing_and_counters_agree(spark):
    lines = spark.createDataFrame([(x,) for x in ['{"a.b":"1","c":"X"}', '{"c":null}', "junk", '{"d":"2"}']], "json string")
    path = scratch_path(spark, "twice")
    for _ in range(2):
        got = store_json(lines, [map_event_generator("t.events", "x")], lambda cells: write_cells(cells, path))
        assert got == {"bad_records": 1, "failed_store": 1, "records_stored": 2, "total": 3}
        cells = spark.read.parquet(path)
        assert sorted((r["table_name"], r["cq"], r["value"]) for r in cells.collect()) == [
            ("t.events", "A.B", "1"), ("t.events", "C", "X"), ("t.events", "D", "2")]


def test_map_and_column_cells_agree_on_names_with_dots(spark):
    df = spark.createDataFrame([("1", "X"), (None, "y")], "`a.b` string, c string")
    rows = lambda d: sorted(map(str, d.collect()))
    by_column = rows(event_cells(df, "ns.events", "x"))
    lines = df.select(F.to_json(F.struct("*")).alias("json"))
    made = []
    store_json(lines, [map_event_generator("ns.events", "x")], lambda cells: made.extend(rows(cells.select(*event_cells(df, "t", "x").columns))))
    assert by_column == sorted(made)
    assert store(df, [event_generator("ns.events", "x")]).count() == 3


def test_a_response_beats_failures_and_uniqueness_is_checked(spark):
    key = "name string, type string, dclass string"
    reqs = spark.createDataFrame([("a.", "A", "IN"), ("b.", "A", "IN"), ("c.", "A", "IN")], key)
    ans = spark.createDataFrame(
        [("a.", "A", "IN", 1, "failure", None), ("a.", "A", "IN", 9, "ok", "NXDOMAIN"), ("a.", "A", "IN", 50, "ok", "NOERROR"),
         ("a.", "A", "IN", 30, "ok", "NOERROR"), ("b.", "A", "IN", 5, "timeout", None), ("b.", "A", "IN", 7, "failure", None)],
        key + ", ms long, outcome string, rcode string")
    got = sorted((r["name"], r["outcome"], r["rcode"], r["ms"]) for r in resolve(reqs, ans).collect())
    assert got == [("a.", "ok", "NOERROR", 30), ("b.", "failure", None, 7), ("c.", "timeout", None, None)]
    with pytest.raises(PySparkException):
        resolve(reqs, ans, answers_unique=True).collect()
    assert resolve(reqs, ans.dropDuplicates(["name"]), answers_unique=True).count() == 3


def test_lookups_get_their_name_server_and_time_their_construction(spark):
    reqs = spark.createDataFrame([("a.", "A", "IN"), ("b.", "A", "IN"), ("bad..", "A", "IN")], "name string, type string, dclass string")

    def factory(timeout):
        return lambda name, rtype, dclass, server: ("NOERROR", server.encode())

    rows = resolve_with(reqs, factory, threads=2, nameservers=["192.0.2.53", "198.51.100.53"]).collect()
    assert all(bytes(r["wire"]).decode() == r["nameserver"] for r in rows if r["outcome"] == "ok")
    assert all(r["total_ms"] >= r["construct_ms"] >= 0 for r in rows)
    assert sorted(r["outcome"] for r in rows) == ["ok", "ok", "parse_failure"]


@pytest.mark.parametrize("name,good", [
    ("é" * 31 + ".", True), ("é" * 32 + ".", False), ("a" * 63 + ".", True), ("a" * 64 + ".", False), (r"a\.b.", True),
    (r"\065\066.", True), ("a" * 62 + r"\046.", True), (".", True), ("a..", False), ("", False)])
def test_valid_name_counts_bytes(spark, name, good):
    assert spark.createDataFrame([(name,)], "name string").select(valid_name().alias("v")).first()["v"] == good


def test_names_behind_many_pointers_decode():
    # a name of a label, then 100 pointers each to the one before it
    buf = bytearray(b"\x00\x01\x80\x00\x00\x00\x00\x01\x00\x00\x00\x00")
    chain = bytearray(b"\x01a\x00")
    first = 12 + 11  # the owner name below is the root, so the rdata begins 11 bytes on
    at = first
    for _ in range(100):
        chain += bytes([0xC0 | at >> 8, at & 255])
        at = first + len(chain) - 2
    body = b"\x00" + b"\x00\x0a\x00\x01" + b"\x00\x00\x00\x00" + len(chain).to_bytes(2, "big") + bytes(chain)
    tail = bytes([0xC0 | at >> 8, at & 255]) + b"\x00\x01\x00\x01\x00\x00\x00\x00\x00\x04\x01\x02\x03\x04"
    buf[6:8] = b"\x00\x02"
    answers = walk(bytes(buf) + body + tail)[2][1]
    assert answers[1][0] == "a." and answers[1][4] == b"\x01\x02\x03\x04"


def test_scratch_tables_go_with_their_scope(spark):
    local = lambda p: p.replace("file:", "")
    kept = scratch_path(spark, "kept")
    with pytest.raises(KeyError), scratch_scope(spark):
        table = staged(spark.range(3), "inside")
        inside = table.inputFiles()[0].replace("file://", "")
        with scratch_scope(spark):
            inner = scratch_path(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(local(inner)) and os.path.exists(inside) and table.count() == 3
        spark.range(3).write.parquet(kept)
        raise KeyError
    assert not os.path.exists(inside) and os.path.exists(local(kept))


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
