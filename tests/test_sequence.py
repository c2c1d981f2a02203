"""SequenceFiles: what Hadoop writes is read, what is written Hadoop reads, files split at their markers."""

import random

import pyarrow.fs as pafs
import pytest
from pyspark.errors import PySparkException

from rrspark.session import arrow_filesystem, scratch_path
from rrspark.sources.files import read_json_lines, read_records, read_responses
from rrspark.sources.sequence import Header, files_of, read_sequence, records, to_vint, vint, write_sequence

TEXT, BYTES = "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable"


def hadoop_write(spark, rows, path, value, parts=2, kind=None, codec="DefaultCodec"):
    conf = {} if kind is None else {
        "mapreduce.output.fileoutputformat.compress": "true", "mapreduce.output.fileoutputformat.compress.type": kind,
        "mapreduce.output.fileoutputformat.compress.codec": f"org.apache.hadoop.io.compress.{codec}"}
    spark.sparkContext.parallelize(rows, parts).saveAsNewAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat", keyClass=TEXT, valueClass=value, conf=conf)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    sizes = [0, 1, 100, 127, 128, 300, 5000]
    return [(f"k{i}é" * rng.choice([1, 1, 60]), rng.randbytes(rng.choice(sizes))) for i in range(4000)] + [("", b"\xff" * 40)]


@pytest.mark.parametrize("kind,codec", [(None, None), ("RECORD", "DefaultCodec"), ("BLOCK", "DefaultCodec"), ("BLOCK", "GzipCodec"),
                                        ("RECORD", "BZip2Codec")])
def test_files_of_hadoop(spark, rows, kind, codec):
    path = scratch_path(spark, "seq")
    hadoop_write(spark, [(k, bytearray(v)) for k, v in rows], path, BYTES, kind=kind, codec=codec)
    for split in (1 << 26, 100_000):
        df = read_sequence(spark, path, split_bytes=split)
        assert sorted((r["key"], bytes(r["value"])) for r in df.collect()) == sorted(rows)
    assert read_sequence(spark, path, split_bytes=100_000).rdd.getNumPartitions() > 10


def test_hadoop_reads_what_is_written(spark, rows):
    path = scratch_path(spark, "seq")
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in rows], "key string, value binary").repartition(3)
    write_sequence(df, path)
    assert sorted((k, bytes(v)) for k, v in spark.sparkContext.sequenceFile(path, TEXT, BYTES).collect()) == sorted(rows)
    assert sorted((r["key"], bytes(r["value"])) for r in read_sequence(spark, path, split_bytes=200_000).collect()) == sorted(rows)
    write_sequence(df.limit(5), path)  # added
    assert read_sequence(spark, path).count() == len(rows) + 5
    assert not [n for n in files_of(path) if "_staging" in n[0]]
    empty = scratch_path(spark, "seq")
    write_sequence(df.where("false"), empty)
    assert read_sequence(spark, empty).count() == 0


def test_texts_nulls_and_json(spark):
    path = scratch_path(spark, "seq")
    write_sequence(spark.createDataFrame([('{"name":"a."}', None), (None, '{"name":"b.é"}')], "key string, value string"), path, binary=False)
    assert sorted(spark.sparkContext.sequenceFile(path, TEXT, TEXT).collect()) == [("", '{"name":"b.é"}'), ('{"name":"a."}', "")]
    assert [r["name"] for r in read_records(spark, path, "sequence", on_bad="drop").collect()] == ["b.é"]
    assert sorted(r["json"] for r in read_json_lines(spark, path, "sequence", column="key").collect()) == ["", '{"name":"a."}']


def test_paths_and_other_files(spark):
    base = scratch_path(spark, "seq")
    df = spark.createDataFrame([("k", bytearray(b"v"))], "key string, value binary")
    for name in ("a1", "a2", "b"):
        write_sequence(df, f"{base}/{name}")
    assert read_responses(spark, f"{base}/a*", "sequence").count() == 2
    assert read_responses(spark, f"{base}/b", "sequence", glob="part-*").count() == 1
    assert read_responses(spark, f"{base}/b", "sequence", glob="none*").count() == 0
    with pytest.raises(PySparkException):
        read_sequence(spark, f"{base}/missing").count()
    spark.range(3).write.csv(f"{base}/other")
    with pytest.raises(PySparkException):
        read_sequence(spark, f"{base}/other").count()
    lines = scratch_path(spark, "lines")
    spark.createDataFrame([('{"name":"a."}',)], "value string").write.text(lines)
    assert read_records(spark, lines, "json", glob="*.txt").count() == 1 and read_records(spark, lines, "json", glob="*.x").count() == 0


def test_every_split_gives_every_record_once(spark, rows):
    path = scratch_path(spark, "seq")
    hadoop_write(spark, [(k, bytearray(v)) for k, v in rows[:300]], path, BYTES, parts=1)
    (name, size), = files_of(path)
    fs = arrow_filesystem(path)[0]
    assert isinstance(fs, pafs.LocalFileSystem)
    with fs.open_input_file(name) as f:
        whole = list(records(f, 0, size))
        rng = random.Random(2)
        for _ in range(40):
            cuts = sorted({0, size, *(rng.randrange(size) for _ in range(rng.randint(1, 30)))})
            assert [r for a, b in zip(cuts, cuts[1:]) for r in records(f, a, b)] == whole
        assert Header(f).value == BYTES


def test_variable_length_numbers():
    for n in [0, 1, -1, 127, 128, -112, -113, 255, 256, 65535, 1 << 20, -(1 << 40), (1 << 63) - 1, -(1 << 63)]:
        assert vint(b"x" + to_vint(n) + b"y", 1) == (n, 1 + len(to_vint(n)))
