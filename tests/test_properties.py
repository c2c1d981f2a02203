"""Property tests: each property is checked over many generated rows in one
Spark job, against plain Python."""

import hashlib
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rrspark.operators.cells import event_id
from rrspark.operators.extract import extract_values
from rrspark.operators.records import distinct_records, partition_sorted
from rrspark.operators.requests import expand_requests

line = st.text(alphabet=st.sampled_from(list("abc.-_ \t") + ["\x00", "é"]), max_size=12)
sub = st.sampled_from(["", "www", "m.", "a.b", "x."])


def py_name(line_text: str, subdomain: str) -> str:
    t = line_text.strip("".join(chr(c) for c in range(0x21)))
    name = t if subdomain == "" else (subdomain + t if subdomain.endswith(".") else subdomain + "." + t)
    return name if name.endswith(".") else name + "."


@settings(max_examples=5, deadline=None)
@given(st.lists(line, min_size=1, max_size=60), st.lists(sub, min_size=1, max_size=3, unique=True))
def test_name_composition(spark, lines, subs):
    df = spark.createDataFrame([(x,) for x in lines], "domain string")
    got = sorted(r.name for r in expand_requests(df, types="A", subdomains=subs).collect())
    assert got == sorted(py_name(x, s) for x in lines for s in subs)
    assert all(n.endswith(".") for n in got)


field = st.one_of(st.none(), st.text(alphabet="abcXYZ019.=, {}", max_size=8))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(field, field, st.one_of(st.none(), st.integers(0, 65535))), min_size=1, max_size=40))
def test_event_id_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "name string, target string, priority int")
    got = [r.id for r in df.select(event_id(df).alias("id")).collect()]
    for (name, target, prio), g in zip(rows, got):
        items = sorted((k, v) for k, v in (("name", name), ("target", target), ("priority", prio)) if v is not None)
        text = "{" + ", ".join(f"{k}={v}" for k, v in items) + "}"
        assert g == uuid.UUID(bytes=hashlib.md5(text.encode()).digest(), version=3).hex


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet='ab"\\ c', max_size=6), min_size=1, max_size=40))
def test_extract_idempotent_on_distinct_plain_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    once = extract_values(df, "s")
    plain = once.where(~F.col("value").contains('"') & ~F.col("value").contains("\\"))  # nothing JSON escapes
    again = extract_values(plain, "value")
    assert sorted(r.value for r in again.collect()) == sorted(r.value for r in plain.collect())
    assert once.count() == distinct_records(once, ignore_ttl=False).count()


def test_partition_sorted(spark):
    df = spark.createDataFrame([(f"n{i % 7}", i) for i in range(200)], "name string, v int")
    out = partition_sorted(df, ["name"], 3)
    assert out.rdd.getNumPartitions() == 3
    for part in out.rdd.glom().collect():
        names = [r.name for r in part]
        assert names == sorted(names)
