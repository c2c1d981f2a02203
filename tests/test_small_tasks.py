"""Aggregates of many records run in many small tasks, whatever partitions the session has, with the same results."""

import os
from collections import Counter

import pytest

from rrspark.plans import queries
from rrspark.session import scratch_path

ROWS = 300


@pytest.fixture
def both(spark, monkeypatch):
    """A query over the same records with the session's tasks and with tasks of ten records."""
    rows = [("IN", f"h{i % 90}.example.com.", "A", i % 7 * 60, f"192.0.2.{i % 45}", None, None) for i in range(ROWS // 2)]
    rows += [("IN", f"h{i % 20}.example.com.", "MX", 60, None, None, "MX1.Example.NET.") for i in range(50)]
    rows += [("IN", "hot.example.com.", "CNAME", 60, None, "h1.example.com.", None)] * (ROWS // 3)
    kinds = "dclass string, name string, type string, ttl long, addr string, alias string, target string"
    recs = spark.createDataFrame(rows, kinds).selectExpr(
        "dclass", "name", "type", "ttl", "addr", "string(null) addrv6", "target",
        "CASE WHEN type = 'MX' THEN 10 END priority", "alias", "string(null) host")

    def run(name, make=lambda df: df):
        monkeypatch.setattr(queries, "rr", lambda spark, sf_dir: make(recs))
        found = []
        for size in (queries.TASK_RECORDS, 10):
            monkeypatch.setattr(queries, "TASK_RECORDS", size)
            df = queries.spark_queries()[name](spark, scratch_path(spark, "no-tables"))
            found.append((df, Counter(df.collect())))
        (_, whole), (small, same) = found
        assert same == whole and found[0][0].schema == small.schema
        return small, same

    return run


def nulled(df):
    """The records and one that is null in every field."""
    return df.unionByName(df.limit(1).selectExpr(*[f"CAST(NULL AS {t}) {c}" for c, t in df.dtypes]))


def test_distinct_with_ttl_in_small_tasks(both):
    small, rows = both("q06_distinct_ttl", nulled)
    assert small.rdd.getNumPartitions() == 31
    assert max(rows.values()) == 1 and sum(r["type"] == "CNAME" for r in rows) == 1


def test_event_ids_in_small_tasks(both):
    small, rows = both("q15_event_ids", nulled)
    assert small.rdd.getNumPartitions() == 31 and len({r["event_id"] for r in rows}) == sum(rows.values())


def test_event_cells_in_small_tasks(both):
    small, rows = both("q16_event_cells", nulled)
    assert small.rdd.getNumPartitions() == 31
    assert sum(n for r, n in rows.items() if r["value"] == "hot.example.com.") == 1


def test_edges_in_small_tasks(both):
    small, rows = both("q17_edges", nulled)
    assert small.rdd.getNumPartitions() == 31
    assert sum(n for r, n in rows.items() if r["row"].startswith("hot.example.com.")) == 1


def test_value_counts_in_small_tasks(both):
    small, rows = both("q18_value_stats", nulled)
    assert small.rdd.getNumPartitions() == 121
    assert sum(r["n"] for r in rows if r["row"] == "in") == ROWS
    assert [r["n"] for r in rows if r["row"] == "hot.example.com."] == [ROWS // 3]
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__part" in plan  # a value of a third of the records leaves each of these tasks as one row


def test_edge_counts_in_small_tasks(both):
    small, rows = both("q19_edge_counts", nulled)
    assert small.rdd.getNumPartitions() == 121
    assert {r["n"] for r in rows if "hot.example.com." in r["row"]} == {ROWS // 3}


def test_decoded_records_in_small_tasks(both):
    small, rows = both("q20_decode_roundtrip")
    assert small.rdd.getNumPartitions() == 30 and max(rows.values()) == 1


def test_cells_of_a_large_store(both):
    small, rows = both("q48_cell_store", nulled)
    assert max(rows.values()) == 1 and sum(r["value"] == "hot.example.com." and r["cq"] == "NAME" for r in rows) == 1
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and small.rdd.getNumPartitions() > 32  # a task for each bucket of each table


def test_counts_of_a_large_store(both):
    small, rows = both("q49_cell_counts", nulled)
    assert sum(r["n"] for r in rows if r["row"] == "in") == ROWS + 50  # MX is in both sets, CNAME in the second
    held = {p.split("/data/")[1].split("/")[0] for p in small.inputFiles()}
    data = small.inputFiles()[0].split("/data/")[0].removeprefix("file:") + "/data"
    assert set(os.listdir(data)) == held and len(held) <= 2  # nothing is kept that a compaction replaced


def test_a_history_of_large_batches(both):
    small, rows = both("q54_distinct_history")
    assert max(rows.values()) == 1 and sum(r["type"] == "CNAME" for r in rows) == 1
    assert all("/records/" in p for p in small.inputFiles())  # the added records are stored once only
