"""Fixtures over keys of any size: the hash of a key leaves no 64 bits, and small keys give the shared text's rows."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rrspark.plans import fixtures
from rrspark.plans.fixtures import FIXTURE_SQL, SPARK_FIXTURE_SQL

M = 1 << 32


def _session(spark, keys):
    """A session of its own (its views hide no others) with one row a key in each table."""
    own = spark.newSession()
    rows = own.createDataFrame([(k, 7) for k in keys], "k long, s long")
    rows.select(F.col("k").alias("l_partkey"), F.col("s").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
                F.lit(3.0).alias("l_quantity")).createOrReplaceTempView("lineitem")
    rows.select(F.col("k").alias("c_custkey"), F.lit(1).alias("c_nationkey")).createOrReplaceTempView("customer")
    rows.select(F.col("k").alias("s_suppkey"), F.lit("S").alias("s_name")).createOrReplaceTempView("supplier")
    return own


def test_keys_of_larger_tables(spark):
    keys = [438_763, 1_200_000, 10**12]
    own = _session(spark, keys)
    ips = [(k * 7919 + 7) * 2654435761 % M for k in keys]
    assert [r.addr for r in own.sql(SPARK_FIXTURE_SQL["rr"]).orderBy(F.length("name"), "name").collect()] == [
        ".".join(str(ip >> s & 255) for s in (24, 16, 8, 0)) for ip in ips]
    places = {k * 2654435761 % M for k in keys}
    for name in ("city_ranges", "owner_ranges"):
        found = own.sql(SPARK_FIXTURE_SQL[name]).collect()
        assert len(found) == len(keys)
        assert all(sum(r.start_ip <= p <= r.end_ip for r in found) >= 1 for p in places)


def test_small_keys_as_in_the_shared_text(spark):
    own = _session(spark, [0, 1, 5, 10, 20_000, 438_000, -3, -20_000, None])
    for name in ("rr", "city_ranges", "owner_ranges"):
        plain, whole = own.sql(FIXTURE_SQL[name]), own.sql(SPARK_FIXTURE_SQL[name])
        assert plain.schema == whole.schema
        assert plain.exceptAll(whole).count() == whole.exceptAll(plain).count() == 0


def test_stored_rows_are_dealt_evenly_without_a_sort_of_each_task(spark, monkeypatch):
    """``repartition(n)`` alone sorts a task's rows before it deals them, which fails in a small heap on millions of rows."""
    made = []
    monkeypatch.setattr(fixtures, "staged", lambda df, name: made.append(df) or df)
    rows = spark.range(0, 40_000, 1, 3).select((F.col("id") % 2).alias("key"), F.lit("same").alias("text"))
    found = fixtures.stored(spark, "a folder of this test", "dealt", lambda: rows)
    assert found is made[0] and found.columns == ["key", "text"]
    assert "RoundRobinPartitioning" not in found._jdf.queryExecution().toString()
    assert {r.key: r["count"] for r in found.groupBy("key").count().collect()} == {0: 20_000, 1: 20_000}
    n = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == n and max(sizes) < 1.2 * 40_000 / n


def test_stored_rows_behind_a_shuffle_are_dealt_by_their_key(spark, monkeypatch):
    """Their order, and so a row's place, may differ when a task runs again."""
    monkeypatch.setattr(fixtures, "staged", lambda df, name: df)
    rows = spark.range(1_000).groupBy((F.col("id") % 100).alias("key")).count()
    found = fixtures.stored(spark, "a folder of this test", "dealt by key", lambda: rows, by=["key"])
    plan = found._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" not in plan and "monotonically" not in plan
    assert found.count() == 100


def test_row_groups_of_a_stored_table_are_small(spark, tmp_path):
    """A task holds a whole row group; at Parquet's own size the eight tasks of a 1 GB heap filled it."""
    rows = spark.range(0, 3_000_000, 1, 8).select(F.md5(F.col("id").cast("string")).alias("text"))
    found = fixtures.stored(spark, str(tmp_path), "row-groups", lambda: rows)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in found.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert max(g.total_byte_size for g in groups) < 10 << 20
    assert sum(g.num_rows for g in groups) == 3_000_000
