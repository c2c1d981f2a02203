"""Work that is kept between runs: records seen before, addresses looked up before; ordered output with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from rrspark.operators import geo_known
from rrspark.operators import history as history_of
from rrspark.operators.geo import enrich_geo
from rrspark.operators.geo_known import KnownAddresses, enrich_geo_known, range_version
from rrspark.operators.history import RecordHistory
from rrspark.operators.records import partition_sorted
from rrspark.session import named_path, scratch_path
from rrspark.sinks.hadoop import Folder

RECORD = "name string, type string, priority int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_batch_adds_only_what_is_unseen(spark):
    first = spark.createDataFrame([("a.", "A", None), ("a.", "A", None), ("b.", "MX", 1), (None, None, None)], RECORD)
    history = RecordHistory(spark, scratch_path(spark, "history"), first.schema, buckets=4)
    assert rows_of(history.add(first)) == rows_of(first.distinct())
    again = first.union(spark.createDataFrame([("b.", "MX", 2), ("a.", "A", 0), ("c.", "A", None)], RECORD))
    assert rows_of(history.add(again)) == [("a.", "A", 0), ("b.", "MX", 2), ("c.", "A", None)]
    assert history.add(again).count() == 0 and history.records().count() == 6
    assert history.add(first.where("false")).count() == 0
    # ttl is left out, other columns must be the history's
    with_ttl = spark.createDataFrame([("a.", "A", None, 5)], RECORD + ", ttl long")
    assert history.add(with_ttl).count() == 0
    with pytest.raises(ValueError):
        history.add(first.drop("type"))
    # another session only knows the folder
    spark.sql(f"DROP TABLE {history.name}")
    assert RecordHistory(spark, history.path, first.schema, buckets=99).add(again).count() == 0
    assert RecordHistory(spark, history.path, first.schema).buckets == 4


def test_the_history_is_never_shuffled(spark):
    batch = spark.range(2000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("name"), F.lit("A").alias("type"),
                                     F.lit(1).alias("priority"))
    history = RecordHistory(spark, scratch_path(spark, "history"), batch.schema, buckets=8)
    history.add(batch)
    assert len(history.records().inputFiles()) == 8  # a file a bucket and batch
    history.add(batch.withColumn("type", F.lit("NS")))
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = history.unseen(batch.withColumn("priority", F.col("priority") + 1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    join, stored = plan.index("SortMergeJoin"), plan.index("Bucketed: true")
    assert "LeftAnti" in plan[join:join + 100]
    right = plan[plan.rindex("+- *", 0, plan.rindex("Sort [__key", 0, stored)):stored]  # from the join down to the history's scan
    assert "Exchange" not in right and plan.count("Exchange hashpartitioning(__key") == plan.count("Exchange") == 1


def test_a_hot_record_of_a_batch_is_one_row_before_the_join(spark):
    batch = spark.range(30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"))
    history = RecordHistory(spark, scratch_path(spark, "history"), batch.schema, buckets=4)
    assert history.add(batch).where("name = 'hot'").count() == 1 and history.records().count() == 20_001
    assert history.add(batch).count() == 0


def test_a_large_batch_is_compared_in_ranges_of_keys(spark, monkeypatch):
    monkeypatch.setattr(history_of, "SLICE_RECORDS", 150)
    rows = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"), F.lit("A").alias("type"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).cast("int").alias("priority"))
    more = rows.where("priority > 1").unionByName(spark.createDataFrame([("new", None, 1), (None, None, None)], RECORD))
    path = scratch_path(spark, "history")
    history = RecordHistory(spark, path, rows.schema, buckets=4)
    scratch = Folder(spark, named_path(spark, ""))
    before = scratch.names()
    shuffled = spark.sparkContext._jsc.sc().newShuffleId()
    added = [history.add(batch, large=True) for batch in (rows, more, rows)]
    assert spark.sparkContext._jsc.sc().newShuffleId() <= shuffled + 4  # that of counting a batch only, whose one row a task is
    assert [sorted(map(repr, a.collect())) for a in added] == [
        sorted(map(repr, rows.distinct().collect())), sorted(map(repr, more.where("name = 'new' OR name IS NULL").collect())), []]
    assert history.records().count() == 2003
    # what a batch took is deleted with it, and each of its records is stored once
    assert set(scratch.names()) - set(before) <= {path.split("/")[-1]} and history.folder.names("added") == []
    assert history.add(more.unionByName(more)).count() == 0 and history.add(more.limit(0), large=True).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rrspark_batch")]


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame([(20 << 24, (20 << 24) + 65535, "c", "AS1 One"), ((20 << 24) + 256, (20 << 24) + 511, None, "Two")],
                                 "start_ip long, end_ip long, city string, org_raw string")


def test_only_unseen_addresses_are_looked_up(spark, blocks, monkeypatch):
    asked = []

    def counted(df, *args, **kw):
        asked.append(sorted(r["addr"] for r in df.collect()))
        return enrich_geo(df, *args, **kw)

    monkeypatch.setattr(geo_known, "enrich_geo", counted)
    known = KnownAddresses(spark, scratch_path(spark, "known"))
    batch = spark.createDataFrame(
        [("a", "20.0.0.1", "old"), ("b", "20.0.1.7", "old"), ("c", "20.0.0.1", None), ("d", None, "own"), ("e", "10.0.0.1", None), ("f", "nonsense", None)],
        "name string, addr string, city string")
    more = batch.union(spark.createDataFrame([("g", "20.0.1.8", "x"), ("h", "99.0.0.1", None)], batch.schema))
    for df in (batch, more, more):
        assert rows_of(enrich_geo_known(df, blocks, known)) == rows_of(enrich_geo(df, blocks))
    assert asked == [["10.0.0.1", "20.0.0.1", "20.0.1.7", "nonsense"], ["20.0.1.8", "99.0.0.1"], []]
    # other ranges know nothing of these answers; the same rows in another order are the same ranges
    other = blocks.where("city IS NOT NULL")
    assert rows_of(enrich_geo_known(batch, other, known)) == rows_of(enrich_geo(batch, other)) and len(asked[3]) == 4
    assert range_version(blocks) == range_version(blocks.orderBy(F.desc("end_ip")).repartition(3)) != range_version(other)
    assert range_version(blocks, None) != range_version(blocks, blocks)
    known.forget(range_version(blocks, None))
    assert len(known.folder.names()) == 1
    assert enrich_geo_known(batch.where("false"), blocks, known).count() == 0


def test_addresses_two_batches_added_side_by_side(spark, blocks):
    known = KnownAddresses(spark, scratch_path(spark, "known"))
    version = range_version(blocks, None)
    once = enrich_geo(spark.createDataFrame([("20.0.0.1",)], "addr string"), blocks)
    known.add(once, version)
    known.add(once, version)
    df = spark.createDataFrame([("20.0.0.1", 1), ("20.0.0.1", 2)], "addr string, n int")
    assert enrich_geo_known(df, blocks, known).count() == 2


def test_a_hot_key_spreads_over_ordered_partitions(spark):
    rng = random.Random(1)
    rows = [(("hot." if rng.random() < 0.4 else f"h{rng.randrange(500)}."), rng.choice("AB")) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "name string, type string").repartition(6)
    parts = {}
    for r in partition_sorted(df, ["name", "type"], 8).withColumn("part", F.spark_partition_id()).collect():
        parts.setdefault(r["part"], []).append((r["name"], r["type"]))
    assert len(parts) == 8 and max(map(len, parts.values())) < 0.2 * len(rows)
    ordered = [parts[p] for p in sorted(parts)]
    assert [x for p in ordered for x in p] == sorted(rows)  # over all partitions too
    assert sum(("hot.", "A") in p or ("hot.", "B") in p for p in ordered) >= 3
