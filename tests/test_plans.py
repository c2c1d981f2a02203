"""Physical-plan checks: range join planned as a hash join, filters without exchanges,
pushdown into the Parquet scan, partial aggregation before the shuffle."""

from rrspark.operators.extract import extract_values
from rrspark.operators.filters import filter_records
from rrspark.operators.geo import enrich_geo
from rrspark.operators.records import distinct_records
from rrspark.plans.fixtures import fixture
from rrspark.sinks.files import write_by_type
from rrspark.session import scratch_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_geo_is_broadcast_hash_join(spark, sf_dir):
    rr = fixture(spark, sf_dir, "rr")
    p = plan(enrich_geo(rr, fixture(spark, sf_dir, "blocks")))
    assert "BroadcastHashJoin" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_geo_large_ranges_use_shuffle_join_on_distinct_addresses(spark, sf_dir):
    rr = fixture(spark, sf_dir, "rr")
    p = plan(enrich_geo(rr, fixture(spark, sf_dir, "blocks"), broadcast_rows=0))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Window" in p and "BETWEEN" not in p.upper()
    assert "RoundRobin" not in p


def test_filter_adds_no_exchange(spark, sf_dir):
    rr = fixture(spark, sf_dir, "rr")
    assert plan(filter_records(rr, "type = 'MX'")).count("Exchange") == plan(rr).count("Exchange")
    scan_only = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert "Exchange" not in plan(filter_records(scan_only, "l_linenumber = 4"))


def test_distinct_has_partial_aggregate(spark, sf_dir):
    rr = fixture(spark, sf_dir, "rr")
    p = plan(extract_values(filter_records(distinct_records(rr), "type = 'MX'"), "lower(target)"))
    assert "HashAggregate" in p and "RoundRobin" not in p
    assert p.count("Exchange hashpartitioning") >= 1


def test_type_partitions_prune_and_push_down(spark, sf_dir):
    path = scratch_path(spark, "plan_by_type")
    write_by_type(distinct_records(fixture(spark, sf_dir, "rr")), path)
    df = spark.read.parquet(path).where("type = 'MX' AND priority = 10").select("target")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(type" in p and "PushedFilters: [IsNotNull(priority), EqualTo(priority,10)]" in p
    assert "ReadSchema: struct<target:string,priority:int>" in p


def test_several_generators_read_records_once(spark, sf_dir):
    from rrspark.operators.cells import edge_generator, event_generator, generate_cells

    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = distinct_records(fixture(spark, sf_dir, "rr"))
        p = plan(generate_cells(d, [event_generator("ev", "dns"), edge_generator("eg", "dns", "name:addr")]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert p.count("FileScan") == 1 and p.count("Generate") == 1 and "Union" not in p
