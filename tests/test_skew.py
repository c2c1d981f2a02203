"""Hot keys: a key holding a large share of the rows must not end up in one task."""

from pyspark.sql import functions as F

from rrspark.operators.cells import cell_counts, value_stat_cells
from rrspark.operators.geo import enrich_geo


def test_geo_shuffle_path_spreads_rows_without_address(spark):
    # two thirds of the records have no address (the NULL join key of a naive left join)
    rows = spark.range(30000).select(
        F.lit("h.").alias("name"),  # all address-less rows are equal
        F.when(F.col("id") % 3 == 0, F.lit("A")).otherwise(F.lit("MX")).alias("type"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("20.0.0."), (F.col("id") % 250).cast("string"))).alias("addr"),
    )
    blocks = spark.createDataFrame([(20 * 2**24, 21 * 2**24 - 1, "tw")], "start_ip long, end_ip long, cc string")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # look at the join's own partitioning
    try:
        out = enrich_geo(rows, blocks, broadcast_rows=0)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sum(sizes) == 30000
    assert max(sizes) < 0.4 * 30000  # no partition holds the 20,000 address-less rows
    assert out.where("cc = 'TW'").count() == 10000 and out.where("cc IS NULL").count() == 20000


def test_hot_value_counts_collapse_before_shuffle(spark):
    # one value in every record: the partial aggregate reduces it to one row per task
    df = spark.range(20000).select(F.lit("IN").alias("dclass"), (F.col("id") % 7).cast("string").alias("name"))
    counts = cell_counts(value_stat_cells(df, "s", "dns"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    hot = counts.where("row = 'in'").first()
    assert hot.n == 20000
