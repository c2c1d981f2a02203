"""Range lookups over tables as users have them: overlaps, separate owners, too large to broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from rrspark.operators.geo import _dyadic, _sweep, enrich_geo, has_overlaps, segments
from rrspark.session import ship_package


def test_sweep_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        blocks = []
        for _ in range(rng.randint(0, 12)):
            size = 1 << rng.randint(0, 4)
            s = rng.randint(0, 40) // size * size
            blocks.append((s, s + size - 1))
        got = {}
        for s, e, i in _sweep(blocks):
            for x in range(s, e + 1):
                assert x not in got
                got[x] = i
        for x in range(60):
            assert got.get(x) == next((i for i, (s, e) in enumerate(blocks) if s <= x <= e), None)


def test_ranges_are_the_blocks_they_consist_of(spark):
    rng = random.Random(3)
    rows = [(7, 0, 65535), (7, 0, 0), (7, 65535, 65535), (7, 1, 65534), (7, 256, 511)]
    rows += [(7, *sorted((rng.randrange(65536), rng.randrange(65536)))) for _ in range(300)]
    df = spark.createDataFrame([(i, b, (b << 16) + s, (b << 16) + e) for i, (b, s, e) in enumerate(rows)], "i int, bucket long, s long, e long")
    found = {}
    for r in _dyadic(df).collect():
        found.setdefault(r["i"], []).append((r["node"] << r["level"], (r["node"] + 1 << r["level"]) - 1))
    for i, (_, s, e) in enumerate(rows):
        blocks = sorted(found[i])
        assert blocks[0][0] == s and blocks[-1][1] == e and len(blocks) <= 30
        assert all(a[1] + 1 == b[0] for a, b in zip(blocks, blocks[1:]))
    assert len(found[0]) == len(found[4]) == 1


def test_a_hot_bucket_spreads_over_tasks(spark):
    """A third of a million ranges in one /16: the best of each block is found by all tasks, one gets its blocks."""
    base = 20 << 24
    h = F.xxhash64("id")
    start = base + F.pmod(h, F.lit(65536))
    ranges = spark.range(330_000, numPartitions=8).select(
        start.alias("start_ip"), F.least(start + F.pmod(F.shiftright(h, 20), F.lit(3000)), F.lit(base + 65535)).alias("end_ip"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"))
    r = ranges.select(F.col("start_ip").alias("__s"), F.col("end_ip").alias("__e"), "city").cache()
    cut = segments(r, ["city"]).cache()
    assert cut.count() <= 65536 and not has_overlaps(cut)
    rows = [tuple(x) for x in r.collect()]
    found = {s: (e, c) for s, e, c in map(tuple, cut.collect())}
    starts = sorted(found)
    import bisect
    for x in random.Random(4).sample(range(base, base + 65536), 60):
        at = starts[bisect.bisect(starts, x) - 1]
        assert found[at][0] >= x and found[at][1] == min((e - s, s, c) for s, e, c in rows if s <= x <= e)[2]
    plan = segments(r, ["city"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_overlapping_ranges_give_one_row_and_the_narrowest(spark, limit):
    base = 20 << 24
    blocks = spark.createDataFrame(
        [(base, base + (1 << 24) - 1, "WIDE", 1.5), (base + 65536, base + 131071, "MID", -0.25), (base + 65536 + 256, base + 65536 + 511, "small", 3.0),
         (base + 65536 + 256, base + 65536 + 511, "other", 4.0)], "start_ip long, end_ip long, city string, lat double")
    asn = spark.createDataFrame([(base + 65536, base + 65536 + 300, "AS7 Seven"), (base, base + (1 << 23), "plain")],
                                "start_ip long, end_ip long, org_raw string")
    rows = ["20.0.0.1", "20.1.0.1", "20.1.1.5", "20.1.1.200", "20.255.0.0", "21.0.0.0", "10.0.0.1", None, "20.1.1.5", "nonsense"]
    df = spark.createDataFrame([(x,) for x in rows], "addr string")
    got = sorted((r["addr"] or "", r["city"], r["lat"], r["asn"], r["org"]) for r in enrich_geo(df, blocks, asn, broadcast_rows=limit).collect())
    assert got == sorted([
        ("20.0.0.1", "WIDE", "1.5", None, "PLAIN"), ("20.1.0.1", "MID", "-0.25", "7", "SEVEN"),
        ("20.1.1.5", "OTHER", "4.0", "7", "SEVEN"), ("20.1.1.5", "OTHER", "4.0", "7", "SEVEN"),
        ("20.1.1.200", "OTHER", "4.0", None, "PLAIN"), ("20.255.0.0", "WIDE", "1.5", None, None),
        ("21.0.0.0", "UNKNOWN", "0.0", "UNKNOWN", "UNKNOWN"), ("10.0.0.1", "RFC1918", "0.0", "RFC1918", "RFC1918"),
        ("", None, None, None, None), ("nonsense", "UNKNOWN", "0.0", "UNKNOWN", "UNKNOWN")])


def test_segments_do_not_overlap(spark):
    rng = random.Random(2)
    rows = [(s, s + rng.choice([0, 10, 300, 70000, 200000]), f"r{i}") for i, s in enumerate(rng.randrange(1 << 20) for _ in range(300))]
    r = spark.createDataFrame(rows, "__s long, __e long, city string")
    assert has_overlaps(r)
    cut = segments(r, ["city"])
    assert not has_overlaps(cut)
    found = sorted(map(tuple, cut.collect()))
    for x in [rng.randrange(1 << 20) for _ in range(500)]:
        want = min(((e - s, s, c) for s, e, c in rows if s <= x <= e), default=(None, None, None))[2]
        assert next((c for s, e, c in found if s <= x <= e), None) == want


def test_records_are_made_once(spark):
    """The path for large tables reads its input once: what made the records is not done again."""
    ship_package(spark)
    calls = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    src = spark.range(3000).select(F.concat(F.lit("20.0."), (F.col("id") % 7).cast("string"), F.lit("."), (F.col("id") % 250).cast("string")).alias("addr"))
    made = src.mapInArrow(run, "addr string")
    blocks = spark.createDataFrame([((20 << 24) + i * 256, (20 << 24) + i * 256 + 255, f"c{i}") for i in range(7)], "start_ip long, end_ip long, city string")
    asn = blocks.select("start_ip", "end_ip", F.lit("AS1 One").alias("org_raw"))
    assert enrich_geo(made, blocks, asn, broadcast_rows=0).where("asn = '1'").count() == 3000
    assert calls.value == 3000
