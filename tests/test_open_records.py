"""Records with any keys through filter, extraction, geo, cells and the stage jobs."""

import json

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rrspark.cli import main
from rrspark.operators.cells import map_event_generator
from rrspark.operators.open_records import (
    cells_of_open, distinct_open, enrich_open, extract_open, filter_open, from_columns, key, open_records, to_json_lines,
)
from rrspark.session import scratch_path

LINES = [
    '{"name":"a.","type":"A","addr":"5.0.0.1","shop":"X","n":{"k":[1,2]},"city":"old","ttl":5}',
    '{"name":"b.","type":"MX","x y":3,"rank":7,"rank":8}',
    '{"name":"c.","type":"A","addr":"10.0.0.1","shop":null,"it\'s":true}',
    '{"name":"d.","type":"A","addr":"no address"}', "{}",
]


def table(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "json string")


def objects(records):
    return [json.loads(r["json"]) for r in to_json_lines(records).collect()]


@pytest.fixture(scope="module")
def records(spark):
    return open_records(table(spark, LINES))


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame([(5 << 24, (5 << 24) + 255, None, "de", "Land", "1.5", "2.5", "AS64500 Org")],
                                 "start_ip long, end_ip long, city string, cc string, country string, lat string, long string, org_raw string")


def test_every_key_is_kept_and_the_last_of_a_repeated_one(records):
    got = objects(records)
    assert got[0] == json.loads(LINES[0]) and got[1] == {"name": "b.", "type": "MX", "x y": 3, "rank": 8} and got[4] == {}
    assert got[2]["shop"] is None and got[2]["it's"] is True


def test_bad_lines(spark):
    lines = table(spark, ['{"a":1}', "junk", "[1]", "3", "", None, '{"a":'])
    with pytest.raises(PySparkException):
        open_records(lines).count()
    assert open_records(lines, on_bad="drop").count() == 1
    seen = Observation("bad")
    assert open_records(lines, on_bad="count", observation=seen).count() == 1 and seen.get == {"bad_records": 6, "records": 1}
    for bad in ({"on_bad": "keep"}, {"on_bad": "count"}):
        with pytest.raises(ValueError):
            open_records(lines, **bad)


def test_filters_name_keys_like_columns(records):
    names = lambda expr, **types: [o["name"] for o in objects(filter_open(records, expr, types))]
    assert names("shop = 'X'") == ["a."] and names("type = 'A' AND NOT (shop <=> 'X')") == ["c.", "d."]
    assert names("`x y` > 2", **{"x y": "int"}) == ["b."] and names("rank = 8", rank="int") == ["b."]
    assert names("ttl + 1 = 6") == ["a."] and names("nowhere IS NULL AND name <> 'a.'") == ["b.", "c.", "d."]
    assert names("`it's` = 'true'") == ["c."] and names("shop > 5", shop="int") == []  # of another type: as if missing
    assert objects(filter_open(records, "shop = 'X'"))[0] == json.loads(LINES[0])
    with pytest.raises(TypeError):
        filter_open(records, "lower(shop)")
    with pytest.raises(AnalysisException):
        filter_open(records, "no_such_function(shop)")


def test_extraction(records):
    got = lambda e, **kw: sorted(r["value"] for r in extract_open(records, e, **kw).collect())
    assert got("coalesce(shop, type)") == ["A", "MX", "X"] and got("n") == ['{\\"k\\":[1,2]}']
    assert got("type", distinct=False, strip=False) == ['"A"'] * 3 + ['"MX"']


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0}])
def test_geo_overwrites_its_own_keys_and_keeps_the_rest(records, blocks, limits):
    got = {o.get("name"): o for o in objects(enrich_open(records, blocks, **limits))}
    assert got["a."] == {**json.loads(LINES[0]), "cc": "DE", "country": "LAND", "lat": "1.5", "long": "2.5", "asn": "64500", "org": "ORG"}
    assert got["b."] == {"name": "b.", "type": "MX", "x y": 3, "rank": 8} and got[None] == {}
    assert got["c."]["city"] == "RFC1918" and got["c."]["shop"] is None and got["c."]["it's"] is True
    assert got["d."]["cc"] == "UNKNOWN" and got["d."]["lat"] == "0.0"


def test_distinct_cells_and_columns(spark, records):
    again = records.union(open_records(table(spark, ['{"type":"MX","rank":8,"x y":3,"name":"b."}', '{"ttl":99}'])))
    assert len(objects(distinct_open(again))) == 5
    cells = cells_of_open(records, [map_event_generator("t", "d")]).collect()
    assert {(r["cq"], r["value"]) for r in cells} >= {("SHOP", "X"), ("N", '{"k":[1,2]}'), ("X Y", "3"), ("IT'S", "true")}
    df = spark.createDataFrame([("a.", None, 3)], "name string, addr string, ttl long")
    assert objects(from_columns(df)) == [{"name": "a.", "ttl": 3}]
    assert records.where("false").select(key("shop")).count() == 0


def test_stage_jobs_on_json(spark, blocks, capsys):
    base = scratch_path(spark, "open-cli")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(f"{base}/in")
    blocks.write.parquet(f"{base}/blocks")
    main(["geo", f"{base}/in", f"{base}/geo", "--blocks", f"{base}/blocks", "--in-format", "json"], spark)
    main(["filter", "rank > 7 OR shop = 'X'", f"{base}/geo", f"{base}/kept", "--key", "rank:int"], spark)
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"matched": 2, "non_matched": 3}
    got = {o["name"]: o for o in objects(spark.read.parquet(f"{base}/kept"))}
    assert got["a."]["n"] == {"k": [1, 2]} and got["a."]["cc"] == "DE" and got["b."]["x y"] == 3
    main(["extract", "shop", f"{base}/kept", f"{base}/shops"], spark)
    assert [r["value"] for r in spark.read.parquet(f"{base}/shops").collect()] == ["X"]
    main(["filter", "type IS NOT NULL", f"{base}/geo", f"{base}/by-type", "--by-type"], spark)
    assert spark.read.parquet(f"{base}/by-type").where("type = 'MX'").select(F.col("record")).count() == 1
