"""Golden cases for the operators and the semantic traps."""

import hashlib
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rrspark.functions.columns import ipv4_to_long, java_trim
from rrspark.plans.wire_fixtures import encode_message, header_flags
from rrspark.operators.cells import (
    cell_counts, directed_edges, edge_cells, event_cells, event_id, parse_edges, store_summary,
)
from rrspark.operators.decode import decode_messages, decode_responses, parse_failures, response_text
from rrspark.operators.extract import extract_counts, extract_values
from rrspark.operators.filters import filter_counts, filter_records, observe_filter
from rrspark.operators.geo import enrich_geo
from rrspark.operators.records import distinct_records, records_from_json, records_to_json
from rrspark.operators.requests import dedupe_requests, expand_requests, order_requests, parse_subdomains, parse_types
from rrspark.operators.resolve import lookup_summary, pick_nameserver, rcode_counts, resolve, resolve_with, responses
from rrspark.schema import RR_SCHEMA

RR = T.StructType([f for f in RR_SCHEMA.fields])


def records(spark, rows):
    return spark.createDataFrame([{f.name: r.get(f.name) for f in RR.fields} for r in rows], RR)


# --- T1 null in != ---------------------------------------------------------------------------

def test_t1_null_safe_not_equal(spark):
    df = records(spark, [{"name": "a.", "type": "A"}, {"name": "b."}, {"name": "c.", "type": "MX"}])
    assert filter_records(df, "type != 'A'").count() == 1
    assert filter_records(df, "NOT (type <=> 'A')").count() == 2


def test_f3_non_boolean_filter(spark):
    df = records(spark, [{"name": "a.", "type": "A"}])
    with pytest.raises(TypeError):
        filter_records(df, "name")
    assert filter_records(df, "name", strict=False).count() == 0


def test_f4_full_match_not_substring(spark):
    df = records(spark, [{"name": "a.", "type": "MX", "target": "1.2.3.4."}, {"name": "b.", "type": "MX", "target": "x1.2.3.4.y"}])
    out = extract_values(df, "CASE WHEN NOT (target rlike '\\\\A\\\\d{1,3}(\\\\.\\\\d{1,3}){3}\\\\.\\\\z') THEN lower(target) END")
    assert [r.value for r in out.collect()] == ["x1.2.3.4.y"]


# --- T2 distinct vs multiset ------------------------------------------------------------------

def test_t2_distinct_vs_multiset(spark):
    rows = [{"name": "a.", "type": "A", "addr": "1.2.3.4", "ttl": 1}, {"name": "a.", "type": "A", "addr": "1.2.3.4", "ttl": 2}]
    df = records(spark, rows)
    assert distinct_records(df).count() == 1
    assert distinct_records(df, ignore_ttl=False).count() == 2
    assert filter_records(df, "type = 'A'").count() == 2
    blocks = spark.createDataFrame([(0, 2**32 - 1, "X")], "start_ip long, end_ip long, cc string")
    assert enrich_geo(df, blocks).count() == 2


# --- T3 TXT keeps its TTL in the text ------------------------------------------------------------

def test_t3_txt_text_includes_ttl(spark):
    def msg(ttl):
        return encode_message(1, 0, [], [{"name": "t.example.", "type_code": 16, "ttl": ttl, "text": "v=spf1"}])
    raw = spark.createDataFrame([("q", msg(60)), ("q", msg(120))], "question string, wire binary")
    rec = decode_responses(raw)
    assert "ttl" not in rec.columns
    assert distinct_records(rec).count() == 2  # text differs by TTL
    assert distinct_records(decode_responses(raw, txt_mode="rdata")).count() == 1
    assert decode_responses(raw, txt_mode="rdata").first().text == '"v=spf1"'


# --- T4 / T5 geo -----------------------------------------------------------------------------------

def blocks_df(spark):
    return spark.createDataFrame(
        [
            (10 * 2**24, 10 * 2**24 + 2**23 - 1, "Ten City", "tc", "Ten", "AS1 ten org", "1.5", "2.5"),
            (20 * 2**24, 20 * 2**24 + 255, None, "tw", "Twenty", None, "3.0", "4.0"),
            (30 * 2**24, 30 * 2**24 + 255, "thirty", "th", "Thirty", "plain owner", None, None),
        ],
        "start_ip long, end_ip long, city string, cc string, country string, org_raw string, lat string, long string",
    )


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_t4_t5_geo_rules(spark, broadcast_rows):
    df = records(spark, [
        {"name": "p.", "type": "A", "addr": "10.0.0.1"},       # private wins over the 10/8 block
        {"name": "g.", "type": "A", "addr": "20.0.0.5"},       # found, no owner -> asn/org absent
        {"name": "o.", "type": "A", "addr": "30.0.0.5"},       # found, owner text without AS number
        {"name": "u.", "type": "A", "addr": "40.0.0.1"},       # not found -> UNKNOWN everywhere
        {"name": "x.", "type": "A", "addr": "not-an-ip"},      # not IPv4 text -> UNKNOWN (no error)
        {"name": "v6.", "type": "AAAA", "addrv6": "::1"},      # passes through
        {"name": "s.", "type": "A", "addr": "172.20.1.1"},
        {"name": "n.", "type": "A", "addr": "192.0.2.1"},      # 192. but not 192.168. -> looked up
    ])
    out = {r.name: r for r in enrich_geo(df, blocks_df(spark), broadcast_rows=broadcast_rows).collect()}
    p = out["p."]
    assert (p.city, p.cc, p.country, p.lat, p.long, p.asn, p.org) == ("RFC1918",) * 3 + ("0.0", "0.0") + ("RFC1918",) * 2
    g = out["g."]
    assert (g.city, g.cc, g.country, g.lat, g.long, g.asn, g.org) == (None, "TW", "TWENTY", "3.0", "4.0", None, None)
    o = out["o."]
    assert (o.city, o.asn, o.org, o.lat) == ("THIRTY", None, "PLAIN OWNER", None)
    for k in ("u.", "x.", "n."):
        u = out[k]
        assert (u.city, u.cc, u.country, u.lat, u.long, u.asn, u.org) == ("UNKNOWN",) * 3 + ("0.0", "0.0") + ("UNKNOWN",) * 2
    assert out["v6."].cc is None and out["v6."].city is None
    assert out["s."].cc == "RFC1918"


def test_geo_asn_table_and_owner_pattern(spark):
    df = records(spark, [{"name": "a.", "type": "A", "addr": "11.128.0.1"}, {"name": "b.", "type": "A", "addr": "20.0.0.9"}])
    blocks = spark.createDataFrame([(0, 2**32 - 1, "c", "Everywhere")], "start_ip long, end_ip long, cc string, country string")
    asn = spark.createDataFrame([(11 * 2**24, 12 * 2**24 - 1, "AS64500   Big  Net")], "start_ip long, end_ip long, org_raw string")
    out = {r.name: r for r in enrich_geo(df, blocks, asn=asn).collect()}
    assert (out["a."].asn, out["a."].org, out["a."].cc) == ("64500", "BIG  NET", "C")
    assert (out["b."].asn, out["b."].org) == (None, None)


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_geo_bucketed_equals_nested_loop(spark, broadcast_rows):
    import random

    rnd = random.Random(7)
    # non-overlapping blocks of mixed widths: some span many /16s, some are a few addresses,
    # several small ones share one /16 and one /24 (both bucket levels are used)
    blocks, pos = [], 0
    while pos < 2**32 - 2**22 and len(blocks) < 400:
        width = rnd.choice([2**22, 2**16, 2**16 + 7, 300, 16, 1, 2**12])
        blocks.append((pos, pos + width - 1, f"c{len(blocks)}"))
        pos += width + rnd.choice([0, 0, 5, 2**14, 2**20])
    addrs = [".".join(str(rnd.randint(0, 255)) for _ in range(4)) for _ in range(300)]
    addrs += [".".join(str((s + k) >> sh & 255) for sh in (24, 16, 8, 0)) for s, e, _ in blocks[:150] for k in (0, e - s)]
    bdf = spark.createDataFrame(blocks, "start_ip long, end_ip long, cc string")
    df = records(spark, [{"name": f"n{i}.", "type": "A", "addr": a} for i, a in enumerate(addrs)])
    got = {r.name: r.cc for r in enrich_geo(df, bdf, broadcast_rows=broadcast_rows).collect()}
    priv = ("10.", "192.168.") + tuple(f"172.{n}." for n in range(16, 32))
    for i, a in enumerate(addrs):
        ip = sum(int(x) << s for x, s in zip(a.split("."), (24, 16, 8, 0)))
        want = "RFC1918" if a.startswith(priv) else next((c.upper() for s, e, c in blocks if s <= ip <= e), "UNKNOWN")
        assert got[f"n{i}."] == want, (a, want, got[f"n{i}."])


# --- T6 case kept ----------------------------------------------------------------------------------

def test_t6_case_kept_in_dedupe(spark):
    df = records(spark, [{"name": "A.Example.", "type": "A"}, {"name": "a.example.", "type": "A"}])
    assert distinct_records(df).count() == 2


# --- T7 parameters ----------------------------------------------------------------------------------

def test_t7_parameters():
    assert parse_types(" a, mx ,TXT") == ["A", "MX", "TXT"]
    with pytest.raises(ValueError):
        parse_types("A,BOGUS")
    assert parse_subdomains("www,m.,,") == ["www", "m."]
    assert parse_subdomains(",www") == ["", "www"]


def test_request_expansion(spark):
    lines = spark.createDataFrame([("  example.com ",), ("",), ("x.org.",)], "domain string")
    out = expand_requests(lines, types="A,MX", subdomains=["", "www", "m."])
    assert out.count() == 3 * 2 * 3
    names = {r.name for r in out.collect()}
    assert {"example.com.", "www.example.com.", "m.example.com.", ".", "www.", "m.", "x.org.", "www.x.org."} <= names
    assert names == {n for n in names if n.endswith(".")}
    d = dedupe_requests(expand_requests(lines.union(lines), types="A"))
    assert d.count() == 3
    first = order_requests(expand_requests(lines, types="MX,A")).first()
    assert (first.name, first.type_code, first.dclass_code) == (".", 1, 1)


def test_java_trim(spark):
    df = spark.createDataFrame([("\t\x01 a b \n",)], "s string")
    assert df.select(java_trim("s").alias("t")).first().t == "a b"


# --- T8 bad JSON policy -----------------------------------------------------------------------------

def test_t8_bad_json(spark):
    lines = spark.createDataFrame([('{"name":"a.","type":"A"}',), ("not json",), ('{"k": null}',)], "json string")
    with pytest.raises(Exception):
        records_from_json(lines, on_bad="fail").collect()
    assert records_from_json(lines, on_bad="drop").count() == 2
    kept = records_from_json(lines, on_bad="keep").where("_corrupt IS NOT NULL").count()
    assert kept == 1
    obs = Observation("json")
    assert records_from_json(lines, on_bad="count", observation=obs).count() == 2
    assert obs.get == {"bad_records": 1, "records": 2}
    s = store_summary(lines).first()
    assert (s.bad_records, s.records_stored, s.failed_store, s.total) == (1, 1, 1, 2)


def test_json_roundtrip_drops_nulls(spark):
    df = records(spark, [{"name": "a.", "type": "MX", "priority": 5, "target": "m."}])
    js = records_to_json(df).first().json
    assert js == '{"name":"a.","type":"MX","target":"m.","priority":5}'


# --- T9 / T13 cells -----------------------------------------------------------------------------------

def test_t13_event_id_is_name_uuid_of_sorted_text(spark):
    df = spark.createDataFrame([("IN", "a.example.", "A", "1.2.3.4", None)], "dclass string, name string, type string, addr string, priority int")
    text = "{addr=1.2.3.4, dclass=IN, name=a.example., type=A}"
    want = uuid.UUID(bytes=hashlib.md5(text.encode("utf-8")).digest(), version=3).hex
    assert df.select(event_id(df).alias("id")).first().id == want


def test_t9_event_cells_skip_null_fields(spark):
    df = spark.createDataFrame([("a.", "A", "1.2.3.4", None)], "name string, type string, addr string, priority int")
    cells = event_cells(df, "ev", "dns").collect()
    assert sorted(c.cq for c in cells) == ["ADDR", "NAME", "TYPE"]
    assert {c.table_name for c in cells} == {"ev"} and {c.cf for c in cells} == {"dns"}


def test_edges_reverse_self_and_stats(spark):
    assert parse_edges("a:b,a:b,c:d:e,") == [("a", "b"), ("c", "d:e")]
    assert directed_edges("name:addr,addr:name,x:x") == [("name", "addr"), ("addr", "name"), ("x", "x")]
    assert directed_edges("name:addr") == [("name", "addr"), ("addr", "name")]
    df = spark.createDataFrame([("A.Example.", "A", "1.2.3.4")], "name string, type string, addr string")
    cells = edge_cells(df, "g", "dns", "name:addr").collect()
    rows = sorted(c.row for c in cells if c.cf == "e\x00A")
    assert rows == ["1.2.3.4\x00ADDR\x00NAME\x00a.example.", "a.example.\x00NAME\x00ADDR\x001.2.3.4"]
    stats = sorted((c.row, c.cq) for c in cells if c.cf == "s\x00A")
    assert stats == [("1.2.3.4", "dns\x00ADDR"), ("a", "dns\x00TYPE"), ("a.example.", "dns\x00NAME")]
    no_type = spark.createDataFrame([("x.", "1.1.1.1")], "name string, addr string")
    assert {c.cf for c in edge_cells(no_type, "g", "dns", "name:addr", univariate=False).collect()} == {"e\x00UNKNOWN"}
    counts = cell_counts(edge_cells(df.union(df), "g", "dns", "name:addr", univariate=False)).collect()
    assert {c.n for c in counts} == {2}


# --- T10 / T11 / A6 decode ----------------------------------------------------------------------------

def test_t10_t11_decode_all_or_nothing_and_padding(spark):
    good = encode_message(1, header_flags(["qr"]), [("a.example.", 1, 1)], [{"name": "a.example.", "type_code": 1, "ttl": 5, "addr": "1.2.3.4"}])
    two = encode_message(2, 0, [], [{"name": "b.", "type_code": 1, "ttl": 5, "addr": "1.1.1.1"},
                                    {"name": "b.", "type_code": 1, "ttl": 5, "addr": "2.2.2.2"}])
    raw = spark.createDataFrame(
        [("a", good + b"\x00" * 9), ("b", two[:-2]), ("c", b"\x01\x02")], "question string, wire binary"
    )
    obs = Observation("parse")
    recs = decode_responses(raw, observation=obs).collect()
    assert [(r.name, r.addr) for r in recs] == [("a.example.", "1.2.3.4")]
    assert obs.get == {"parse_failures": 2, "records": 1}
    pf = parse_failures(raw).first()
    assert (pf.parse_failures, pf.records) == (2, 1)


def test_p9_message_view_and_text(spark):
    wire = encode_message(
        5, header_flags(["qr", "aa"], rcode=3), [("x.example.", 1, 1)],
        authority=[{"name": "example.", "type_code": 6, "ttl": 60, "host": "ns.example.", "admin": "h.example.", "serial": 1}],
    )
    raw = spark.createDataFrame([("x.example.\tIN\tA", wire)], "question string, wire binary")
    m = decode_messages(raw).first()
    assert (m.rcode, m.opcode, m.id, list(m.flags)) == ("NXDOMAIN", "QUERY", 5, ["qr", "aa"])
    assert m.answers is None and m.additional is None
    assert m.authority[0].type == "SOA" and m.authority[0].ttl == 60
    assert m.question[0].name == "x.example." and m.question[0].rdata == ""
    text = response_text(decode_messages(raw)).first().text
    assert text.startswith("x.example.\tIN\tA: {") and '"rcode":"NXDOMAIN"' in text


# --- T12 ANSI-safe address parsing --------------------------------------------------------------------

def test_t12_ipv4_parse_never_raises(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("256.1.1.1",), ("a.b.c.d",), ("1.2.3",), (None,)], "a string")
    got = [r.ip for r in df.select(ipv4_to_long("a").alias("ip")).collect()]
    assert got == [16909060, None, None, None, None]


# --- extraction (P12-P14) ------------------------------------------------------------------------------

def test_extract_json_encode_then_strip(spark):
    df = spark.createDataFrame([('a"b', 10), ('""x"', 20), (None, 30)], "s string, n int")
    vals = {r.value for r in extract_values(df, "s").collect()}
    assert vals == {'a\\"b', '\\"\\"x\\'}
    assert {r.value for r in extract_values(df, "n").collect()} == {"10", "20", "30"}
    assert {r.value for r in extract_values(df, "array(n, 1)").collect()} == {"[10,1]", "[20,1]", "[30,1]"}
    assert {r.value for r in extract_values(df, "s", strip_outer_quotes=False).collect()} == {'"a\\"b"', '"\\"\\"x\\""'}
    js = spark.createDataFrame([('{"k": "v\\"1", "n": 2, "z": null}',)], "j string").select(F.parse_json("j").alias("v"))
    assert extract_values(js, "variant_get(v, '$.z')").count() == 0
    assert {r.value for r in extract_values(js, "variant_get(v, '$.k')", strip_outer_quotes=False).collect()} == {'"v\\"1"'}
    assert {r.value for r in extract_values(js, "variant_get(v, '$.n')").collect()} == {"2"}
    c = extract_counts(df, "s").first()
    assert (c.result, c.no_result) == (2, 1)
    once = extract_values(df, "s")
    assert sorted(r.value for r in extract_values(once, "value", strip_outer_quotes=False).collect()) != []


def test_filter_counts_and_observe(spark):
    df = records(spark, [{"name": "a.", "type": "A"}, {"name": "b.", "type": "MX"}, {"name": "c."}])
    c = filter_counts(df, "type = 'A'").first()
    assert (c.matched, c.non_matched) == (1, 2)
    kept, obs = observe_filter(df, "type = 'A'")
    assert kept.count() == 1 and obs.get == {"matched": 1, "non_matched": 2}


# --- resolve (J3, J5, A3-A5) --------------------------------------------------------------------------

def test_resolve_outcomes(spark):
    reqs = spark.createDataFrame(
        [("a.", "A", "IN"), ("a.", "A", "IN"), ("b.", "A", "IN"), ("c.", "MX", "IN"), ("bad..", "A", "IN")],
        "name string, type string, dclass string",
    )
    ans = spark.createDataFrame(
        [("a.", "A", "IN", 5, "ok", "NOERROR"), ("a.", "A", "IN", 7, "ok", "NOERROR"), ("b.", "A", "IN", 3, "ok", "NXDOMAIN"),
         ("bad..", "A", "IN", 1, "ok", "NOERROR")],
        "name string, type string, dclass string, ms long, outcome string, rcode string",
    )
    att = resolve(reqs, ans)
    got = sorted((r.name, r.outcome, r.rcode, r.ms) for r in att.collect())
    assert got == [("a.", "ok", "NOERROR", 5), ("a.", "ok", "NOERROR", 5), ("b.", "ok", "NXDOMAIN", 3),
                   ("bad..", "parse_failure", None, None), ("c.", "timeout", None, None)]
    assert responses(att).count() == 3
    assert {(r.rcode, r.n) for r in rcode_counts(att).collect()} == {("NOERROR", 2), ("NXDOMAIN", 1)}
    s = lookup_summary(att).first()
    assert (s.num_requests, s.responses, s.request_timeouts, s.request_parse_failures, s.perform_ms, s.perform_pct) == (5, 3, 1, 1, 13, 100.0)
    assert att.where("question = 'a.\tIN\tA'").count() == 2


def test_resolve_with_lookup_function(spark):
    # defined here so that it is shipped to the Python workers by value
    def _stub_factory(timeout):
        def lookup(name, rtype, dclass):
            if name.startswith("slow"):
                raise TimeoutError()
            if name.startswith("down"):
                raise OSError("refused")
            return "NOERROR", encode_message(1, header_flags(["qr"]), [(name, 1, 1)],
                                             [{"name": name, "type_code": 1, "ttl": 1, "addr": "192.0.2.1"}])
        return lookup

    reqs = spark.createDataFrame([("ok.", "A", "IN"), ("slow.", "A", "IN"), ("down.", "A", "IN"), ("..", "A", "IN")],
                                 "name string, type string, dclass string")
    att = resolve_with(reqs, _stub_factory, threads=4, partitions=2)
    got = sorted((r.name, r.outcome) for r in att.collect())
    assert got == [("..", "parse_failure"), ("down.", "failure"), ("ok.", "ok"), ("slow.", "timeout")]
    assert decode_responses(responses(att)).first().addr == "192.0.2.1"


def test_pick_nameserver_is_stable(spark):
    df = spark.createDataFrame([("a.",), ("b.",), ("c.",)], "name string")
    a = [r.ns for r in df.select(pick_nameserver(["n1", "n2"]).alias("ns")).collect()]
    b = [r.ns for r in df.select(pick_nameserver(["n1", "n2"]).alias("ns")).collect()]
    assert a == b and set(a) <= {"n1", "n2"}


def test_packed_messages_roundtrip(spark, sf_dir):
    """Records packed six to a message (answer/additional/authority, names compressed across
    records), decoded in Spark: the distinct records come back unchanged."""
    from rrspark.plans.fixtures import fixture
    from rrspark.plans.wire_fixtures import record_messages

    rr = fixture(spark, sf_dir, "rr")
    cols = [c for c in rr.columns if c != "ttl"]
    got = distinct_records(decode_responses(record_messages(rr)).select(*cols))
    want = distinct_records(rr).select(*cols)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_signature_times_are_utc_in_any_session(spark):
    import datetime
    import struct

    from rrspark.functions.rdata import _time

    seconds = [0, 1, 951782399, 951782400, 1709164800, 2**31, 2**32 - 1, 1711846800]
    df = spark.createDataFrame([(i, bytearray(struct.pack("!I", s))) for i, s in enumerate(seconds)], "i int, data binary")
    want = [datetime.datetime.fromtimestamp(s, datetime.timezone.utc).strftime("%Y%m%d%H%M%S") for s in seconds]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r["t"] for r in df.orderBy("i").select(_time(F.col("data"), 0).alias("t")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_presentation_text_of_further_types(spark):
    import base64
    import struct

    from rrspark.operators.decode import decode_responses

    def name(text):
        return b"".join(bytes([len(x)]) + x.encode() for x in text.split(".") if x) + b"\0"

    def message(code, data):
        head = struct.pack("!6H", 1, 0x8180, 0, 1, 0, 0)
        return bytearray(head + name("alfa.example.com.") + struct.pack("!HHIH", code, 1, 60, len(data)) + data)

    # the bitmap of RFC 4034, 4.3
    bitmap = bytes([0, 6, 0x40, 1, 0, 0, 0, 3, 4, 0x1B]) + bytes(26) + b"\x20"
    cases = {
        47: (name("host.example.com.") + bitmap, "host.example.com. A MX RRSIG NSEC TYPE1234"),
        51: (b"\x01\x00\x00\x0c\x04\xaa\xbb\xcc\xdd", "1 0 12 AABBCCDD"), 37: (struct.pack("!HHB", 1, 7, 5) + b"cert", "1 7 5 Y2VydA=="),
        49: (b"\x00\x02\x01abc", base64.b64encode(b"\x00\x02\x01abc").decode()), 26: (b"\x00\x0a" + name("a.b.") + name("c."), "10 a.b. c."),
        3: (name("m."), "m."), 4: (name("f."), "f."), 19: (b"\x03123", '"123"'), 20: (b"\x02ab\x01c", '"ab" "c"'),
        27: (b"\x021.\x012\x013", '"1." "2" "3"'), 29: (b"\x00\x01", "\\# 2 0001")}
    df = spark.createDataFrame([(str(c), message(c, d)) for c, (d, _) in cases.items()], "question string, wire binary")
    got = {r["type"]: r["rdata"] for r in decode_responses(df).collect()}
    from rrspark.schema import type_name
    assert got == {type_name(c): text for c, (_, text) in cases.items()}
    empty = spark.createDataFrame([("q", message(51, b"\x01\x00\x00\x01\x00")), ("q", message(47, name("n.")))], "question string, wire binary")
    assert sorted(r["rdata"] for r in decode_responses(empty).collect()) == ["1 0 1 -", "n."]
