"""Registered queries: a Spark form and an equivalent DuckDB SQL form each.

Every query reads the driver's tables through the fixtures, so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.cells import (
    edge_cells, edge_generator, event_cells, event_generator, event_id, generate_cells,
    map_edge_generator, map_event_generator, record_cell_counts, store_summary, value_stat_generator,
)
from ..operators.decode import decode_messages, decode_responses, parse_failures, response_text, section_size
from ..operators.extract import extract_count_columns, extract_values
from ..operators.filters import filter_count_columns, filter_records, lower_unless_ipv4
from ..operators.open_records import enrich_open, filter_open, key as open_key, open_records
from ..operators.requests import dedupe_requests, expand_requests, order_requests, with_codes
from ..operators.resolve import lookup_summary, pick_nameserver, question_key, rcode_counts, resolve, responses
from ..operators.geo import enrich_geo, geo_counts
from ..operators.geo_known import KnownAddresses, enrich_geo_known
from ..operators.history import RecordHistory
from ..operators.records import distinct_records, drop_ttl, partition_sorted, records_from_json, records_to_json
from ..session import scratch_path
from ..sinks.files import store, store_json, write_by_type, write_cells, write_records, write_responses
from ..sinks.module import COUNTERS, ParquetFactory, store_records
from ..sinks.store import BUCKETS, CellStore
from ..sources.files import read_domains, read_ranges, read_records, read_responses
from ..schema import IPV4_NAME_PATTERN as IPV4_NAME_RE
from .pipeline import run_chain
from .messages import answers_with_wire
from .wire_fixtures import record_responses
from .fixtures import fixture, stored, with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

_SPARK: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None, fixtures: list[str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _SPARK[name] = fn
        if oracle is not None:
            _ORACLE[name] = with_fixtures(oracle, fixtures)
        return fn
    return deco


def rr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "rr")


# Records that a task of a large aggregate takes. A task's hash tables then fit its share of a small heap, or spill a few times only.
TASK_RECORDS = 200_000
# Tasks that count cells take this many times fewer records, as a record gives several cells.
RECORD_CELLS = 4


def _partitions(spark: SparkSession, sf_dir: str, per_record: int = 1) -> int | None:
    """In how many partitions to aggregate the records (counted from the stored table's footers); None where the
    session's own tasks are small enough."""
    n = -(-rr(spark, sf_dir).count() * per_record // TASK_RECORDS)
    return n if n > spark.sparkContext.defaultParallelism * per_record else None


RR_COLS = "dclass, name, type, ttl, addr, addrv6, target, priority, alias, host"
RR_COLS_NO_TTL = "dclass, name, type, addr, addrv6, target, priority, alias, host"


# --- requests and resolving ----------------------------------------------------------------

TRIM_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"
SUBDOMAINS = ["", "www", "m."]


Q01_SQL = f"""
SELECT d.domain, CASE WHEN d.n LIKE '%.' THEN d.n ELSE d.n || '.' END AS name, t.type, t.type_code,
       'IN' AS dclass, 1 AS dclass_code
FROM (SELECT domain, CASE WHEN s.sub = '' THEN tr WHEN s.sub LIKE '%.' THEN s.sub || tr ELSE s.sub || '.' || tr END AS n
      FROM (SELECT domain, regexp_replace(domain, '{TRIM_RE}', '', 'g') AS tr FROM domains) x,
           (VALUES (''), ('www'), ('m.')) s(sub)) d,
     (VALUES ('A', 1), ('MX', 15)) t(type, type_code)"""


@register("q01_requests", Q01_SQL)
def q01_requests(spark, sf_dir):
    """Every domain line x {A, MX} x {bare, www, m.}; duplicates kept."""
    return expand_requests(fixture(spark, sf_dir, "domains"), types="A,MX", subdomains=SUBDOMAINS)


@register(
    "q02_request_dedupe",
    f"SELECT DISTINCT name, type, type_code, dclass, dclass_code FROM ({Q01_SQL}) q",
)
def q02_request_dedupe(spark, sf_dir):
    return dedupe_requests(q01_requests(spark, sf_dir))


VALID_NAME_SQL = r"(r.name = '.' OR (regexp_full_match(r.name, '([^.]{1,63}\.)+') AND strlen(r.name) <= 254))"
ATTEMPTS_SQL = f"""
SELECT r.name, r.type, r.dclass, r.name || chr(9) || r.dclass || chr(9) || r.type AS question,
  CASE WHEN NOT {VALID_NAME_SQL} THEN 'parse_failure' ELSE coalesce(a.outcome, 'timeout') END AS outcome,
  CASE WHEN {VALID_NAME_SQL} AND a.outcome = 'ok' THEN a.rcode END AS rcode,
  CASE WHEN {VALID_NAME_SQL} THEN a.ms END AS ms
FROM requests r LEFT JOIN answers a ON r.name = a.name AND r.type = a.type AND r.dclass = a.dclass"""


# The recorded answers are one row per (name, type, class) by construction (GROUP BY), so
# the queries tell ``resolve`` instead of letting it reduce them again.
def _attempts(spark, sf_dir) -> DataFrame:
    return resolve(fixture(spark, sf_dir, "requests"), spark.table("answers"), answers_unique=True)


@register("q03_resolve", ATTEMPTS_SQL)
def q03_resolve(spark, sf_dir):
    """Requests resolved against recorded answers: one attempt row per request."""
    return _attempts(spark, sf_dir)


BEST_SQL = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, type, dclass ORDER BY
    CASE outcome WHEN 'ok' THEN 1 WHEN 'failure' THEN 2 ELSE 3 END,
    CASE rcode WHEN 'NOERROR' THEN 0 WHEN 'SERVFAIL' THEN 2 WHEN 'NXDOMAIN' THEN 3 ELSE 65536 END, ms) AS place
  FROM repeated_answers) x WHERE place = 1)"""


@register("q37_resolve_repeated", ATTEMPTS_SQL.replace("answers a ON", f"{BEST_SQL} a ON"))
def q37_resolve_repeated(spark, sf_dir):
    """Several recorded answers per question, responses and failures mixed: the best one counts."""
    return resolve(fixture(spark, sf_dir, "requests"), spark.table("repeated_answers"))


@register("q04_rcodes", f"SELECT rcode, count(*) AS n FROM ({ATTEMPTS_SQL}) x WHERE outcome = 'ok' GROUP BY rcode")
def q04_rcodes(spark, sf_dir):
    return rcode_counts(_attempts(spark, sf_dir))


@register(
    "q04_lookup_summary",
    f"""
SELECT count(*) AS num_requests, count(*) FILTER (WHERE outcome = 'ok') AS responses,
  count(*) FILTER (WHERE outcome = 'failure') AS lookup_failures,
  count(*) FILTER (WHERE outcome = 'timeout') AS request_timeouts,
  count(*) FILTER (WHERE outcome = 'parse_failure') AS request_parse_failures,
  CAST(0 AS BIGINT) AS construct_ms, CAST(coalesce(sum(ms), 0) AS BIGINT) AS perform_ms, CAST(0 AS BIGINT) AS parse_ms,
  CAST(coalesce(sum(ms), 0) AS BIGINT) AS total_ms,
  round(0 * 100.0 / sum(ms), 4) AS construct_pct, round(sum(ms) * 100.0 / sum(ms), 4) AS perform_pct,
  round(0 * 100.0 / sum(ms), 4) AS parse_pct
FROM ({ATTEMPTS_SQL}) x""",
)
def q04_lookup_summary(spark, sf_dir):
    return lookup_summary(_attempts(spark, sf_dir))


@register(
    "q51_lookup_times",
    f"""
SELECT count(*) AS num_requests, count(*) FILTER (WHERE outcome = 'ok') AS responses,
  count(*) FILTER (WHERE outcome = 'failure') AS lookup_failures,
  count(*) FILTER (WHERE outcome = 'timeout') AS request_timeouts,
  count(*) FILTER (WHERE outcome = 'parse_failure') AS request_parse_failures,
  CAST(sum(length(name)) AS BIGINT) AS construct_ms, CAST(sum(ms) AS BIGINT) AS perform_ms, CAST(0 AS BIGINT) AS parse_ms,
  CAST(sum(length(name) + coalesce(ms, 0) + 1) AS BIGINT) AS total_ms,
  round(sum(length(name)) * 100.0 / sum(length(name) + coalesce(ms, 0) + 1), 4) AS construct_pct,
  round(sum(ms) * 100.0 / sum(length(name) + coalesce(ms, 0) + 1), 4) AS perform_pct, CAST(0 AS DOUBLE) AS parse_pct
FROM ({ATTEMPTS_SQL}) x""",
)
def q51_lookup_times(spark, sf_dir):
    """Lookup totals and time shares of attempts that come with construction and total times."""
    attempts = _attempts(spark, sf_dir).withColumn("construct_ms", F.length("name").cast("long"))
    total = F.col("construct_ms") + F.coalesce("ms", F.lit(0)) + 1
    return lookup_summary(attempts.withColumn("total_ms", total.cast("long")))


# --- deduplication -----------------------------------------------------------------------

@register("q05_distinct", f"SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr")
def q05_distinct(spark, sf_dir):
    return distinct_records(rr(spark, sf_dir), ignore_ttl=True)


@register("q06_distinct_ttl", f"SELECT DISTINCT {RR_COLS} FROM rr")
def q06_distinct_ttl(spark, sf_dir):
    return distinct_records(rr(spark, sf_dir), ignore_ttl=False, partitions=_partitions(spark, sf_dir))


@register("q54_distinct_history", f"SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr")
def q54_distinct_history(spark, sf_dir):
    """Distinct records over three batches, each only against what the history holds; what all of them added."""
    recs = rr(spark, sf_dir)
    history = RecordHistory(spark, scratch_path(spark, "history"), drop_ttl(recs).schema, buckets=8)
    large = _partitions(spark, sf_dir) is not None
    added = [history.add(recs.where(w), large=large) for w in ("type IN ('A', 'MX')", "type <> 'A'", "type = 'A'")]
    return added[0].unionByName(added[1]).unionByName(added[2])


# --- filter + extract --------------------------------------------------------------------

def _extract_lower_unless_ip(spark, sf_dir, rtype: str, field: str) -> DataFrame:
    recs = distinct_records(rr(spark, sf_dir))
    return extract_values(filter_records(recs, f"type = '{rtype}'"), lower_unless_ipv4(field))


def _oracle_lower_unless_ip(rtype: str, field: str) -> str:
    return (
        f"SELECT DISTINCT lower({field}) AS value FROM (SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr) d "
        f"WHERE type = '{rtype}' AND NOT regexp_full_match({field}, '{IPV4_NAME_RE}')"
    )


@register("q07_mailservers", _oracle_lower_unless_ip("MX", "target"))
def q07_mailservers(spark, sf_dir):
    """Distinct mail servers: MX targets that are not IPv4-looking names, lower-cased."""
    return _extract_lower_unless_ip(spark, sf_dir, "MX", "target")


@register("q08_nameservers", _oracle_lower_unless_ip("NS", "target"))
def q08_nameservers(spark, sf_dir):
    return _extract_lower_unless_ip(spark, sf_dir, "NS", "target")


@register("q09_soa_hosts", _oracle_lower_unless_ip("SOA", "host"))
def q09_soa_hosts(spark, sf_dir):
    return _extract_lower_unless_ip(spark, sf_dir, "SOA", "host")


@register(
    "q10_filter_null_safe",
    f"SELECT {RR_COLS} FROM rr WHERE target IS DISTINCT FROM 'MX1.Example.NET.'",
)
def q10_filter_null_safe(spark, sf_dir):
    """``target != 'MX1.Example.NET.'`` where a missing target counts as not equal."""
    return filter_records(rr(spark, sf_dir), "NOT (target <=> 'MX1.Example.NET.')")


@register(
    "q11_filter_counts",
    f"""
SELECT count(*) FILTER (WHERE type = 'MX') AS matched,
       count(*) FILTER (WHERE type IS DISTINCT FROM 'MX') AS non_matched,
       count(*) FILTER (WHERE type = 'MX' AND NOT regexp_full_match(target, '{IPV4_NAME_RE}')) AS result,
       count(*) - count(*) FILTER (WHERE type = 'MX' AND NOT regexp_full_match(target, '{IPV4_NAME_RE}')) AS no_result
FROM rr""",
)
def q11_filter_counts(spark, sf_dir):
    """MATCHED / NON-MATCHED of the MX filter and RESULT / NO RESULT of the mail-server
    extraction over all records, in one scan."""
    recs = rr(spark, sf_dir)
    return recs.agg(
        *filter_count_columns(recs, "type = 'MX'"),
        *extract_count_columns(F.when(F.col("type") == "MX", lower_unless_ipv4("target"))),
    )


# --- geo enrichment ----------------------------------------------------------------------

GEO_OUT = "city, cc, country, lat, long, asn, org"


def _oracle_geo(src: str, blocks: str = "blocks") -> str:
    """DuckDB form of the enrichment over relation ``src`` (plain BETWEEN join)."""
    priv = ("(s.addr LIKE '10.%' OR s.addr LIKE '192.168.%' OR "
            "regexp_full_match(s.addr, '172\\.(1[6-9]|2[0-9]|3[01])\\..*'))")
    ip = ("(CAST(split_part(s.addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(s.addr, '.', 2) AS BIGINT) * 65536"
          " + CAST(split_part(s.addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(s.addr, '.', 4) AS BIGINT))")
    asn_re = r"AS(\d+)\s+(.+)"
    def pick(found_value, zero=False):
        p = "'0.0'" if zero else "'RFC1918'"
        u = "'0.0'" if zero else "'UNKNOWN'"
        return (f"CASE WHEN j.addr IS NULL THEN NULL WHEN j.priv THEN {p} WHEN j.b_start IS NULL THEN {u} "
                f"ELSE {found_value} END")
    matched = f"regexp_full_match(j.org_raw, '{asn_re}')"
    return f"""(SELECT j.* EXCLUDE (priv, b_start, b_city, b_cc, b_country, b_lat, b_long, org_raw),
  {pick('upper(j.b_city)')} AS city, {pick('upper(j.b_cc)')} AS cc, {pick('upper(j.b_country)')} AS country,
  {pick('upper(j.b_lat)', True)} AS lat, {pick('upper(j.b_long)', True)} AS long,
  {pick(f"CASE WHEN {matched} THEN regexp_extract(j.org_raw, '^{asn_re}$', 1) END")} AS asn,
  {pick(f"CASE WHEN {matched} THEN upper(regexp_extract(j.org_raw, '^{asn_re}$', 2)) ELSE upper(j.org_raw) END")} AS org
 FROM (SELECT s.*, {priv} AS priv, b.start_ip AS b_start, b.city AS b_city, b.cc AS b_cc,
         b.country AS b_country, b.lat AS b_lat, b.long AS b_long, b.org_raw
       FROM {src} s LEFT JOIN {blocks} b
         ON s.addr IS NOT NULL AND NOT {priv} AND {ip} BETWEEN b.start_ip AND b.end_ip) j)"""


def _geo(spark, sf_dir, distinct: bool) -> DataFrame:
    recs = rr(spark, sf_dir)
    if distinct:
        recs = distinct_records(recs)
    return enrich_geo(recs, fixture(spark, sf_dir, "blocks"))


@register(
    "q12_geo",
    f"SELECT name, addr, {GEO_OUT} FROM {_oracle_geo(f'(SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr)')} g "
    "WHERE addr IS NOT NULL",
)
def q12_geo(spark, sf_dir):
    """Distinct A records with location and owner fields."""
    return _geo(spark, sf_dir, distinct=True).where("addr IS NOT NULL").select(
        "name", "addr", *GEO_OUT.split(", ")
    )


@register("q13_geo_by_country", f"SELECT cc, count(*) AS n FROM {_oracle_geo('rr')} g GROUP BY cc")
def q13_geo_by_country(spark, sf_dir):
    """Records per country code after enrichment (NULL = not an A record)."""
    return geo_counts(_geo(spark, sf_dir, distinct=False), "cc")


@register(
    "q14_geo_passthrough",
    f"SELECT {RR_COLS}, {GEO_OUT} FROM {_oracle_geo('(SELECT * FROM rr WHERE addr IS NOT NULL)')} g "
    f"UNION ALL SELECT {RR_COLS}, NULL AS city, NULL AS cc, NULL AS country, NULL AS lat, NULL AS long, "
    "NULL AS asn, NULL AS org FROM rr WHERE addr IS NULL",
)
def q14_geo_passthrough(spark, sf_dir):
    """Whole enrichment output, duplicates kept: A records enriched, others unchanged."""
    return _geo(spark, sf_dir, distinct=False)


def _oracle_geo_ranges() -> str:
    """Location and owner of every distinct address by the narrowest range over it, as one-address
    blocks for ``_oracle_geo``; coordinates print as 32-bit floats."""
    ip = ("(CAST(split_part(addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(addr, '.', 2) AS BIGINT) * 65536"
          " + CAST(split_part(addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(addr, '.', 4) AS BIGINT))")

    def best(table: str, order: str) -> str:
        return (f"(SELECT * FROM (SELECT i.ip, t.*, row_number() OVER (PARTITION BY i.ip ORDER BY t.end_ip - t.start_ip, "
                f"t.start_ip, {order}) AS place FROM ips i JOIN {table} t ON i.ip BETWEEN t.start_ip AND t.end_ip) b "
                "WHERE place = 1)")
    return f"""
WITH ips AS (SELECT DISTINCT {ip} AS ip FROM rr WHERE addr IS NOT NULL),
found AS (SELECT l.ip AS start_ip, l.ip AS end_ip, l.city, l.cc, l.country, CAST(CAST(l.lat AS FLOAT) AS VARCHAR) AS lat,
            CAST(CAST(l.long AS FLOAT) AS VARCHAR) AS long, o.org_raw
          FROM {best('city_ranges', 't.city')} l LEFT JOIN {best('owner_ranges', 't.org_raw')} o ON l.ip = o.ip)
SELECT {RR_COLS}, {GEO_OUT} FROM {_oracle_geo('(SELECT * FROM rr WHERE addr IS NOT NULL)', 'found')} g
UNION ALL SELECT {RR_COLS}, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM rr WHERE addr IS NULL"""


def _geo_ranges(spark, sf_dir, **limits) -> DataFrame:
    recs = rr(spark, sf_dir)
    tables = []
    for name in ("city_ranges", "owner_ranges"):
        path = scratch_path(spark, name)
        fixture(spark, sf_dir, name).write.parquet(path)
        tables.append(read_ranges(spark, path))
    return enrich_geo(recs, tables[0], asn=tables[1], **limits)


@register("q38_geo_ranges", _oracle_geo_ranges())
def q38_geo_ranges(spark, sf_dir):
    """Overlapping location ranges and a separate owner table, both small enough to broadcast."""
    return _geo_ranges(spark, sf_dir)


@register("q39_geo_ranges_sorted", _oracle_geo_ranges())
def q39_geo_ranges_sorted(spark, sf_dir):
    """The same by the path for tables too large to broadcast."""
    return _geo_ranges(spark, sf_dir, broadcast_rows=0)


@register(
    "q53_geo_known",
    f"SELECT {RR_COLS}, {GEO_OUT} FROM {_oracle_geo('(SELECT * FROM rr WHERE addr IS NOT NULL)')} g "
    f"UNION ALL SELECT {RR_COLS}, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM rr WHERE addr IS NULL",
)
def q53_geo_known(spark, sf_dir):
    """The enrichment in two batches, the second with the addresses that the first looked up."""
    known = KnownAddresses(spark, scratch_path(spark, "known-addresses"))
    recs, blocks = rr(spark, sf_dir), fixture(spark, sf_dir, "blocks")
    second = F.coalesce(F.col("ttl") % 2 == 0, F.lit(False))
    parts = [enrich_geo_known(recs.where(part), blocks, known) for part in (~second, second)]
    return parts[0].unionByName(parts[1])


# --- cells: events, edges, statistics --------------------------------------------------------

RR_FIELDS_NO_TTL = RR_COLS_NO_TTL.split(", ")
EVENT_TABLE, EDGE_TABLE, DATA_TYPE = "dns_events", "dns_edges", "dns"
EDGES = "name:addr,name:target,target:name,name:alias,alias:alias"
# The same configuration after adding reverse edges (each reverse not configured already).
EDGES_DIRECTED = [("name", "addr"), ("addr", "name"), ("name", "target"), ("target", "name"),
                  ("name", "alias"), ("alias", "name"), ("alias", "alias")]


def _oracle_event_id(fields: list[str]) -> str:
    parts = ", ".join(f"'{f}=' || CAST({f} AS VARCHAR)" for f in sorted(fields))
    h = f"md5('{{' || concat_ws(', ', {parts}) || '}}')"
    return (f"(substr({h}, 1, 12) || '3' || substr({h}, 14, 3) || "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 15))")


def _distinct_rr(spark, sf_dir) -> DataFrame:
    return distinct_records(rr(spark, sf_dir), partitions=_partitions(spark, sf_dir))


@register(
    "q15_event_ids",
    f"SELECT {_oracle_event_id(RR_FIELDS_NO_TTL)} AS event_id, {RR_COLS_NO_TTL} "
    f"FROM (SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr) d",
)
def q15_event_ids(spark, sf_dir):
    d = _distinct_rr(spark, sf_dir)
    return d.select(event_id(d).alias("event_id"), *d.columns)


@register(
    "q16_event_cells",
    f"SELECT '{EVENT_TABLE}' AS table_name, event_id AS \"row\", '{DATA_TYPE}' AS cf, cq, value FROM "
    f"(SELECT {_oracle_event_id(RR_FIELDS_NO_TTL)} AS event_id, * FROM (SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr) d) e "
    "CROSS JOIN LATERAL (VALUES "
    + ", ".join(f"('{f.upper()}', CAST({f} AS VARCHAR))" for f in RR_FIELDS_NO_TTL)
    + ") v(cq, value) WHERE value IS NOT NULL",
)
def q16_event_cells(spark, sf_dir):
    return event_cells(_distinct_rr(spark, sf_dir), EVENT_TABLE, DATA_TYPE)


def _oracle_edges(src: str) -> str:
    rows = []
    for a, b in EDGES_DIRECTED:
        rows.append(
            f"SELECT '{EDGE_TABLE}' AS table_name, lower(CAST({a} AS VARCHAR)) || chr(0) || '{a.upper()}' || chr(0) || "
            f"'{b.upper()}' || chr(0) || lower(CAST({b} AS VARCHAR)) AS \"row\", 'e' || chr(0) || coalesce(type, 'UNKNOWN') AS cf, "
            f"'{DATA_TYPE}' AS cq, '1' AS value FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        )
    return "\nUNION ALL\n".join(rows)


@register("q17_edges", _oracle_edges(f"(SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr)"))
def q17_edges(spark, sf_dir):
    """Edge cells with reverse edges; a configured reverse or self pair is not doubled."""
    return edge_cells(_distinct_rr(spark, sf_dir), EDGE_TABLE, DATA_TYPE, EDGES, bidirectional=True, univariate=False)


@register(
    "q18_value_stats",
    "SELECT table_name, \"row\", cf, cq, count(*) AS n FROM ("
    + "\nUNION ALL\n".join(
        f"SELECT '{EDGE_TABLE}' AS table_name, lower(CAST({f} AS VARCHAR)) AS \"row\", 's' || chr(0) || coalesce(type, 'UNKNOWN') AS cf, "
        f"'{DATA_TYPE}' || chr(0) || '{f.upper()}' AS cq FROM rr WHERE {f} IS NOT NULL"
        for f in RR_COLS.split(", ")
    )
    + ") s GROUP BY table_name, \"row\", cf, cq",
)
def q18_value_stats(spark, sf_dir):
    """How often each value occurs per field and record type, over all records."""
    return record_cell_counts(rr(spark, sf_dir), value_stat_generator(EDGE_TABLE, DATA_TYPE),
                              _partitions(spark, sf_dir, RECORD_CELLS))


@register(
    "q19_edge_counts",
    f"SELECT table_name, \"row\", cf, cq, count(*) AS n FROM ({_oracle_edges('rr')}) e GROUP BY table_name, \"row\", cf, cq",
)
def q19_edge_counts(spark, sf_dir):
    """Edge frequencies over all records (duplicates count)."""
    return record_cell_counts(rr(spark, sf_dir), edge_generator(EDGE_TABLE, DATA_TYPE, EDGES, univariate=False),
                              _partitions(spark, sf_dir, RECORD_CELLS))


def records_json(spark, sf_dir) -> DataFrame:
    """JSON record lines: every record, every event's props (an ``error`` event's value
    written as an explicit null), and every page URL (not JSON)."""
    r = records_to_json(rr(spark, sf_dir))
    ev = spark.table("events").select(
        F.when(F.col("event_type") == "error", F.lit('{"k": null}')).otherwise(F.col("props")).alias("json"))
    pg = spark.table("pages").select(F.col("url").alias("json"))
    return r.unionByName(ev).unionByName(pg)


@register(
    "q27_store_summary",
    """SELECT (SELECT count(*) FROM pages) AS bad_records,
       (SELECT count(*) FROM rr) + (SELECT count(*) FROM events WHERE event_type IS DISTINCT FROM 'error') AS records_stored,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS failed_store,
       (SELECT count(*) FROM rr) + (SELECT count(*) FROM events) AS total""",
)
def q27_store_summary(spark, sf_dir):
    return store_summary(records_json(spark, sf_dir))


# --- raw responses: decode, message view, JSON, type partitions, whole chain ---------------------

def _rr_messages(spark, sf_dir) -> DataFrame:
    """Raw responses, one message per record: a stored input table, made once per session."""
    recs = rr(spark, sf_dir)
    return stored(spark, sf_dir, "messages", lambda: record_responses(recs))


@register("q20_decode_roundtrip", f"SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr")
def q20_decode_roundtrip(spark, sf_dir):
    """Every record encoded as a wire response (compressed owner name), decoded, deduped."""
    return distinct_records(decode_responses(_rr_messages(spark, sf_dir), fields=RR_FIELDS_NO_TTL),
                            partitions=_partitions(spark, sf_dir))


TYPED_COLS = "dclass, name, type, ttl, target, priority, weight, port, host, admin, serial, refresh, retry, expire, min, rdata"
TXT_LINE = ("CASE WHEN type = 'TXT' THEN name || CASE WHEN length(name) < 16 THEN chr(9) ELSE '' END || chr(9) || "
            "CAST(ttl AS VARCHAR) || chr(9) || 'IN' || chr(9) || 'TXT' || chr(9) || '\"' || txt || '\"' END")


def _typed(spark, sf_dir, txt_mode: str) -> DataFrame:
    typed = fixture(spark, sf_dir, "typed").withColumnRenamed("txt", "text").withColumn("rdata", F.col("raw")).drop("raw")
    raw = stored(spark, sf_dir, "typed-messages", lambda: record_responses(typed))
    return decode_responses(raw, ignore_ttl=False, txt_mode=txt_mode, fields=[*TYPED_COLS.split(", "), "text"])


@register("q44_decode_types", f"SELECT {TYPED_COLS}, {TXT_LINE} AS text FROM typed")
def q44_decode_types(spark, sf_dir):
    """PTR, TXT, SRV, whole SOA, a type with presentation text and an unknown type, decoded."""
    return _typed(spark, sf_dir, "record")


@register("q45_decode_txt_rdata", f"SELECT {TYPED_COLS}, CASE WHEN type = 'TXT' THEN '\"' || txt || '\"' END AS text FROM typed")
def q45_decode_txt_rdata(spark, sf_dir):
    """The same with TXT as its quoted strings alone."""
    return _typed(spark, sf_dir, "rdata")


@register(
    "q21_messages",
    """SELECT a.rcode, count(*) AS messages, count(*) AS question_records,
  CAST(coalesce(sum(n_answers), 0) AS BIGINT) AS answer_records, CAST(coalesce(sum(n_additional), 0) AS BIGINT) AS additional_records,
  CAST(coalesce(sum(n_authority), 0) AS BIGINT) AS authority_records
FROM answers a LEFT JOIN (SELECT q_name, q_type, q_dclass, count(*) FILTER (WHERE section = 'answers') AS n_answers,
    count(*) FILTER (WHERE section = 'additional') AS n_additional, count(*) FILTER (WHERE section = 'authority') AS n_authority
  FROM answer_records GROUP BY q_name, q_type, q_dclass) r ON a.name = q_name AND a.type = q_type AND a.dclass = q_dclass
WHERE a.outcome = 'ok' GROUP BY a.rcode""",
)
def q21_messages(spark, sf_dir):
    """Message view of the recorded responses: messages and records per section, per rcode."""
    ans = answers_with_wire(spark, sf_dir).where("wire IS NOT NULL")
    msgs = decode_messages(ans.select(F.concat_ws("\t", "name", "dclass", "type").alias("question"), "wire"))
    return msgs.where("error IS NULL").groupBy("rcode").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(section_size("question")).cast("long").alias("question_records"),
        F.sum(section_size("answers")).cast("long").alias("answer_records"),
        F.sum(section_size("additional")).cast("long").alias("additional_records"),
        F.sum(section_size("authority")).cast("long").alias("authority_records"),
    )


@register("q22_json_records", f"SELECT {RR_COLS} FROM rr")
def q22_json_records(spark, sf_dir):
    """Records -> JSON text (absent fields left out) -> records."""
    js = records_to_json(rr(spark, sf_dir))
    return records_from_json(js, "json", on_bad="fail").select(*RR_COLS.split(", "))


@register(
    "q23_foreign_json",
    "SELECT DISTINCT CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS value FROM events "
    "WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 50",
)
def q23_foreign_json(spark, sf_dir):
    """Foreign JSON (event properties) through Variant: filter ``k > 50``, extract ``k``."""
    fixture(spark, sf_dir, "rr")  # registers the base tables
    ev = spark.table("events").select(F.try_parse_json("props").alias("v"))
    kept = filter_records(ev, "try_variant_get(v, '$.k', 'int') > 50")
    return extract_values(kept, "try_variant_get(v, '$.k', 'int')")


@register("q24_by_type", f"SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr WHERE type = 'MX'")
def q24_by_type(spark, sf_dir):
    """Write records into one directory per type, read back only the MX directory."""
    path = scratch_path(spark, "by_type")
    write_by_type(distinct_records(rr(spark, sf_dir)), path)
    return spark.read.parquet(path).where("type = 'MX'").select(*RR_FIELDS_NO_TTL)


PIPELINE_FILTER = "type = 'A' AND NOT (cc <=> 'RFC1918')"
PIPELINE_EXTRACT = "named_struct('addr', addr, 'cc', cc, 'country', country)"


@register(
    "q25_pipeline",
    "SELECT DISTINCT CAST(json_object('addr', addr, 'cc', cc, 'country', country) AS VARCHAR) AS value FROM "
    f"{_oracle_geo(f'(SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr)')} g WHERE type = 'A' AND cc IS DISTINCT FROM 'RFC1918'",
)
def q25_pipeline(spark, sf_dir):
    """Whole chain in one job: raw responses -> decode -> distinct -> geo -> filter -> extract."""
    chain = run_chain(_rr_messages(spark, sf_dir), fixture(spark, sf_dir, "blocks"), PIPELINE_FILTER,
                      PIPELINE_EXTRACT, fields=RR_FIELDS_NO_TTL)
    return chain.values


DECODED_COLS = "dclass, name, type, addr, addrv6, target, priority, alias, host, admin, serial"


@register(
    "q26_resolve_decode",
    f"""
SELECT DISTINCT d.dclass, d.name, d.type, d.addr, d.addrv6, d.target, d.priority, d.alias, d.host,
  CASE WHEN d.type = 'SOA' THEN '.' END AS admin, CAST(CASE WHEN d.type = 'SOA' THEN 0 END AS BIGINT) AS serial
FROM answer_records d JOIN requests r ON d.q_name = r.name AND d.q_type = r.type AND d.q_dclass = r.dclass
WHERE {VALID_NAME_SQL}""",
)
def q26_resolve_decode(spark, sf_dir):
    """Requests resolved against recorded responses, successful responses decoded, deduped."""
    reqs = fixture(spark, sf_dir, "requests")
    attempts = resolve(reqs, answers_with_wire(spark, sf_dir), answers_unique=True)
    recs = decode_responses(responses(attempts))
    return distinct_records(recs.select(*DECODED_COLS.split(", ")))


# --- views, counters, sources and sinks of the remaining operator groups --------------------------

def _q28_oracle() -> str:
    def shown(field: str, text: bool = True) -> str:
        value = f"'\"' || {field} || '\"'" if text else f"CAST({field} AS VARCHAR)"
        return f"coalesce(',\"{field}\":' || {value}, '')"

    record = ("'{\"dclass\":\"IN\",\"name\":\"' || d.name || '\",\"type\":\"' || d.type || '\",\"ttl\":' || CAST(ttl AS VARCHAR) || "
              + " || ".join([shown("addr"), shown("addrv6"), shown("target"), shown("alias"), shown("priority", False)])
              + " || CASE WHEN d.type = 'SOA' THEN ',\"admin\":\".\"' ELSE '' END || " + shown("host")
              + " || CASE WHEN d.type = 'SOA' THEN ',\"expire\":0,\"min\":0,\"refresh\":0,\"retry\":0,\"serial\":0' ELSE '' END || '}'")
    sections = " || ".join(
        f"coalesce(',\"{s}\":[' || string_agg({record}, ',' ORDER BY place) FILTER (WHERE section = '{s}') || ']', '')"
        for s in ("answers", "additional", "authority"))
    return f"""
SELECT a.name || chr(9) || a.dclass || chr(9) || a.type || ': ' || '{{"opcode":"QUERY","rcode":"' || a.rcode || '","flags":'
  || CASE WHEN a.rcode = 'NXDOMAIN' THEN '["qr","aa","rd","ra"]' ELSE '["qr","rd","ra"]' END || ',"id":' || CAST(a.ms AS VARCHAR)
  || ',"question":[{{"dclass":"IN","name":"' || a.name || '","type":"' || a.type || '","ttl":0,"rdata":""}}]' || {sections} || '}}' AS text
FROM requests r JOIN answers a ON r.name = a.name AND r.type = a.type AND r.dclass = a.dclass
LEFT JOIN answer_records d ON a.name = q_name AND a.type = q_type AND a.dclass = q_dclass
WHERE a.outcome = 'ok' AND {VALID_NAME_SQL} GROUP BY a.name, a.type, a.dclass, a.rcode, a.ms"""


@register("q28_response_text", _q28_oracle())
def q28_response_text(spark, sf_dir):
    """Dump view: ``key: message`` text of every response received for the requests."""
    attempts = resolve(fixture(spark, sf_dir, "requests"), answers_with_wire(spark, sf_dir), answers_unique=True)
    return response_text(decode_messages(responses(attempts)))


@register(
    "q29_parse_failures",
    "SELECT count(*) FILTER (WHERE type = 'CNAME') AS parse_failures, "
    "count(*) FILTER (WHERE type IS DISTINCT FROM 'CNAME') AS records, CAST(0 AS BIGINT) AS truncated_messages FROM rr",
)
def q29_parse_failures(spark, sf_dir):
    """Responses of every record, those of CNAME records cut short by 3 bytes: each cut
    message is one parse failure and yields no records."""
    raw = _rr_messages(spark, sf_dir)
    cut = F.when(F.col("question").endswith("\tCNAME"), F.expr("substring(wire, 1, length(wire) - 3)")).otherwise(F.col("wire"))
    return parse_failures(raw.withColumn("wire", cut))


@register("q32_sequence_files", f"SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr")
def q32_sequence_files(spark, sf_dir):
    """Raw responses written as Hadoop SequenceFiles (Text, BytesWritable), read back,
    decoded and deduplicated."""
    path = scratch_path(spark, "responses_seq")
    write_responses(_rr_messages(spark, sf_dir), path, format="sequence")
    return distinct_records(decode_responses(read_responses(spark, path, format="sequence"), fields=RR_FIELDS_NO_TTL))


def _stat_union(src: str, fields: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{EDGE_TABLE}' AS table_name FROM {src} WHERE {f} IS NOT NULL" for f in fields)


@register(
    "q33_store_cells",
    "SELECT table_name, count(*) AS n FROM ("
    "SELECT table_name FROM (SELECT '" + EVENT_TABLE + "' AS table_name FROM (SELECT DISTINCT " + RR_COLS_NO_TTL + " FROM rr) d CROSS JOIN LATERAL (VALUES "
    + ", ".join(f"(CAST({f} AS VARCHAR))" for f in RR_FIELDS_NO_TTL)
    + ") v(value) WHERE value IS NOT NULL) e UNION ALL SELECT table_name FROM ("
    + _oracle_edges(f"(SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr)") + ") g UNION ALL "
    + _stat_union(f"(SELECT DISTINCT {RR_COLS_NO_TTL} FROM rr)", RR_FIELDS_NO_TTL)
    + ") c GROUP BY table_name",
)
def q33_store_cells(spark, sf_dir):
    """Storage step with two generators (events; edges with statistics) writing cells to one
    directory per table; cells per table read back."""
    path = scratch_path(spark, "cells")
    gens = [event_generator(EVENT_TABLE, DATA_TYPE), edge_generator(EDGE_TABLE, DATA_TYPE, EDGES)]
    store(_distinct_rr(spark, sf_dir), gens, sink=lambda cells: write_cells(cells, path))
    return spark.read.parquet(path).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


# Cells that a task merges, about: a bucket of one table in a large store.
BUCKET_CELLS = 6_000_000

# Two data sets that share record types; a store takes one, the other, and the first again.
STORE_SETS = {"first": "type IN ('A', 'MX', 'NS')", "second": "type IN ('MX', 'NS', 'CNAME', 'SOA')"}


def _event_cell_sql(src: str) -> str:
    return (f"SELECT '{EVENT_TABLE}' AS table_name, event_id AS \"row\", '{DATA_TYPE}' AS cf, cq, value FROM "
            f"(SELECT {_oracle_event_id(RR_FIELDS_NO_TTL)} AS event_id, * FROM {src}) e CROSS JOIN LATERAL (VALUES "
            + ", ".join(f"('{f.upper()}', CAST({f} AS VARCHAR))" for f in RR_FIELDS_NO_TTL) + ") v(cq, value) WHERE value IS NOT NULL")


def _compacted(into: CellStore) -> None:
    """Compact a store that nobody else reads, and delete what that replaced at once."""
    into.compact()
    into.clean(older_than_s=0)


def _filled_store(spark, sf_dir, generators, again: str) -> CellStore:
    """A store that takes the first data set, compacts, takes the second, and the first once more under ``again``."""
    recs = rr(spark, sf_dir).drop("ttl")
    tasks = _partitions(spark, sf_dir, RECORD_CELLS)
    into = CellStore(spark, scratch_path(spark, "cell-store"), max(BUCKETS, (tasks or 0) * TASK_RECORDS // BUCKET_CELLS), large=tasks is not None)

    def add(data_set: str, run: str) -> None:
        into.add(generate_cells(recs.where(STORE_SETS[data_set]), generators), run)

    add("first", "first")
    _compacted(into)
    add("second", "second")
    add("first", again)
    return into


@register(
    "q48_cell_store",
    "SELECT DISTINCT * FROM (" + "\nUNION ALL\n".join(
        f"{_event_cell_sql(src)} UNION ALL {_oracle_edges(src)}"
        for src in [f"(SELECT {RR_COLS_NO_TTL} FROM rr WHERE {w})" for w in STORE_SETS.values()]) + ") c",
)
def q48_cell_store(spark, sf_dir):
    """Two data sets in one keyed store, the first of them stored twice: one cell per key, of both sets."""
    gens = [event_generator(EVENT_TABLE, DATA_TYPE), edge_generator(EDGE_TABLE, DATA_TYPE, EDGES, univariate=False)]
    return _filled_store(spark, sf_dir, gens, again="first, once more").cells()


def _stat_cell_sql(src: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{EDGE_TABLE}' AS table_name, lower(CAST({f} AS VARCHAR)) AS \"row\", 's' || chr(0) || coalesce(type, 'UNKNOWN') AS cf, "
        f"'{DATA_TYPE}' || chr(0) || '{f.upper()}' AS cq FROM {src} WHERE {f} IS NOT NULL" for f in RR_FIELDS_NO_TTL)


@register(
    "q49_cell_counts",
    "SELECT table_name, \"row\", cf, cq, count(*) AS n FROM (" + "\nUNION ALL\n".join(
        f"SELECT table_name, \"row\", cf, cq FROM ({_oracle_edges(src)}) e UNION ALL {_stat_cell_sql(src)}"
        for src in [f"(SELECT {RR_COLS_NO_TTL} FROM rr WHERE {w})" for w in STORE_SETS.values()])
    + ") c GROUP BY table_name, \"row\", cf, cq",
)
def q49_cell_counts(spark, sf_dir):
    """Edge and value frequencies over two loads and a repeated load: every run counts once."""
    into = _filled_store(spark, sf_dir, [edge_generator(EDGE_TABLE, DATA_TYPE, EDGES)], again="first")
    _compacted(into)
    return into.counts()


@register(
    "q50_storage_module",
    "SELECT count(*) FILTER (WHERE target IS NOT NULL) AS records_stored, count(*) FILTER (WHERE target IS NULL) AS failed_store, "
    "count(DISTINCT target) AS targets, count(target) AS n FROM rr",
)
def q50_storage_module(spark, sf_dir):
    """Records handed to a storage module that refuses those without a target; what is read back, and the
    counters committed with it."""
    schema = pa.schema([pa.field("name", pa.string()), pa.field("target", pa.string(), nullable=False)])
    path = scratch_path(spark, "module")
    counted = store_records(rr(spark, sf_dir).select("name", "target"), ParquetFactory(schema), {"path": path})
    found = spark.read.parquet(path).agg(F.countDistinct("target").alias("targets"), F.count("target").alias("n"))
    return found.withColumns({c: F.lit(counted[c]).cast("long") for c in COUNTERS})


@register("q34_domain_files", Q01_SQL)
def q34_domain_files(spark, sf_dir):
    """Domain list written as plain text files and read back line by line (blank and padded
    lines kept), then expanded as in q01."""
    path = scratch_path(spark, "domains_txt")
    fixture(spark, sf_dir, "domains").write.mode("overwrite").text(path)
    return expand_requests(read_domains(spark, path, glob="*.txt"), types="A,MX", subdomains=SUBDOMAINS)


# Documentation addresses (RFC 5737) standing in for a list of name servers.
NAMESERVERS = ["192.0.2.53", "198.51.100.53", "203.0.113.53"]


@register(
    "q36_nameserver_choice",
    "SELECT name || chr(9) || dclass || chr(9) || type AS question, "
    "CASE CAST(CAST(('0x' || substr(md5(name), 1, 15)) AS BIGINT) % 3 AS INTEGER) "
    + " ".join(f"WHEN {i} THEN '{ns}'" for i, ns in enumerate(NAMESERVERS))
    + " END AS nameserver FROM requests",
)
def q36_nameserver_choice(spark, sf_dir):
    """The name server each request goes to (hash of the name, repeatable on retry)."""
    reqs = fixture(spark, sf_dir, "requests")
    return reqs.select(question_key().alias("question"), pick_nameserver(NAMESERVERS, "name").alias("nameserver"))


# --- orders, non-boolean filters, records with any keys --------------------------------------------

@register("q40_filter_not_boolean", f"SELECT {RR_COLS} FROM rr WHERE false")
def q40_filter_not_boolean(spark, sf_dir):
    """A filter whose result is no boolean matches nothing (``strict=False``)."""
    return filter_records(rr(spark, sf_dir), "lower(name)", strict=False)


def _breaks(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, and neighbours within a partition that are out of order."""
    placed = df.select(*cols).withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    key = F.struct(*cols)
    before = F.lag(key).over(Window.partitionBy("part").orderBy("place"))
    return placed.withColumn("broken", before > key).agg(F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("breaks"))


@register("q41_sorted_records", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS breaks FROM rr")
def q41_sorted_records(spark, sf_dir):
    """Stage output sorted by name and type within each partition."""
    return _breaks(partition_sorted(rr(spark, sf_dir), ["name", "type"], 8), ["name", "type"])


@register("q42_sorted_requests", f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS breaks FROM ({Q01_SQL}) q")
def q42_sorted_requests(spark, sf_dir):
    """Requests in their natural order: name, type code, class code."""
    return _breaks(order_requests(q01_requests(spark, sf_dir)), ["name", "type_code", "dclass_code"])


@register(
    "q43_store_json",
    f"""SELECT table_name, count(*) AS n, (SELECT count(*) FROM orders) AS bad_records,
  (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS failed_store FROM (
  SELECT 'ev.foreign' AS table_name FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT 'ev.foreign' FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT 'eg.foreign' FROM orders, (VALUES (1), (2), (3), (4)) v(x) WHERE o_orderkey % 7 <> 0) c
GROUP BY table_name""",
)
def q43_store_json(spark, sf_dir):
    """Storage step over JSON lines with keys of their own, explicit nulls and lines that are no
    JSON, to tables with a dot in their names; run twice, which must change nothing."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    good = orders.select(F.concat(F.lit('{"order.id":"o'), F.col("o_orderkey").cast("string"), F.lit('","status":'), F.when(
        F.col("o_orderkey") % 7 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"'))),
        F.lit("}")).alias("json"))
    lines = good.unionByName(orders.select(F.lit("no json").alias("json")))
    path = scratch_path(spark, "foreign_cells")
    made = [map_event_generator("ev.foreign", "o"), map_edge_generator("eg.foreign", "o", "order.id:status")]
    for _ in range(2):
        counted = store_json(lines, made, sink=lambda cells: write_cells(cells, path))
    tables = spark.read.parquet(path).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return tables.withColumns({c: F.lit(counted[c]).cast("long") for c in ("bad_records", "failed_store")})


@register(
    "q46_request_codes",
    "SELECT name, type, dclass, CASE type WHEN 'A' THEN 1 WHEN 'MX' THEN 15 ELSE 16 END AS type_code, 1 AS dclass_code FROM requests",
)
def q46_request_codes(spark, sf_dir):
    """Codes of requests that only carry mnemonics, as column expressions."""
    return with_codes(fixture(spark, sf_dir, "requests"))


@register("q47_stage_output", f"SELECT {RR_COLS}, NULL AS cc FROM rr WHERE type = 'MX'")
def q47_stage_output(spark, sf_dir):
    """Records written as a stage output and read back: every field is there, filters reach the scan."""
    path = scratch_path(spark, "stage-output")
    write_records(rr(spark, sf_dir), path)
    return read_records(spark, path).where("type = 'MX' AND cc IS NULL").select(*RR_COLS.split(", "), "cc")


@register(
    "q52_open_records",
    f"""SELECT name, addr, coalesce(city, 'kept') AS city, cc, lat, length(name) AS "x-len", '["' || name || '",1]' AS more
FROM {_oracle_geo("(SELECT * FROM rr WHERE type = 'A')")} g WHERE length(name) > 14 AND cc IS DISTINCT FROM 'RFC1918'
UNION ALL SELECT name, NULL, 'kept', NULL, NULL, length(name), '["' || name || '",1]' FROM rr WHERE type = 'MX' AND length(name) > 14""",
)
def q52_open_records(spark, sf_dir):
    """JSON lines with keys of their own through geo and a filter on such a key: these keys are still there, a key that
    enrichment sets is overwritten where something was found."""
    lines = rr(spark, sf_dir).select(F.to_json(F.struct(
        "name", "type", "addr", F.lit("kept").alias("city"), F.length("name").alias("x-len"),
        F.struct(F.array(F.col("name")).alias("names")).alias("more"))).alias("json"))
    kept = filter_open(enrich_open(open_records(lines), fixture(spark, sf_dir, "blocks")),
                       "`x-len` > 14 AND type IN ('A', 'MX') AND NOT (cc <=> 'RFC1918')", types={"x-len": "int"})
    first = F.concat(F.lit('["'), F.try_variant_get("record", "$.more.names[0]", "string"), F.lit('",1]'))
    return kept.select(*[open_key(c).alias(c) for c in ("name", "addr", "city", "cc", "lat")], open_key("x-len", "bigint").alias("x-len"),
                       first.alias("more"))


def spark_queries() -> dict[str, QueryFn]:
    return dict(_SPARK)


def oracle_queries() -> dict[str, str]:
    return dict(_ORACLE)
