"""Test inputs derived from the driver's tables with SQL that runs unchanged on Spark and DuckDB.

Each fixture is a SELECT over the base tables (or over earlier fixtures), so its size grows
with the tables. Spark registers them as temporary views; the oracle side inlines the same
text as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Records: one per lineitem row; the line number picks the record type, a hash of part and supplier the address,
# over the whole address space, so addresses grow with the table and repeat as its pairs do.
RR_SQL = """
SELECT 'IN' AS dclass,
  'h' || CAST(l_partkey AS STRING) || '.example.com.' AS name, t AS type,
  CAST(l_quantity AS BIGINT) * 60 AS ttl,
  CASE WHEN t='A' THEN CAST(CAST(floor(ip / 16777216) AS BIGINT) AS STRING) || '.' || CAST(CAST(floor(ip / 65536) AS BIGINT) % 256 AS STRING)
       || '.' || CAST(CAST(floor(ip / 256) AS BIGINT) % 256 AS STRING) || '.' || CAST(ip % 256 AS STRING) END AS addr,
  CASE WHEN t='AAAA' THEN '2001:db8:0:0:0:0:' || CAST(l_partkey % 10000 AS STRING) || ':' ||
       CAST(l_suppkey % 10000 AS STRING) END AS addrv6,
  CASE WHEN t IN ('MX','NS') AND l_suppkey % 5 = 0 THEN '192.0.2.' || CAST(l_suppkey % 250 AS STRING) || '.'
       WHEN t IN ('MX','NS') THEN 'MX' || CAST(l_suppkey AS STRING) || '.Example.NET.' END AS target,
  CASE WHEN t='MX' THEN CAST(l_suppkey % 3 * 10 AS INT) END AS priority,
  CASE WHEN t='CNAME' THEN 'h' || CAST(l_suppkey AS STRING) || '.example.com.' END AS alias,
  CASE WHEN t='SOA' AND l_suppkey % 6 = 0 THEN '192.0.2.' || CAST(l_suppkey % 250 AS STRING) || '.'
       WHEN t='SOA' THEN 'NS' || CAST(l_suppkey AS STRING) || '.Example.ORG.' END AS host
FROM (SELECT *, (CAST(l_partkey AS BIGINT) * 7919 + l_suppkey) * 2654435761 % 4294967296 AS ip,
      CASE l_linenumber WHEN 1 THEN 'A' WHEN 2 THEN 'A' WHEN 3 THEN 'AAAA' WHEN 4 THEN 'MX'
      WHEN 5 THEN 'NS' WHEN 6 THEN 'CNAME' ELSE 'SOA' END AS t FROM lineitem) x
"""

# Location and owner ranges: 25 blocks of four /8 and a half from nation, with gaps; 10/8 lies in one, so the private rule
# must win over it.
BLOCKS_SQL = """
SELECT CAST(n_nationkey * 10 + 8 AS BIGINT) * 16777216 AS start_ip,
  CAST(n_nationkey * 10 + 12 AS BIGINT) * 16777216 + 8388607 AS end_ip,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'City ' || n_name END AS city,
  'c' || CAST(n_nationkey AS STRING) AS cc, n_name AS country,
  CASE n_nationkey % 3 WHEN 0 THEN 'AS' || CAST(64500 + n_nationkey AS STRING) || ' Org ' || n_name
       WHEN 1 THEN 'Plain ' || n_name END AS org_raw,
  CAST(n_nationkey * 3 % 90 AS STRING) || '.5' AS lat, '-' || CAST(n_nationkey * 7 % 180 AS STRING) || '.25' AS long
FROM nation
"""

# Lookups: every distinct record name x {A, MX, TXT}.
REQUESTS_SQL = """
SELECT name, q.type AS type, 'IN' AS dclass
FROM (SELECT DISTINCT name FROM rr) n
CROSS JOIN (SELECT 'A' AS type UNION ALL SELECT 'MX' UNION ALL SELECT 'TXT') q
"""

# Recorded lookups: one per (name, type, class) of the records; TXT lookups have none.
ANSWERS_SQL = """
SELECT name, type, dclass, k % 97 AS ms,
  CASE WHEN k % 10 = 0 THEN 'timeout' WHEN k % 10 = 1 THEN 'failure' ELSE 'ok' END AS outcome,
  CASE WHEN k % 10 < 2 THEN NULL WHEN k % 10 = 2 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode
FROM (SELECT name, type, dclass, COUNT(*) AS k FROM rr GROUP BY name, type, dclass) g
"""

# The records that each successful recorded lookup brings, by section of its message: those of the question, for
# MX and NS the addresses of the name, and its SOA records where the name doesn't exist.
ANSWER_RECORDS_SQL = """
SELECT *, CAST(row_number() OVER (PARTITION BY q_name, q_type, q_dclass, section
  ORDER BY ttl, addr, addrv6, target, priority, alias, host) AS INT) AS place
FROM (SELECT DISTINCT a.name AS q_name, a.type AS q_type, a.dclass AS q_dclass,
    CASE WHEN a.rcode = 'NOERROR' AND r.type = a.type THEN 'answers'
         WHEN a.rcode = 'NOERROR' AND a.type IN ('MX', 'NS') AND r.type = 'A' THEN 'additional'
         WHEN a.rcode = 'NXDOMAIN' AND r.type = 'SOA' THEN 'authority' END AS section,
    r.dclass, r.name, r.type, r.ttl, r.addr, r.addrv6, r.target, r.priority, r.alias, r.host
  FROM answers a JOIN rr r ON a.name = r.name AND a.dclass = r.dclass WHERE a.outcome = 'ok') x
WHERE section IS NOT NULL
"""

# Recorded lookups with several answers per key: one per record that was seen, so a key has
# timeouts, failures and responses side by side.
REPEATED_ANSWERS_SQL = """
SELECT name, type, dclass, ttl % 89 AS ms,
  CASE WHEN ttl % 420 = 0 THEN 'timeout' WHEN ttl % 300 = 0 THEN 'failure' ELSE 'ok' END AS outcome,
  CASE WHEN ttl % 420 = 0 OR ttl % 300 = 0 THEN NULL WHEN ttl % 240 = 0 THEN 'NXDOMAIN'
       WHEN ttl % 180 = 0 THEN 'SERVFAIL' ELSE 'NOERROR' END AS rcode
FROM rr
"""

# Location ranges that overlap: per customer a /12, /16, /18 or /24 at a place that a hash of the key gives, so
# distinct ranges grow with the table, with floating coordinates; owner ranges per supplier, /8 or /12.
CITY_RANGES_SQL = """
SELECT place - place % width AS start_ip, place - place % width + width - 1 AS end_ip, city, cc, country, lat, long
FROM (SELECT CAST(c_custkey AS BIGINT) * 2654435761 % 4294967296 AS place,
       CAST(CASE WHEN c_custkey % 10 = 0 THEN 1048576 WHEN c_custkey % 10 = 5 THEN 256 WHEN c_custkey % 10 < 5 THEN 65536
            ELSE 16384 END AS BIGINT) AS width,
       'City ' || CAST(c_custkey AS STRING) AS city, 'n' || CAST(c_nationkey AS STRING) AS cc,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Land ' || CAST(c_nationkey AS STRING) END AS country,
       CAST(c_custkey % 180 - 90 AS DOUBLE) + 0.25 AS lat, CAST(c_custkey % 360 - 180 AS DOUBLE) + 0.5 AS long
      FROM customer) c
"""

OWNER_RANGES_SQL = """
SELECT place - place % width AS start_ip, place - place % width + width - 1 AS end_ip, org_raw
FROM (SELECT CAST(s_suppkey AS BIGINT) * 2654435761 % 4294967296 AS place,
       CAST(CASE WHEN s_suppkey % 3 = 0 THEN 16777216 ELSE 1048576 END AS BIGINT) AS width,
       CASE WHEN s_suppkey % 4 = 0 THEN 'Plain ' || s_name
            ELSE 'AS' || CAST(64500 + s_suppkey AS STRING) || ' Org ' || s_name END AS org_raw
      FROM supplier) s
"""

# Records of the other types, per order: what each must decode to, and ``raw``, the data of those types
# that are written as bytes.
TYPED_SQL = """
SELECT 'IN' AS dclass, 'r' || CAST(o_orderkey AS STRING) || '.example.com.' AS name, type, o_custkey % 1000 AS ttl,
  CASE WHEN type IN ('PTR', 'SRV') THEN 'h' || CAST(o_custkey AS STRING) || '.example.com.' END AS target,
  CASE WHEN type = 'TXT' THEN 'order ' || CAST(o_orderkey AS STRING) END AS txt,
  CASE WHEN type = 'SRV' THEN CAST(o_custkey % 100 AS INT) END AS priority,
  CASE WHEN type = 'SRV' THEN CAST(o_custkey % 50 AS INT) END AS weight,
  CASE WHEN type = 'SRV' THEN CAST(o_custkey % 60000 AS INT) END AS port,
  CASE WHEN type = 'SOA' THEN 'ns' || CAST(o_custkey AS STRING) || '.example.com.' END AS host,
  CASE WHEN type = 'SOA' THEN 'admin.example.com.' END AS admin,
  CASE WHEN type = 'SOA' THEN CAST(o_orderkey AS BIGINT) END AS serial,
  CASE WHEN type = 'SOA' THEN CAST(3600 + o_custkey AS BIGINT) END AS refresh,
  CASE WHEN type = 'SOA' THEN CAST(600 + o_custkey AS BIGINT) END AS retry,
  CASE WHEN type = 'SOA' THEN CAST(4000000000 + o_custkey % 1000 AS BIGINT) END AS expire,
  CASE WHEN type = 'SOA' THEN CAST(60 AS BIGINT) END AS min,
  CASE type WHEN 'TLSA' THEN '3 1 1 ' || digits WHEN 'TYPE65280' THEN chr(92) || '# 6 ' || digits END AS rdata,
  CASE type WHEN 'TLSA' THEN chr(92) || '# 9 030101' || digits WHEN 'TYPE65280' THEN chr(92) || '# 6 ' || digits END AS raw
FROM (SELECT *, lpad(CAST(o_orderkey AS STRING), 12, '0') AS digits, CASE o_orderkey % 6 WHEN 0 THEN 'PTR' WHEN 1 THEN 'TXT'
        WHEN 2 THEN 'SRV' WHEN 3 THEN 'SOA' WHEN 4 THEN 'TLSA' ELSE 'TYPE65280' END AS type FROM orders) o
"""

# Domain-list lines: the host of every page URL. Every third line is padded with blanks and
# tabs, and pages with a query string add one blank line each, so trimming and blank-line
# handling are exercised on data that grows with the table.
DOMAINS_SQL = """
SELECT CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN '  ' || host ELSE chr(9) || host || ' ' END AS domain
FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages) p
UNION ALL
SELECT '' AS domain FROM pages WHERE url LIKE '%?%'
"""

FIXTURE_SQL: dict[str, str] = {
    "rr": RR_SQL,
    "blocks": BLOCKS_SQL,
    "requests": REQUESTS_SQL,
    "answers": ANSWERS_SQL,
    "answer_records": ANSWER_RECORDS_SQL,
    "domains": DOMAINS_SQL,
    "repeated_answers": REPEATED_ANSWERS_SQL,
    "city_ranges": CITY_RANGES_SQL,
    "owner_ranges": OWNER_RANGES_SQL,
    "typed": TYPED_SQL,
}
FIXTURE_ORDER = ["rr", "blocks", "requests", "answers", "answer_records", "domains", "repeated_answers", "city_ranges", "owner_ranges",
                 "typed"]


def _whole_range(sql: str, key: str) -> str:
    """``sql`` with its hash ``key * 2654435761 % 4294967296`` of 64-bit ``key`` written so that no product leaves 64 bits: the
    same value for every key, where the product itself is too large from a key of about 3.4 billion on."""
    plain = f"{key} * 2654435761 % 4294967296"
    if plain not in sql:
        raise ValueError(f"no {plain!r} in the fixture")
    left = f"({key} % 4294967296)"  # 2654435761 = 40503 * 65536 + 31153
    return sql.replace(plain, f"({left} * 40503 % 4294967296 * 65536 + {left} * 31153) % 4294967296")


# Spark forms where the shared text would plan a join against a literal list: the three
# request types are an ``explode`` per name instead (narrow, no join). Hashes of keys are
# taken without the overflow that the shared text has for large keys.
SPARK_FIXTURE_SQL: dict[str, str] = {
    **FIXTURE_SQL,
    "rr": _whole_range(RR_SQL, "(CAST(l_partkey AS BIGINT) * 7919 + l_suppkey)"),
    "city_ranges": _whole_range(CITY_RANGES_SQL, "CAST(c_custkey AS BIGINT)"),
    "owner_ranges": _whole_range(OWNER_RANGES_SQL, "CAST(s_suppkey AS BIGINT)"),
    "requests": """
SELECT name, type, 'IN' AS dclass
FROM (SELECT DISTINCT name FROM rr) n LATERAL VIEW explode(array('A', 'MX', 'TXT')) q AS type
""",
}


def register_tables(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Register the driver's parquet tables as temporary views (lazy; nothing is read)."""
    for t in tables or BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


_REGISTERED: dict[tuple[int, str], str] = {}
_STAGED: dict[tuple[str, str, str], DataFrame] = {}

# Fixtures that stand in for large stored inputs. The driver's file is one row group, so they are
# written once per session as a table of many files, which the queries then scan.
STORED_FIXTURES = {"rr"}

# Bytes of a row group in a stored table. A task holds a whole row group, writing it and reading it back; at Parquet's 128 MB the
# tasks of one small heap together fill it.
ROW_GROUP_BYTES = 8 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """``session.staged`` with small row groups; the shuffle that dealt the rows goes with the write."""
    with session.shuffles_removed(df.sparkSession):
        return session.staged(df, name, {"parquet.block.size": ROW_GROUP_BYTES})


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], by: list[str] | None = None) -> DataFrame:
    """The table that ``make`` gives, written once per session and directory in as many files as
    there are cores. ``by`` names the key of rows that come from a shuffle (see ``_dealt``)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = staged(_dealt(make(), spark.sparkContext.defaultParallelism, by), f"fixture-{name}")
    return _STAGED[key]


def _dealt(df: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """The rows in ``n`` near equal partitions, dealt by a hash of each row's place. ``repartition(n)`` alone sorts the rows of
    every task first, and its many spills don't fit a small heap once a task has millions of rows. Places are the same on
    a retry only where a task's rows come straight from files; rows behind a shuffle are dealt by their key ``by``."""
    if by:
        return df.repartition(n, *by)
    return df.withColumn("dealt_by", F.monotonically_increasing_id()).repartition(n, "dealt_by").drop("dealt_by")


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register base tables and fixtures as temporary views, once per session and directory
    (file listing and footer reads are not repeated for every query)."""
    key = (id(spark), spark.sparkContext.applicationId)
    if _REGISTERED.get(key) == sf_dir and all(spark.catalog.tableExists(n) for n in FIXTURE_ORDER):
        return
    register_tables(spark, sf_dir, ["lineitem", "nation", "pages", "events", "customer", "supplier", "orders"])
    for name in FIXTURE_ORDER:
        df = spark.sql(SPARK_FIXTURE_SQL[name])
        if name in STORED_FIXTURES:
            df = stored(spark, sf_dir, name, lambda df=df: df)
        df.createOrReplaceTempView(name)
    _REGISTERED[key] = sf_dir


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_fixtures(spark, sf_dir)
    return spark.table(name)


def with_fixtures(sql: str, names: list[str] | None = None) -> str:
    """Prefix ``sql`` with the fixtures as CTEs, for engines without Spark's views."""
    names = names or FIXTURE_ORDER
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in FIXTURE_ORDER if n in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":  # merge the query's own CTEs into the list
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
