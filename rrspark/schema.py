"""Record schema and DNS mnemonic tables.

A record is one flat row; a field that does not apply to its type is NULL (the JSON form
omits it). The set of fields the pipeline can produce is closed, so one fixed schema
covers every stage.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fields in the order the decode stage emits them.
RR_FIELDS: list[tuple[str, T.DataType]] = [
    ("dclass", T.StringType()),
    ("name", T.StringType()),
    ("type", T.StringType()),
    ("ttl", T.LongType()),
    ("addr", T.StringType()),
    ("addrv6", T.StringType()),
    ("target", T.StringType()),
    ("text", T.StringType()),
    ("alias", T.StringType()),
    ("priority", T.IntegerType()),
    ("port", T.IntegerType()),
    ("weight", T.IntegerType()),
    ("admin", T.StringType()),
    ("host", T.StringType()),
    ("expire", T.LongType()),
    ("min", T.LongType()),
    ("refresh", T.LongType()),
    ("retry", T.LongType()),
    ("serial", T.LongType()),
    ("rdata", T.StringType()),
]

# Location and owner fields added by geo enrichment (all text, upper case).
GEO_FIELDS: list[str] = ["city", "cc", "country", "lat", "long", "asn", "org"]

RR_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RR_FIELDS])
ENRICHED_SCHEMA = T.StructType(
    list(RR_SCHEMA.fields) + [T.StructField(n, T.StringType(), True) for n in GEO_FIELDS]
)

# Message view: header plus one array of records per section.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("opcode", T.StringType(), True),
        T.StructField("rcode", T.StringType(), True),
        T.StructField("flags", T.ArrayType(T.StringType()), True),
        T.StructField("id", T.IntegerType(), True),
        T.StructField("question", T.ArrayType(RR_SCHEMA), True),
        T.StructField("answers", T.ArrayType(RR_SCHEMA), True),
        T.StructField("additional", T.ArrayType(RR_SCHEMA), True),
        T.StructField("authority", T.ArrayType(RR_SCHEMA), True),
    ]
)

# ---------------------------------------------------------------------------
# DNS mnemonics and codes as published by IANA (RFC 1035 and later).
# They must equal the public registry for lookups and decoded text to be right.
# ---------------------------------------------------------------------------
TYPE_CODES: dict[str, int] = {
    "A": 1, "NS": 2, "MD": 3, "MF": 4, "CNAME": 5, "SOA": 6, "MB": 7, "MG": 8, "MR": 9,
    "NULL": 10, "WKS": 11, "PTR": 12, "HINFO": 13, "MINFO": 14, "MX": 15, "TXT": 16,
    "RP": 17, "AFSDB": 18, "X25": 19, "ISDN": 20, "RT": 21, "NSAP": 22, "NSAP-PTR": 23,
    "SIG": 24, "KEY": 25, "PX": 26, "GPOS": 27, "AAAA": 28, "LOC": 29, "NXT": 30,
    "EID": 31, "NIMLOC": 32, "SRV": 33, "ATMA": 34, "NAPTR": 35, "KX": 36, "CERT": 37,
    "A6": 38, "DNAME": 39, "OPT": 41, "APL": 42, "DS": 43, "SSHFP": 44, "IPSECKEY": 45,
    "RRSIG": 46, "NSEC": 47, "DNSKEY": 48, "DHCID": 49, "NSEC3": 50, "NSEC3PARAM": 51,
    "TLSA": 52, "SPF": 99, "TKEY": 249, "TSIG": 250, "IXFR": 251, "AXFR": 252,
    "MAILB": 253, "MAILA": 254, "ANY": 255, "CAA": 257, "DLV": 32769,
}
CLASS_CODES: dict[str, int] = {"IN": 1, "CH": 3, "HS": 4, "NONE": 254, "ANY": 255}
CLASS_ALIASES: dict[str, str] = {"CHAOS": "CH", "HESIOD": "HS"}
RCODE_NAMES: dict[int, str] = {
    0: "NOERROR", 1: "FORMERR", 2: "SERVFAIL", 3: "NXDOMAIN", 4: "NOTIMP", 5: "REFUSED",
    6: "YXDOMAIN", 7: "YXRRSET", 8: "NXRRSET", 9: "NOTAUTH", 10: "NOTZONE", 16: "BADVERS",
}
OPCODE_NAMES: dict[int, str] = {0: "QUERY", 1: "IQUERY", 2: "STATUS", 4: "NOTIFY", 5: "UPDATE"}
# Header flag bits, most significant first, with their mnemonics.
HEADER_FLAGS: list[tuple[str, int]] = [
    ("qr", 15), ("aa", 10), ("tc", 9), ("rd", 8), ("ra", 7), ("ad", 5), ("cd", 4),
]
# Private IPv4 ranges of RFC 1918, as text prefixes of the dotted form.
PRIVATE_PREFIXES: list[str] = ["10.", "192.168."] + [f"172.{n}." for n in range(16, 32)]
PRIVATE_LABEL = "RFC1918"
UNKNOWN_LABEL = "UNKNOWN"
ZERO_COORD = "0.0"
# Geo owner text form "AS<number> <name>".
ASN_PATTERN = r"^AS(\d+)\s+(.+)$"
# A name that looks like a dotted IPv4 address with a final dot.
IPV4_NAME_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\.$"

TYPE_NAMES: dict[int, str] = {v: k for k, v in TYPE_CODES.items()}
CLASS_NAMES: dict[int, str] = {v: k for k, v in CLASS_CODES.items()}


def type_name(code: int) -> str:
    return TYPE_NAMES.get(code, f"TYPE{code}")


def class_name(code: int) -> str:
    return CLASS_NAMES.get(code, f"CLASS{code}")


def rcode_name(code: int) -> str:
    return RCODE_NAMES.get(code, f"RESERVED{code}")


def opcode_name(code: int) -> str:
    return OPCODE_NAMES.get(code, f"RESERVED{code}")


def type_code(mnemonic: str) -> int:
    """Code of a type mnemonic (also ``TYPE<n>``); raises ValueError when unknown."""
    m = mnemonic.strip().upper()
    if m in TYPE_CODES:
        return TYPE_CODES[m]
    if m.startswith("TYPE") and m[4:].isdigit() and 0 <= int(m[4:]) <= 65535:
        return int(m[4:])
    raise ValueError(f"unknown record type: {mnemonic!r}")


def class_code(mnemonic: str) -> int:
    m = mnemonic.strip().upper()
    m = CLASS_ALIASES.get(m, m)
    if m in CLASS_CODES:
        return CLASS_CODES[m]
    if m.startswith("CLASS") and m[5:].isdigit() and 0 <= int(m[5:]) <= 65535:
        return int(m[5:])
    raise ValueError(f"unknown record class: {mnemonic!r}")
