"""What a record's bytes mean, as column expressions over a walked record (``functions.wire``): the struct
``name, tcode, ccode, ttl, fixed, names, strings``.

Text forms are the public master-file ones: absolute names with a final dot, IPv6 as eight groups without
leading zeros, unknown types as ``\\# length hex``. Fields that nobody selects are never computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import HEADER_FLAGS, OPCODE_NAMES, RR_FIELDS, TYPE_CODES
from .codes import class_name_col, mapped_name, rcode_name_col, type_name_col

RAW_RECORD = "struct<name:string,tcode:int,ccode:int,ttl:bigint,fixed:binary,names:array<string>,strings:array<binary>>"
# Bytes that stand for themselves inside quotes.
_PLAIN_QUOTED = r"^[ !#-\[\]-~]*$"


def _number(data: Column, at: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(data, at + 1, size)), 16, 10).cast("long")


def _rest(data: Column, at: int) -> Column:
    return F.substring(data, F.lit(at + 1), F.length(data))


def ipv4_text(data: Column, at: int = 0) -> Column:
    return F.concat_ws(".", *[_number(data, at + i, 1) for i in range(4)])


def ipv6_text(data: Column) -> Column:
    digits = F.lower(F.hex(data))
    groups = F.regexp_replace(F.regexp_replace(digits, "(.{4})(?!$)", "$1:"), "(^|:)0{1,3}", "$1")
    return F.when(digits.startswith("0" * 20 + "ffff"), ipv4_text(data, 12)).otherwise(groups)


def quoted(data: Column) -> Column:
    """A character string in quotes: quotes and backslashes escaped, bytes that don't print as \\DDD."""
    text = F.decode(data, "ISO-8859-1")
    shown = F.transform(F.split(text, ""), lambda c: F.when(c.isin('"', "\\"), F.concat(F.lit("\\"), c)).when(
        c.between(" ", "~") | (c == ""), c).otherwise(F.concat(F.lit("\\"), F.lpad(F.ascii(c).cast("string"), 3, "0"))))
    return F.concat(F.lit('"'), F.when(text.rlike(_PLAIN_QUOTED), text).otherwise(F.array_join(shown, "")), F.lit('"'))


def strings_text(strings: Column) -> Column:
    return F.array_join(F.transform(strings, quoted), " ")


def presentation_line(name: Column, ttl: Column, dclass: Column, rtype: Column, rdata: Column) -> Column:
    """Master-file line of a record: name padded with tabs, TTL, class, type, rdata."""
    tab = F.lit("\t")
    head = F.when(F.length(name) < 8, F.concat(name, tab)).otherwise(name)
    head = F.when(F.length(head) < 16, F.concat(head, tab)).otherwise(head)
    line = F.concat(head, tab, ttl.cast("string"), tab, dclass, tab, rtype)
    return F.when(rdata == "", line).otherwise(F.concat(line, tab, rdata))


def _time(data: Column, at: int) -> Column:
    """Seconds since 1970 as yyyyMMddHHmmss in UTC, whatever the session's time zone."""
    seconds = _number(data, at, 4)
    day, rest = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), seconds % 86400
    parts = [(F.year(day), 4), (F.month(day), 2), (F.dayofmonth(day), 2),
             (F.floor(rest / 3600), 2), (F.floor(rest / 60) % 60, 2), (rest % 60, 2)]
    return F.concat(*[F.lpad(x.cast("string"), n, "0") for x, n in parts])


def types_in_bitmap(data: Column) -> Column:
    """Mnemonics of a type bitmap (RFC 4034): windows of 256 types, each its number, its length and its bits."""
    def byte(at: Column) -> Column:
        return F.conv(F.hex(F.substring(data, at + 1, F.lit(1))), 16, 10).cast("int")

    def step(s: Column, _: Column) -> Column:
        at = s["at"]
        bits = F.filter(F.sequence(F.lit(0), byte(at + 1) * 8 - 1), lambda k: _bit(byte(at + 2 + F.floor(k / 8).cast("int")), k % 8))
        found = F.transform(bits, lambda k: type_name_col(byte(at) * 256 + k))
        return F.when((at + 2 < F.length(data)) & (byte(at + 1) > 0), F.struct(
            (at + 2 + byte(at + 1)).alias("at"), F.concat(s["types"], found).alias("types"))).otherwise(s)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("types"))
    windows = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.length(data) / 3).cast("int")))
    return F.array_join(F.aggregate(windows, start, step)["types"], " ")


def _bit(byte: Column, place: Column) -> Column:
    """Whether the bit at a place, the first being the highest, is set."""
    return F.floor(byte / F.pow(F.lit(2.0), F.lit(7) - place)).cast("int") % 2 == 1


def _salt(data: Column) -> Column:
    return F.when(F.length(data) == 0, F.lit("-")).otherwise(F.hex(data))


def _other_text(f: Column, names: Column, strings: Column) -> list[tuple[list[str], Column]]:
    """Presentation text of the types without fields of their own."""
    def n(at: int, size: int) -> Column:
        return _number(f, at, size)

    def line(*parts: Column) -> Column:
        return F.concat_ws(" ", *parts)

    first, second = F.get(names, 0), F.get(names, 1)
    return [
        (["SPF", "HINFO", "X25", "ISDN", "GPOS"], strings_text(strings)),
        (["MD", "MF", "MB", "MG", "MR", "DNAME"], first),
        (["PX"], line(n(0, 2), first, second)),
        (["NSEC"], line(first, F.when(F.length(f) > 2, types_in_bitmap(f)))),
        (["NSEC3PARAM"], line(n(0, 1), n(1, 1), n(2, 2), _salt(_rest(f, 5)))),
        (["CERT"], line(n(0, 2), n(2, 2), n(4, 1), F.base64(_rest(f, 5)))),
        (["DHCID"], F.base64(f)),
        (["MINFO", "RP"], line(first, second)),
        (["AFSDB", "RT", "KX"], line(n(0, 2), first)),
        (["CAA"], line(n(0, 1), F.decode(_rest(f, 2), "US-ASCII"), quoted(F.get(strings, 0)))),
        (["DS", "DLV"], line(n(0, 2), n(2, 1), n(3, 1), F.hex(_rest(f, 4)))),
        (["SSHFP"], line(n(0, 1), n(1, 1), F.hex(_rest(f, 2)))),
        (["TLSA"], line(n(0, 1), n(1, 1), n(2, 1), F.hex(_rest(f, 3)))),
        (["NAPTR"], line(n(0, 2), n(2, 2), strings_text(strings), first)),
        (["DNSKEY"], line(n(0, 2), n(2, 1), n(3, 1), F.base64(_rest(f, 4)))),
        (["RRSIG"], line(type_name_col(n(0, 2).cast("int")), n(2, 1), n(3, 1), n(4, 4), _time(f, 8), _time(f, 12), n(16, 2),
                         first, F.base64(_rest(f, 18)))),
    ]


def record_fields(field: Callable[[str], Column], txt_mode: str = "record", question: bool = False) -> dict[str, Column]:
    """The record's fields by name; ``field`` gives the columns of the walked record."""
    f, names, strings = field("fixed"), field("names"), field("strings")
    code = field("tcode")

    def of(*types: str) -> Column:
        return code.isin([TYPE_CODES[t] for t in types])

    def soa(at: int) -> Column:
        return F.when(of("SOA"), _number(f, at, 4))

    def small(types: tuple[str, ...], at: int) -> Column:
        return F.when(of(*types), _number(f, at, 2).cast("int"))

    rtype, dclass = type_name_col(code), class_name_col(field("ccode"))
    first = F.get(names, 0)
    out = {"dclass": dclass, "name": field("name"), "type": rtype, "ttl": field("ttl")}
    if question:
        nothing = {n: F.lit(None).cast(t) for n, t in RR_FIELDS}
        return nothing | out | {"rdata": F.lit("")}
    texts = strings_text(strings)
    out |= {
        "addr": F.when(of("A"), ipv4_text(f)),
        "addrv6": F.when(of("AAAA"), ipv6_text(f)),
        "target": F.when(of("NS", "PTR", "MX", "SRV"), first),
        "text": F.when(of("TXT"), presentation_line(field("name"), field("ttl"), dclass, rtype, texts)
                       if txt_mode == "record" else texts),
        "alias": F.when(of("CNAME"), first),
        "priority": small(("MX", "SRV"), 0), "weight": small(("SRV",), 2), "port": small(("SRV",), 4),
        "host": F.when(of("SOA"), first), "admin": F.when(of("SOA"), F.get(names, 1)),
        "serial": soa(0), "refresh": soa(4), "retry": soa(8), "expire": soa(12), "min": soa(16),
    }
    other = F.when(of("A", "AAAA", "NS", "PTR", "MX", "SRV", "TXT", "CNAME", "SOA"), F.lit(None).cast("string"))
    for types, text in _other_text(f, names, strings):
        other = other.when(of(*types), text)
    size = F.length(f)
    out["rdata"] = other.when(size == 0, F.lit("\\# 0")).otherwise(
        F.concat(F.lit("\\# "), size.cast("string"), F.lit(" "), F.hex(f)))
    return out


def record_struct(r: Column, txt_mode: str = "record", question: bool = False) -> Column:
    fields = record_fields(lambda n: r[n], txt_mode, question)
    return F.struct(*[fields[n].cast(t).alias(n) for n, t in RR_FIELDS])


def flag_names(flags: Column) -> Column:
    """Mnemonics of the flags set; none set prints as one empty string."""
    found = F.filter(F.array(*[F.when(flags.bitwiseAND(1 << bit) != 0, F.lit(n)) for n, bit in HEADER_FLAGS]),
                     lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(found)


def rcode_text(flags: Column) -> Column:
    return rcode_name_col(flags.bitwiseAND(15))


def opcode_text(flags: Column) -> Column:
    return mapped_name(OPCODE_NAMES, F.shiftright(flags, 11).bitwiseAND(15), "RESERVED")
