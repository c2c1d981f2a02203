"""Column expressions used across operators. All are built-in Spark SQL functions, so they
stay inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import IPV4_NAME_PATTERN, PRIVATE_PREFIXES

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: ColumnOrName) -> Column:
    """Strip every character <= U+0020 from both ends (SQL ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def full_match(c: ColumnOrName, pattern: str) -> Column:
    """True when the whole text matches ``pattern`` (``rlike`` alone finds a substring)."""
    return _col(c).rlike(r"\A(?:" + pattern + r")\z")


def looks_like_ipv4_name(c: ColumnOrName) -> Column:
    """A name such as ``192.0.2.1.`` (dotted quad plus final dot)."""
    return full_match(c, IPV4_NAME_PATTERN)


def ipv4_to_long(c: ColumnOrName) -> Column:
    """Dotted-quad IPv4 text -> unsigned 32-bit value as long; NULL when not an address."""
    c = _col(c)
    parts = F.split(c, r"\.")
    octets = [parts.getItem(i).try_cast("long") for i in range(4)]
    valid = full_match(c, r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}")
    for o in octets:
        valid = valid & (o <= F.lit(255))
    value = octets[0] * F.lit(16777216) + octets[1] * F.lit(65536) + octets[2] * F.lit(256) + octets[3]
    return F.when(valid, value)


def is_private_ipv4(c: ColumnOrName) -> Column:
    """Text-prefix test for RFC 1918 space, exactly as the text is written."""
    c = _col(c)
    cond = None
    for p in PRIVATE_PREFIXES:
        t = c.startswith(p)
        cond = t if cond is None else (cond | t)
    return cond


def json_scalar(c: ColumnOrName, data_type: str) -> Column:
    """JSON text of a value: strings are quoted and escaped, numbers and booleans are written
    as they are, arrays/maps/structs as JSON documents."""
    c = _col(c)
    if data_type == "string":
        # Encode inside a one-field struct, then cut the wrapper: '{"v":' (5 chars) and '}'.
        wrapped = F.to_json(F.struct(c.alias("v")))
        return F.when(c.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - F.lit(6)))
    if data_type == "variant":  # a JSON null inside the variant is no result, like a missing field
        return F.when(~F.is_variant_null(c), F.to_json(c))
    if data_type.startswith(("array", "map", "struct")):
        return F.to_json(c)
    return c.cast("string")


def strip_outer_quotes(c: ColumnOrName) -> Column:
    """Remove every leading and every trailing double quote."""
    return F.regexp_replace(F.regexp_replace(_col(c), r'^"+', ""), r'"+$', "")


def name_uuid_hex(text: ColumnOrName) -> Column:
    """Name-based (version 3, MD5) UUID of the UTF-8 bytes of ``text``, as 32 hex digits
    without dashes. The version nibble becomes 3 and the variant bits 10."""
    h = F.md5(F.encode(_col(text), "UTF-8"))
    return F.concat(
        F.substring(h, 1, 12),
        F.lit("3"),
        F.substring(h, 14, 3),
        F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"),
        F.substring(h, 18, 15),
    )


def canonical_text(fields: list[tuple[str, Column]]) -> Column:
    """``{k1=v1, k2=v2}`` over the non-NULL fields, keys in sorted order (a sorted map's text)."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in sorted(fields, key=lambda kv: kv[0])]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
