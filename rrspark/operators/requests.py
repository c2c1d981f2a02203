"""Lookup requests from domain lists (P1-P5) and their order and equality (O3, O4).

Expansion is one ``explode`` of a literal array per line (no join, no shuffle): every line
yields len(types) x len(subdomains) requests, without deduplication.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import java_trim
from ..schema import class_code, type_code

REQUEST_COLUMNS = ["name", "type", "type_code", "dclass", "dclass_code"]


def parse_types(types: str | Sequence[str]) -> list[str]:
    """Comma list or sequence of type mnemonics -> upper-case list; unknown types are
    rejected here on the driver instead of failing inside a task."""
    items = types.split(",") if isinstance(types, str) else list(types)
    out = []
    for t in items:
        t = t.strip().upper()
        if not t:
            continue
        type_code(t)  # raises ValueError when unknown
        out.append(t)
    if not out:
        raise ValueError("no record types given")
    return out


def parse_subdomains(subdomains: str | Sequence[str]) -> list[str]:
    """Comma list (trailing empty entries dropped, as a Java split does) or sequence."""
    if isinstance(subdomains, str):
        items = subdomains.split(",")
        while items and items[-1] == "":
            items.pop()
        return items or [""]
    return list(subdomains)


def compose_name(line: Column, subdomain: str) -> Column:
    """Lookup name for one line: ``""`` -> the trimmed line; a prefix ending in ``.`` is put
    in front as is; any other prefix with a ``.`` between; a final ``.`` is added when missing
    (so a blank line becomes the root name ``.``)."""
    base = java_trim(line)
    if subdomain == "":
        name = base
    elif subdomain.endswith("."):
        name = F.concat(F.lit(subdomain), base)
    else:
        name = F.concat(F.lit(subdomain + "."), base)
    return F.when(name.endswith("."), name).otherwise(F.concat(name, F.lit(".")))


def expand_requests(
    df: DataFrame,
    types: str | Sequence[str] = ("A",),
    subdomains: str | Sequence[str] = ("",),
    dclass: str = "IN",
    column: str = "domain",
    dedupe: bool = False,
) -> DataFrame:
    """Each line x each type x each subdomain -> ``domain, name, type, type_code, dclass,
    dclass_code``. ``dedupe=True`` keeps one request per (name, type, class)."""
    tlist = parse_types(types)
    subs = parse_subdomains(subdomains)
    cls = dclass.strip().upper()
    ccode = class_code(cls)
    line = F.col(column)
    combos = [
        F.struct(compose_name(line, s).alias("name"), F.lit(t).alias("type"), F.lit(type_code(t)).alias("type_code"))
        for t in tlist
        for s in subs
    ]
    out = df.select(line.alias("domain"), F.explode(F.array(*combos)).alias("r")).select(
        "domain", "r.name", "r.type", "r.type_code", F.lit(cls).alias("dclass"), F.lit(ccode).alias("dclass_code")
    )
    return dedupe_requests(out) if dedupe else out


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """One request per (name, type code, class code): request equality. The mnemonics are
    functions of the codes, so a plain ``distinct`` over the five columns is the same and
    plans as a hash aggregate with a map-side partial step."""
    return requests.select(*REQUEST_COLUMNS).distinct()


def order_requests(requests: DataFrame) -> DataFrame:
    """Natural request order: name, then type code, then class code (a global range sort)."""
    return requests.orderBy("name", "type_code", "dclass_code")


def with_codes(requests: DataFrame) -> DataFrame:
    """Add ``type_code`` / ``dclass_code`` to requests that only carry mnemonics."""
    from ..functions.codes import class_code_col, type_code_col

    return requests.withColumns({"type_code": type_code_col("type"), "dclass_code": class_code_col("dclass")})
