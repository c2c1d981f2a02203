"""Raw DNS responses made of the tables' own records, in column expressions: the input of the message queries.

A recorded answer's message holds the records that the tables have for its question: those of the asked name
and type as ANSWER, for MX and NS the addresses of that name as ADDITIONAL, and for a name that doesn't exist its SOA
records as AUTHORITY. The bytes are hexadecimal text put together from fixed parts and made binary at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import class_code_col, type_code_col
from ..schema import RCODE_NAMES
from .fixtures import fixture, stored

SECTIONS = ("answers", "authority", "additional")  # in the order of a message


def _number(value: Column, size: int) -> Column:
    return F.lpad(F.hex(value.cast("long")), 2 * size, "0")


def name_hex(name: Column) -> Column:
    """A name of plain labels: each after its length, closed by an empty one."""
    labels = F.filter(F.split(name, r"\."), lambda x: x != "")
    return F.concat(F.array_join(F.transform(labels, lambda x: F.concat(_number(F.octet_length(x), 1), F.hex(F.encode(x, "UTF-8")))), ""),
                    F.lit("00"))


def record_hex(field: Callable[[str], Column]) -> Column:
    """One record: owner, type, class, TTL, length and data."""
    none = F.lit("").cast("string")
    quad = F.array_join(F.transform(F.split(field("addr"), r"\."), lambda x: _number(x, 1)), "")
    groups = F.array_join(F.transform(F.split(field("addrv6"), ":"), lambda x: F.lpad(F.upper(x), 4, "0")), "")
    rtype = field("type")
    data = (F.when(rtype == "A", quad).when(rtype == "AAAA", groups).when(rtype == "NS", name_hex(field("target")))
            .when(rtype == "CNAME", name_hex(field("alias"))).when(rtype == "MX", F.concat(_number(field("priority"), 2), name_hex(field("target"))))
            .when(rtype == "SOA", F.concat(name_hex(field("host")), F.lit("00"), F.lit("00" * 20))).otherwise(none))
    return F.concat(name_hex(field("name")), _number(type_code_col(rtype), 2), _number(class_code_col(field("dclass")), 2),
                    _number(field("ttl"), 4), _number(F.length(data) / 2, 2), data)


def answers_with_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded answers (``name, type, dclass, ms, outcome, rcode``) with ``wire``, the message of each successful
    one; a stored table, made once per session."""
    return stored(spark, sf_dir, "answer-messages", lambda: _answers_with_wire(spark, sf_dir), by=["name", "type", "dclass"])


def _answers_with_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["name", "type", "dclass"]
    held = fixture(spark, sf_dir, "answer_records")
    packed = held.groupBy(*[F.col(f"q_{k}").alias(k) for k in key]).agg(F.sort_array(F.collect_list(F.struct(
        "section", "place", record_hex(F.col).alias("hex")))).alias("held"))

    def section(name: str) -> Column:
        return F.filter(F.coalesce(F.col("held"), F.array().cast("array<struct<section:string,place:int,hex:string>>")),
                        lambda r: r["section"] == name)

    code = F.create_map(*[F.lit(x) for code, name in RCODE_NAMES.items() for x in (name, code)])[F.col("rcode")]
    flags = F.lit(0x8180) + F.when(F.col("rcode") == "NXDOMAIN", 0x0400).otherwise(0) + code
    question = F.concat(name_hex(F.col("name")), _number(type_code_col("type"), 2), _number(class_code_col("dclass"), 2))
    counts = [_number(F.size(section(s)), 2) for s in SECTIONS]
    body = [F.array_join(F.transform(section(s), lambda r: r["hex"]), "") for s in SECTIONS]
    wire = F.unhex(F.concat(_number(F.col("ms"), 2), _number(flags, 2), F.lit("0001"), *counts, question, *body))
    answers = fixture(spark, sf_dir, "answers")
    return answers.join(packed, key, "left").select(
        *key, "ms", "outcome", "rcode", F.when(F.col("outcome") == "ok", wire).alias("wire"))
