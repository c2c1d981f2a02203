"""Mnemonic <-> code mapping as column expressions (P4): a literal map looked up per row,
kept inside codegen. Unknown codes print as ``TYPE<n>`` / ``CLASS<n>``."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CLASS_CODES, CLASS_NAMES, RCODE_NAMES, TYPE_CODES, TYPE_NAMES


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def mapped_name(names: dict[int, str], code: Column, other: str) -> Column:
    """The name of a code, or ``other`` followed by the code."""
    return F.coalesce(F.try_element_at(_map(names), code), F.concat(F.lit(other), code.cast("string")))


def type_code_col(c: str | Column) -> Column:
    c = F.upper(F.col(c) if isinstance(c, str) else c)
    generic = F.when(c.rlike(r"^TYPE\d{1,5}$"), F.substring(c, 5, 5).try_cast("int"))
    return F.coalesce(F.try_element_at(_map(TYPE_CODES), c), generic)


def class_code_col(c: str | Column) -> Column:
    c = F.upper(F.col(c) if isinstance(c, str) else c)
    generic = F.when(c.rlike(r"^CLASS\d{1,5}$"), F.substring(c, 6, 5).try_cast("int"))
    return F.coalesce(F.try_element_at(_map(CLASS_CODES), c), generic)


def type_name_col(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return mapped_name(TYPE_NAMES, c, "TYPE")


def class_name_col(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return mapped_name(CLASS_NAMES, c, "CLASS")


def rcode_name_col(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return mapped_name(RCODE_NAMES, c, "RESERVED")
