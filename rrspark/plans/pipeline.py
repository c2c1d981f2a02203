"""The whole chain as one Spark plan: raw responses -> decoded -> distinct -> enriched ->
filtered -> extracted values. Each stage is returned, so callers can write or count any of
them; nothing runs until an action."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..operators.decode import decode_responses
from ..operators.extract import extract_values
from ..operators.filters import filter_records
from ..operators.geo import enrich_geo
from ..operators.records import distinct_records


@dataclass(frozen=True)
class Chain:
    records: DataFrame
    enriched: DataFrame
    filtered: DataFrame
    values: DataFrame


def run_chain(
    raw: DataFrame,
    blocks: DataFrame,
    filter_expr: str | Column,
    extract_expr: str | Column,
    asn: DataFrame | None = None,
    fields: list[str] | None = None,
    ignore_ttl: bool = True,
    txt_mode: str = "record",
) -> Chain:
    """``fields`` keeps only those record fields before deduplication (all by default)."""
    decoded = decode_responses(raw, ignore_ttl=ignore_ttl, txt_mode=txt_mode, fields=fields)
    records = distinct_records(decoded, ignore_ttl=ignore_ttl)
    enriched = enrich_geo(records, blocks, asn=asn)
    filtered = filter_records(enriched, filter_expr)
    return Chain(records, enriched, filtered, extract_values(filtered, extract_expr))
