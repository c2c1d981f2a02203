"""DNS resource-record analytics on Spark: every step a DataFrame -> DataFrame function."""

from .operators.cells import (
    cell_counts, edge_cells, edge_generator, event_cells, event_generator, event_id, generate_cells,
    store_summary, value_stat_cells,
)
from .operators.decode import decode_messages, decode_responses, parse_failures, response_text
from .operators.extract import extract_counts, extract_values
from .operators.filters import filter_counts, filter_records, lower_unless_ipv4, observe_filter
from .operators.geo import enrich_geo
from .operators.records import distinct_records, partition_sorted, records_from_json, records_to_json
from .operators.requests import dedupe_requests, expand_requests, order_requests
from .operators.resolve import lookup_summary, pick_nameserver, rcode_counts, resolve, resolve_with, responses
from .plans.pipeline import run_chain
from .schema import ENRICHED_SCHEMA, MESSAGE_SCHEMA, RR_SCHEMA

__all__ = [
    "cell_counts", "edge_cells", "edge_generator", "event_cells", "event_generator", "event_id", "generate_cells",
    "store_summary", "value_stat_cells", "decode_messages", "decode_responses", "parse_failures", "response_text",
    "extract_counts", "extract_values", "filter_counts", "filter_records", "lower_unless_ipv4", "observe_filter",
    "enrich_geo", "distinct_records", "partition_sorted", "records_from_json", "records_to_json",
    "dedupe_requests", "expand_requests", "order_requests", "lookup_summary", "pick_nameserver", "rcode_counts",
    "resolve", "resolve_with", "responses", "run_chain", "ENRICHED_SCHEMA", "MESSAGE_SCHEMA", "RR_SCHEMA",
]
