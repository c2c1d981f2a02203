"""Records with any keys (S3, F2, P11, U9): one Variant column, ``record``, through filter, extraction, geo and cells.

The fixed record schema covers what the pipeline itself makes. Records from elsewhere may hold other keys, and these
must still be there after a stage. Here a record stays one Variant; an expression names its keys like columns, each is
looked up in the record as the expression needs it (``try_variant_get``: a missing key, or one of another type, is NULL), and
enrichment overwrites same-named keys and keeps the rest. Nothing but the keys an expression names is ever
unpacked, so there is no schema to infer and no second pass.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import json_scalar, strip_outer_quotes
from ..schema import ENRICHED_SCHEMA, GEO_FIELDS
from .cells import MapGenerator, map_cells
from .filters import predicate
from .geo import enrich_geo
from .records import last_of_each_key

RECORD = "record"
KNOWN_TYPES = {f.name: f.dataType.simpleString() for f in ENRICHED_SCHEMA.fields}


def key(name: str, type: str | None = None) -> Column:
    """A key of the record: of the record schema's type, or ``type``, or as text (a list or object as JSON)."""
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(F.col(RECORD), f"$[{quote}{name}{quote}]", type or KNOWN_TYPES.get(name, "string"))


def open_records(lines: DataFrame, column: str = "json", on_bad: str = "fail", observation: Observation | None = None) -> DataFrame:
    """Column ``record`` of JSON text. What is no JSON object is bad: it fails the job, is dropped (``"drop"``) or
    dropped and counted into ``observation`` (``"count"``). Of a repeated key the last value counts."""
    if on_bad not in ("fail", "drop", "count"):
        raise ValueError("on_bad must be 'fail', 'drop' or 'count'")
    if on_bad == "count" and observation is None:
        raise ValueError("on_bad='count' needs an Observation")
    text = F.col(column)
    is_object = text.rlike(r"^\s*\{")
    # a repeated key makes no Variant; such a line is read as a map first
    again = F.to_variant_object(last_of_each_key(F.from_json(text, "map<string,variant>")))
    out = lines.select(F.when(is_object, F.coalesce(F.try_parse_json(text), again)).alias(RECORD), text.alias("__text"))
    good = F.col(RECORD).isNotNull()
    if on_bad == "count":
        out = out.observe(observation, F.count_if(~good).alias("bad_records"), F.count_if(good).alias("records"))
    if on_bad == "fail":
        refuse = F.raise_error(F.concat(F.lit("malformed record: "), F.substring("__text", 1, 200))).cast("boolean")
        return out.where(F.when(good, F.lit(True)).otherwise(refuse)).select(RECORD)
    return out.where(good).select(RECORD)


def from_columns(records: DataFrame) -> DataFrame:
    """Records of columns as open ones; absent (NULL) fields are absent keys."""
    return records.select(F.parse_json(F.to_json(F.struct("*"))).alias(RECORD))


def to_json_lines(records: DataFrame, column: str = "json") -> DataFrame:
    return records.select(F.to_json(RECORD).alias(column))


@contextmanager
def _quiet() -> Iterator[None]:
    """Spark logs every failed analysis as an error; here one only names the next key."""
    log = logging.getLogger("SQLQueryContextLogger")
    level = log.level
    log.setLevel(logging.CRITICAL)
    try:
        yield
    finally:
        log.setLevel(level)


def with_keys(records: DataFrame, expr: str | Column, types: Mapping[str, str] | None = None) -> DataFrame:
    """``records`` and, as columns, the keys that ``expr`` names: whatever it can't resolve is a key of the record."""
    expr = F.expr(expr) if isinstance(expr, str) else expr
    types = types or {}
    out, seen = records, set(records.columns)
    while True:
        try:
            with _quiet():
                out.select(expr).schema  # noqa: B018  analysis only, no job
            return out
        except AnalysisException as e:
            if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            name = e.getMessageParameters()["objectName"].split("`.`")[0].strip("`").replace("``", "`")
            if name in seen:
                raise
            seen.add(name)
            out = out.withColumn(name, key(name, types.get(name)))


def filter_open(records: DataFrame, expr: str | Column, types: Mapping[str, str] | None = None, strict: bool = True) -> DataFrame:
    """Keep the records whose predicate is true; all their keys stay. ``types`` gives keys outside the record
    schema a type other than text."""
    named = with_keys(records, expr, types)
    return named.where(predicate(named, expr, strict)).select(*records.columns)


def extract_open(records: DataFrame, expr: str | Column, types: Mapping[str, str] | None = None, strip: bool = True,
                 distinct: bool = True) -> DataFrame:
    """``extract_values`` over open records."""
    named = with_keys(records, expr, types)
    col = F.expr(expr) if isinstance(expr, str) else expr
    value = json_scalar(col, named.select(col).schema.fields[0].dataType.simpleString())
    out = named.select((strip_outer_quotes(value) if strip else value).alias("value")).where(F.col("value").isNotNull())
    return out.distinct() if distinct else out


def enrich_open(records: DataFrame, blocks: DataFrame, asn: DataFrame | None = None, **limits) -> DataFrame:
    """Location and owner of each record's ``addr`` as keys of the record: those that were found overwrite keys of
    the same name, all other keys stay; records without an address pass as they are."""
    found = enrich_geo(records.select(RECORD, key("addr").alias("addr")), blocks, asn=asn, **limits)
    geo = F.filter(F.array(*[F.struct(F.lit(f).alias("key"), F.to_variant_object(F.array(F.col(f))).alias("value"), F.col(f).alias("text"))
                             for f in GEO_FIELDS]), lambda e: e["text"].isNotNull())
    # a Variant of a text is made through an array, as objects, arrays and maps are all that can be one
    new = F.transform(geo, lambda e: F.struct(e["key"].alias("key"), F.variant_get(e["value"], "$[0]", "variant").alias("value")))
    old = F.map_entries(F.variant_get(F.col(RECORD), "$", "map<string,variant>"))
    kept = F.filter(old, lambda e: ~F.exists(geo, lambda g: g["key"] == e["key"]))
    merged = F.to_variant_object(F.map_from_entries(F.concat(kept, new)))
    return found.select(F.when(F.col("addr").isNull() | (F.size(geo) == 0), F.col(RECORD)).otherwise(merged).alias(RECORD))


def distinct_open(records: DataFrame, without: Sequence[str] = ("ttl",)) -> DataFrame:
    """Distinct records, the keys of ``without`` left out. Equal objects have one text whatever the order of their keys."""
    whole = F.variant_get(F.col(RECORD), "$", "map<string,variant>")
    if without:
        whole = F.map_filter(whole, lambda k, v: ~k.isin(list(without)))
    text = F.to_json(F.to_variant_object(whole))
    return records.select(text.alias("json")).distinct().select(F.parse_json("json").alias(RECORD))


def cells_of_open(records: DataFrame, generators: Sequence[MapGenerator]) -> DataFrame:
    """Cells of the map generators (``cells.map_event_generator``, ``map_edge_generator``); a key that is an
    explicit null has no text, so has no cell."""
    fields = F.map_filter(F.try_variant_get(F.col(RECORD), "$", "map<string,string>"), lambda k, v: v.isNotNull())
    return map_cells(records.select(fields.alias("fields")), generators)

