"""Stage jobs for ``spark-submit`` (or ``python -m rrspark.cli``), one per step of the
domain-mining workflow:

    collect  TYPES DOMAINS OUT --answers PATH | --lookup module:factory   (requests -> responses)
    parse    IN OUT [--keep-ttl] [--txt rdata] [--in-format sequence]    (responses -> distinct records)
    geo      IN OUT --blocks PATH [--asn PATH]                             (records -> enriched)
    filter   EXPR IN OUT [--by-type]                                       (records -> subset)
    extract  EXPR IN OUT [--keep-quotes]                                   (records -> distinct values)
    store    IN OUT [--events TABLE:TYPE] [--edges TABLE:TYPE:a:b,c:d] [--no-reverse] [--no-stats] [--in-format json]
             [--run ID] [--keyed [--compact]] (the same input with the same settings changes nothing when stored again)
    dump     IN OUT                                                        (responses -> text files)

geo, filter and extract take JSON records with any keys too (--in-format json or sequence); these stay one Variant
column, and every key of theirs is still there after a stage. Expressions are Spark SQL. Every stage reads and writes Parquet unless told otherwise; all but geo
and dump, which count nothing, print their counters as one JSON line; parse, filter and extract also commit them
with their output, store with its run.
"""

from __future__ import annotations

import argparse
import hashlib
import importlib
import json
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from .operators.cells import edge_generator, event_generator, generate_cells, map_edge_generator, map_event_generator
from .operators.decode import decode_messages, decode_responses, response_text
from .operators.extract import extract_count_columns, extract_values
from .operators.filters import observe_filter
from .operators.geo import enrich_geo
from .operators.open_records import RECORD, enrich_open, key, open_records, with_keys
from .operators.records import distinct_records
from .operators.requests import expand_requests
from .operators.resolve import lookup_summary, rcode_counts, resolve, resolve_with, responses
from .session import ensure_checkpoint_dir, scratch_scope
from .sinks.files import (
    store, store_json, store_json_run, write_by_type, write_cells, write_counted, write_records, write_responses,
)
from .sinks.hadoop import Folder
from .sinks.store import BUCKETS, CellStore
from .sources.files import read_domains, read_json_lines, read_ranges, read_records, read_responses


def _emit(counters: dict) -> None:
    print(json.dumps(counters, default=str))


def cmd_collect(spark: SparkSession, a) -> None:
    reqs = expand_requests(read_domains(spark, a.domains), types=a.types, subdomains=a.subdomains.split(","),
                           dclass=a.dclass)
    if a.answers:
        attempts = resolve(reqs, spark.read.parquet(a.answers))
    else:
        module, _, name = a.lookup.partition(":")
        factory = getattr(importlib.import_module(module), name)
        servers = a.nameservers.split(",") if a.nameservers else None
        attempts = resolve_with(reqs, factory, threads=a.threads, timeout=a.timeout, partitions=a.partitions,
                                nameservers=servers, outstanding=a.outstanding)
    path_attempts = a.out.rstrip("/") + "_attempts"
    write_records(attempts, path_attempts)  # materialised once; responses and totals read it back
    done = spark.read.parquet(path_attempts)
    write_responses(responses(done), a.out)
    codes = {r["rcode"]: r["n"] for r in rcode_counts(done).collect()}  # one row per response code
    _emit(lookup_summary(done).first().asDict() | {"rcodes": codes})


def cmd_parse(spark: SparkSession, a) -> None:
    obs = Observation("parse")
    recs = decode_responses(read_responses(spark, a.input, a.in_format), ignore_ttl=not a.keep_ttl,
                            txt_mode=a.txt, observation=obs)
    recs = distinct_records(recs, ignore_ttl=not a.keep_ttl)
    _emit(write_counted(spark, a.out, lambda path: write_records(recs, path), lambda: obs.get))


def _records(spark: SparkSession, a):
    """Records of columns, or open ones (one Variant column): JSON input, or what a stage made of it."""
    if a.in_format != "parquet":
        return open_records(read_json_lines(spark, a.input, a.in_format))
    found = spark.read.parquet(a.input)
    return found if found.columns == [RECORD] else read_records(spark, a.input)


def cmd_geo(spark: SparkSession, a) -> None:
    asn = read_ranges(spark, a.asn) if a.asn else None
    recs = _records(spark, a)
    enrich = enrich_open if recs.columns == [RECORD] else enrich_geo
    write_records(enrich(recs, read_ranges(spark, a.blocks), asn=asn), a.out)


def cmd_filter(spark: SparkSession, a) -> None:
    recs = _records(spark, a)
    kept, obs = observe_filter(with_keys(recs, a.expr, _key_types(a)) if recs.columns == [RECORD] else recs, a.expr)
    if recs.columns == [RECORD]:
        kept = kept.select(RECORD) if not a.by_type else kept.select(RECORD, key("type").alias("type"))
    write = write_by_type if a.by_type else write_records
    _emit(write_counted(spark, a.out, lambda path: write(kept, path), lambda: obs.get))


def cmd_extract(spark: SparkSession, a) -> None:
    recs = _records(spark, a)
    recs = with_keys(recs, a.expr, _key_types(a)) if recs.columns == [RECORD] else recs
    obs = Observation("extract")
    counted = recs.observe(obs, *extract_count_columns(a.expr))
    values = extract_values(counted, a.expr, strip_outer_quotes=not a.keep_quotes)
    _emit(write_counted(spark, a.out, lambda path: write_records(values, path), lambda: obs.get))


def _key_types(a) -> dict[str, str]:
    return dict(k.rsplit(":", 1) for k in a.key or [])


def cmd_store(spark: SparkSession, a) -> None:
    any_keys = a.in_format != "parquet"
    event, edge = (map_event_generator, map_edge_generator) if any_keys else (event_generator, edge_generator)
    gens = []
    for spec in a.events or []:
        table, dtype = spec.split(":", 1)
        gens.append(event(table, dtype))
    for spec in a.edges or []:
        table, dtype, edges = spec.split(":", 2)
        gens.append(edge(table, dtype, edges, bidirectional=not a.no_reverse, univariate=not a.no_stats))
    if not gens:
        raise SystemExit("store: give --events and/or --edges")

    lines = read_json_lines(spark, a.input, a.in_format) if any_keys else spark.read.parquet(a.input)
    run = a.run or _input_id(spark, lines, [a.events, a.edges, a.no_reverse, a.no_stats])
    if a.keyed:
        _store_keyed(spark, a, lines, gens, run, any_keys)
    elif any_keys:
        _emit({"run": run, **store_json(lines, gens, lambda cells: write_cells(cells, a.out, run))})
    else:
        obs = Observation("store")
        store(_counted(lines, obs), gens, sink=lambda cells: write_cells(cells, a.out, run))
        _emit({"run": run, **_all_stored(obs)})


def _counted(records, obs: Observation):
    return records.observe(obs, F.count(F.lit(1)).alias("records_stored"))


def _all_stored(obs: Observation) -> dict:
    return {"bad_records": 0, "failed_store": 0, **obs.get, "total": obs.get["records_stored"]}


def _store_keyed(spark: SparkSession, a, lines, gens, run: str, any_keys: bool) -> None:
    into = CellStore(spark, a.out, a.buckets)
    if any_keys:
        store_json_run(lines, gens, into, run)
    else:
        obs = Observation("store")
        into.add(generate_cells(_counted(lines, obs), gens), run, lambda: _all_stored(obs))
    _emit({"run": run, **into.counters(run)})
    if a.compact:
        into.compact()


def _input_id(spark: SparkSession, df, settings: list) -> str:
    """The same for the same input files (names and sizes) and settings, so storing them again is the same run."""
    files = sorted((f, Folder(spark, f).size()) for f in df.inputFiles())
    return hashlib.sha1(repr((files, settings)).encode()).hexdigest()


def cmd_dump(spark: SparkSession, a) -> None:
    """``key: message`` lines written as text files by the executors (not through the driver)."""
    response_text(decode_messages(read_responses(spark, a.input, a.in_format))).write.mode("overwrite").text(a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rrspark")
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("collect")
    c.add_argument("types")
    c.add_argument("domains")
    c.add_argument("out")
    c.add_argument("--dclass", default="IN")
    c.add_argument("--subdomains", default="")
    src = c.add_mutually_exclusive_group(required=True)
    src.add_argument("--answers")
    src.add_argument("--lookup", help="module:factory; factory(timeout) -> lookup(name, type, dclass)")
    c.add_argument("--threads", type=int, default=50)
    c.add_argument("--timeout", type=float, default=5.0)
    c.add_argument("--outstanding", type=int, default=5000, help="requests of a task that may be unanswered at once")
    c.add_argument("--partitions", type=int)
    c.add_argument("--nameservers", help="comma-separated; one per name is handed to the lookup")

    pr = sub.add_parser("parse")
    pr.add_argument("input")
    pr.add_argument("out")
    pr.add_argument("--keep-ttl", action="store_true")
    pr.add_argument("--txt", choices=["record", "rdata"], default="record")
    pr.add_argument("--in-format", choices=["parquet", "sequence"], default="parquet")

    g = sub.add_parser("geo")
    g.add_argument("input")
    g.add_argument("out")
    g.add_argument("--blocks", required=True)
    g.add_argument("--asn")
    g.add_argument("--in-format", choices=["parquet", "json", "sequence"], default="parquet")

    f = sub.add_parser("filter")
    f.add_argument("expr")
    f.add_argument("input")
    f.add_argument("out")
    f.add_argument("--by-type", action="store_true", help="write one directory per record type")
    f.add_argument("--in-format", choices=["parquet", "json", "sequence"], default="parquet")
    f.add_argument("--key", action="append", help="NAME:TYPE of a key outside the record schema; text otherwise")

    e = sub.add_parser("extract")
    e.add_argument("expr")
    e.add_argument("input")
    e.add_argument("out")
    e.add_argument("--keep-quotes", action="store_true")
    e.add_argument("--in-format", choices=["parquet", "json", "sequence"], default="parquet")
    e.add_argument("--key", action="append", help="NAME:TYPE of a key outside the record schema; text otherwise")

    s = sub.add_parser("store")
    s.add_argument("input")
    s.add_argument("out")
    s.add_argument("--events", action="append")
    s.add_argument("--edges", action="append")
    s.add_argument("--no-reverse", action="store_true")
    s.add_argument("--no-stats", action="store_true")
    s.add_argument("--in-format", choices=["parquet", "json", "sequence"], default="parquet")

    s.add_argument("--run", help="id of this data set; by default made of the input files and settings")
    s.add_argument("--keyed", action="store_true", help="OUT is a keyed store: one cell per key, counts over all runs")
    s.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a new keyed store")
    s.add_argument("--compact", action="store_true", help="merge the runs of the keyed store afterwards")

    d = sub.add_parser("dump")
    d.add_argument("input")
    d.add_argument("out")
    d.add_argument("--in-format", choices=["parquet", "sequence"], default="parquet")
    return p


COMMANDS = {"collect": cmd_collect, "parse": cmd_parse, "geo": cmd_geo, "filter": cmd_filter,
            "extract": cmd_extract, "store": cmd_store, "dump": cmd_dump}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"rrspark-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    with scratch_scope(spark):
        COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
