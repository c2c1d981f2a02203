"""IPv4 location and owner enrichment (J1, J2, J4, P11, F6).

Where ranges of a table overlap, it is first cut into segments that don't, and the narrowest range wins
each segment; a table without overlaps is used as it is. Ranges are looked at per /16 bucket,
which bounds every group by 65,536 addresses.

Two physical paths, chosen by the measured size of the bucketed range tables:

* small (at most ``broadcast_rows`` bucket rows and ``broadcast_bytes``): equi-join on the bucket plus
  ``BETWEEN`` as a broadcast hash join; the records are never shuffled. Ranges of a /16 or
  wider use /16 buckets, narrower ones /24 buckets, so an address meets few candidates.
* larger: the records are staged once on shared storage (what made them is not done again). Each
  distinct address is looked up in both tables at once: per /16 bucket one sort of the
  addresses and of the places where segments begin and end, the last one before an address is
  its segment. Records with an address then join on it (each address once, AQE splits a hot one);
  those without pass by the join.

A stream has no distinct addresses; above the limits it joins the bucketed tables without broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import full_match, ipv4_to_long, is_private_ipv4
from ..schema import ASN_PATTERN, GEO_FIELDS, PRIVATE_LABEL, UNKNOWN_LABEL, ZERO_COORD
from ..session import ship_package, staged

LOCATION_FIELDS = ["city", "cc", "country", "lat", "long"]
DEFAULT_BUCKET_BITS = 16
DEFAULT_FINE_BITS = 8
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def _text(c: Column, dtype: T.DataType) -> Column:
    """Value as text the way the reference prints it; floating values as 32-bit floats."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.cast("float").cast("string")
    return c.cast("string")


def bucket_ranges(ranges: DataFrame, bucket_bits: int = DEFAULT_BUCKET_BITS,
                  start: str = "start_ip", end: str = "end_ip") -> DataFrame:
    """One row per (range, bucket it touches). A range wider than a bucket repeats."""
    return ranges.withColumn(
        "__bucket",
        F.explode(F.sequence(F.shiftright(F.col(start), bucket_bits), F.shiftright(F.col(end), bucket_bits))),
    )


def _pieces(ranges: DataFrame) -> DataFrame:
    """``bucket, s, e, width`` and the payload: every range clipped to the /16 buckets it touches."""
    rest = [c for c in ranges.columns if c not in ("__s", "__e")]
    cut = ranges.withColumn("bucket", F.explode(F.sequence(F.shiftright("__s", 16), F.shiftright("__e", 16))))
    low = F.shiftleft(F.col("bucket"), 16)
    return cut.select("bucket", F.greatest("__s", low).alias("s"), F.least("__e", low + 65535).alias("e"),
                      (F.col("__e") - F.col("__s")).alias("width"), *rest)


def has_overlaps(ranges: DataFrame) -> bool:
    """Whether two ranges (``__s``, ``__e``) share an address."""
    before = Window.partitionBy("bucket").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    reach = _pieces(ranges.select("__s", "__e")).withColumn("reach", F.max("e").over(before))
    return not reach.where("s <= reach").isEmpty()


def _dyadic(pieces: DataFrame) -> DataFrame:
    """Every piece (``bucket, s, e``) as the aligned blocks it consists of: ``level`` (2^level addresses) and ``node``,
    the block's number at that level. At most two a level, 30 in all; a range of one CIDR block is a single one."""
    low, high = F.col("s").bitwiseAND(65535), F.col("e").bitwiseAND(65535) + 1

    def at(k: Column) -> Column:
        # blocks of level k that lie within: from l to r - 1; those that fill no block of the next level are taken
        size = F.pow(F.lit(2.0), k).cast("long")
        left, right = F.floor((low + size - 1) / size).cast("long"), F.floor(high / size).cast("long")
        odd = left.bitwiseAND(1)
        return F.array(F.when((left < right) & (odd == 1), F.struct(k.alias("level"), left.alias("node"))),
                       F.when((right.bitwiseAND(1) == 1) & (left + odd < right), F.struct(k.alias("level"), (right - 1).alias("node"))))

    blocks = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(16)), at)), lambda x: x.isNotNull())
    return pieces.withColumn("__block", F.explode(blocks)).select("*", "__block.level", "__block.node").drop("__block")


def _sweep(blocks: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """Over one bucket's blocks (start, end), best first: segments (start, end, place in the list), each the best of
    the blocks over it. Neighbours of one block stay apart."""
    order = sorted(range(len(blocks)), key=lambda i: blocks[i][0])
    edges = sorted({b[0] for b in blocks} | {b[1] + 1 for b in blocks})
    active: list[int] = []
    n = 0
    for at, stop in zip(edges, edges[1:]):
        while n < len(order) and blocks[order[n]][0] <= at:
            heapq.heappush(active, order[n])
            n += 1
        while active and blocks[active[0]][1] < at:
            heapq.heappop(active)
        if active:
            yield at, stop - 1, active[0]


def segments(ranges: DataFrame, payload: list[str]) -> DataFrame:
    """``__s, __e`` and payload of the segments that the narrowest ranges win, of equally wide ones the one that
    starts first; equal ranges go by the order of their payload.

    Ranges are cut into aligned blocks and Spark keeps the best range of every block, with a partial step, so it
    doesn't matter how many ranges lie in a /16: what is left of it are at most 131,071 blocks, whose
    nesting one task then sweeps."""
    ship_package(ranges.sparkSession)
    names = ["__s", "__e", *payload]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def cut() -> list[tuple]:
            out: list[tuple] = []
            for at, stop, i in _sweep([(s, e) for _, s, e, *_ in held]):
                won = held[i][3:]  # where the range begins and its payload: neighbours of one range are one segment
                if out and out[-1][1] + 1 == at and out[-1][2] == won:
                    out[-1] = (out[-1][0], stop, won)
                else:
                    out.append((at, stop, won))
            return [(s, e, *won[2:]) for s, e, won in out]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            types = [pa.int64(), pa.int64(), *[b.schema.field(p).type for p in payload]]
            done = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[0] != key:
                    done += cut()
                    key, held = row[0], []
                held.append(row)
            if done:
                yield batch(done)
        if held and (done := cut()):
            yield batch(done)

    pieces = _pieces(ranges.withColumn("__start", F.col("__s")))
    best = _dyadic(pieces).groupBy("bucket", "level", "node").agg(F.min(F.struct("width", "__start", *payload)).alias("best"))
    size = F.pow(F.lit(2.0), F.col("level")).cast("long")
    low = F.shiftleft(F.col("bucket"), 16) + F.col("node") * size
    rows = best.select("bucket", low.alias("s"), (low + size - 1).alias("e"), F.col("best.width").alias("width"),
                       F.col("best.__start").alias("start"), *[F.col("best")[p].alias(p) for p in payload])
    schema = T.StructType([T.StructField("__s", T.LongType()), T.StructField("__e", T.LongType()),
                           *[ranges.schema[p] for p in payload]])
    return rows.repartition("bucket").sortWithinPartitions("bucket", "width", "start", *payload).mapInArrow(run, schema)


def _bucket_join(keys: DataFrame, ip_col: str, r: DataFrame, payload: list[str], prefix: str, levels, level_rows,
                 broadcast: bool) -> DataFrame:
    """Left equi-join on the bucket plus ``BETWEEN``, one join per level that has ranges."""
    keep = [i for i, n in enumerate(level_rows) if n > 0] or [0]
    ip, out = F.col(ip_col), keys
    for i in keep:
        bits, cond = levels[i]
        p = f"{prefix}{i}_"
        right = bucket_ranges(r.where(cond), bits, "__s", "__e").select(
            F.col("__bucket").alias(f"{p}bucket"), F.col("__s").alias(f"{p}start"), F.col("__e").alias(f"{p}end"),
            *[F.col(x).alias(f"{p}{x}") for x in payload])
        on = (F.shiftright(ip, bits) == F.col(f"{p}bucket")) & ip.between(F.col(f"{p}start"), F.col(f"{p}end"))
        out = out.join(F.broadcast(right) if broadcast else right, on, "left").withColumn(
            f"{p}found", F.col(f"{p}start").isNotNull()).drop(f"{p}bucket", f"{p}start", f"{p}end")
    found = F.lit(False)
    for i in keep:
        found = found | F.col(f"{prefix}{i}_found")
    merged = {f"{prefix}found": found}
    for x in payload:
        v = F.lit(None)
        for i in keep:
            v = F.when(F.col(f"{prefix}{i}_found"), F.col(f"{prefix}{i}_{x}")).otherwise(v)
        merged[f"{prefix}{x}"] = v
    return out.withColumns(merged).drop(*[f"{prefix}{i}_{x}" for i in keep for x in payload + ["found"]])


def _sorted_lookup(addresses: DataFrame, ip_col: str, tables: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Distinct ``addresses`` with ``<prefix>found`` and ``<prefix><payload>`` of every table: one
    exchange on the /16 bucket, one sort, no candidate pairs."""
    types = [f"struct<on:boolean,{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in r.schema.fields if f.name in payload)}>"
             for r, payload, _ in tables]
    states = [f"__state{i}" for i in range(len(tables))]

    def row(kind: int, at: Column, filled: int | None, value: Column | None) -> list[Column]:
        return [F.shiftright(at, 16).alias("bucket"), at.alias("at"), F.lit(kind).alias("kind"),
                *[(value if i == filled else F.lit(None)).cast(t).alias(s) for i, (s, t) in enumerate(zip(states, types))]]

    rows = addresses.select(*row(2, F.col(ip_col), None, None))
    for i, (r, payload, _) in enumerate(tables):
        names = [f.name for f in r.schema.fields if f.name in payload]
        cut = _pieces(r)
        begin = F.struct(F.lit(True).alias("on"), *[F.col(n) for n in names])
        over = F.struct(F.lit(False).alias("on"), *[F.lit(None).cast(r.schema[n].dataType).alias(n) for n in names])
        rows = rows.unionByName(cut.select(*row(1, F.col("s"), i, begin)))
        # an end is a row of its own, before a segment that begins at the same place
        rows = rows.unionByName(cut.where(F.col("e").bitwiseAND(65535) != 65535).select(*row(0, F.col("e") + 1, i, over)))
    upto = Window.partitionBy("bucket").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumns({s: F.last(s, ignorenulls=True).over(upto) for s in states}).where("kind = 2")
    out = [F.col("at").alias(ip_col)]
    for s, (_, payload, prefix) in zip(states, tables):
        out += [F.coalesce(F.col(s)["on"], F.lit(False)).alias(f"{prefix}found"),
                *[F.col(s)[x].alias(f"{prefix}{x}") for x in payload]]
    return seen.select(*out)


def range_lookup(
    keys: DataFrame,
    ip_col: str,
    tables: list[tuple[DataFrame, list[str], str]],
    bucket_bits: int = DEFAULT_BUCKET_BITS,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    fine_bits: int = DEFAULT_FINE_BITS,
) -> DataFrame:
    """Left range join with every table (``start_ip, end_ip``, inclusive; its payload columns; a prefix):
    ``keys`` plus ``<prefix>found`` and ``<prefix><payload>`` per table. ``ip_col`` is a long (NULL: no
    lookup). See the module text for overlaps and the physical paths; the limits hold for all
    tables together."""
    wide = (F.col("__e") - F.col("__s") + F.lit(1)) >= F.lit(1 << bucket_bits)
    levels = [(bucket_bits, wide), (fine_bits, ~wide)]
    ready, rows, size = [], 0, 0
    for ranges, payload, prefix in tables:
        r = ranges.select(F.col("start_ip").cast("long").alias("__s"), F.col("end_ip").cast("long").alias("__e"),
                          *payload).where("__s <= __e")
        if has_overlaps(r):
            r = staged(segments(r, payload), "geo-segments")
        counts, width = _bucket_size(r, levels)
        ready.append((r, payload, prefix, counts))
        rows, size = rows + sum(counts), size + width
    small = rows <= broadcast_rows and size <= broadcast_bytes
    if small or keys.isStreaming:
        for r, payload, prefix, counts in ready:
            keys = _bucket_join(keys, ip_col, r, payload, prefix, levels, counts, small)
        return keys
    keys = staged(keys, "geo-records")
    with_ip = keys.where(F.col(ip_col).isNotNull())
    looked = _sorted_lookup(with_ip.select(ip_col).distinct(), ip_col, [t[:3] for t in ready])
    joined = with_ip.join(looked, ip_col, "left")
    added = [f for f in joined.schema.fields if f.name not in keys.columns]
    without = keys.where(F.col(ip_col).isNull()).withColumns({
        f.name: F.lit(False) if f.name.endswith("found") else F.lit(None).cast(f.dataType) for f in added})
    return joined.unionByName(without)


def _bucket_size(r: DataFrame, levels) -> tuple[list[int], int]:
    """(rows per level, bytes) that the bucketed table would hold, in one pass over the range table
    and without exploding it: rows = buckets touched per range, bytes = rows x row width."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8))
        for f in r.schema.fields
    ) + F.lit(24)
    per_level = [
        F.when(cond, F.shiftright(F.col("__e"), bits) - F.shiftright(F.col("__s"), bits) + F.lit(1)).otherwise(F.lit(0))
        for bits, cond in levels
    ]
    rows = per_level[0]
    for n in per_level[1:]:
        rows = rows + n
    m = r.agg(F.sum(rows * width).alias("bytes"), *[F.sum(n).alias(f"n{i}") for i, n in enumerate(per_level)]).first()
    return [int(m[f"n{i}"] or 0) for i in range(len(levels))], int(m["bytes"] or 0)


def enrich_geo(
    df: DataFrame,
    blocks: DataFrame,
    asn: DataFrame | None = None,
    bucket_bits: int = DEFAULT_BUCKET_BITS,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``city, cc, country, lat, long, asn, org`` to records that have ``addr``.

    * private address (text prefix 10., 192.168., 172.16.-172.31.) -> ``RFC1918`` in all
      seven fields, lat/long ``0.0`` (checked first, so a block covering 10/8 loses);
    * no block holds the address (or ``addr`` is not an IPv4 text) -> ``UNKNOWN``, lat/long
      ``0.0``, also for ``asn``/``org``;
    * found -> the block's fields upper-cased; a NULL block field leaves the record's field;
      the owner text ``AS<n> <name>`` gives ``asn=<n>``, ``org=<NAME>``; other text gives
      only ``org``; no owner range gives neither.

    ``blocks``: ``start_ip, end_ip`` (longs, inclusive) and any of the location fields; where ranges
    overlap the narrowest one holds the address.
    ``asn``: owner ranges ``start_ip, end_ip, org_raw``; when omitted and ``blocks`` has
    ``org_raw``, owners come from the same lookup. Records without ``addr`` pass through.
    Duplicates are kept (no deduplication at this stage).
    """
    cols = df.columns
    base = df
    for f in GEO_FIELDS:
        if f not in cols:
            base = base.withColumn(f, F.lit(None).cast("string"))
    addr = F.col("addr")
    keyed = base.withColumn("__private", is_private_ipv4(addr)).withColumn(
        "__ip", F.when(addr.isNotNull() & ~F.col("__private"), ipv4_to_long(addr))
    )

    bfields = {f.name: f.dataType for f in blocks.schema.fields}
    loc_payload = [f for f in LOCATION_FIELDS if f in bfields]
    owner_from_blocks = asn is None and "org_raw" in bfields
    if owner_from_blocks:
        loc_payload.append("org_raw")
    blocks_sel = blocks.select(
        "start_ip", "end_ip", *[_text(F.col(f), bfields[f]).alias(f) for f in loc_payload]
    )
    tables = [(blocks_sel, loc_payload, "__g_")]
    owner_col = None
    if owner_from_blocks:
        owner_col = F.col("__g_org_raw")
    elif asn is not None:
        tables.append((asn.select("start_ip", "end_ip", F.col("org_raw").cast("string")), ["org_raw"], "__a_"))
        owner_col = F.col("__a_org_raw")  # shown only where a location was found
    j = range_lookup(keyed, "__ip", tables, bucket_bits, broadcast_rows, broadcast_bytes)

    is_none = addr.isNull()
    private = F.col("__private")
    found = F.col("__g_found")

    def pick(field: str, found_value: Column, const_zero: bool = False) -> Column:
        priv = F.lit(ZERO_COORD if const_zero else PRIVATE_LABEL)
        unk = F.lit(ZERO_COORD if const_zero else UNKNOWN_LABEL)
        return (
            F.when(is_none, F.col(field))
            .when(private, priv)
            .when(~found, unk)
            .otherwise(F.coalesce(found_value, F.col(field)))
        )

    new = {}
    for f in LOCATION_FIELDS:
        fv = F.upper(F.col(f"__g_{f}")) if f in loc_payload else F.lit(None).cast("string")
        new[f] = pick(f, fv, const_zero=f in ("lat", "long"))
    if owner_col is not None:
        matched = full_match(owner_col, ASN_PATTERN[1:-1])
        asn_v = F.when(matched, F.regexp_extract(owner_col, ASN_PATTERN, 1))
        org_v = F.when(matched, F.upper(F.regexp_extract(owner_col, ASN_PATTERN, 2))).otherwise(F.upper(owner_col))
    else:
        asn_v = F.lit(None).cast("string")
        org_v = F.lit(None).cast("string")
    new["asn"] = pick("asn", asn_v)
    new["org"] = pick("org", org_v)
    out = j.withColumns(new)
    return out.select(*[F.col(c) for c in cols], *[F.col(f) for f in GEO_FIELDS if f not in cols])


def geo_counts(enriched: DataFrame, by: str = "cc") -> DataFrame:
    """Records per location value (partial aggregation before the shuffle)."""
    return enriched.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
