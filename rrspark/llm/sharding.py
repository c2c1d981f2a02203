"""Byte-balanced shards by histogram sort.

Rows are ordered by (hash of the text, doc_id), so equal texts lie next to each other. Splitters are
found without moving rows: each round counts, exactly and across all partitions, the bytes
and rows below a set of probes; a probe close enough to its target becomes the splitter, the
others' intervals shrink to the two probes around the target. Where an interval has shrunk to one
hash value (each count comes with the least and greatest key it met), a group of equal texts
straddles the target; if neither of its edges is close enough, the search goes on over the group's doc_ids, so only a group larger than the tolerance is split. Then
the rows move once, to more ranges than shards, and sort within them; the exact counts
below each splitter give every range its first slot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, scalar_int, stage

TOLERANCE = 0.01
WHOLE = 0.05  # groups up to this share of a shard are never split
PROBES = 64
RANGE_BYTES = 256 << 20
MIN_RANGES, MAX_RANGES = 4, 4096  # per shard
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Splitter:
    """Rows at or above (h, d) go right; ``bytes`` and ``rows`` lie below."""

    h: int
    d: int
    bytes: int
    rows: int


@dataclass
class Interval:
    """What lies around a target: keys ``low`` to ``high`` (both occur), with the exact bytes and rows
    below ``low`` and up to ``high``."""

    low: int
    high: int
    bytes: tuple[int, int]
    rows: tuple[int, int]

    def nearest(self, target: int) -> Splitter:
        left = target - self.bytes[0] <= self.bytes[1] - target or self.high == HIGH
        return Splitter(self.low, LOW, self.bytes[0], self.rows[0]) if left else Splitter(
            self.high + 1, LOW, self.bytes[1], self.rows[1])


def _histogram(keys: DataFrame, probes: list[int], column: str) -> list[Interval]:
    """Exact bytes, rows, least and greatest key between neighbouring probes, empty gaps left out."""
    edges = np.array(probes, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        least, most = np.full(len(edges) + 1, HIGH), np.full(len(edges) + 1, LOW)
        for b in batches:
            key = b.column(0).to_numpy()
            at = np.searchsorted(edges, key, side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(size, at, b.column(1).to_numpy())
            np.minimum.at(least, at, key)
            np.maximum.at(most, at, key)
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (used, size[used], rows[used], least[used], most[used])],
            ["at", "size", "n", "least", "most"])

    counted = arrow_map(keys.select(column, "size"), run, "at long, size long, n long, least long, most long")
    summed = counted.groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("least").alias("least"),
                                           F.max("most").alias("most")).collect()
    out, size, rows = [], 0, 0
    for r in sorted(summed, key=lambda r: r["at"]):  # a row per probe at most
        out.append(Interval(r["least"], r["most"], (size, size + r["size"]), (rows, rows + r["n"])))
        size, rows = out[-1].bytes[1], out[-1].rows[1]
    return out


def _search(keys: DataFrame, column: str, slack: dict[int, float]) -> dict[int, Interval]:
    """Per target the interval around it, narrowed until an end is within the target's slack or one
    key is left."""
    known = {t: x for x in _histogram(keys, [], column) for t in slack}
    while True:
        todo = [t for t, x in known.items() if x.low < x.high and abs(x.nearest(t).bytes - t) > slack[t]]
        if not todo:
            return known
        around = {(known[t].low, known[t].high) for t in todo}  # their own ends are probes too
        probes = {p for a, z in around for p in (a, z + 1, *(a + (z - a) * i // PROBES + 1 for i in range(PROBES)))}
        found = _histogram(keys, sorted(p for p in probes if p <= HIGH), column)
        for t in todo:
            known[t] = next((x for x in found if x.bytes[0] <= t < x.bytes[1]), found[-1])


def splitters(keys: DataFrame, slack: dict[int, float], whole: dict[int, float]) -> dict[int, Splitter]:
    """A splitter of the rows ``h, d, size`` for every target (bytes below it): it misses the
    target by its slack at most, if single rows and groups of up to ``whole`` bytes allow it."""
    out: dict[int, Splitter] = {}
    hot: dict[int, tuple[Interval, list[int]]] = {}
    for t, x in _search(keys, "h", slack).items():
        out[t] = x.nearest(t)
        if abs(out[t].bytes - t) > slack[t] and x.bytes[1] - x.bytes[0] > whole[t]:
            hot.setdefault(x.low, (x, []))[1].append(t)
    for h, (x, ts) in hot.items():  # hash values that straddle a target; no more than there are targets
        if x.rows[1] - x.rows[0] < 2:
            continue
        inside = _search(keys.where(F.col("h") == h), "d", {t - x.bytes[0]: slack[t] for t in ts})
        for t in ts:
            s = inside[t - x.bytes[0]].nearest(t - x.bytes[0])
            if abs(x.bytes[0] + s.bytes - t) < abs(out[t].bytes - t):
                out[t] = Splitter(h, s.h, x.bytes[0] + s.bytes, x.rows[0] + s.rows)
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` (all columns) with ``size`` (UTF-8 bytes of the text plus 1), ``shard`` and ``slot``.

    A null text counts as empty, a null doc_id as the smallest. Rows with equal text and doc_id can't
    be told apart by the key and stay in one shard. An empty table gives no rows. Columns that
    clash with the new ones are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h, d = F.xxhash64(text), F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW))
    size = F.octet_length(text).cast("long") + 1
    keys = stage(docs.select(h.alias("h"), d.alias("d"), size.alias("size")), "sharding-keys")
    total = scalar_int(keys.agg(F.sum("size")).first()[0])
    per = max(MIN_RANGES, min(MAX_RANGES, total // (shards * RANGE_BYTES) + 1))
    parts = shards * per
    # shard bounds must meet the tolerance, those of the ranges inside a shard a tenth of a range
    slack = {total * j // parts: (tolerance * total / shards if j % per == 0 else 0.1 * total / parts)
             for j in range(parts - 1, 0, -1)}
    whole = {t: (WHOLE * total / shards if i % per == 0 else 0) for t, i in zip(slack, range(parts - 1, 0, -1))}
    of_shard = {total * j // shards for j in range(1, shards)}
    bounds = sorted(((s.h, s.d, s.bytes, s.rows, t in of_shard) for t, s in splitters(keys, slack, whole).items()),
                    key=lambda x: (x[0], x[1], x[3]))
    heads = np.array([b[0] for b in bounds], dtype=np.int64)
    split_groups = [(b[0], b[1]) for b in bounds if b[1] != LOW]

    @F.pandas_udf("int")
    def range_of(h: pd.Series, d: pd.Series) -> pd.Series:
        h, d = h.to_numpy(), d.to_numpy()
        at = np.searchsorted(heads, h, side="right")
        for bh, bd in split_groups:
            at -= (h == bh) & (d < bd)
        return pd.Series(at.astype(np.int32))

    # range i holds the rows between bounds i - 1 and i: its shard, and the rows before it there
    shard, base, first = [0], [0], 0
    for _, _, _, rows, new_shard in bounds:
        first = rows if new_shard else first
        shard.append(shard[-1] + new_shard)
        base.append(rows - first)
    moved = docs.select(F.struct("*").alias("row"), size.alias("size"), h.alias("h"), d.alias("d"))
    moved = moved.withColumn("range", range_of("h", "d")).repartitionById(len(bounds) + 1, F.col("range"))
    placed = moved.sortWithinPartitions("h", "d").withColumn(
        "row_index", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    lookup = lambda xs, kind: F.element_at(F.lit(xs).cast(f"array<{kind}>"), F.col("range") + 1)
    return placed.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in ("size", "shard", "slot")],
        "size", lookup(shard, "int").alias("shard"), (lookup(base, "bigint") + F.col("row_index")).alias("slot"))


def shard_digest(docs: DataFrame) -> DataFrame:
    return shard_by_bytes(docs).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
