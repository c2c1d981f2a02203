"""SimHash near-duplicates: fingerprints, pivot distance tables, connected components.

Fingerprint: ASCII letters lower-cased, words are runs of non-blank bytes, shingles of
``shingle_words`` words (repeats count), XXH64 of each with seed 42, majority per bit.

Linking (at most ``max_bits`` differing bits) runs over *distinct* fingerprints:

1. The pivot table holds, per fingerprint, its Hamming distance to every reference fingerprint:
   zero, the 64 one-bit references and ``RANDOM_PIVOTS`` random ones. By the triangle
   inequality two linked fingerprints differ by at most ``max_bits`` in every coordinate.
2. Comparing all pairs of rows of that table would be quadratic, so pairs first meet on the
   coordinates of the one-bit references relative to the zero reference
   (``d(x, bit i) - d(x, 0) = 1 - 2 x_i``). The 64 references are cut into ``max_bits + 1``
   families; linked fingerprints agree on all relative coordinates of at least one family
   (pigeonhole), so an equi-join per family loses no link.
3. A family bucket of more than ``BUCKET_ROWS`` fingerprints is cut again by the families of the
   references that are left, as often as needed; as a bucket with r references left holds at most
   2^r distinct fingerprints, this always ends. No bucket is dropped or capped.
4. Inside a bucket one sorted coordinate bounds each row's partners, the other
   coordinates discard pairs by maximum coordinate difference, and the survivors are verified by
   their exact Hamming distance. Only a spanning forest of a bucket's links leaves the task.

Components come from alternating large-star / small-star joins over those links, staged on shared
storage per round; nothing but row counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, parallelism, scalar_int, stage

SEED = 42
RANDOM_PIVOTS = 15
PAIRS_PER_TASK = 20_000_000
BUCKET_ROWS = 4096
PAIR_BLOCK = 1 << 18
FLUSH_ROWS = 1 << 16

_SHIFT = np.arange(64, dtype=np.uint64)


def fingerprint_of(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of one whole text; 0 when it has no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle_words, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PAIR_BLOCK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + PAIR_BLOCK], stops[at:at + PAIR_BLOCK])],
            dtype="<u8")
        counts += _bit_counts(hashes)
    return int((np.uint64(1) << _SHIFT[counts * 2 > n]).sum(dtype=np.uint64))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set; blocks of 255 rows are summed in bytes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    out = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        out += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint_of(t.as_py(), shingle_words) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, fp long")


def pivots() -> np.ndarray:
    """The random reference fingerprints (the zero and one-bit ones need no table entry)."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, RANDOM_PIVOTS, dtype=np.uint64) * np.uint64(2) + \
        np.arange(RANDOM_PIVOTS, dtype=np.uint64) % np.uint64(2)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances (rows x references) to zero and the random references, as bytes."""
    refs = np.concatenate((np.zeros(1, np.uint64), pivots()))
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int16)


def linked_pairs(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``max_bits``: sorted first coordinate, maximum coordinate difference,
    exact verification; in blocks, so memory stays bounded."""
    dist = pivot_table(fps)
    order = np.argsort(dist[:, 1], kind="stable")
    lead = dist[order, 1]
    stop = np.searchsorted(lead, lead + max_bits, side="right")
    width = stop - np.arange(len(fps)) - 1
    done = 0
    while done < len(fps):
        upto = max(done + 1, int(np.searchsorted(np.cumsum(width[done:]), PAIR_BLOCK, side="right")) + done)
        w = width[done:upto]
        left = np.repeat(np.arange(done, upto), w)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w)
        left, right = order[left], order[right]
        for c in range(dist.shape[1]):
            if not len(left):
                break
            near = np.abs(dist[left, c] - dist[right, c]) <= max_bits
            left, right = left[near], right[near]
        if len(left):
            near = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
            if near.any():
                yield left[near], right[near]
        done = upto


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Spanning stars of a bucket's components: (fingerprint index, index of its root)."""
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for left, right in linked_pairs(fps, max_bits):
        for i, j in zip(left.tolist(), right.tolist()):
            i, j = root(i), root(j)
            if i != j:
                parent[max(i, j)] = min(i, j)
    roots = [root(i) for i in range(len(fps))]
    members = [i for i, r in enumerate(roots) if r != i]
    return members, [roots[i] for i in members]


def _families(bits: list[int], n: int) -> list[list[int]]:
    return [bits[len(bits) * i // n: len(bits) * (i + 1) // n] for i in range(n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(distinct: DataFrame, max_bits: int) -> tuple[DataFrame, int]:
    """Rows ``mask, part, fp``: fingerprints that agree on the references in ``mask``; every
    bucket has 2 to BUCKET_ROWS rows. And how many pairs all buckets have."""
    spark = distinct.sparkSession
    level = distinct.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("part"), "fp")
    masks, done, pairs = [0], None, 0
    while True:
        cuts = []
        for m in masks:
            left = [i for i in range(64) if not m >> i & 1]
            cuts += [(_signed(m), _signed(m | sum(1 << i for i in f))) for f in _families(left, max_bits + 1) if f]
        masks = sorted({c & ((1 << 64) - 1) for _, c in cuts})
        choice = F.create_map(*[x for m in sorted({m for m, _ in cuts}) for x in (
            F.lit(m), F.array(*[F.lit(c) for o, c in cuts if o == m]))])
        cut = level.select(F.explode(choice[F.col("mask")]).alias("mask"), "fp").select(
            "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp")
        cut = stage(cut, "simhash-buckets")
        sizes = cut.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stage(sizes, "simhash-sizes")
        fit = sizes.where(F.col("n") <= BUCKET_ROWS)
        pairs += scalar_int(fit.agg(F.sum(F.col("n") * F.col("n"))).first()[0])
        small = cut.join(fit.drop("n"), ["mask", "part"])
        done = small if done is None else done.unionByName(small)
        hot = sizes.where(F.col("n") > BUCKET_ROWS).drop("n")
        if hot.isEmpty():
            return done, pairs
        level = cut.join(hot, ["mask", "part"])


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []

        def close() -> None:
            fps = np.unique(np.concatenate(held)).view(np.uint64)
            members, roots = _forest(fps, max_bits)
            out_a.append(fps[members].view(np.int64))
            out_b.append(fps[roots].view(np.int64))

        def flush() -> pa.RecordBatch:
            rb = pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
            out_a.clear()
            out_b.clear()
            return rb

        for b in batches:
            mask, part, fp = (b.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(fp)]):
                if hi <= lo:
                    continue
                if (mask[lo], part[lo]) != key and held:
                    close()
                    held = []
                key = (mask[lo], part[lo])
                held.append(fp[lo:hi])
            if sum(map(len, out_a)) >= FLUSH_ROWS:
                yield flush()
        if held:
            close()
        if out_a:
            yield flush()

    buckets, pairs = _buckets(distinct, max_bits)
    # the work is in the pairs, not in the bytes by which Spark would merge partitions
    tasks = max(parallelism(distinct.sparkSession), pairs // PAIRS_PER_TASK + 1)
    grouped = buckets.repartition(tasks, "mask", "part").sortWithinPartitions("mask", "part")
    return arrow_map(grouped, run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``fp, root``: the smallest member (as an unsigned order-free label) of each node's
    component, by alternating large-star and small-star until the links stop changing."""
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
                  "simhash-links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "simhash-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "simhash-small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` per input row; ``component_id`` is the smallest doc_id reachable
    over links of at most ``max_bits`` differing bits.

    Null and wordless texts share the fingerprint zero and link like any other. Repeated rows keep
    one output row each. Null ids take part in linking but are never a component's id unless it
    has no other. An empty table gives no rows; extra columns are ignored.
    """
    rows = stage(fingerprints(docs, shingle_words), "simhash-fps")
    per_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = components(links(per_fp.select("fp"), max_bits))
    named = per_fp.join(comp, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents whose id is their component's smallest; rows with a null id stay. Rows that
    repeat a kept id count as copies: one of them stays."""
    found = near_duplicates(docs, shingle_words, max_bits)
    per_id = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("kept"), F.count("*").alias("n"))
    per_id = stage(per_id.where("NOT kept OR n > 1"), "simhash-gone")
    once = docs.join(per_id.select("doc_id"), "doc_id", "left_anti")
    repeated = docs.join(per_id.where("kept").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(repeated.select(*docs.columns))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
