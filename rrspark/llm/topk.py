"""Exact top-k by inner product: tiled matrix products, partial selection, tree merge.

Vectors are cut into blocks where they are read, without a shuffle; the queries are cut into blocks
too and dealt to every group of shards. Each (query block, shard block) pair is one tile: a matrix
product in numpy, the best k of each query in the tile, ties to the smaller id. A task goes on with a
query's best of its tiles so far, for up to ``HELD_ROWS`` queries; the tasks' lists are merged ``FAN_IN``
at a time until one is left per query, so no task ever holds more than FAN_IN * k entries of a query.
Every query meets every vector, in blocks.

Only the queries are repeated, once per group of shards: no more groups than the shuffle parallelism, and
so few (but ``MIN_GROUPS``) that the repeated queries are no more than the vectors. Both sides are shuffled
by group; a broadcast would take all the repeated queries through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, parallelism, stage

K = 10
QUERY_ROWS, SHARD_ROWS = 512, 4096
FAN_IN = 16
MIN_GROUPS, HELD_ROWS = 16, 1 << 18
EXACT = 2**53
LONG = (1 << 63) - 1


def quantised(embedding: np.ndarray) -> np.ndarray:
    return np.floor(1024.0 * embedding.astype(np.float64))


def usable(column: str) -> Column:
    """Not null, without null or non-finite components."""
    bad = F.exists(F.col(column), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(False))


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """``block, dim, ids, data``: up to ``rows`` quantised vectors of one length per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        made = 0
        part = TaskContext.get().partitionId()

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids = np.concatenate([i for i, _ in held[dim]])
            data = np.concatenate([d for _, d in held[dim]])
            held[dim] = [(ids[rows:], data[rows:])]
            made += 1
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 24) + made], pa.int64()), "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([ids[:rows].tobytes()], pa.binary()),
                "data": pa.array([data[:rows].tobytes()], pa.binary())})

        for b in batches:
            ids, column = b.column(0).to_numpy(), b.column(1)
            sizes = np.asarray(column.value_lengths())
            flat = quantised(column.flatten().to_numpy(zero_copy_only=False))
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                held.setdefault(dim, []).append((ids[at], flat[starts[at][:, None] + np.arange(dim)]))
                while sum(len(i) for i, _ in held[dim]) >= rows:
                    yield block(dim)
        for dim in held:
            if sum(len(i) for i, _ in held[dim]):
                yield block(dim)

    return arrow_map(vectors, run, "block long, dim int, ids binary, data binary")


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where every partial sum is exact, else in Python integers
    (kept within plus or minus 2^63 - 1)."""
    bound = max(1, q.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0))
    if bound < EXACT:
        return (q @ v.T).astype(np.int64)
    whole = lambda m: np.vectorize(int, otypes=[object])(m)
    return np.clip(whole(q) @ whole(v).T, -LONG, LONG).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best of one row: highest score, then smallest id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _tiles(pairs: DataFrame, k: int) -> DataFrame:
    """``query_id, query_row, tile, top``: each query's best of the tiles that a task took together, up to ``HELD_ROWS`` queries
    at once; ``tile`` is the last of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray, list[int], np.ndarray, np.ndarray]] = {}  # by query block
        rows = 0

        def taken() -> Iterator[pa.RecordBatch]:
            for q_block, (block, q_ids, ends, v, s) in held.items():
                top = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(-s), pa.array(v)], ["minus", "vec_id"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids, pa.int64()), pa.array([(q_block << 10) + i for i in range(len(q_ids))], pa.int64()),
                     pa.array([block] * len(q_ids), pa.int64()), top],
                    ["query_id", "query_row", "tile", "top"])
            held.clear()

        for b in batches:
            for r in range(len(b)):
                row = {n: b.column(i)[r].as_py() for i, n in enumerate(b.schema.names)}
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                scores = _scores(np.frombuffer(row["q_data"]).reshape(len(q_ids), row["dim"]),
                                 np.frombuffer(row["data"]).reshape(len(ids), row["dim"]))
                before = held.pop(row["q_block"], None)
                if before is None:
                    rows += len(q_ids)
                best: list[tuple[np.ndarray, np.ndarray]] = []
                for i, query in enumerate(q_ids.tolist()):
                    other = np.flatnonzero(ids != query) if (ids == query).any() else slice(None)
                    s, v = scores[i][other], ids[other]
                    at = _best(s, v, k)
                    s, v = s[at], v[at]
                    if before is not None:
                        kept = slice(before[2][i], before[2][i + 1])
                        s, v = np.concatenate([before[4][kept], s]), np.concatenate([before[3][kept], v])
                        at = _best(s, v, k)
                        s, v = s[at], v[at]
                    best.append((v, s))
                ends = np.cumsum([0, *(len(v) for v, _ in best)]).tolist()
                held[row["q_block"]] = (row["block"], q_ids, ends, np.concatenate([v for v, _ in best]),
                                        np.concatenate([s for _, s in best]))
                if rows >= HELD_ROWS:
                    yield from taken()
                    rows = 0
        yield from taken()

    return arrow_map(pairs, run, "query_id long, query_row long, tile long, "
                                 "top array<struct<minus: long, vec_id: long>>")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, groups: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: per row of ``queries`` the k best rows of ``vectors`` (both
    ``vec_id, embedding``) by inner product of the quantised components.

    Rows with the query's own vec_id are no candidates. Vectors that are null or hold null or non-finite
    components, and rows without a vec_id, take no part; only vectors of equal length are compared.
    Repeated vectors are candidates each; query rows equal in id and vector are one query. Empty tables
    give no rows.
    """
    spark = vectors.sparkSession
    pick = lambda df: df.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    asked = pick(queries).distinct()
    n_asked = asked.count()
    groups = groups or min(parallelism(spark), max(MIN_GROUPS, vectors.count() // max(1, n_asked)))
    shards = _blocks(pick(vectors), SHARD_ROWS).withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    blocks = stage(_blocks(asked.repartition(n_asked // QUERY_ROWS + 1), QUERY_ROWS), "topk-queries")
    dealt = blocks.select(
        F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    # dealt by a stated number, which adaptive execution keeps: few bytes a task are much work here
    shards, dealt = (df.repartition(2 * groups, "group", "dim") for df in (shards, dealt))
    lists = stage(_tiles(shards.hint("merge").join(dealt.hint("merge"), ["group", "dim"]), k), "topk-tiles")
    return _merged(lists, k)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """Merge the tiles' lists of each query level by level, about FAN_IN lists at a time."""
    left = lists.select("tile").distinct().count()
    at = F.xxhash64("tile")
    while left > 1:
        left = -(-left // FAN_IN)
        lists = lists.groupBy("query_id", "query_row", F.pmod(at, F.lit(left)).alias("tile")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        at = F.col("tile")
    return lists.select("query_id", F.posexplode("top").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def query_set(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.col("vec_id") % 100 == 0)
