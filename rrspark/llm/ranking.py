"""Ranked lexical search: dense blocked matrix products of item tiles and document impact tiles.

The terms of the items are the only columns ever needed. One pass over the whole documents keeps, for each,
its number of terms and how often it holds each of those terms (staged), and gives N and L; a narrow pass
over these counts gives df. Then TILE_ITEMS items, over the compact vocabulary of their own terms, become
matrices of weights (items x at most TILE_TERMS terms), TILE_DOCS documents become impact tiles over the same
terms, and the scores are their products in float64. A tile takes only as many terms as keep every partial
sum below 2^53, so each product is exact; tiles are added up in 64-bit integers. Of each block of documents
only the best k of an item stay (cut at the k-th score, equal scores by doc_id), a task merges its blocks' lists as
it goes, and the tasks' lists are merged in a tree, FAN_IN at a time.

Items are dealt by hash to groups of about GROUP_BYTES of text, one pass over the documents each, so the
vocabulary sent to the tasks and the sums that reach the driver are bounded whatever the items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, scalar_int, stage

K = 20
TILE_DOCS, TILE_TERMS, TILE_ITEMS = 1024, 1024, 256
GROUP_BYTES = 4 << 20
SLICE = 1 << 20
FAN_IN = 64
EXACT = 2**53
MAX_IMPACT = 10**6  # 10^9 tf div (1000 tf + 12 m) is at most 10^6

# A-Z become a-z, and every byte that no term holds a blank; bytes from 0x80 on belong to terms.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, about SLICE bytes at a time."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= SLICE else folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


@dataclass(frozen=True)
class Items:
    """A group of items: their terms and, sparse, how often each item holds which."""

    ids: np.ndarray  # item ids
    terms: list[bytes]
    row: np.ndarray  # of the sparse counts
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Items:
        index: dict[bytes, int] = {}
        row, term, times = [], [], []
        for r, (_, text) in enumerate(rows):
            found: dict[int, int] = {}
            for part in slices(text):
                for t in part:
                    i = index.setdefault(t, len(index))
                    found[i] = found.get(i, 0) + 1
            row += [r] * len(found)
            term += found.keys()
            times += found.values()
        as_array = lambda x: np.array(x, np.int64)
        return cls(as_array([i for i, _ in rows]), list(index), as_array(row), as_array(term), as_array(times))


def counted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, held, times``: number of terms of each text, and of the given terms it holds the
    numbers (32-bit, ascending) and how often (32-bit). Texts without a term don't appear."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(shared.value)}.get
        for b in batches:
            ids, ns, held, times = [], [], [], []
            for doc, text in zip(b.column(0), b.column(1)):
                n, parts = 0, []
                for words in slices(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    n += len(words)
                    parts.append(np.array([i for i in map(get, words) if i is not None], np.int32))
                if n:
                    at, count = np.unique(np.concatenate(parts), return_counts=True)
                    ids.append(doc.as_py())
                    ns.append(n)
                    held.append(at.astype("<i4").tobytes())
                    times.append(count.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())],
                ["doc_id", "n", "held", "times"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")), run,
                     "doc_id long, n long, held binary, times binary")


def _document_frequency(counts: DataFrame, terms: int) -> np.ndarray:
    """df of each term: every task adds up its documents, ``terms`` sums in all reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["term", "df"])

    total = np.zeros(terms, np.int64)
    for r in arrow_map(counts.select("held"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        total[r["term"]] = r["df"]
    return total


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def impacts(times: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """10^9 tf div (1000 tf + 12 m), m from the document's length, all in 64-bit integers."""
    m = 100 - 25 + (25 * n * n_docs) // length
    return (10**9 * times) // (1000 * times + 12 * m)


def tiles(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """The distinct terms of an item tile, cut so that in no cut the weights of an item, times MAX_IMPACT, can add
    up to 2^53, nor are there more than TILE_TERMS. A term too heavy for that stands alone."""
    terms, at = np.unique(term, return_inverse=True)
    heaviest = np.zeros(len(terms), np.int64)
    np.maximum.at(heaviest, at, weight)
    out, lo = [], 0
    while lo < len(terms):
        width = int(np.searchsorted(np.cumsum(heaviest[lo:lo + TILE_TERMS]), EXACT // MAX_IMPACT))
        out.append(terms[lo:lo + max(1, width)])
        lo += max(1, width)
    return out


def product(weigh: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Whole-number product: BLAS in float64 where no sum can reach 2^53, else (a term alone) in 64-bit integers."""
    if weigh.shape[1] == 1 and weigh.max(initial=0) >= EXACT // MAX_IMPACT:
        return weigh.astype(np.int64) @ tile.astype(np.int64)
    return (weigh @ tile).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores above 0, equal scores by ascending id."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        held = scores[at]
        at = at[held >= np.partition(held, len(held) - k)[len(held) - k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Block:
    """Up to TILE_DOCS documents: their ids and the sparse impacts of their terms."""

    def __init__(self, b: pa.RecordBatch, n_docs: int, length: int) -> None:
        held, times = b.column(2).to_pylist(), b.column(3).to_pylist()
        self.ids = b.column(0).to_numpy()
        self.term = np.frombuffer(b"".join(held), "<i4")
        self.doc = np.repeat(np.arange(len(held)), [len(x) // 4 for x in held])
        self.impact = impacts(np.frombuffer(b"".join(times), "<i4").astype(np.int64),
                              b.column(1).to_numpy()[self.doc], n_docs, length)

    def tile(self, terms: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Dense terms x documents; ``place`` is a scratch array over the whole vocabulary, -1 throughout."""
        place[terms] = np.arange(len(terms))
        column = place[self.term]
        place[terms] = -1
        at = np.flatnonzero(column >= 0)
        out = np.zeros((len(terms), len(self.ids)))
        out[column[at], self.doc[at]] = self.impact[at]
        return out


def _lists(counts: DataFrame, items: Items, df: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """``row, item_id, task, doc_id, score``: each task's k best documents of every item."""
    shared = counts.sparkSession.sparkContext.broadcast(
        (items.ids, len(items.terms), items.row, items.term, items.times * weights(df, n_docs)[items.term]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, n_terms, row, term, weight = shared.value
        none = np.empty(0, np.int64)
        kept = [(none, none)] * len(item_ids)  # ids and scores
        place = np.full(n_terms, -1, np.int64)
        blocks = []  # first item, number of items, sparse weights and the cut vocabulary
        for lo in range(0, len(item_ids), TILE_ITEMS):
            at = slice(*np.searchsorted(row, (lo, lo + TILE_ITEMS)))
            cuts = tiles(row[at], term[at], weight[at])
            blocks.append((lo, min(TILE_ITEMS, len(item_ids) - lo), row[at] - lo, term[at], weight[at], cuts))
        for whole in batches:
            for start in range(0, len(whole), TILE_DOCS):
                docs = Block(whole.slice(start, TILE_DOCS), n_docs, length)
                for lo, size, r, t, w, cuts in blocks:
                    scores = np.zeros((size, len(docs.ids)), np.int64)
                    for terms in cuts:
                        column = np.searchsorted(terms, t)
                        at = np.flatnonzero(terms[np.minimum(column, len(terms) - 1)] == t)
                        weigh = np.zeros((size, len(terms)))
                        weigh[r[at], column[at]] = w[at]
                        scores += product(weigh, docs.tile(terms, place))
                    for i in range(size):
                        top = best(scores[i], docs.ids, k)
                        if len(top):
                            ids = np.concatenate((kept[lo + i][0], docs.ids[top]))
                            found = np.concatenate((kept[lo + i][1], scores[i][top]))
                            top = best(found, ids, k)
                            kept[lo + i] = ids[top], found[top]
        sizes = [len(ids) for ids, _ in kept]
        rows = np.repeat(np.arange(len(kept)), sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(item_ids[rows]), pa.array(np.full(len(rows), TaskContext.get().partitionId())),
             pa.array(np.concatenate([none, *(i for i, _ in kept)])), pa.array(np.concatenate([none, *(s for _, s in kept)]))],
            ["row", "item_id", "task", "doc_id", "score"])

    return arrow_map(counts.where("doc_id IS NOT NULL"), run, "row long, item_id long, task long, doc_id long, score long")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The tasks' lists of each item merged FAN_IN at a time; a level holds k rows a list."""
    left = scalar_int(lists.agg(F.max("task")).first()[0]) + 1
    order = [F.desc("score"), "doc_id"]
    while True:
        left = -(-left // FAN_IN)
        lists = lists.withColumn("task", F.pmod("task", F.lit(left)))
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy("row", "task").orderBy(*order))).where(
            F.col("rank") <= k)
        if left == 1:
            return lists.select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: per row of ``items`` (``item_id, text``) the k best rows of ``docs``
    (``doc_id, text``) with a score above 0, ranks from 1, equal scores by ascending doc_id.

    Null and empty texts have no terms: such items and documents get no rows. Documents without a doc_id
    count in N, L and df but are not ranked; repeated documents count, and are ranked, each. Rows of ``items``
    equal in id and text are one; rows with one id and different texts are ranked each. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    size = scalar_int(asked.agg(F.sum(F.octet_length("text"))).first()[0])
    groups = size // GROUP_BYTES + 1
    out = None
    for group in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        found = Items.of([(r["item_id"], bytes(r["text"])) for r in mine.select(
            "item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text").collect()])
        counts = stage(counted(docs, found.terms), "ranking-counts")
        n_docs, length = counts.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not found.terms:
            continue
        df = _document_frequency(counts, len(found.terms))
        top = _merged(stage(_lists(counts, found, df, n_docs, length, k), "ranking-lists"), k)
        out = top if out is None else out.unionByName(top)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
