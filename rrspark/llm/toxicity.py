"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Positives are texts confirmed toxic in the training fold; every other training text is unlabelled,
toxic ones among them included. With class prior pi the risk is
``pi * Rp(+) + max(0, Ru(-) - pi * Rp(-))``; where the second part falls below zero its gradient is
reversed (Kiryo et al. 2017). The class prior is an argument, or is estimated from positives and unlabelled
rows alone: classifiers that tell one from the other, fitted on all folds of the sample but one, score that one, and the
prior is the share of unlabelled texts over the share of positives above the cut where this quotient with its
confidence bound is least (the best-bin estimate of Garg et al. 2021). What else the labels
say doesn't count, so labels of positives alone, or of mostly positives, are as good as any.

Features: hashed lower-case words (runs of Unicode letters and marks) with their prefixes and suffixes, and every
n-gram inside words of scripts written without blanks (1 to 4 code points) or of more than ``LONG`` code points
(4 to 6), present or not;
the log-likelihood ratio of positives to the other texts selects them, words of either side, by exact counts over all
training rows that Spark adds up. The weights are fitted in numpy on a bounded, hash-ordered sample of ``positives`` and
``unlabelled`` training rows; the features are made on the executors, only the selected ones of these rows reach the
driver. Scoring reads every whole text, in windows of two blocks of ``BLOCK`` words that overlap by one: the score is that
of the worst window, so a text isn't toxic for being long.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, id_crc

BITS = 18
THRESHOLD = 0.7
CACHE_WORDS = 100_000
PREFIXES, SUFFIXES = (3, 4, 5, 6), (4, 5)

LEAST_ROWS = 3  # positives, or others, with a selected bucket, at any size
# a bucket that isn't twice as frequent in positives counts if it is in a fiftieth of the rows at most, a quarter
# more frequent on one side, and its log-likelihood ratio is over GAIN (longer texts alone raise all a little)
GAIN, RARE, RATIO = 8.0, 0.02, 1.25
APART_L2 = 0.05  # strong, as few positives may have to tell many buckets apart
FOLDS, PRIOR_ROWS, LEAST_POSITIVES = 8, (2000, 6000), 20
BLOCK, PIECE, OVERLAP = 128, 1024, 8
BROADCAST_IDS = 1_000_000
LONG = 16
INNER, INNER_LONG = (1, 2, 3, 4), (4, 5, 6)
# Thai to Myanmar, Khmer, Tai, kana, Han and their like: no blanks between words
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u2e80-\u31ff\u3400-\u4dbf"
                       "\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


_WHOLE, _PREFIX, _SUFFIX = (zlib.crc32(c) for c in (b"=", b"^", b"$"))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Every code point: letters and marks of all scripts as they are, others as blanks."""
    return np.fromiter((i if unicodedata.category(chr(i))[0] in "LM" else 32 for i in range(sys.maxunicode + 1)), "<u4")


def word_list(text: str | None) -> list[str]:
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    return _letters()[codes].tobytes().decode("utf-32-le").split()


def words_of(text: str | None) -> set[str]:
    return set(word_list(text))


def blocks_of(text: str | None) -> list[set[str]]:
    """The distinct words of every BLOCK words in turn; words of over PIECE code points in pieces that overlap."""
    words = word_list(text)
    if max(map(len, words), default=0) > PIECE:
        words = [w[i:i + PIECE] for w in words for i in range(0, max(1, len(w) - OVERLAP), PIECE - OVERLAP)]
    return [set(words[i:i + BLOCK]) for i in range(0, len(words), BLOCK)]


def buckets_of(word: str) -> list[int]:
    """Buckets of a word, its prefixes (3 to 6 bytes) and its suffixes (4 and 5 bytes)."""
    raw = word.encode("utf-8", "replace")
    n = len(raw)
    hashes = [zlib.crc32(raw, _WHOLE), *[zlib.crc32(raw[:k], _PREFIX) for k in PREFIXES if n >= k],
              *[zlib.crc32(raw[-k:], _SUFFIX) for k in SUFFIXES if n >= k]]
    return [h & ((1 << BITS) - 1) for h in hashes]


def _grams(words: list[str], orders: tuple[int, ...]) -> Iterator[np.ndarray]:
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "replace"), dtype="<u4")
    divide = np.append(0, np.cumsum(codes == 32))
    for n in orders:
        if (size := len(codes) - n + 1) > 0:
            h = np.full(size, 0x9E3779B1 * (n + 8) & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h = (h ^ codes[i:i + size]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            yield (h & np.uint32((1 << BITS) - 1)).astype(np.int64)[divide[n:] == divide[:-n]]


def inner_buckets(words: set[str]) -> np.ndarray:
    """Distinct buckets of the n-grams inside unspaced and long words."""
    unspaced = [w for w in words if not w.isascii() and _UNSPACED.search(w)]
    long = [w for w in words if len(w) > LONG and (w.isascii() or not _UNSPACED.search(w))]
    found = [g for part, orders in ((unspaced, INNER), (long, INNER_LONG)) if part for g in _grams(part, orders)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class _Packed(dict):
    """Buckets of words as bytes; bounded."""

    def __missing__(self, word: str) -> bytes:
        found = buckets_of(word)
        packed = struct.pack(f"<{len(found)}i", *found)
        if len(word) <= LONG:  # longer ones would fill the memory
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = packed
        return packed


def row_of(text: str | None, packed: _Packed | None = None) -> np.ndarray:
    """The distinct buckets of a text, sorted; a task hands in a cache of its own, which goes with it."""
    words = words_of(text)
    found = np.frombuffer(b"".join(map((_Packed() if packed is None else packed).__getitem__, words)), dtype="<i4")
    return np.unique(np.concatenate((found.astype(np.int64), inner_buckets(words))))


@dataclass
class Model:
    """A linear model over the presence of the selected buckets."""

    weights: dict[int, float]
    bias: float

    def scorer(self):
        model = self

        known = np.zeros(1 << BITS, dtype=bool)
        known[list(model.weights)] = True

        class Hits(dict):
            def __missing__(self, word: str) -> tuple[int, ...]:
                hits = tuple(b for b in buckets_of(word) if b in model.weights)
                if len(word) <= LONG:  # longer ones would fill the memory
                    if len(self) >= CACHE_WORDS:
                        self.clear()
                    self[word] = hits
                return hits

        cache = Hits()

        def hits_of(words: set[str]) -> set[int]:
            found = {b for hits in map(cache.__getitem__, words) for b in hits}
            inner = inner_buckets(words)
            found.update(inner[known[inner]].tolist())
            return found

        def score(text: str | None) -> float:
            blocks = [hits_of(words) for words in blocks_of(text)] or [set()]
            windows = [a | b for a, b in zip(blocks, blocks[1:])] or blocks
            return float(_sigmoid(self.bias + max(sum(map(self.weights.__getitem__, sorted(w))) for w in windows)))

        return score


def _sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def select(p: np.ndarray, u: np.ndarray, n: int, m: int) -> np.ndarray:
    """The buckets that tell positives from the other rows. Of positives: in LEAST_ROWS of them at least, and twice as
    frequent as in the others, or more frequent by GAIN, RARE and RATIO; of the others: more frequent in them by
    these three. ``p`` of the ``n`` positives and ``u`` of all ``m`` rows have a bucket."""
    others, rest = u - p, max(1, m - n)
    pooled = np.clip(u / m, 1e-12, 1 - 1e-12)

    def loglik(k: np.ndarray, n: int) -> np.ndarray:
        q = np.clip(k / n, 1e-12, 1 - 1e-12)
        return k * np.log(q / pooled) + (n - k) * np.log((1 - q) / (1 - pooled))

    gain = loglik(p, n) + loglik(others, rest)
    a, b = p / n, others / rest
    clear = (gain > GAIN) & (u <= RARE * m)
    toxic = (p >= LEAST_ROWS) & (((a > 2 * b) & (gain > 0)) | ((a > RATIO * b) & clear))
    return np.flatnonzero(toxic | ((others >= LEAST_ROWS) & (b > RATIO * a) & clear))


class _Rows:
    """Sparse presence rows over the selected buckets."""

    def __init__(self, rows: list[np.ndarray], column: np.ndarray) -> None:
        parts = [c[c >= 0] for c in (column[r] for r in rows)]
        self.size = np.array([len(p) for p in parts], dtype=np.int64)
        self.idx = np.concatenate([np.zeros(0, np.int64), *parts])
        self.row = np.repeat(np.arange(len(parts)), self.size)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.idx], minlength=len(self.size))

    def gradient(self, g: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.idx, weights=g[self.row], minlength=n)


def risk(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the PU risk of the logistic loss: of positives, and of negatives before it is cut at 0."""
    # losses: log(1 + e^-z) for the label +1, log(1 + e^z) for -1
    return prior * np.logaddexp(0, -z_p).mean(), np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()


def step(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The nnPU direction by the scores: the gradient of the risk, or, where its negative part is
    below 0, that part's gradient reversed."""
    plus, minus = -(1 - _sigmoid(z_p)) / len(z_p), _sigmoid(z_p) / len(z_p)
    unlabelled = _sigmoid(z_u) / len(z_u)
    if risk(z_p, z_u, prior)[1] >= 0:
        return prior * plus - prior * minus, unlabelled
    return prior * minus, -unlabelled


def apart(z_p: np.ndarray, z_u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient by the scores of the logistic loss that tells positives from unlabelled rows, either side a half."""
    return -(1 - _sigmoid(z_p)) / len(z_p) / 2, _sigmoid(z_u) / len(z_u) / 2


def _descend(p: _Rows, u: _Rows, n: int, bias: float, direction, l2: float, rounds: int = 300, rate: float = 0.05) -> np.ndarray:
    """Full-batch Adam; ``n`` weights and the bias."""
    w = np.append(np.zeros(n), bias)
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, rounds + 1):
        gp, gu = direction(p.dot(w[:n]) + w[n], u.dot(w[:n]) + w[n])
        grad = np.append(p.gradient(gp, n) + u.gradient(gu, n) + l2 * w[:n], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def best_bin(z_p: np.ndarray, z_u: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Share of positives among the unlabelled by the scores of both: the share of unlabelled over that of positives
    above a cut, at the cut where this and its confidence bound are least."""
    z_p, z_u = np.sort(z_p), np.sort(z_u)
    cuts = np.unique(np.concatenate((z_p, z_u)))
    cuts = cuts[cuts <= z_p[-1]]
    above = lambda z: 1 - np.searchsorted(z, cuts) / len(z)
    q_p, q_u = above(z_p), above(z_u)
    width = sum(np.sqrt(np.log(4 / delta) / 2 / len(z)) for z in (z_p, z_u))
    return float((q_u / q_p)[np.argmin(q_u / q_p + (1 + gamma) * width / q_p)])


def estimate_prior(kept: np.ndarray, positive: list[tuple[int, np.ndarray]], unlabelled: list[tuple[int, np.ndarray]],
                   least: float) -> float:
    """The class prior by ``best_bin`` over scores that each row gets from a classifier fitted on the other folds (rows come
    with their fold; a document's are all in one). Never below ``least``, the share of known positives, which is also taken
    where there are fewer than LEAST_POSITIVES: so few say nothing about a share, and the bound alone would be near 1."""
    column = np.full(1 << BITS, -1, np.int64)
    column[kept] = np.arange(len(kept))
    n = len(kept)
    if len(positive) < LEAST_POSITIVES:
        return least
    scores: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for fold in range(FOLDS):
        others = [[r for f, r in rows if f != fold] for rows in (positive, unlabelled)]
        if not all(others):
            return least
        w = _descend(*(_Rows(rows, column) for rows in others), n, 0.0, apart, APART_L2, rounds=100)
        for held, rows in zip(scores, (positive, unlabelled)):
            held.append(_Rows([r for f, r in rows if f == fold], column).dot(w[:n]) + w[n])
    return min(0.99, max(least, best_bin(*map(np.concatenate, scores))))


def train(kept: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, l2: float = 1e-3) -> Model:
    """Fit on the nnPU risk; a row is the distinct buckets of a text, of those ``kept``. Without a positive or
    unlabelled row every text scores 0."""
    if not positive or not unlabelled or prior <= 0:
        return Model({}, -500.0)
    column = np.full(1 << BITS, -1, np.int64)
    column[kept] = np.arange(len(kept))
    n = len(kept)
    bias = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    w = _descend(_Rows(positive, column), _Rows(unlabelled, column), n, bias, lambda p, u: step(p, u, prior), l2 * prior)
    return Model({int(k): float(x) for k, x in zip(kept, w[:n])}, float(w[n]))


def _counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Rows of ``docs`` (text, positive) with each bucket: positives, all; and how many these are."""
    width = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, packed = np.zeros((2, width + 1), dtype=np.int64), _Packed()  # the last place counts the rows
        for b in batches:
            for text, positive in zip(b.column(0), b.column(1).to_pylist()):
                row = row_of(text.as_py(), packed)
                for k in range(1 + bool(positive)):
                    sums[k, row] += 1
                    sums[k, width] += 1
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(sums[1, at]), pa.array(sums[0, at])], ["bucket", "p", "u"])

    got = arrow_map(docs.select("text", "positive"), run, "bucket int, p long, u long").groupBy("bucket").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")).toArrow()  # at most 2^BITS + 1 rows
    sums = np.zeros((2, width + 1), dtype=np.int64)
    for k, name in enumerate("pu"):
        sums[k, got.column("bucket").to_numpy()] = got.column(name).to_numpy()
    return sums[0, :width], sums[1, :width], int(sums[0, width]), int(sums[1, width])


def _features(docs: DataFrame, kept: np.ndarray) -> DataFrame:
    known = np.zeros(1 << BITS, dtype=bool)
    known[kept] = True
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = _Packed()
        for b in batches:
            found = [row_of(t.as_py(), packed) for t in b.column(0)]
            rows = [r[shared.value[r]].astype("<i4").tobytes() for r in found]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), *b.columns[1:]], ["buckets", "positive", "place"])

    return arrow_map(docs.select("text", "positive", "place"), run, "buckets binary, positive boolean, place long")


def fit(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 12000, prior: float | None = None) -> Model:
    """Learn from rows whose crc32(doc_id) mod 3 is not 1. A document labelled more than once is
    toxic if any of its labels is; null labels and ids are ignored, and so is whether other documents are labelled.
    ``prior``: the toxic share of the documents; estimated where it is None."""
    learn = id_crc() % 3 != 1
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).where("toxic = 1")
    toxic = known.count()
    if not toxic:
        return train(np.zeros(0, np.int64), [], [], 0.0)
    ids = known.select("doc_id", F.lit(True).alias("positive"))
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & learn)
    marked = rows.join(F.broadcast(ids) if toxic <= BROADCAST_IDS else ids, "doc_id", "left")
    p, u, n, m = _counts(marked)
    if not n:
        return train(np.zeros(0, np.int64), [], [], 0.0)
    kept = select(p, u, n, m)
    order = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    here = rows.select("doc_id").distinct()
    chosen = ids.join(here, "doc_id", "left_semi").orderBy(order, "doc_id").limit(positives)
    others = here.orderBy(order, "doc_id").limit(unlabelled).withColumn("positive", F.lit(False))
    sample = F.broadcast(chosen.unionByName(others).withColumn("place", order))  # at most positives + unlabelled ids
    found: dict[bool, list[tuple[int, bytes]]] = {True: [], False: []}
    for batch in _features(rows.join(sample, "doc_id"), kept).toArrow().to_batches():
        for x, positive, place in zip(*(batch.column(c).to_pylist() for c in ("buckets", "positive", "place"))):
            found[positive].append((place, x))
    pos, unl = ([(place % FOLDS, np.frombuffer(x, dtype="<i4")) for place, x in sorted(found[k])] for k in (True, False))
    if prior is None:  # on less of the sample, as it takes a fit a fold
        prior = estimate_prior(kept, pos[:PRIOR_ROWS[0]], unl[:PRIOR_ROWS[1]], n / m)
    return train(kept, [r for _, r in pos], [r for _, r in unl], prior)


def toxicity(docs: DataFrame, labels: DataFrame, **how: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document.

    Null and empty texts are scored by the bias alone. A null doc_id is never learned from
    and not held out. Empty tables: no rows, or (no labels) every score 0.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **how))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.value.scorer()
        for b in batches:
            scores = np.array([score(t.as_py()) for t in b.column(2)], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(id_crc() % 3 == 1, F.lit(False)).alias("held_out")
    return arrow_map(docs.select(F.col("doc_id").cast("long"), held, F.col("text").cast("string")), run,
                     "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, **how: float) -> DataFrame:
    """The documents, all columns, that score under the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **how))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.value.scorer()
        for b in batches:
            yield b.filter(pc.less(pa.array([score(t.as_py()) for t in b.column(at)], pa.float64()), THRESHOLD))

    return arrow_map(docs, run, docs.schema)
