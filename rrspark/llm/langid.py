"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased per code point through a lookup table, other than letters become blanks and
runs of blanks count once. Counts of hashed 2- and 3-grams come from every training
text: each task counts per language, Spark adds the counts up. The log-probability
matrix (buckets x languages, at most MATRIX_BYTES: the more languages, the fewer buckets) is
broadcast; a text's scores are the product of its sparse n-gram row and that matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, id_crc

ORDERS = (2, 3)
MAX_BITS = 16
MATRIX_BYTES = 64 << 20
SMOOTHING = 0.5
CHUNK = 1 << 18
MIN_SCORE = 0.5
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_LUT_SIZE = 0x600


def _fold(code: int) -> int:
    c = chr(code)
    low = c.lower()
    return ord(low) if c.isalpha() and len(low) == 1 else 32 if not c.isalpha() else code


_LUT = np.array([_fold(i) for i in range(_LUT_SIZE)], dtype=np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LETTER.search(text))


def codes_of(text: str) -> np.ndarray:
    """Folded code points, a blank before and after, blanks never doubled."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    low = _LUT[np.minimum(raw, _LUT_SIZE - 1)]
    folded = np.concatenate(([np.uint32(32)], np.where(raw < _LUT_SIZE, low, raw), [np.uint32(32)]))
    return folded[np.append(True, (folded[1:] != 32) | (folded[:-1] != 32))].astype(np.uint32)


def grams_of(text: str, bits: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the whole text, in bounded pieces."""
    codes = codes_of(text)
    for at in range(0, len(codes), CHUNK):
        part = codes[at:at + CHUNK + max(ORDERS) - 1]
        for n in ORDERS:
            size = min(CHUNK, len(part) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, 0x9E3779B1 * n & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h = (h ^ part[i:i + size]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            yield (h & np.uint32((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages
    bits: int

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0
        total = self.log_prior.copy()
        for grams in grams_of(text, self.bits):
            total += self.log_prob[grams].sum(0, dtype=np.float64)
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(docs: DataFrame) -> Model:
    """Counts over all training rows: non-null text and lang, crc32(doc_id) mod 4 not 2. Languages
    are ordered by name, so ties go to the first."""
    learn = docs.where((id_crc() % 4 != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string"), F.col("text").cast("string"))
    priors = {r[0]: r[1] for r in learn.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(priors)
    if not langs:
        return Model([], np.zeros(0), np.zeros((0, 0)), 0)
    bits = min(MAX_BITS, (MATRIX_BYTES // (4 * len(langs))).bit_length() - 1)
    if bits < 8:
        raise ValueError(f"{len(langs)} languages don't fit a matrix of {MATRIX_BYTES} bytes")
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(index), 1 << bits), dtype=np.int64)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                row = counts[index[lang]]
                for grams in grams_of(text.as_py(), bits):
                    row += np.bincount(grams, minlength=1 << bits) if len(grams) > 4096 else 0
                    if len(grams) <= 4096:
                        np.add.at(row, grams, 1)
        for i, row in enumerate(counts):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(row[at])],
                ["lang", "bucket", "n"])

    summed = arrow_map(learn, run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = summed.toArrow()  # at most languages x buckets rows
    counts = np.zeros((1 << bits, len(langs)))
    counts[got.column("bucket").to_numpy(), got.column("lang").to_numpy()] = got.column("n").to_numpy()
    counts += SMOOTHING
    prior = np.array([priors[x] for x in langs], dtype=float)
    return Model(langs, np.log(prior / prior.sum()), np.log(counts / counts.sum(0)).astype(np.float32), bits)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document; the score is the posterior of the
    predicted language.

    Null, empty and letterless texts give ``und`` with score 0, as does a table with nothing to
    learn from. A null doc_id is neither learned from nor held out.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.value.predict(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(id_crc() % 4 == 2, F.lit(False)).alias("held_out")
    return arrow_map(docs.select(F.col("doc_id").cast("long"), held, F.col("text").cast("string")), run,
                     "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, all columns, whose language is told with a posterior of ``min_score`` or more."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.value.predict(t.as_py()) for t in b.column(at)]
            yield b.filter(pa.array([x != UNDETERMINED and s >= min_score for x, s in found], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
