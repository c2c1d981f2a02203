"""Sequence packing: bounded-space online best-fit.

A packer holds at most ``open_bins`` open bins. A bitset has bit f set when some open bin has f free
places, so the best-fitting bin is the lowest set bit at or above the piece's length. When
a new bin would exceed the bound, the fullest open bin (lowest set bit) closes.

Every task packs its own rows in the order they come. The pieces of bins that are filled to less than
``TIGHT`` then come together from all tasks, PIECES_PER_TASK a task, and are packed once more; the other
bins stay as they are.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, scalar_int, stage

CAPACITY = 1024
OPEN_BINS = 1024
TIGHT = 0.97
PIECES_PER_TASK = 200_000
END_ID = 2
CACHE_WORDS, KEPT_CHARS = 400_000, 64

# Texts of these code points only: there the pattern below splits as the tokenizer's own does.
_PLAIN = re.compile("[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]*")
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_WORD = re.compile(
    rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where it is
    printable Latin-1, else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Tokens(dict):
    """Ids of whole texts as little-endian unsigned 32-bit bytes, closed by END_ID.

    The words that the tokenizer's pattern yields are encoded one by one by the tokenizer's model
    and kept in this bounded cache; a text with code points beyond _PLAIN goes to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.end = np.array([END_ID], dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        letters = word.encode().decode("latin-1").translate(self.letters)
        ids = struct.pack(f"<{len(t)}I", *[x.id for x in t]) if (t := self.model.tokenize(letters)) else b""
        if len(word) <= KEPT_CHARS:  # longer ones would fill the memory
            self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.__getitem__, _WORD.findall(text))) + self.end
        return self.whole(text) + self.end


@lru_cache(maxsize=1)  # kept by a worker for its next tasks
def tokens_for(path: str) -> Tokens:
    return Tokens(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's ids (little-endian unsigned 32-bit)
    and END_ID, cut into pieces of ``capacity`` ids where there are more; the first piece takes the
    remainder. Null texts count as empty: END_ID alone."""
    path = tokenizer or default_tokenizer()
    step = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_for(path)
        for whole in batches:
            for at in range(0, len(whole), step):
                b = whole.slice(at, step)
                doc, piece, start, length, ids = [], [], [], [], []
                for d, x in zip(b.column(0).to_pylist(), map(tokens.ids, b.column(1).to_pylist())):
                    n = len(x) // 4
                    lo, hi, i = 0, n % capacity or min(n, capacity), 0
                    while lo < n:
                        doc.append(d)
                        piece.append(i)
                        start.append(lo)
                        length.append(hi - lo)
                        ids.append(x[lo * 4:hi * 4])
                        lo, hi, i = hi, hi + capacity, i + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])
        tokens.clear()  # a worker that goes on to other stages keeps the tokenizer, not its words

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, piece int, start long, length long, ids binary")


class Packer:
    """Bounded-space best-fit; ``place`` gives (bin, offset) of a piece of 1 to ``capacity`` places."""

    def __init__(self, capacity: int, open_bins: int, first_bin: int = 0) -> None:
        self.capacity, self.open_bins, self.next = capacity, open_bins, first_bin
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length << length
        if fits:
            free = (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            bin_, free = self.next, self.capacity
            self.next += 1
        if free > length:
            self.free[free - length].append(bin_)
            self.bits |= 1 << (free - length)
            self.open += 1
        return bin_, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.free[free]
        bin_ = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_


def _packed(rows: DataFrame, column: str, names: tuple[str, str], capacity: int, open_bins: int) -> DataFrame:
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for b in batches:
            found = [packer.place(n) for n in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x for x, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())],
                [*b.schema.names, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"{n} long" for n in names)])
    return arrow_map(rows, run, schema)


def pack(rows: DataFrame, length: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """``rows`` (all columns; ``length`` is 1 to ``capacity``) with ``sequence_id`` and ``offset``: no
    sequence holds more than ``capacity``, offsets are gapless from 0.

    An empty table gives no rows; equal rows are separate pieces. Columns that clash with the two new
    ones are replaced.
    """
    rows = rows.drop("sequence_id", "offset")
    kept = rows.select(F.struct("*").alias("row"), F.col(length).cast("long").alias("n"))
    first = stage(_packed(kept, "n", ("bin", "at"), capacity, open_bins), "packing-first")
    loose = first.groupBy("bin").agg(F.sum("n").alias("fill"), F.count("*").alias("pieces")).where(
        F.col("fill") < TIGHT * capacity)
    loose = stage(loose, "packing-loose")
    tasks = scalar_int(loose.agg(F.sum("pieces")).first()[0]) // PIECES_PER_TASK + 1
    order = F.xxhash64("bin", "at")
    again = first.join(loose, "bin", "left_semi").repartition(tasks, order).sortWithinPartitions(order)
    again = _packed(again.select("row", "n"), "n", ("bin", "at"), capacity, open_bins)
    # bins packed again get negative numbers
    both = first.join(loose, "bin", "left_anti").select("row", "bin", "at").unionByName(
        again.select("row", (-1 - F.col("bin")).alias("bin"), "at"))
    return both.select("row.*", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))


def packed_digest(docs: DataFrame) -> DataFrame:
    cut = pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(cut)
