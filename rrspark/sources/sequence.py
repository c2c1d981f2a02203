"""Hadoop SequenceFiles as a data source: files split at their sync markers, Arrow batches in and out.

The format is the published one (version 6): a header with the two class names, the compression and a 16-byte marker; then
records, or compressed blocks of records, each after the marker. A task reads the part of a file between two places: it
looks for the first marker from its start on and stops at the first marker from its end on, so a file of any size is read by many
tasks and no block twice. Keys are ``Text``, values ``Text`` or ``BytesWritable``.
"""

from __future__ import annotations

import bz2
import fnmatch
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..session import arrow_filesystem, ship_package

TEXT, BYTES = "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable"
CODECS = "org.apache.hadoop.io.compress."
DECOMPRESS = {"DefaultCodec": zlib.decompress, "DeflateCodec": zlib.decompress,
              "GzipCodec": lambda x: zlib.decompress(x, 31), "BZip2Codec": bz2.decompress}
SYNC_ESCAPE = b"\xff\xff\xff\xff"
SPLIT_BYTES = 64 << 20
BATCH_ROWS, BATCH_BYTES = 10_000, 8 << 20
BLOCK_BYTES = 1 << 20


def vint(x: bytes, at: int) -> tuple[int, int]:
    """A variable-length integer at a place, and the place after it."""
    first = x[at] - 256 if x[at] > 127 else x[at]
    if first >= -112:
        return first, at + 1
    size = -112 - first if first >= -120 else -120 - first
    value = int.from_bytes(x[at + 1:at + 1 + size], "big")
    return (value if first >= -120 else ~value), at + 1 + size


def to_vint(n: int) -> bytes:
    if -112 <= n <= 127:
        return struct.pack("b", n)
    body = n if n >= 0 else ~n
    raw = body.to_bytes((body.bit_length() + 7) // 8, "big")
    return struct.pack("b", (-112 if n >= 0 else -120) - len(raw)) + raw


class Header:
    """What the start of a file says; ``end`` is where its records begin."""

    def __init__(self, file) -> None:
        x = file.read_at(min(file.size(), 1 << 16), 0)
        if x[:3] != b"SEQ" or x[3] != 6:
            raise ValueError("not a SequenceFile of version 6")
        at = 4

        def text() -> str:
            nonlocal at
            n, at = vint(x, at)
            at += n
            return x[at - n:at].decode()

        self.key, self.value = text(), text()
        self.compressed, self.blocks = bool(x[at]), bool(x[at + 1])
        at += 2
        self.codec = text().removeprefix(CODECS) if self.compressed else None
        if self.key != TEXT or self.value not in (TEXT, BYTES) or self.codec not in (None, *DECOMPRESS):
            raise ValueError(f"can't read {self.key}, {self.value}, {self.codec}")
        pairs = int.from_bytes(x[at:at + 4], "big")
        at += 4
        for _ in range(2 * pairs):
            text()
        self.sync, self.end = x[at:at + 16], at + 16


class Reader:
    """A file's bytes from a place on, read ahead in large pieces."""

    def __init__(self, file, at: int) -> None:
        self.file, self.size = file, file.size()
        self.first, self.held, self.used = at, b"", 0  # where what is held begins, and how much of it is used

    @property
    def at(self) -> int:
        return self.first + self.used

    def _more(self, need: int, keep: int) -> bool:
        """Read on, dropping what is used but for ``keep``; False at the end of the file."""
        kept = self.held[keep:]
        self.first, self.used = self.first + keep, self.used - keep
        read = min(max(need - len(kept) + self.used, 1 << 20), self.size - self.first - len(kept))
        self.held = kept + self.file.read_at(read, self.first + len(kept)) if read > 0 else kept
        return read > 0

    def take(self, n: int) -> bytes:
        if len(self.held) - self.used < n:
            self._more(n, self.used)
            if len(self.held) - self.used < n:
                raise EOFError("the file ends inside a record")
        self.used += n
        return self.held[self.used - n:self.used]

    def vint(self) -> int:
        first = self.take(1)
        size = first[0] - 256 if first[0] > 127 else first[0]
        more = 0 if size >= -112 else (-112 - size if size >= -120 else -120 - size)
        return vint(first + self.take(more), 0)[0]

    def skip_to(self, marker: bytes) -> bool:
        """To the next marker (with its escape); False if there is none."""
        while (found := self.held.find(marker, self.used)) < 0:
            self.used = max(self.used, len(self.held) - len(marker) + 1)
            if not self._more(0, self.used):
                return False
        self.used = found
        return True


def _bare(x: bytes, kind: str) -> bytes:
    """The content of a serialised Text or BytesWritable."""
    if kind == BYTES:
        return x[4:]
    return x[vint(x, 0)[1]:]


def records(file, start: int, end: int) -> Iterator[tuple[bytes, bytes]]:
    """Keys and values of the part of a file between two places."""
    head = Header(file)
    r = Reader(file, max(start, head.end))
    marker = SYNC_ESCAPE + head.sync
    if start > head.end and not r.skip_to(marker):
        return
    inflate = DECOMPRESS.get(head.codec)
    while r.at < r.size:
        size = r.take(4)
        if size == SYNC_ESCAPE:
            if r.at - 4 >= end:
                return
            if r.take(16) != head.sync:
                raise ValueError("a marker that isn't this file's")
            if head.blocks:
                n = r.vint()
                key_sizes, keys, value_sizes, values = (inflate(r.take(r.vint())) for _ in range(4))
                ks, k, vs, v = 0, 0, 0, 0
                for _ in range(n):
                    a, ks = vint(key_sizes, ks)
                    b, vs = vint(value_sizes, vs)
                    yield _bare(keys[k:k + a], head.key), _bare(values[v:v + b], head.value)
                    k, v = k + a, v + b
            continue
        whole, key = int.from_bytes(size, "big"), int.from_bytes(r.take(4), "big")
        x = r.take(whole)
        value = inflate(x[key:]) if head.compressed else x[key:]
        yield _bare(x[:key], head.key), _bare(value, head.value)


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int

    def __post_init__(self) -> None:
        self.value = (self.path, self.start)


def files_of(path: str) -> list[tuple[str, int]]:
    """Files and sizes: a file, those of a folder, or of a pattern in the last parts of the path; hidden ones left out."""
    from pyarrow import fs as pafs

    fs, at = arrow_filesystem(path)
    fixed, wild = at, []
    while any(c in fixed for c in "*?["):
        fixed, _, last = fixed.rpartition("/")
        wild.insert(0, last)
    shown = lambda i: not i.base_name.startswith(("_", "."))
    found = [fs.get_file_info(fixed)]
    for pattern in wild:
        found = [i for d in found if d.type == pafs.FileType.Directory for i in fs.get_file_info(pafs.FileSelector(d.path))
                 if shown(i) and fnmatch.fnmatchcase(i.base_name, pattern)]
    inside = [i for d in found if d.type == pafs.FileType.Directory for i in fs.get_file_info(pafs.FileSelector(d.path)) if shown(i)]
    files = [i for i in [*found, *inside] if i.type == pafs.FileType.File]
    if not files and not wild and found[0].type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    return sorted((i.path, i.size) for i in files)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], binary: bool) -> None:
        self.path, self.binary = options["path"], binary
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Part]:
        return [Part(f, at, min(size, at + self.split)) for f, size in files_of(self.path) for at in range(0, size, self.split)]

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        kind = pa.binary() if self.binary else pa.string()
        if part is None:
            return
        keys: list[str] = []
        values: list = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, kind)], ["key", "value"])

        with arrow_filesystem(self.path)[0].open_input_file(part.path) as f:
            for k, v in records(f, part.start, part.end):
                keys.append(k.decode("utf-8", "replace"))
                values.append(v if self.binary else v.decode("utf-8", "replace"))
                held += len(k) + len(v)
                if len(keys) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield batch()
                    keys, values, held = [], [], 0
        if keys:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    name: str


def block(keys: list[bytes], values: list[bytes], sync: bytes) -> bytes:
    """A compressed block: marker, number of records, key lengths, keys, value lengths, values."""
    out = [SYNC_ESCAPE, sync, to_vint(len(keys))]
    for part in (b"".join(to_vint(len(k)) for k in keys), b"".join(keys), b"".join(to_vint(len(v)) for v in values), b"".join(values)):
        packed = zlib.compress(part, 6)
        out += [to_vint(len(packed)), packed]
    return b"".join(out)


class _Writer(DataSourceArrowWriter):
    """Every task writes a file to the staging folder; commit moves those of the tasks that count."""

    def __init__(self, options: dict[str, str], binary: bool) -> None:
        self.path, self.binary, self.job = options["path"], binary, options["job"]

    def _staging(self):
        fs, at = arrow_filesystem(self.path)
        return fs, at, f"{at}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        name, sync = f"part-{uuid.uuid4().hex}", uuid.uuid4().bytes
        text = lambda s: to_vint(len(s)) + s
        head = [b"SEQ\x06", text(TEXT.encode()), text((BYTES if self.binary else TEXT).encode()), b"\x01\x01",
                text(f"{CODECS}DefaultCodec".encode()), b"\x00\x00\x00\x00", sync]
        with fs.open_output_stream(f"{staging}/{name}") as f:
            f.write(b"".join(head))
            keys: list[bytes] = []
            values: list[bytes] = []
            held = 0
            for b in iterator:
                for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    raw = (v or b"") if self.binary else (v or "").encode()
                    keys.append(text((k or "").encode()))
                    values.append(struct.pack(">i", len(raw)) + raw if self.binary else text(raw))
                    held += len(keys[-1]) + len(values[-1])
                    if held >= BLOCK_BYTES:
                        f.write(block(keys, values, sync))
                        keys, values, held = [], [], 0
            if keys:
                f.write(block(keys, values, sync))
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, at, staging = self._staging()
        for m in messages:
            if m is not None:
                fs.move(f"{staging}/{m.name}", f"{at}/{m.name}")
        fs.create_dir(staging, recursive=True)
        fs.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        fs.delete_dir(staging)


class _Sequence(DataSource):
    binary = True

    def schema(self) -> str:
        return f"key string, value {'binary' if self.binary else 'string'}"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), self.binary)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), self.binary)


class BinarySequence(_Sequence):
    @classmethod
    def name(cls) -> str:
        return "rrspark_sequence"


class TextSequence(_Sequence):
    binary = False

    @classmethod
    def name(cls) -> str:
        return "rrspark_text_sequence"


def _format(spark: SparkSession, binary: bool) -> str:
    ship_package(spark)
    source = BinarySequence if binary else TextSequence
    spark.dataSource.register(source)
    return source.name()


def read_sequence(spark: SparkSession, path: str, binary: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``key, value`` of SequenceFiles of (Text, BytesWritable), or (Text, Text) unless ``binary``."""
    return spark.read.format(_format(spark, binary)).option("splitBytes", str(split_bytes)).load(path)


def write_sequence(df: DataFrame, path: str, binary: bool = True) -> None:
    """``df``'s two columns added to the folder ``path`` as block-compressed SequenceFiles, all or none of them."""
    df.write.format(_format(df.sparkSession, binary)).mode("append").option("job", uuid.uuid4().hex).save(path)
