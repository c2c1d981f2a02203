"""Decode raw responses into records (P6-P10, A6).

``mapInArrow`` walks each message (``functions.wire``: sections, names, bytes) and column expressions
(``functions.rdata``) make the record fields of them, so a field nobody asks for costs nothing. Records
come from the ANSWER, then ADDITIONAL, then AUTHORITY section. The stage is narrow; deduplication
afterwards is one hash aggregate. A message that cannot be parsed yields no records (all
or nothing per message) and is counted as a parse failure.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.rdata import RAW_RECORD, flag_names, opcode_text, rcode_text, record_fields, record_struct
from ..functions.wire import WireError, walk
from ..schema import MESSAGE_SCHEMA, RR_FIELDS, RR_SCHEMA
from ..session import ship_package

FLUSH_RECORDS = 5000
FLUSH_BYTES = 16 << 20
_RAW_ARROW = [("name", pa.string()), ("tcode", pa.int32()), ("ccode", pa.int32()), ("ttl", pa.int64()), ("fixed", pa.binary()),
              ("names", pa.list_(pa.string())), ("strings", pa.list_(pa.binary()))]
_RAW_COLUMNS = RAW_RECORD[len("struct<"):-1].replace(":", " ")


def _walked(wire: bytes | None) -> tuple[tuple | None, str | None]:
    """(walked message, error)."""
    try:
        if wire is None:
            raise WireError("no message")
        return walk(wire), None
    except (WireError, ValueError, IndexError, struct.error) as e:  # counted, not raised
        return None, str(e) or type(e).__name__


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Raw records of each message, or one row with its error; bounded output batches."""
    names = [n for n, _ in _RAW_ARROW] + ["__error"]
    types = [t for _, t in _RAW_ARROW] + [pa.string()]
    rows: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for wire in batch.column(0):
            wire = wire.as_py()
            found, error = _walked(wire)
            if found is None:
                rows.append((None,) * len(_RAW_ARROW) + (error,))
            else:
                _, answers, authority, additional = found[2]
                for section in (answers, additional, authority):
                    rows += [(*r, None) for r in section]
            size += len(wire or b"")
            if len(rows) >= FLUSH_RECORDS or size >= FLUSH_BYTES:
                yield flush()
                rows.clear()
                size = 0
    yield flush()


def decode_with_errors(df: DataFrame, wire_col: str = "wire", txt_mode: str = "record",
                       fields: list[str] | None = None) -> DataFrame:
    """Every record of every message, plus one row with ``__error`` set per bad message."""
    if txt_mode not in ("record", "rdata"):
        raise ValueError("txt_mode must be 'record' or 'rdata'")
    ship_package(df.sparkSession)
    raw = df.select(wire_col).mapInArrow(_record_batches, f"{_RAW_COLUMNS.replace(',', ', ')}, __error string")
    made = record_fields(F.col, txt_mode)
    kinds = dict(RR_FIELDS)
    return raw.select(*[made[n].cast(kinds[n]).alias(n) for n in fields or RR_SCHEMA.fieldNames()], "__error")


def decode_responses(
    df: DataFrame,
    ignore_ttl: bool = True,
    txt_mode: str = "record",
    wire_col: str = "wire",
    observation: Observation | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Raw responses (``wire`` binary) -> records with the fixed record schema, or only ``fields``.

    ``ignore_ttl`` drops ``ttl`` (default, as the reference's parse job). ``txt_mode="record"``
    keeps TXT ``text`` as the whole presentation line (TTL included); ``"rdata"`` keeps only
    the quoted strings. Pass an ``Observation`` to collect ``parse_failures`` and ``records``
    in the same pass."""
    out = decode_with_errors(df, wire_col, txt_mode, fields)
    if observation is not None:
        err = F.col("__error").isNotNull()
        out = out.observe(observation, F.count_if(err).alias("parse_failures"), F.count_if(~err).alias("records"))
    out = out.where(F.col("__error").isNull()).drop("__error")
    return out.drop("ttl") if ignore_ttl else out


def parse_failures(df: DataFrame, wire_col: str = "wire") -> DataFrame:
    """One row: messages that failed to parse, records decoded from the others, and messages with the
    TC bit of which only the records before the break were kept. Per message only its counts
    leave Python."""

    def run(batches):
        for batch in batches:
            counts = []
            for wire in batch.column(0).to_pylist():
                found, _ = _walked(wire)
                kept = sum(map(len, found[2][1:])) if found else 0
                counts.append((int(found is None), kept, int(bool(found) and kept < sum(struct.unpack_from("!3H", wire, 6)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 3,
                                             names=["failed", "records", "cut"])

    ship_package(df.sparkSession)
    d = df.select(wire_col).mapInArrow(run, "failed long, records long, cut long")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return d.agg(total("failed").alias("parse_failures"), total("records").alias("records"), total("cut").alias("truncated_messages"))


# --- message view -------------------------------------------------------------------------------

SECTIONS = ("question", "answers", "authority", "additional")  # wire order
FLUSH_MESSAGES = 500


def _message_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw = pa.struct(_RAW_ARROW)
    schema = pa.schema([("question_key", pa.string()), ("id", pa.int32()), ("flags", pa.int32()),
                        *[(s, pa.list_(raw)) for s in SECTIONS], ("error", pa.string())])
    names = [n for n, _ in _RAW_ARROW]
    for whole in batches:
        for at in range(0, len(whole), FLUSH_MESSAGES):
            rows = []
            batch = whole.slice(at, FLUSH_MESSAGES)
            for key, wire in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, error = _walked(wire)
                row = {"question_key": key, "error": error}
                if found is not None:
                    row["id"], row["flags"], sections = found
                    # an empty section is left out
                    row |= {s: [dict(zip(names, r)) for r in rs] or None for s, rs in zip(SECTIONS, sections)}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _record_of(section: str):
    return lambda r: record_struct(r, question=section == "question")


def decode_messages(df: DataFrame, key_col: str | None = "question", wire_col: str = "wire") -> DataFrame:
    """Whole-message view: ``question_key, opcode, rcode, flags, id, question, answers,
    additional, authority, error``; each section is an array of records (TTL included) or
    NULL when empty; ``error`` is set (and the rest NULL) for a message that does not parse."""
    ship_package(df.sparkSession)
    key = F.col(key_col) if key_col and key_col in df.columns else F.lit(None).cast("string")
    raw = df.select(key.cast("string").alias("question_key"), wire_col).mapInArrow(
        _message_batches, "question_key string, id int, flags int, "
        + ", ".join(f"{s} array<{RAW_RECORD}>" for s in SECTIONS) + ", error string")
    flags = F.col("flags")
    good = lambda c: F.when(F.col("error").isNull(), c)
    sections = {s: F.transform(s, _record_of(s)) for s in SECTIONS}
    return raw.select(
        "question_key", good(opcode_text(flags)).alias("opcode"), good(rcode_text(flags)).alias("rcode"),
        good(flag_names(flags)).alias("flags"), "id",
        *[sections[s].alias(s) for s in ("question", "answers", "additional", "authority")], "error")


def section_size(c: str | Column) -> Column:
    """Number of records in a section column (0 when the section is absent)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def response_text(messages: DataFrame) -> DataFrame:
    """``key: message`` text per response (the dump tool's output), the message as JSON."""
    body = F.to_json(F.struct(*[F.col(f.name) for f in MESSAGE_SCHEMA.fields]))
    return messages.where(F.col("error").isNull()).select(
        F.concat(F.coalesce(F.col("question_key"), F.lit("")), F.lit(": "), body).alias("text")
    )
