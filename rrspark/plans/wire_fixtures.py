"""Raw DNS responses derived from the fixture tables, for the decode-stage queries.

These stand in for what a resolver returns. Encoding runs per Arrow batch in ``mapInArrow``
(narrow, no shuffle), so the number of messages grows with the tables.
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..schema import HEADER_FLAGS, class_code, type_code
from ..session import ship_package

RESPONSE_SCHEMA = T.StructType([T.StructField("question", T.StringType()), T.StructField("wire", T.BinaryType())])
SECTION_CYCLE = ("answers", "additional", "authority")


def _rec(d: dict) -> dict:
    r = {k: v for k, v in d.items() if v is not None}
    r["type_code"] = type_code(d["type"])
    r["class_code"] = class_code(d.get("dclass") or "IN")
    return r


def record_messages(records: DataFrame, per_message: int = 6) -> DataFrame:
    """Pack consecutive records into messages of up to ``per_message`` records, spread over
    the answer, additional and authority sections in turn; the first record gives the
    question. Output ``question, wire``."""
    cols = records.columns

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            keys, wires = [], []
            for i in range(0, len(rows), per_message):
                chunk = [_rec(r) for r in rows[i:i + per_message]]
                sections = {s: [] for s in SECTION_CYCLE}
                for j, r in enumerate(chunk):
                    sections[SECTION_CYCLE[j % 3]].append(r)
                first = chunk[0]
                q = (first["name"], first["type_code"], first["class_code"])
                wires.append(encode_message(i & 0xFFFF, header_flags(["qr", "rd", "ra"]), [q], **sections))
                keys.append(f"{first['name']}\t{rows[i].get('dclass') or 'IN'}\t{first['type']}")
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(wires, pa.binary())],
                                             names=["question", "wire"])

    ship_package(records.sparkSession)
    return records.select(*cols).mapInArrow(run, RESPONSE_SCHEMA)


def record_responses(records: DataFrame) -> DataFrame:
    """One response per record: the record's own question and the record in ANSWER, owner
    name compressed. Output ``question, wire``; narrow (one Arrow pass per batch)."""
    cols = records.columns
    tcodes: dict[str, int] = {}
    ccodes: dict[str, int] = {}

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            keys, wires = [], []
            for i, vals in enumerate(zip(*[d[c] for c in cols])):
                rec = dict(zip(cols, vals))
                t = rec["type"]
                tc = tcodes.get(t)
                if tc is None:
                    tc = tcodes[t] = type_code(t)
                dc = rec.get("dclass") or "IN"
                cc = ccodes.get(dc)
                if cc is None:
                    cc = ccodes[dc] = class_code(dc)
                keys.append(f"{rec['name']}\t{dc}\t{t}")
                wires.append(record_response(i, rec, tc, cc))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(wires, pa.binary())],
                                             names=["question", "wire"])

    ship_package(records.sparkSession)
    return records.select(*cols).mapInArrow(run, RESPONSE_SCHEMA)


# --- encoding: test input only ---------------------------------------------------------------------

T_A, T_NS, T_CNAME, T_SOA, T_PTR, T_MX, T_TXT, T_AAAA, T_SRV = 1, 2, 5, 6, 12, 15, 16, 28, 33


def _name_labels(name: str) -> list[bytes]:
    if name in (".", ""):
        return []
    if "\\" not in name:
        return [x.encode() for x in (name[:-1] if name.endswith(".") else name).split(".")]
    labels, cur, i = [], bytearray(), 0
    while i < len(name):
        ch = name[i]
        if ch == "\\" and i + 1 < len(name):
            if name[i + 1:i + 4].isdigit() and len(name[i + 1:i + 4]) == 3:
                cur.append(int(name[i + 1:i + 4]))
                i += 4
                continue
            cur.extend(name[i + 1].encode())
            i += 2
            continue
        if ch == ".":
            labels.append(bytes(cur))
            cur = bytearray()
        else:
            cur.extend(ch.encode())
        i += 1
    if cur:
        labels.append(bytes(cur))
    return labels


class MessageWriter:
    """Builds one message with name compression (case-sensitive suffix match)."""

    def __init__(self) -> None:
        self.buf = bytearray(12)
        self.names: dict[tuple[bytes, ...], int] = {}

    def name(self, text: str, compress: bool = True) -> None:
        labels = _name_labels(text)
        if compress and labels:
            full = tuple(labels)
            if full in self.names:
                self.buf += struct.pack("!H", 0xC000 | self.names[full])
                return
        for i in range(len(labels)):
            suffix = tuple(labels[i:])
            if compress and suffix in self.names:
                self.buf += struct.pack("!H", 0xC000 | self.names[suffix])
                return
            if len(self.buf) < 0x3FFF:
                self.names.setdefault(suffix, len(self.buf))
            self.buf.append(len(labels[i]))
            self.buf += labels[i]
        self.buf.append(0)

    def question(self, name: str, rtype: int, rclass: int) -> None:
        self.name(name)
        self.buf += struct.pack("!HH", rtype, rclass)

    def record(self, rec: dict) -> None:
        rtype = rec["type_code"]
        self.name(rec["name"])
        self.buf += struct.pack("!HHI", rtype, rec.get("class_code", 1), int(rec.get("ttl") or 0))
        at = len(self.buf)
        self.buf += b"\0\0"
        if rtype == T_A:
            self.buf += bytes(int(x) for x in rec["addr"].split("."))
        elif rtype == T_AAAA:
            groups = rec["addrv6"].split(":")
            self.buf += struct.pack("!8H", *[int(g, 16) for g in groups])
        elif rtype in (T_NS, T_PTR):
            self.name(rec["target"])
        elif rtype == T_CNAME:
            self.name(rec["alias"])
        elif rtype == T_MX:
            self.buf += struct.pack("!H", int(rec.get("priority") or 0))
            self.name(rec["target"])
        elif rtype == T_SRV:
            self.buf += struct.pack("!HHH", int(rec.get("priority") or 0), int(rec.get("weight") or 0), int(rec.get("port") or 0))
            self.name(rec["target"], compress=False)
        elif rtype == T_SOA:
            self.name(rec.get("host") or ".")
            self.name(rec.get("admin") or ".")
            self.buf += struct.pack("!IIIII", *[int(rec.get(k) or 0) for k in ("serial", "refresh", "retry", "expire", "min")])
        elif rtype == T_TXT:
            raw = (rec.get("text") or "").encode()
            for i in range(0, max(len(raw), 1), 255):
                chunk = raw[i:i + 255]
                self.buf.append(len(chunk))
                self.buf += chunk
        else:
            rd = rec.get("rdata") or "\\# 0"
            parts = rd.split()
            self.buf += bytes.fromhex("".join(parts[2:])) if len(parts) > 2 else b""
        struct.pack_into("!H", self.buf, at, len(self.buf) - at - 2)

    def finish(self, mid: int, flags: int, counts: tuple[int, int, int, int]) -> bytes:
        struct.pack_into("!6H", self.buf, 0, mid, flags, *counts)
        return bytes(self.buf)


def encode_message(
    mid: int,
    flags: int,
    question: list[tuple[str, int, int]],
    answers: list[dict] = (),
    authority: list[dict] = (),
    additional: list[dict] = (),
) -> bytes:
    """Wire bytes of a message. Records are dicts with ``name, type_code, ttl`` and fields."""
    w = MessageWriter()
    for q in question:
        w.question(*q)
    for section in (answers, authority, additional):
        for r in section:
            w.record(r)
    return w.finish(mid, flags, (len(question), len(answers), len(authority), len(additional)))


def header_flags(names: list[str], rcode: int = 0, opcode: int = 0) -> int:
    bits = dict(HEADER_FLAGS)
    v = (opcode & 0xF) << 11 | (rcode & 0xF)
    for n in names:
        v |= 1 << bits[n]
    return v


# --- one-record responses (fast path for deriving raw inputs from record tables) -----------------

_HEADER = struct.Struct("!6H")

def name_wire(name: str) -> bytes:
    """Uncompressed wire form of a name (escapes honoured)."""
    return b"".join(bytes((len(x),)) + x for x in _name_labels(name)) + b"\0"


def _name_or_pointer(name: str, qname: str) -> bytes:
    return b"\xc0\x0c" if name == qname else name_wire(name)


def record_response(mid: int, rec: dict, tcode: int, ccode: int) -> bytes:
    """Response holding one record in ANSWER and its own question; the owner name (and any
    rdata name equal to it) is a pointer to the question name at offset 12."""
    name = rec["name"]
    g = rec.get
    if tcode == T_A:
        rd = bytes(int(x) for x in g("addr").split("."))
    elif tcode == T_AAAA:
        rd = struct.pack("!8H", *[int(x, 16) for x in g("addrv6").split(":")])
    elif tcode in (T_NS, T_PTR):
        rd = _name_or_pointer(g("target"), name)
    elif tcode == T_CNAME:
        rd = _name_or_pointer(g("alias"), name)
    elif tcode == T_MX:
        rd = struct.pack("!H", g("priority") or 0) + _name_or_pointer(g("target"), name)
    elif tcode == T_SRV:
        rd = struct.pack("!HHH", g("priority") or 0, g("weight") or 0, g("port") or 0) + name_wire(g("target"))
    elif tcode == T_SOA:
        rd = (name_wire(g("host") or ".") + name_wire(g("admin") or ".")
              + struct.pack("!IIIII", *[g(k) or 0 for k in ("serial", "refresh", "retry", "expire", "min")]))
    elif tcode == T_TXT:
        raw = (g("text") or "").encode()
        rd = b"".join(bytes((len(raw[i:i + 255]),)) + raw[i:i + 255] for i in range(0, max(len(raw), 1), 255))
    else:
        parts = (g("rdata") or "").split()
        rd = bytes.fromhex("".join(parts[2:])) if len(parts) > 2 else b""
    tc = struct.pack("!HH", tcode, ccode)
    return (_HEADER.pack(mid & 0xFFFF, 0x8180, 1, 1, 0, 0) + name_wire(name) + tc
            + b"\xc0\x0c" + tc + struct.pack("!IH", g("ttl") or 0, len(rd)) + rd)
