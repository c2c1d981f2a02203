"""Document fingerprints: a Merkle tree over sections, paragraphs and short spans.

Sections are divided by blank lines, paragraphs by line ends, and a paragraph is cut into spans after
sentence ends; where none comes, after the first place from ``LEAST`` code points on at which a hash of the last
``WINDOW`` code points says so, at ``SPAN`` code points at the latest. So an edit moves the cuts near it alone. Every node's digest covers its children's digests, the
children cover the text without gaps: equal roots mean equal texts, and where two trees differ,
the branches with differing digests locate the edit (``changed``).

A fingerprint is text: the root (32 hex digits), then per section ``/`` and its digest (8), per
paragraph ``,`` and its digest (8), ``:`` and 8 digits per span. Likeness is the Dice
coefficient of two fingerprints' spans.
"""

from __future__ import annotations

import difflib
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, parallelism

SPAN, LEAST, WINDOW, ONE_IN = 64, 16, 4, 16
DIGITS = 8  # of a span's digest in a fingerprint: 32 bits
_PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+")
# over the classes of the code points: s sentence end, w blank, c place to cut after, x other
_SPANS = re.compile(rf"(?:[wcx]{{1,{LEAST - 1}}}[wx]{{0,{SPAN - LEAST}}}c?s*|s+)w*")
_CLASS = np.full(0x3002, ord("x"), dtype=np.uint8)
_CLASS[[i for i in range(len(_CLASS)) if chr(i).isspace()]] = ord("w")
_CLASS[[ord(c) for c in ".!?"]] = ord("s")


def _classes(text: str) -> str:
    """One letter per code point, see _SPANS."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = _CLASS[np.minimum(codes, len(_CLASS) - 1)]
    if len(codes) >= WINDOW:
        h = np.zeros(len(codes) - WINDOW + 1, dtype=np.uint32)
        for i in range(WINDOW):
            h = (h ^ codes[i:len(codes) - WINDOW + 1 + i]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        at = np.flatnonzero(h % np.uint32(ONE_IN) == 0) + WINDOW - 1
        out[at[out[at] == ord("x")]] = ord("c")
    return out.tobytes().decode("ascii")


def spans(text: str, classes: str, start: int, end: int) -> list[str]:
    """The spans of a paragraph, text[start:end]. A cut depends on code points of its own span alone, as
    LEAST is over WINDOW."""
    return [text[m.start():m.end()] for m in _SPANS.finditer(classes, start, end)]


def _node(children: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(children), digest_size=16).digest()


def _sections(text: str) -> list[str]:
    if "\n" not in text:
        return [text] if text else []
    cuts = [m.end() for m in re.finditer(r"\n[^\S\n]*\n\s*", text)]
    return [s for s in (text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])) if s]


def fingerprint(text: str | None) -> str:
    leaf = xxhash.xxh3_128_digest
    sections, shown = [], []
    text, at = text or "", 0
    classes = _classes(text)
    for section in _sections(text):
        paragraphs, parts = [], []
        for paragraph in _PARAGRAPH.findall(section):
            leaves = [leaf(s.encode("utf-8", "surrogatepass")) for s in spans(text, classes, at, at + len(paragraph))]
            at += len(paragraph)
            digest = _node(leaves)
            paragraphs.append(digest)
            parts.append("," + digest[:4].hex() + ":" + b"".join([s[:DIGITS // 2] for s in leaves]).hex())
        digest = _node(paragraphs)
        sections.append(digest)
        shown.append("/" + digest[:4].hex() + "".join(parts))
    return _node(sections).hex() + "".join(shown)


def _tree(fp: str) -> list[tuple[str, list[str]]]:
    """Sections of a fingerprint: (digest, paragraphs as shown)."""
    return [(s[:8], s[9:].split(",") if len(s) > 8 else []) for s in fp[33:].split("/")] if len(fp) > 32 else []


def spans_of(fp: str) -> Counter:
    shown = [p.partition(":")[2] for _, paragraphs in _tree(fp) for p in paragraphs]
    return Counter(x[i:i + DIGITS] for x in shown for i in range(0, len(x), DIGITS))


def _likeness(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 1.0


def likeness(a: str, b: str) -> float:
    """0 to 1; equal roots give 1."""
    return 1.0 if a[:32] == b[:32] else _likeness(spans_of(a), spans_of(b))


def changed(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Branches in which two fingerprints differ: (section and paragraph in a, the same in b), -1 where
    one side has none. Equal sections are passed over whole."""
    if a[:32] == b[:32]:
        return []
    ta, tb = _tree(a), _tree(b)
    out = []
    for tag, i, j, k, m in difflib.SequenceMatcher(None, [s for s, _ in ta], [s for s, _ in tb], False).get_opcodes():
        if tag == "equal":
            continue
        pa_ = [(s, n, p) for s in range(i, j) for n, p in enumerate(ta[s][1])]
        pb_ = [(s, n, p) for s in range(k, m) for n, p in enumerate(tb[s][1])]
        inner = difflib.SequenceMatcher(None, [p for *_, p in pa_], [p for *_, p in pb_], False)
        for tag2, p, q, r, t in inner.get_opcodes():
            if tag2 != "equal":
                for n in range(max(q - p, t - r)):
                    left = pa_[p + n][:2] if p + n < q else (-1, -1)
                    right = pb_[r + n][:2] if r + n < t else (-1, -1)
                    out.append((*left, *right))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` per row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t.as_py()) for t in b.column(1)], pa.string())],
                ["doc_id", "fingerprint"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, fingerprint string")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``bucket, ahead, doc_id, text``, each partition one bucket of the doc_id order, sorted; the
    rows after a bucket's own (``ahead``) are the first of the next bucket, after the last bucket
    the first of all. One exchange."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = parts or parallelism(docs.sparkSession)
    cuts = F.percentile_approx("doc_id", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 10_000) \
        if parts > 1 else F.array().cast("array<bigint>")
    row = rows.agg(F.min("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1)), cuts).first()
    smallest, nulls = row[0], row[1]
    starts = sorted(set(row[2] or []) - ({smallest} if not nulls else set()))
    doc = F.col("doc_id")
    bucket = F.lit(0)
    if starts:
        known = F.lit(starts).cast("array<bigint>")
        # the number of starts at or below the id
        own = F.array_size(F.filter(known, lambda s: s <= doc))
        bucket = F.coalesce(own, F.lit(0))
    first = doc.isNull() if nulls else doc == F.lit(smallest)
    ahead = F.coalesce(F.array_contains(F.lit(starts).cast("array<bigint>"), doc), F.lit(False)) if starts else F.lit(False)
    copies = F.filter(F.array(
        F.struct(bucket.cast("int").alias("bucket"), F.lit(0).alias("ahead")),
        F.when(ahead, F.struct((bucket - 1).cast("int").alias("bucket"), F.lit(1).alias("ahead"))),
        F.when(F.coalesce(first, F.lit(False)), F.struct(F.lit(len(starts)).alias("bucket"), F.lit(1).alias("ahead")))),
        lambda c: c.isNotNull())
    spread = rows.select("doc_id", "text", F.explode(copies).alias("c")).select("c.bucket", "c.ahead", "doc_id", "text")
    return spread.repartitionById(len(starts) + 1, F.col("bucket")).sortWithinPartitions(
        "ahead", "doc_id", "text")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per document its fingerprint, its edited text's, and the likeness to that and to the next
    document's.

    Null texts count as empty and null ids as smallest; rows with equal ids follow each other in
    the order of their texts. The only document of a table is its own next one. An empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            out = []
            for ahead, doc, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                text = text.as_py()
                fp = fingerprint(text)
                spans = spans_of(fp)
                if held is not None:
                    own_doc, own, own_fp, own_spans = held
                    changed_text = edited(own, text)
                    changed_fp = fingerprint(changed_text)
                    out.append((
                        own_doc, len(own), hashlib.sha256(changed_text.encode("utf-8", "surrogatepass")).hexdigest(),
                        own_fp, changed_fp,
                        1.0 if own_fp[:32] == changed_fp[:32] else _likeness(own_spans, spans_of(changed_fp)),
                        1.0 if own_fp[:32] == fp[:32] else _likeness(own_spans, spans)))
                held = (doc, text, fp, spans) if not ahead else None
                if ahead:
                    break
            yield pa.RecordBatch.from_pylist([dict(zip(fields.names, r)) for r in out], schema=fields)
            if ahead:
                break
        if held is not None:
            raise ValueError("a bucket lacks the row that follows it")
        for _ in batches:
            pass

    fields = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return arrow_map(
        with_next(docs, parts).select("bucket", "ahead", "doc_id", "text"), run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
