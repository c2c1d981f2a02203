"""Cross-tokenizer alignment: galloping intersection of two tokenizers' byte ends.

Tokenizer A is a byte-level BPE over a blank and the text, B a SentencePiece BPE over the text, which
puts that blank itself, so both spell the same bytes. Their ends are two ascending lists; the shorter drives
an exponential and then a binary search into the longer. Ends that both have cut the tokens into groups, and
the rank an end takes in the other list says where its overlaps begin and stop.

Texts are tokenised in parts of about PART characters, cut before a blank between two other characters: both tokenizers have an
end there, so parts are aligned on their own and a text of any length takes bounded memory (but for a
stretch without such a blank, which is one part). One pass over the texts stages, for each row, its digest, its
distinct linked id pairs and how often it links them.

A second pass over these pairs counts the documents of each. Counts of frequent pairs, up to HEAD_PAIRS of them,
are sent to the tasks, which look the rows' pairs up in place; pairs rarer than those are joined by their key
in Spark, where none can be hot any more. Nothing is dropped: which way a pair goes only depends on its count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, stage
from rrspark.llm.packing import default_tokenizer, tokens_for
from rrspark.llm.sentencepiece_dropout import default_model, pieces_for

PART = 1 << 16
BATCH_CHARS, BATCH_ROWS = 1 << 18, 2048
STRIDE = 64
HEAD_PAIRS = 2_000_000
CHUNK_PAIRS = 1 << 21
_CUT = re.compile(r"(?<=\S)(?= \S)")


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _gallop(values: np.ndarray, cursor: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """The first place in ``longer`` at or after each cursor that isn't below the value: steps of 1, 2, 4, ... from
    the cursor till one is passed, then a binary search of the last step. All values search at once."""
    last = len(longer) - 1
    low, step = cursor.copy(), 1
    high = np.minimum(low, last + 1)
    going = np.flatnonzero((high <= last) & (longer[np.minimum(high, last)] < values))
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, last + 1)
        step *= 2
        at = high[going]
        going = going[(at <= last) & (longer[np.minimum(at, last)] < values[going])]
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        below = longer[middle] < values[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def gallop(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rank of every value of ``shorter`` in ``longer`` (number of smaller values), both ascending: every
    STRIDE-th value gallops from the start, the others from where the one before them came out."""
    heads = _gallop(shorter[::STRIDE], np.zeros(-(-len(shorter) // STRIDE), np.int64), longer)
    return _gallop(shorter, np.repeat(heads, STRIDE)[:len(shorter)], longer)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two ascending lists of ends with the same last value: the places in A and in B of the common ends, and
    the places in A and in B of the tokens of each overlap, in order."""
    flip = len(ends_a) > len(ends_b)
    shorter, longer = (ends_b, ends_a) if flip else (ends_a, ends_b)
    rank = gallop(shorter, longer)
    common = longer[rank] == shorter
    # a token overlaps the other's tokens from where the one before it stopped (after it, if both end there) to its rank
    first = np.concatenate(([0], rank[:-1] + common[:-1]))
    count = rank - first + 1
    linked = np.repeat(np.arange(len(shorter)), count), ranges(first, count)
    groups = np.flatnonzero(common), rank[common]
    return (*groups[::-1], *linked[::-1]) if flip else (*groups, *linked)


class Aligner:
    """Both tokenizers, the bytes and lengths of their ids, and the written form of these ids."""

    def __init__(self, tokenizer: str, model: str) -> None:
        import sentencepiece

        self.a = tokens_for(tokenizer)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        back = {ord(c): b for b, c in self.a.letters.items()}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[ord(c)] for c in token) if all(ord(c) in back for c in token) else token.encode()
        self.bytes_b = pieces_for(model).bytes_of  # refuses a vocabulary whose pieces go on past a blank
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # ids as text, each closed inside its list, and closed at the end of its list
        self.text_a = np.array([b"%d%c" % (i, c) for c in b",|" for i in range(self.size_a)], object)
        self.text_b = np.array([b"%d%c" % (i, c) for c in b",;" for i in range(self.size_b)], object)

    def parts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids in A and in B of each part; None where the bytes of either differ from a blank and the part."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = np.frombuffer(self.a.ids(" " + text), "<u4")[:-1]  # without the end id
            whole = b" " + text.encode()
            same = b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            out.append((a.astype(np.int64), np.array(b, np.int64)) if same else None)
        return out


@lru_cache(maxsize=1)  # kept by a worker for its next tasks
def aligner_for(tokenizer: str, model: str) -> Aligner:
    return Aligner(tokenizer, model)


def cut(text: str) -> list[str]:
    """The parts of a text, each without the blank before it (both tokenizers get it back)."""
    out, at = [], 0
    while len(text) - at > PART:
        here = _CUT.search(text, at + PART)
        if not here:
            break
        out.append(text[at:here.start()])
        at = here.start() + 1
    return [*out, text[at:]]


class Row:
    """What is gathered of one row over its parts."""

    def __init__(self, doc_id: int | None, parts: int) -> None:
        self.doc_id, self.left, self.whole = doc_id, parts, True
        self.counts = np.zeros(4, np.int64)
        self.sha = hashlib.sha256()
        self.empty = True
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, counts: np.ndarray, groups: bytes, pairs: np.ndarray, times: np.ndarray) -> None:
        self.counts += counts
        self.sha.update((b"" if self.empty else b";") + groups)
        self.empty = False
        self.pairs.append(pairs)
        self.times.append(times)

    def result(self) -> tuple:
        if not self.whole or self.empty:
            return (self.doc_id, 0, 0, 0, 0, "", b"", b"")
        pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate(self.times)).astype("<i4")
        return (self.doc_id, *self.counts.tolist(), self.sha.hexdigest(), pairs.astype("<u4").tobytes(), times.tobytes())


def _align_parts(al: Aligner, rows: list[Row], texts: list[str]) -> None:
    """Align the parts side by side: their ends, one part after the other, are one ascending list each."""
    found = al.parts(texts)
    for row, ids in zip(rows, found):
        row.left -= 1
        row.whole &= ids is not None
    rows = [r for r, ids in zip(rows, found) if ids is not None]
    found = [ids for ids in found if ids is not None]
    if not found:
        return
    a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
    in_a, in_b, link_a, link_b = align(np.cumsum(al.length_a[a]), np.cumsum(al.length_b[b]))
    ends_a, ends_b = np.cumsum([len(x) for x, _ in found]), np.cumsum([len(y) for _, y in found])
    group_ends = np.searchsorted(in_a, ends_a - 1) + 1  # a part's end is a common end
    link_ends = np.searchsorted(link_a, ends_a - 1, side="right")
    # the groups written out: A's tokens of a group, then B's
    size_a, size_b = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
    before_b, before_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
    written = np.empty(len(a) + len(b), object)
    last = np.zeros(len(a), np.int64)
    last[in_a] = al.size_a
    written[np.arange(len(a)) + np.repeat(before_b, size_a)] = al.text_a[a + last]
    last = np.zeros(len(b), np.int64)
    last[in_b] = al.size_b
    written[np.arange(len(b)) + np.repeat(before_a, size_b)] = al.text_b[b + last]
    # distinct pairs of each part
    part = np.repeat(np.arange(len(found)), np.diff(link_ends, prepend=0))
    keys, times = np.unique((part * al.size_a + a[link_a]) * al.size_b + b[link_b], return_counts=True)
    part, pairs = np.divmod(keys, al.size_a * al.size_b)
    pair_ends = np.searchsorted(part, np.arange(len(found)), side="right")
    written, lo = written.tolist(), np.zeros(5, np.int64)
    for i, row in enumerate(rows):
        hi = np.array([ends_a[i], ends_b[i], group_ends[i], link_ends[i], pair_ends[i]])
        text = b"".join(written[lo[0] + lo[1]:hi[0] + hi[1]])
        row.add((hi - lo)[:4], text[:-1], pairs[lo[4]:hi[4]], times[lo[4]:hi[4]])
        lo = hi


_ALIGNED = ["place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def aligned(docs: DataFrame, tokenizer: str | None = None, model: str | None = None) -> DataFrame:
    """``place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``: each row's tokens, groups and links
    counted, the digest of its groups, its distinct linked pairs (``id in A * size of B + id in B``, unsigned 32-bit,
    ascending) and how often each is linked (32-bit). ``place`` numbers the rows.

    Texts that are null, empty, or not spelt by both tokenizers (a literal U+2581) have no tokens: zeros,
    an empty digest and no pairs. Repeated rows are rows each; other columns are left out.
    """
    tokenizer, model = tokenizer or default_tokenizer(), model or default_model()
    al = aligner_for(tokenizer, model)
    if al.size_a * al.size_b > 1 << 32:
        raise ValueError("the two vocabularies have more pairs than 32 bits can number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner_for(tokenizer, model)
        rows: list[Row] = []  # not yet sent
        todo: list[tuple[Row, str]] = []

        def results() -> pa.RecordBatch:
            if todo:
                _align_parts(al, *map(list, zip(*todo)))
            todo.clear()
            done = [r for r in rows if not r.left]
            rows[:] = [r for r in rows if r.left]
            found = [(first + made + i, *r.result()) for i, r in enumerate(done)]
            columns = list(zip(*found)) if found else [[]] * len(_ALIGNED)
            types = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _ALIGNED)

        first, made, held = TaskContext.get().partitionId() << 33, 0, 0
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                parts = cut(text.as_py()) if text.as_py() else []
                row = Row(doc_id.as_py(), len(parts))
                rows.append(row)
                for p in parts:
                    todo.append((row, p))
                    held += len(p)
                    if held >= BATCH_CHARS or len(rows) >= BATCH_ROWS:
                        yield (out := results())
                        made, held = made + len(out), 0
                if len(rows) >= BATCH_ROWS:
                    yield (out := results())
                    made, held = made + len(out), 0
        yield results()
        al.a.clear()  # a worker that goes on to other stages keeps the tokenizers, not their words

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                     "pairs binary, times binary")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, docs, best``: in how many rows of ``aligned`` each pair is linked, and whether no other pair of its A id
    is in more. Tasks count CHUNK_PAIRS at a time, so a pair of every document leaves a task as few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def counted() -> pa.RecordBatch:
            pairs, docs = np.unique(np.frombuffer(b"".join(held), "<u4"), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(docs.astype(np.int64))], ["pair", "docs"])

        for b in batches:
            for x in b.column(0).to_pylist():
                held.append(x)
                size += len(x)
                if size >= 4 * CHUNK_PAIRS:
                    yield counted()
                    held, size = [], 0
        yield counted()

    counts = arrow_map(rows.select("pairs"), run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = stage(counts.withColumn("a", F.expr(f"pair div {size_b}")), "alignment-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # one row an id of A
    return counts.join(F.broadcast(most), "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _head(counts: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The number of documents from which on a pair's count is sent to the tasks, and these pairs, ascending."""
    sizes = counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("level")).count().collect()  # 63 levels at most
    total, floor = 0, 1 << 62
    for level, n in sorted(((r["level"], r["count"]) for r in sizes), reverse=True):
        total += n
        if total > HEAD_PAIRS:
            break
        floor = 1 << level
    head = counts.where(F.col("docs") >= floor).orderBy("pair").toArrow()
    return floor, tuple(head.column(c).to_numpy() for c in ("pair", "docs", "best"))


def linked(rows: DataFrame, size_b: int) -> DataFrame:
    """``rows`` of ``aligned`` (staged: they are read several times) with ``n_best``, links whose pair is in the most
    documents of its A id, and ``count_sum``, the documents of the pair added up over the links."""
    counts = stage(pair_counts(rows, size_b), "alignment-pairs")
    floor, head = _head(counts)
    shared = rows.sparkSession.sparkContext.broadcast(head)
    kept = [c for c in rows.columns if c not in ("pairs", "times")]

    def looked_up(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each row its pairs, their times, where the head holds them and whether it does."""
        keys = shared.value[0]
        for x, y in zip(b.column("pairs").to_pylist(), b.column("times").to_pylist()):
            pairs = np.frombuffer(x, "<u4").astype(np.int64)
            at = np.searchsorted(keys, pairs)
            known = at < len(keys)
            known[known] = keys[at[known]] == pairs[known]
            yield pairs, np.frombuffer(y, "<i4").astype(np.int64), at, known

    def in_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, docs, best = shared.value
        for b in batches:
            sums = [(int(times[known][best[at[known]]].sum()), int(times[known] @ docs[at[known]]))
                    for _, times, at, known in looked_up(b)]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, kept), *(pa.array([x[i] for x in sums], pa.int64()) for i in (0, 1))], [*kept, "n_best", "count_sum"])

    def in_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, (pairs, times, _, known) in zip(b.column("place").to_pylist(), looked_up(b)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full((~known).sum(), place)), pa.array(pairs[~known]), pa.array(times[~known])],
                    ["place", "pair", "times"])

    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in [*kept, "n_best", "count_sum"])
    out = arrow_map(rows, in_head, schema)
    if floor > 1:  # pairs rarer than that: none can be hot
        rare = counts.where(F.col("docs") < floor)
        links = arrow_map(rows.select("place", "pairs", "times"), in_tail, "place long, pair long, times long")
        more = links.join(rare, "pair").groupBy("place").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
        out = out.join(more, "place", "left")
        for name, extra in (("n_best", "more_best"), ("count_sum", "more_sum")):
            out = out.withColumn(name, F.col(name) + F.coalesce(extra, F.lit(0)))
        out = out.drop("more_best", "more_sum")
    return out


def alignment_digest(docs: DataFrame) -> DataFrame:
    """``aligned`` and ``linked`` over all rows, without the pairs."""
    rows = stage(aligned(docs), "alignment-rows")
    size_b = aligner_for(default_tokenizer(), default_model()).size_b
    return linked(rows, size_b).drop("place")
