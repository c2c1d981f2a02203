"""SentencePiece BPE encoding with seeded merge dropout, and decoding.

The agenda of merges is worked off best score first, leftmost first among equals; a merge taken from it
is skipped when a keyed hash of (seed, epoch, doc_id, place of the word, extent of the merge) falls under
``dropout``.
A skipped merge returns only as a part of another one. Without dropout the ids are those of the library;
with dropout every segmentation decodes to the same text.

Words (a run of blanks and what follows up to the next blank) are segmented on their own, as no piece of
the vocabulary goes on past a blank (checked when it is loaded). Every occurrence has a key of its own, so
its merges are drawn afresh. What a word gives is kept as a bounded tree: a node stands for the merges skipped
so far and holds the merges that follow if nothing else is skipped. An occurrence hashes those; at the
first that its key skips it goes on to that merge's child. This gives what working off the
agenda would. Nodes are made when they are called for a second time; till then the occurrence's own merges are
worked off. All this is done side by side in numpy for the words of a batch: each round takes
every word's best merge off its agenda. Very long words go one by one over a heap.

The library reads U+2581 as a blank and so loses it; here a literal one is written as its three
bytes, so any text comes back whole.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map

DROPOUT = 0.1
SEED = 17
CACHE_WORDS = 500_000
CACHE_NODES = 1_000_000
SIDE_BY_SIDE_CHARS = 32
WIDTHS = (8, 12, 16, 24, 32)
BATCH_DOCS = 64
BLANK = "▁"
_WORD = re.compile(r" +[^ ]*|[^ ]+")
_RANGE = 1 << 64
_NONE = np.int64(1) << 40


_I, _J, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _extent(i, j, end):
    """What a merge of the symbols at i and j that ends at ``end`` adds to the key: numpy arrays of uint64."""
    with np.errstate(over="ignore"):
        return i * _I + j * _J + end * _END


def _skip_hash(key, i, j, end):
    """Keyed hash of a merge of the symbols at i and j that ends at ``end``: numpy arrays of uint64."""
    return _mixed(key ^ _extent(i, j, end))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Column:
    """A numpy array that grows."""

    def __init__(self, dtype) -> None:
        self.held, self.size = np.empty(1 << 12, dtype), 0

    def add(self, x: np.ndarray) -> None:
        if self.size + len(x) > len(self.held):
            self.held = np.concatenate((self.held[:self.size], np.empty(self.size + len(x), self.held.dtype)))
        self.held[self.size:self.size + len(x)] = x
        self.size += len(x)


class Tree:
    """Nodes of the words met: their ids, the merges tested there (slots) and the child of each slot."""

    def __init__(self) -> None:
        self.roots: dict[str, int] = {}  # -1: met once
        self.words: list[str] = []
        self.before, self.parent = Column(np.int32), Column(np.int64)  # merges before the node's own, slot it hangs on
        self.first, self.slots = Column(np.int64), Column(np.int32)
        self.code, self.extent, self.child, self.owner = (Column(x) for x in (np.int32, np.uint64, np.int32, np.int32))
        self.start, self.length, self.ids = Column(np.int64), Column(np.int64), Column(np.int32)

    def full(self) -> bool:
        return len(self.roots) >= CACHE_WORDS or len(self.words) >= CACHE_NODES or self.ids.size >= 8 * CACHE_NODES

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray, parents: np.ndarray, before: np.ndarray,
            codes: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Numbers of the new nodes."""
        at = len(self.words)
        self.words += words
        self.start.add(self.ids.size + np.cumsum(lengths) - lengths)
        self.length.add(lengths)
        self.ids.add(ids)
        self.first.add(self.code.size + np.cumsum(slots) - slots)
        self.slots.add(slots)
        self.parent.add(parents)
        self.before.add(before)
        self.code.add(codes)
        wide = codes.astype(np.uint64)
        low = np.uint64(63)
        self.extent.add(_extent(wide >> np.uint64(12), wide >> np.uint64(6) & low, wide & low))
        self.child.add(np.full(len(codes), -1, np.int32))
        new = np.arange(at, len(self.words))
        self.owner.add(np.repeat(new, slots))
        return new

    def path(self, slot: int) -> list[int]:
        """Codes of the merges skipped on the way to the child of a slot."""
        out = []
        while slot >= 0:
            out.append(int(self.code.held[slot]))
            slot = int(self.parent.held[self.owner.held[slot]])
        return out


class Pieces:
    """The vocabulary: pieces with score and id, byte pieces, and what each id decodes to."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError(f"piece {piece!r} goes on past a blank")
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.bytes_of.append(piece.replace(BLANK, " ").encode())
        # every way to make a piece of two others: key left * size + right, priority, the piece made
        self.size = sp.get_piece_size()
        pairs = [(self.ids[p[:c]] * self.size + self.ids[p[c:]], -self.scores[p], i)
                 for p, i in self.ids.items() for c in range(1, len(p)) if p[:c] in self.ids and p[c:] in self.ids]
        order = {s: r for r, s in enumerate(sorted({s for _, s, _ in pairs}))}
        pairs.sort()
        self.pair_keys = np.array([k for k, _, _ in pairs], dtype=np.int64)
        self.pair_rank = np.array([order[s] for _, s, _ in pairs], dtype=np.int64)
        self.pair_made = np.array([i for _, _, i in pairs], dtype=np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(priority, piece made) of merging two pieces; _NONE where they make none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_rank[at], _NONE), self.pair_made[at]


@lru_cache(maxsize=2)
def pieces_for(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Ids of whole texts as little-endian signed 32-bit bytes."""

    def __init__(self, path: str, dropout: float, seed: int, epoch: int) -> None:
        self.pieces = pieces_for(path)
        self.dropout, self.seed = int(dropout * _RANGE), xxhash.xxh64_intdigest(f"{seed}|{epoch}".encode())
        self.tree = Tree()
        self.literal = np.array([self.pieces.byte_ids[b] for b in BLANK.encode()], dtype=np.int32)

    def merged(self, word: str, key: int) -> list[str]:
        """The segmentation of one word (blanks as BLANK) over a heap of merges."""
        symbols: list[str] = list(word)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, agenda = self.pieces.scores, []
        for i in range(n - 1):
            if (s := scores.get(word[i:i + 2])) is not None:
                agenda.append((-s, i, i + 1, i + 2))
        heapq.heapify(agenda)
        key = np.uint64(key)
        while agenda:
            _, i, j, end = heapq.heappop(agenda)
            # stale unless the two symbols still meet at j and end where they did
            if not symbols[i] or after[i] != j or not symbols[j] or after[j] != end:
                continue
            if self.dropout and _skip_hash(key, np.uint64(i), np.uint64(j), np.uint64(end)) < self.dropout:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = end
            if end < n:
                before[end] = i
                if (s := scores.get(symbols[i] + symbols[end])) is not None:
                    heapq.heappush(agenda, (-s, i, end, after[end]))
            if (h := before[i]) >= 0 and (s := scores.get(symbols[h] + symbols[i])) is not None:
                heapq.heappush(agenda, (-s, h, i, end))
        return [s for s in symbols if s]

    def _ids(self, piece: str) -> list[int]:
        i = self.pieces.ids.get(piece)
        return [self.pieces.byte_ids[b] for b in piece.encode()] if i is None else [i]

    def word(self, word: str, key: int) -> bytes:
        out = [i for piece in self.merged(word.replace(" ", BLANK), key) for i in self._ids(piece)]
        return struct.pack(f"<{len(out)}i", *out)

    def runs(self, words: list[str], keys: np.ndarray | None = None, paths: list[list[int]] | None = None):
        """Words of at most SIDE_BY_SIDE_CHARS characters worked off side by side, merges skipped by ``keys`` or
        those of ``paths``: their ids, ids a word, the merges done (codes) and merges a word."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        group = np.searchsorted(WIDTHS, size)
        parts = [(at, self._run([words[i] for i in at], size[at], None if keys is None else keys[at],
                                [paths[i] for i in at] if paths else None))
                 for at in (np.flatnonzero(group == g) for g in range(len(WIDTHS))) if len(at)]
        out = []
        for k in (0, 2):  # back in the order of the words
            counts, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            base = 0
            for at, p in parts:
                counts[at] = p[k + 1]
                starts[at] = base + np.cumsum(p[k + 1]) - p[k + 1]
                base += len(p[k])
            out += [np.concatenate([p[k] for _, p in parts])[_ranges(starts, counts)], counts]
        return out

    def _run(self, plain: list[str], size: np.ndarray, key: np.ndarray | None, paths: list[list[int]] | None):
        words = [w.replace(" ", BLANK) for w in plain]
        n, width = len(words), int(size.max()) + 1
        ids = self.pieces.ids
        joined = "".join(words)
        chars = {c: ids.get(c, -1) for c in set(joined)}
        symbol = np.full((n, width), -1, dtype=np.int64)
        symbol[np.arange(width) < size[:, None]] = [chars[c] for c in joined]
        place = np.broadcast_to(np.arange(width), (n, width))
        before, after = place - 1, place + 1
        alive = place < size[:, None]
        rank, made = np.full((n, width), _NONE), np.zeros((n, width), dtype=np.int64)
        barred = np.array(sorted(r << 18 | c for r, p in enumerate(paths or ()) for c in p), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def weigh(row: np.ndarray, i: np.ndarray) -> None:
            """The agenda's entry for the symbols at i and after it."""
            j = after[row, i]
            inside = np.minimum(j, width - 1)
            r, m = self.pieces.pair(symbol[row, i], np.where(j < size[row], symbol[row, inside], -1))
            if key is not None and self.dropout:
                known = np.flatnonzero(r < _NONE)
                end = after[row[known], inside[known]]
                hashed = _skip_hash(key[row[known]], i[known].astype(np.uint64), j[known].astype(np.uint64),
                                    end.astype(np.uint64))
                r[known[hashed < np.uint64(self.dropout)]] = _NONE
            elif len(barred):
                code = row << 18 | i << 12 | j << 6 | after[row, inside]
                at = np.minimum(np.searchsorted(barred, code), len(barred) - 1)
                r[barred[at] == code] = _NONE
            rank[row, i], made[row, i] = r, m

        weigh(*np.nonzero(alive))
        rows = np.arange(n)
        while len(rows):
            best = rank if len(rows) == n else rank[rows]
            i = best.argmin(1)
            some = best[np.arange(len(rows)), i] < _NONE
            rows, i = rows[some], i[some]
            j = after[rows, i]
            symbol[rows, i] = made[rows, i]
            alive[rows, j] = False
            rank[rows, j] = _NONE
            end = after[rows, j]
            after[rows, i] = end
            if key is None:
                done.append((rows, i << 12 | j << 6 | end))
            inner = end < size[rows]
            before[rows[inner], end[inner]] = i[inner]
            h = before[rows, i]
            led = h >= 0
            weigh(np.concatenate((rows, rows[led])), np.concatenate((i, h[led])))
        flat, counts = symbol[alive].astype(np.int32), alive.sum(1)
        unknown = np.flatnonzero(flat < 0)  # single characters
        if len(unknown):
            row, at = (x[unknown] for x in np.nonzero(alive))
            known = [self._ids(words[r][i]) for r, i in zip(row.tolist(), at.tolist())]
            wide = np.ones(len(flat), np.int64)
            wide[unknown] = [len(k) for k in known]
            starts = np.cumsum(wide) - wide
            flat = np.repeat(flat, wide)
            flat[_ranges(starts[unknown], wide[unknown])] = [i for k in known for i in k]
            counts = counts + np.bincount(row, weights=wide[unknown] - 1, minlength=n).astype(np.int64)
        row = np.concatenate([r for r, _ in done]) if done else np.zeros(0, np.int64)
        code = np.concatenate([c for _, c in done]) if done else np.zeros(0, np.int64)
        return flat, counts, code[np.argsort(row, kind="stable")].astype(np.int32), np.bincount(row, minlength=n)

    def _nodes(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The node of each occurrence, -1 for those worked off on their own; which these are, their ids
        and ids an occurrence."""
        tree = self.tree
        roots = tree.roots
        node = np.array([roots.get(w, -2) for w in words], dtype=np.int64)
        lacking = np.flatnonzero(node < 0)
        alone = [np.zeros(0, np.int64)]
        if len(lacking):
            times = Counter([words[i] for i in lacking.tolist()])
            new = [w for w, k in times.items() if k > 1 or w in roots]
            roots.update((w, -1) for w in times)
            if new:
                ids, lengths, codes, slots = self.runs(new)
                none = np.zeros(len(new), np.int64)
                roots.update(zip(new, tree.add(new, ids, lengths, none - 1, none, codes, slots).tolist()))
            node[lacking] = [roots[words[i]] for i in lacking.tolist()]
            alone.append(np.flatnonzero(node < 0))
        live = np.flatnonzero(node >= 0) if self.dropout else np.zeros(0, np.int64)
        while len(live):
            own = tree.slots.held[node[live]]
            slot = _ranges(tree.first.held[node[live]], own)
            at = np.repeat(np.arange(len(live)), own)
            hit = np.flatnonzero(_mixed(keys[live][at] ^ tree.extent.held[slot]) < np.uint64(self.dropout))
            hit = hit[np.append(True, at[hit][1:] != at[hit][:-1])] if len(hit) else hit
            slot, live = slot[hit], live[at[hit]]
            child = tree.child.held[slot]
            wanted, times = np.unique(slot[child < 0], return_counts=True)
            if len(wanted):
                again = (times > 1) | (tree.child.held[wanted] == -2)
                tree.child.held[wanted] = -2
                new = wanted[again]
                if len(new):
                    owners = tree.owner.held[new]
                    # merges up to and without the skipped one
                    before = tree.before.held[owners] + new - tree.first.held[owners]
                    named = [tree.words[o] for o in owners.tolist()]
                    ids, lengths, codes, slots = self.runs(named, paths=[tree.path(x) for x in new.tolist()])
                    starts = np.cumsum(slots) - slots
                    rest = slots - before
                    tree.child.held[new] = tree.add(
                        named, ids, lengths, new, before, codes[_ranges(starts + before, rest)], rest)
                child = tree.child.held[slot]
            alone.append(live[child < 0])
            live = live[child >= 0]
            node[live] = child[child >= 0]
        direct = np.concatenate(alone)
        if not len(direct):
            return node, direct, np.zeros(0, np.int32), np.zeros(0, np.int64)
        node[direct] = -1
        return node, direct, *self.runs([words[i] for i in direct.tolist()], keys=keys[direct])[:2]

    def _flat(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences one after the other, and ids an occurrence; "" stands for a literal U+2581."""
        short = np.array([0 < len(w) <= SIDE_BY_SIDE_CHARS for w in words], dtype=bool)
        at = np.flatnonzero(short)
        tree = self.tree
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        extra, base = [self.literal], len(self.literal)  # ids that no node holds
        lengths[~short] = len(self.literal)
        for i in np.flatnonzero(~short).tolist():
            if words[i]:
                found = np.frombuffer(self.word(words[i], int(keys[i])), "<i4")
                extra.append(found)
                starts[i], lengths[i] = base, len(found)
                base += len(found)
        held = np.zeros(len(words), dtype=bool)
        if len(at):
            if tree.full():
                tree = self.tree = Tree()
            node, direct, ids, counts = self._nodes([words[i] for i in at.tolist()], keys[at])
            extra.append(ids)
            starts[at[direct]], lengths[at[direct]] = base + np.cumsum(counts) - counts, counts
            kept = node >= 0
            held[at[kept]] = True
            starts[at[kept]], lengths[at[kept]] = tree.start.held[node[kept]], tree.length.held[node[kept]]
        out = np.empty(lengths.sum(), dtype=np.int32)
        inner = np.repeat(held, lengths)
        out[inner] = tree.ids.held[_ranges(starts[held], lengths[held])]
        out[~inner] = np.concatenate(extra)[_ranges(starts[~held], lengths[~held])]
        return out, lengths

    def words(self, todo: list[tuple[str, int]]) -> list[bytes]:
        """``word`` of many (word, key) pairs."""
        out, lengths = self._flat([w for w, _ in todo], np.array([k for _, k in todo], dtype=np.uint64))
        return [x.astype("<i4").tobytes() for x in np.split(out, np.cumsum(lengths)[:-1])]

    def _keys(self, doc_id: int | None, n: int) -> np.ndarray:
        """One key for each place of a document."""
        start = np.uint64(xxhash.xxh64_intdigest(str(doc_id).encode(), self.seed))
        with np.errstate(over="ignore"):
            return _mixed(np.arange(n, dtype=np.uint64) * _I + start)

    def encode_flat(self, docs: list[tuple[int | None, str | None]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other, and where each document's end."""
        words: list[str] = []
        keys, ends = [], [0]
        for doc_id, text in docs:
            for i, part in enumerate(text.split(BLANK) if text else ()):
                if i:
                    words.append("")
                words += _WORD.findall(part if i else " " + part)
            keys.append(self._keys(doc_id, len(words) - ends[-1]))
            ends.append(len(words))
        if not words:
            return np.zeros(0, np.int32), np.zeros(len(docs), np.int64)
        ids, lengths = self._flat(words, np.concatenate(keys))
        return ids, np.append(0, np.cumsum(lengths))[ends[1:]]

    def encode(self, doc_id: int | None, text: str | None) -> bytes:
        return self.encode_flat([(doc_id, text)])[0].astype("<i4").tobytes()


@lru_cache(maxsize=1)  # kept by a worker for its next tasks
def encoder_for(path: str, dropout: float, seed: int, epoch: int) -> Encoder:
    return Encoder(path, dropout, seed, epoch)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, dropout: float = DROPOUT, seed: int = SEED,
           epoch: int = 0) -> DataFrame:
    """``doc_id, ids`` per row; null and empty texts give no ids. Equal rows get equal ids; another
    ``epoch`` or ``seed`` gives other segmentations."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, dropout, seed, epoch)
        for b in (b.slice(at, BATCH_DOCS) for b in batches for at in range(0, len(b), BATCH_DOCS)):
            ids, ends = encoder.encode_flat(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "ids"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` of ``encoded`` (doc_id, ids); null and empty ids give the empty text."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = pieces_for(path).bytes_of.__getitem__
        for b in batches:
            texts = []
            for ids in b.column(1):
                raw = b"".join(map(get, ids.values.to_numpy().tolist())) if ids.is_valid else b""
                texts.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             ["doc_id", "ids", "text"])

    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, text string")


def round_trip_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, ids, n_ids, decoded_sha256`` (SHA-256 of the decoded text's UTF-8)."""
    return decode(encode(docs)).select(
        "doc_id", "ids", F.size("ids").alias("n_ids"), F.sha2("text", 256).alias("decoded_sha256"))
