"""Cross-tokenizer alignment against brute force over the libraries' own ids, and edge tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rrspark.llm import alignment
from rrspark.llm.packing import default_tokenizer
from rrspark.llm.sentencepiece_dropout import default_model


def brute(docs):
    """What the contract says, token by token, with whole texts encoded by the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    letter = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}

    def bytes_b(i):
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    rows, held = [], defaultdict(int)
    for doc, text in docs:
        a = [] if not text else tok.encode(" " + text, add_special_tokens=False).ids
        b = [] if not text else sp.encode(text)
        byte_a = [bytes(letter[c] for c in tok.id_to_token(i)) for i in a]
        byte_b = [bytes_b(i) for i in b]
        if not text or b"".join(byte_a) != (" " + text).encode() or b"".join(byte_b) != (" " + text).encode():
            rows.append((doc, 0, 0, 0, "", Counter()))
            continue
        groups, links, i, j, end_a, end_b, first = [], Counter(), 0, 0, len(byte_a[0]), len(byte_b[0]), (0, 0)
        while True:
            links[a[i], b[j]] += 1
            if end_a == end_b:
                groups.append((a[first[0]:i + 1], b[first[1]:j + 1]))
                first = (i + 1, j + 1)
            step_a, step_b = end_a <= end_b, end_b <= end_a
            i, j = i + step_a, j + step_b
            if i == len(a):
                break
            end_a, end_b = end_a + step_a * len(byte_a[i]), end_b + step_b * len(byte_b[j])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc, len(a), len(b), len(groups), hashlib.sha256(text.encode()).hexdigest(), links))
        for pair in links:
            held[pair] += 1
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return Counter(
        (doc, n_a, n_b, n_groups, links.total(), sum(t for p, t in links.items() if held[p] == most[p[0]]),
         sum(t * held[p] for p, t in links.items()), digest)
        for doc, n_a, n_b, n_groups, digest, links in rows)


def found(df):
    return Counter(tuple(r) for r in df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


ODD = [
    None, "", " ", "  a   b ", "\n\n x\n", "a ▁ b", "<|endoftext|> </s><s> [INST]", "don't we'll  5000 3.14 naïve café", "中文没有空格 日本語 русский язык",
    "𝄞 🙂🙂 ​  x y", "\x00\x01 \x7f", "tab\tand\r\nline", "a" * 900, "word " * 3000, "a  b " * 500, "é" * 300 + " x" * 300, "same", "same"]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"place": F.lit("x"), "pairs": F.lit(1), "n_best": F.lit(0.5)})


def test_alignment_equals_brute_force(spark, sf_dir, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id here"), (3, "again 3"), (3, "again 3")]
    want, df = brute(docs), table(spark, docs).repartition(4)
    assert found(alignment.alignment_digest(df)) == want
    monkeypatch.setattr(alignment, "HEAD_PAIRS", 300)  # most pairs by the join
    assert found(alignment.alignment_digest(df)) == want


def test_alignment_head_may_be_empty(spark, monkeypatch):
    docs = list(enumerate(["one text", "one text two", "other"]))
    monkeypatch.setattr(alignment, "HEAD_PAIRS", 0)
    assert found(alignment.alignment_digest(table(spark, docs))) == brute(docs)


def test_parts_give_what_the_whole_gives():
    al = alignment.aligner_for(default_tokenizer(), default_model())
    text = "Some words, 12 of  them\n and\tmore. " * 5000 + "中" * 200 + " é ▁ "
    whole = alignment.Row(1, 1)
    alignment._align_parts(al, [whole], [text.replace("▁", "_")])
    old, alignment.PART = alignment.PART, 500
    try:
        parts = alignment.cut(text.replace("▁", "_"))
        assert " ".join(parts) == text.replace("▁", "_") and len(parts) > 100
        row = alignment.Row(1, len(parts))
        for i in range(0, len(parts), 7):
            alignment._align_parts(al, [row] * len(parts[i:i + 7]), parts[i:i + 7])
        assert row.left == 0 and row.result() == whole.result()
        bad = alignment.cut(text)
        row = alignment.Row(1, len(bad))
        alignment._align_parts(al, [row] * len(bad), bad)
        assert row.result()[1:6] == (0, 0, 0, 0, "")
    finally:
        alignment.PART = old


@pytest.mark.parametrize("n,m", [(1, 1), (1, 500), (300, 300), (300, 5000), (5000, 40)])
def test_galloping_and_overlaps(n, m):
    rng = np.random.default_rng(n + m)
    last = 10 * max(n, m)
    a, b = (np.unique(np.append(rng.choice(last, k - 1, replace=False), last)) for k in (n, m))
    assert np.array_equal(alignment.gallop(a, b), np.searchsorted(b, a))
    in_a, in_b, link_a, link_b = alignment.align(a, b)
    assert np.array_equal(a[in_a], np.intersect1d(a, b)) and np.array_equal(b[in_b], np.intersect1d(a, b))
    start_a, start_b = np.concatenate(([-1], a[:-1])), np.concatenate(([-1], b[:-1]))
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if start_a[i] < b[j] and start_b[j] < a[i]} if n * m < 10**6 else None
    assert len(link_a) == len(a) + len(b) - len(in_a)
    if want is not None:
        assert list(zip(link_a.tolist(), link_b.tolist())) == sorted(want)


def test_alignment_empty_table(spark):
    out = alignment.alignment_digest(table(spark, [(1, "x")]).where("false"))
    assert out.count() == 0
    assert found(alignment.alignment_digest(table(spark, [(1, None), (2, "▁")]))) == brute([(1, None), (2, "▁")])
