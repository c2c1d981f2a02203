"""Ranked lexical search against brute force, and edge tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rrspark.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) in plain integers."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_all, l_all = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            n = c.total()
            m = 100 - 25 + 25 * n * n_all // l_all
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms_of(text) if c[t])
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def table(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the", "The", "é", "Été", "x1", "1", "K", "naïve", "中文", "it's", "-", "a_b"] + [f"w{i}" for i in range(60)]
    made = [" ".join(rng.choices(words, k=rng.choice([1, 3, 20, 200]))) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(made)] + [(400, None), (401, ""), (402, "- . _ \x7f"), (None, "the w1 w2")]
    docs += [(i, made[7]) for i in range(500, 560)] + [(7, made[7])]  # ties and repeated rows
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 30])))) for i in range(20)]
    items += [(30, None), (31, ""), (32, "nowhere"), (33, made[7]), (34, "the the the w1"), (34, "the the the w1")]
    return docs, items


def test_ranking_equals_brute_force(spark, texts, monkeypatch):
    docs, items = texts
    want = brute(docs, dict(items).items())
    d, i = table(spark, docs, "doc_id").repartition(5), table(spark, items, "item_id")
    assert rows_of(ranking.rank(d, i)) == want
    # several groups of items, small tiles of every kind
    for name, value in {"GROUP_BYTES": 1500, "TILE_DOCS": 16, "TILE_ITEMS": 4, "TILE_TERMS": 3, "FAN_IN": 2, "SLICE": 40}.items():
        monkeypatch.setattr(ranking, name, value)
    assert rows_of(ranking.rank(d, i)) == want


def test_ranking_whole_long_text_counts(spark):
    docs = [(1, "a " * 1_500_000 + "needle"), (2, "b needle"), (3, "x" * 3_000_000), (4, "needle" * 3)]
    assert rows_of(ranking.rank(table(spark, docs, "doc_id"), table(spark, [(0, "needle a"), (1, "x" * 3_000_000)], "item_id"))) == brute(
        docs, [(0, "needle a"), (1, "x" * 3_000_000)])


def test_ranking_empty_tables(spark, texts):
    d, i = table(spark, texts[0], "doc_id"), table(spark, texts[1], "item_id")
    for a, b in ((d.where("false"), i), (d, i.where("false")), (d.where("doc_id >= 400 and doc_id < 500"), i)):
        out = ranking.rank(a, b)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_tiles_keep_sums_exact():
    bound = ranking.EXACT // ranking.MAX_IMPACT
    rng = np.random.default_rng(1)
    term = np.sort(rng.integers(0, 400, 3000))
    weight = rng.integers(1, bound // 20, 3000)
    weight[5] = bound * 3  # alone, in 64-bit integers
    row = rng.integers(0, 6, 3000)
    whole = np.zeros((6, 400), np.int64)
    whole[row, term] = weight
    at = np.flatnonzero(whole.ravel())
    row, term = at // 400, at % 400
    cuts = ranking.tiles(row, term, whole[row, term])
    assert np.array_equal(np.concatenate(cuts), np.unique(term))
    impact = rng.integers(0, ranking.MAX_IMPACT + 1, (400, 9)).astype(float)
    total = np.zeros((6, 9), np.int64)
    for c in cuts:
        if len(c) > 1:
            assert whole[:, c].sum(axis=1).max() < bound
        total += ranking.product(whole[:, c].astype(float), impact[c])
    assert np.array_equal(total, whole @ impact.astype(np.int64))
