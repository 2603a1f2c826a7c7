"""Ranked search against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(texts, items, k):
    """(item, rank, doc, score) from the formula, for (id, text) rows."""
    terms = lambda x: TERM.findall((x or "").translate(LOWER))
    bags = [(i, Counter(terms(x))) for i, x in texts]
    df = Counter(t for _, bag in bags for t in bag)
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            if bag:
                m = 100 - 75 + 75 * bag.total() * n_docs // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag)
                if score > 0:
                    found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


def test_hard_rows(spark, edge, edge_rows):
    items = [(1, "the fox, THE dog"), (2, "one two two"), (3, None), (4, "!!"), (5, "word7 filler3 filler29999 more"), (None, "text 日本語 À"), (2, "one two two"), (6, "nowhere")]
    queries = spark.createDataFrame([(*x, "x") for x in items], "item_id int, text string, doc_id string")
    assert rows(ranked.search(edge, queries, 3)) == plainly([r[:2] for r in edge_rows], items, 3)


@pytest.mark.parametrize("shard", [7, 64])
def test_ties_over_many_shards_and_blocks(spark, monkeypatch, shard):
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "QUERY_BYTES", 400)
    rng = np.random.default_rng(shard)
    words = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(words[int(60 * x**2)] for x in rng.random(n))
    texts = [(i, draw(int(rng.integers(1, 12)))) for i in range(300)] + [(i, "w1 w2") for i in range(300, 340)]
    items = [(i, draw(6)) for i in range(12)] + [(12, "w1 w2 w2"), (13, "w59")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(ranked.search(docs, spark.createDataFrame(items, "item_id long, text string"), 5)) == plainly(texts, items, 5)


def test_empty(spark, edge, empty):
    queries = spark.createDataFrame([(1, "fox")], "item_id long, text string")
    assert ranked.search(empty, queries).count() == 0
    assert ranked.search(edge, queries.limit(0)).count() == 0


def test_documents_below_the_threshold_are_skipped():
    """One rare term decides; the common term's list is not searched for others."""
    n = 4000
    every, few = np.arange(n), np.arange(0, n, 100)
    shard = ranked.Shard(np.array([0, n, n + len(few)]), np.concatenate([every, few]), np.full(n + len(few), 1000, np.int64), n)
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 500]), 3)
    assert set(docs) == set(few.tolist()) and set(scores.tolist()) == {501_000}
    assert shard.looked < 400


def test_lengths_beyond_64_bits():
    n = np.array([3, 1 << 40], np.int64)
    assert ranked.lengths(n, 1 << 30, 1 << 50).tolist() == [25 + 75 * x * (1 << 30) // (1 << 50) for x in n.tolist()]
