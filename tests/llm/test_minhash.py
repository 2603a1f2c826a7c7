"""MinHash near-duplicates: the guarantee of the index, and components against all pairs."""

import numpy as np
import pytest

from tessera.llm import minhash
from tessera.llm.minhash import near_duplicates
from tests.llm.test_search import reached, shingles


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 16, (400, 80)).astype(np.uint16)
    other = base.copy()
    for i, row in enumerate(other):  # the errors dealt out evenly, which is the worst case, or anyhow
        at = rng.choice(80, minhash.DISTANCE, replace=False) if i % 2 else (np.arange(minhash.DISTANCE) * minhash.WIDTH % 80 + np.arange(minhash.DISTANCE) // minhash.CHUNKS)
        row[at] ^= np.uint16(1 + i)
    assert ((base != other).sum(axis=1) == minhash.DISTANCE).all()
    a, b = minhash.keys(base), minhash.keys(other)
    assert all(len(np.intersect1d(x, y)) for x, y in zip(a, b, strict=True))
    apart = base.copy()
    apart[:, [c * minhash.WIDTH + j for c in range(minhash.CHUNKS) for j in (0, 1)]] ^= np.uint16(7)  # one more: two errors in each chunk
    assert not any(len(np.intersect1d(x, y)) for x, y in zip(a, minhash.keys(apart), strict=True))


def test_distance_tells_the_similarity():
    rng = np.random.default_rng(4)
    found = []
    for _ in range(60):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (80, 10, 10))
        one, two = minhash.signatures([np.unique(np.concatenate([common, x])) for x in (a, b)])
        found.append(np.count_nonzero(one != two))
    assert 14 < np.mean(found) < 18 and max(found) <= minhash.DISTANCE


def test_documents_exactly(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in near_duplicates(docs, 2, 80).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == reached(rows, 2, 80)
    assert all(got[i]["n_shingles"] == len(shingles(t, 2)) and got[i]["kept"] == (i == got[i]["component_id"]) for i, t in rows)


@pytest.mark.parametrize("edits", [3, 6, 9])
def test_families_and_chains(spark, edits):
    """Texts around one text that are no copies of each other, a chain of near copies, and texts just above and below the threshold."""
    rng = np.random.default_rng(edits)
    rows = []
    for i in range(120):
        t = [f"f{x}" for x in range(100)]
        for j in rng.choice(100, edits, replace=False):
            t[j] = f"edit{i}_{j}"
        rows.append(t)
    chain = [[f"c{x}" for x in range(90)]]
    for i in range(10):
        chain.append(list(chain[-1]))
        chain[-1][i * 9] = f"new{i}"
    for n in range(1, 40):
        rows += [[f"s{n}_{x}" for x in range(n + 1)], [f"s{n}_{x}" for x in range(n + 1)][: max(2, n - n // 5)]]
    rows = [(5000 - i, " ".join(t)) for i, t in enumerate(rows + chain + [[f"f{x}" for x in range(100)]] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df, 2, 80).collect()} == reached(rows, 2, 80)


def test_hard_rows(spark, edge, edge_rows, empty):
    rows = near_duplicates(edge, 2, 80).collect()
    assert len(rows) == len(edge_rows)
    got = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert got[2] == got[1] == 1 and got[8] == got[7] == 7 and got[6] == 6
    assert all(got[i] == i for i in (3, 4, 5, 9, 10))
    assert {(r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None} == {(0, None, True), (1, 6, False)}
    assert sorted(r["kept"] for r in rows if r["component_id"] == 6) == [False, False, True]
    assert near_duplicates(empty).count() == 0
    found = {r["doc_id"]: r["signature"] for r in minhash.signature_table(edge, 2).collect()}
    assert found[3] is None and found[1] == found[2] and len(found[7]) == 160
