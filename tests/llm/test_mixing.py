from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import mixing

WEIGHTS = st.one_of(st.floats(1e-4, 1e3), st.integers(1, 20))


def lags(slots, weights, length):
    """The largest distance of a source from its exact share at any slot before ``length``."""
    total, worst = sum(map(Fraction, weights)), Fraction(0)
    for turn, w in zip(slots, weights, strict=True):
        rate, done = Fraction(w) / total, 0
        for s in (*turn, length):
            if s > length:
                break
            worst = max(worst, abs(done - rate * s))  # before the slot
            if s < length:
                done += 1
                worst = max(worst, abs(done - rate * (s + 1)))
    return worst


@settings(max_examples=60, deadline=None)
@given(st.lists(WEIGHTS, min_size=1, max_size=7))
def test_windows_and_deviation(weights):
    slots, starts = mixing.schedule([300] * len(weights), weights)
    total = sum(map(Fraction, weights))
    end = starts[1] if len(starts) > 1 else sum(map(len, slots))
    for turn, w in zip(slots, weights, strict=True):
        for k, slot in enumerate(s for s in turn if s < end):
            assert k * total // Fraction(w) <= slot < -(-(k + 1) * total // Fraction(w))  # release and deadline
    assert lags(slots, weights, end) < 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), WEIGHTS), min_size=1, max_size=6))
def test_every_block_once(sources):
    slots, starts = mixing.schedule([n for n, _ in sources], [w for _, w in sources])
    assert [len(t) for t in slots] == [n for n, _ in sources]
    assert sorted(s for t in slots for s in t) == list(range(sum(n for n, _ in sources)))
    assert starts == sorted(starts)


@pytest.mark.parametrize("weights", [[1000.4, 1000, 999.6, 1.4], [1, 1e-5], [1, 0.5, 1e-7], [2**0.5, 3**0.5, 0.3]])
def test_given_weights_hold_on_long_phases(weights):
    """Against the given weights, over seven orders of magnitude: nothing is rounded."""
    rate = [w / sum(weights) for w in weights]
    slots, starts = mixing.schedule([max(1, int(200_000 * r) + 1) for r in rate], weights)
    assert starts[1:2] == [] or starts[1] > 50_000
    assert lags(slots, weights, starts[1] if len(starts) > 1 else sum(map(len, slots))) < 1


def test_many_sources():
    slots, _ = mixing.schedule([2] * 3000, [1.0 + i % 7 for i in range(3000)])
    assert sorted(s for t in slots for s in t) == list(range(6000))


@pytest.mark.parametrize("weight", [0, -1, float("nan"), float("inf")])
def test_bad_weights(weight):
    with pytest.raises(ValueError, match="weight"):
        mixing.schedule([1, 1], [1, weight])


def test_rows(edge, edge_rows):
    rows = mixing.mix(edge, {"a": 2, "b": 1}, block_rows=2, carry=True).collect()
    assert Counter((r["doc_id"], r["source"]) for r in rows) == Counter((r[0], r[3]) for r in edge_rows)
    assert Counter((r["row"]["doc_id"], r["row"]["text"], r["row"]["position"]) for r in rows) == Counter((r[0], r[1], "x") for r in edge_rows)
    assert len({r["position"] for r in rows}) == len(rows)
    blocks = defaultdict(set)
    for r in rows:
        blocks[r["source"], r["block"]].add(r["slot"])
    assert all(len(s) == 1 for s in blocks.values())
    assert sorted(next(iter(s)) for s in blocks.values()) == list(range(len(blocks)))


def test_target_weights_hold(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'web' when id % 3 = 1 then 'books' else 'code' end as source")
    got = mixing.mix(rows, {"web": 5, "books": 3, "code": 2}, block_rows=10).where("phase = 0").orderBy("position").collect()
    for name, share in (("web", 0.5), ("books", 0.3), ("code", 0.2)):
        for n in range(500, len(got), 500):
            assert abs(sum(r["source"] == name for r in got[:n]) / 10 - share * n / 10) < 1.01


def test_more_sources_than_slots_of_a_cycle(spark, empty):
    assert mixing.mix(empty).count() == 0
    got = mixing.mix(spark.range(2100).selectExpr("id as doc_id", "cast(id as string) as source")).collect()
    assert sorted(r["slot"] for r in got) == list(range(2100))
