"""Inventories are made inside each caption: candidates need no exchange, and are the ones that joins of tokens give."""

from __future__ import annotations

import random

from tessera.operators import builders
from tessera.operators.extract import action_candidates, children, tokens_of
from tessera.plans import adapters, annotated

from .test_by_caption import exchanges, plan

TOKENS = "caption_id string, caption_shape string, tokens array<struct<i int, text string, lemma string, pos string, tag string, dep string, head_i int>>"


def _captions(spark, seed, n=60):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    rows = []
    for c in range(n):
        size = r.randrange(0, 9)
        rows.append((f"c{c}", "sentence", [(i, pick("Go", "up", "on", None), pick("go", "up", None), pick("VERB", "ADP", "ADV", None), pick("RP", "IN", None), pick("prt", "prep", "dobj", None), pick(None, *range(max(1, size)))) for i in range(size)]))
    return spark.createDataFrame(rows, TOKENS)


def test_action_phrases_are_those_that_joins_give(spark):
    for seed in range(3):
        rows = _captions(spark, seed)
        tokens = tokens_of(rows)
        taken = tokens.where("i % 5 = 3").select("caption_id", "i")
        want = action_candidates(tokens.where("pos = 'VERB'"), children(tokens), taken).collect()
        got = builders.action_phrases(rows, taken).collect()
        assert len(want) > 20 and sorted(map(repr, got)) == sorted(map(repr, want))


def test_action_phrases_need_no_exchange(spark, sf):
    rows = adapters.bucketed(annotated.captions(spark, sf), 8)
    taken = adapters.bucketed(rows.selectExpr("caption_id", "1 AS i").limit(10), 8)
    assert "Exchange hashpartitioning" not in plan(builders.action_phrases(rows, taken))  # joins of tokens had one for each side, by caption and token, and one for distinct rows


def test_joins_by_caption_and_token_take_buckets_as_they_are(spark):
    seen = []
    rows = adapters.bucketed(spark.range(50).selectExpr("cast(id % 7 AS string) AS caption_id", "id AS i"), 8)
    joined = rows.hint("merge").join(rows.select("caption_id", "i").hint("merge"), ["caption_id", "i"])
    with adapters._held(spark, adapters.ALL_KEYS, "false"):
        seen.append(exchanges(joined.select("*")))
    assert seen == [0] and exchanges(joined.select("*", "i")) > 0
    assert adapters.bucketed(joined, 8).count() == 50 and spark.conf.get(adapters.ALL_KEYS) == "true"


def test_modes_share_their_candidates(spark, sf, monkeypatch):
    made = []
    real = builders.attribute_candidates
    monkeypatch.setattr(builders, "attribute_candidates", lambda *a: made.append(a[-1]) or real(*a))
    asked = annotated.attribute_inventory(spark, sf)
    assert made == ["all"]  # before, once for each mode
    lex, rows = annotated.lexicon(spark), adapters.bucketed(annotated.captions(spark, sf), 8)
    for mode in ("mwe_only", "single_token_only"):
        alone = builders.attribute_inventory(rows, lex["objects"], lex["prepositions"], annotated._lookup(spark), mode)
        key = ("unit", "span_key", "observed_count", "caption_count", "example_caption_ids", "decision_status")
        assert made[-1] == mode and sorted(alone.select(*key).collect()) == sorted(asked.where(f"mode = '{mode}'").select(*key).collect())
