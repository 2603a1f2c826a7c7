"""Graphs made inside each caption are those of the joins, on the golden captions and on random trees with nulls."""

import random

from pyspark.sql import functions as F

from tessera.functions.text import normalize_query, separator_key
from tessera.operators import caption_graph
from tessera.operators.extract import extract, extract_joined, extract_rows
from tessera.plans import golden
from tessera.schema import ANNOTATED

#: text, part of speech, dependencies
NOUNS = [(w, "NOUN", ("nsubj", "nsubj", "nsubjpass", "dobj", "pobj", "pobj", "conj", None)) for w in ("cat", "cats", "Boat", "desk", "lamp", "kite", "top")]
VERBS = [(w, "VERB", ("ROOT", "conj", "conj", "acl")) for w in ("follow", "sing", "waits", "carry")]
SMALL = [(w, "ADP", ("prep", "prep", "agent", "prt")) for w in ("on", "of", "By", "near", "for")]
OTHER = [("dark", "ADJ", ("amod", "conj")), ("green", "ADJ", ("amod", "amod", "compound")), ("five", "NUM", ("nummod",)), (",", "PUNCT", ("punct",)), ("the", "DET", ("det", "conj")), ("is", "AUX", ("auxpass", "aux")), ("pale", None, ("amod",)), ("yellow", "ADJ", (None, "amod")), ("on top of", "ADP", ("prep",))]


def trees(n: int, seed: int = 4) -> list[tuple]:
    """Captions of random words that hang together at random, nulls among them; every third a tag list."""
    rnd, rows = random.Random(seed), []
    for k in range(n):
        words = []
        for _ in range(rnd.randint(0, 8)):
            word = rnd.choice(rnd.choice((NOUNS, NOUNS, VERBS, SMALL, OTHER)))
            words += [("on", "ADP", ("prep",)), ("top", "NOUN", ("pobj",)), ("of", "ADP", ("prep",))] if word[0] == "on top of" else [word]
        size = len(words)
        tokens = []
        for i, (w, pos, deps) in enumerate(words):
            dep = rnd.choice(deps)
            head = min(i + 1, size - 1) if dep in ("amod", "nummod", "det") and rnd.random() < 0.8 else rnd.choice((rnd.randrange(size), max(i - 1, 0), max(i - 2, 0)))
            tokens.append((i, w, None if rnd.random() < 0.05 else w.lower().rstrip("s"), pos, rnd.choice(("RP", "VBG", "VBG", "NN", None)), "", dep, None if rnd.random() < 0.02 else head, "", i * 5, i * 5 + len(w), rnd.choice((" ", " ", "", None))))
        chunks, begin = [], 0
        for i, (_, pos, _) in enumerate(words):
            if pos == "NOUN" and rnd.random() < 0.9:
                chunks.append(("", i, "", "", "", "", "", 0, "", begin, min(size, i + rnd.randint(1, 2)), 0, 0))
                begin = rnd.choice((begin, i + 1, i + 1))
        cuts = sorted(rnd.sample(range(size + 1), min(size + 1, 4)))
        segments = [(f"t{j}", "", "", 0, 0, a, z) for j, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]
        rows.append((f"r{k}", "", "tag_list" if k % 3 == 0 else "sentence", tokens, chunks, segments))
    return rows


def forest(n: int) -> list[tuple]:
    """Those of the captions whose conjuncts make trees: rings and double ways are outside the joins' contract."""
    out = []
    for row in trees(n):
        up = {t[0]: t[7] for t in row[3]}
        out.append(row) if all(_ends(up, i) for i in up) else None
    return out


def _ends(up: dict, i: int) -> bool:
    for _ in up:
        if up[i] in (None, i):
            return True
        i = up[i]
    return False


RULES = {"mentions": {"R12", "R13", "R14", "R15"}, "edges": {"R13", "R14", "R16", "R16.1", "R16.2", "R16.3", "R17", "R17.1", "R18", "R18.1"}}


def test_same_graph_as_the_joins(spark):
    lex = golden.lexicons(spark)
    rows = golden.captions(spark).unionByName(spark.createDataFrame([*forest(4000), ("none", "", "sentence", None, None, None)], ANNOTATED)).repartition(3).persist()
    for kind, got, want in zip(("mentions", "edges"), extract(rows, lex, lambda df: df), extract_joined(rows, lex), strict=True):
        assert got.columns == want.columns
        a, b = ({str(r) for r in df.collect()} for df in (got, want))
        assert sorted(a - b)[:3] == sorted(b - a)[:3], kind
        assert len(a) > 400 and {r["rule_id"] for r in got.select("rule_id").distinct().collect()} == RULES[kind]


def test_no_exchange_and_one_pass(spark):
    mentions, _ = extract(golden.captions(spark), golden.lexicons(spark), lambda df: df)
    plan = mentions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan  # before: about twenty tables were cut


def test_large_lexicons_are_joined(spark, monkeypatch):
    lex = golden.lexicons(spark)
    monkeypatch.setattr(caption_graph, "LEXICON_ROWS", 2)
    mentions, _ = extract(golden.captions(spark), lex)
    assert mentions.count() == sum(map(len, golden.MENTIONS.values()))


def test_rows_with_large_lexicons(spark, monkeypatch):
    lex = golden.lexicons(spark)
    some = golden.captions(spark, ("c0", "c2", "c7"))
    few = extract_rows(some, lex)
    monkeypatch.setattr(caption_graph, "LEXICON_ROWS", 2)
    for name in ("mentions", "edges"):
        a, b = ({str(r) for r in df.select("caption_id", F.inline(name)).collect()} for df in (few, extract_rows(some, lex)))
        assert a == b and a


def test_keys_as_spark_makes_them(spark):
    texts = [f"A{chr(i)}_b-{chr(i)} " for i in range(1, 0x3100) if i not in (0x1C89, 0x1C8A)]  # new in Unicode 16, which Spark knows and Python 3.13 does not
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_query("t").alias("q"), separator_key(F.col("t")).alias("s"))
    assert [r for r in df.collect() if (caption_graph.query_key(r["t"]), caption_graph.spaced_key(r["t"])) != (r["q"], r["s"])] == []


def test_same_attribute_candidates_as_the_joins(spark):
    from tessera.operators import builders

    objects = golden.lexicons(spark).objects
    words = spark.createDataFrame([("on top of", 3), ("top of", 2)], "key string, width int")
    rows = golden.captions(spark).unionByName(spark.createDataFrame([*trees(3000), ("none", "", "sentence", None, None, None)], ANNOTATED)).repartition(3).persist()
    for mode in builders.MODES:
        got, want = (f(rows, objects, words, mode) for f in (builders.attribute_candidates, builders.attribute_candidates_joined))
        a, b = (sorted(map(str, df.select(want.columns).collect())) for df in (got, want))
        assert a == b and len(a) > 300, mode
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().replace("REPARTITION_BY_NUM", "").split("InMemoryTableScan")[0]
