"""Small hand-annotated captions with a small lexicon: the extraction rules' own examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import Lexicons
from ..schema import ANNOTATED
from ..sources import lexicons as files

#: caption: (shape, tokens ``text/lemma/POS/TAG/dep/head``, noun chunks (start, end, root))
CASES = {
    "c0": ("sentence", "Three/three/NUM/CD/nummod/2 striped/striped/ADJ/JJ/amod/2 cats/cat/NOUN/NNS/nsubj/3 follow/follow/VERB/VBP/ROOT/3 a/a/DET/DT/det/5 kite/kite/NOUN/NN/dobj/3 ././PUNCT/./punct/3", [(0, 3, 2), (4, 6, 5)]),
    "c1": ("tag_list", "red/red/ADJ/JJ/amod/1 lamp/lamp/NOUN/NN/ROOT/1 ,/,/PUNCT/,/punct/2 five/five/NUM/CD/nummod/4 chairs/chair/NOUN/NNS/ROOT/4 ,/,/PUNCT/,/punct/5 dancing/dance/VERB/VBG/ROOT/6", [(0, 2, 1), (3, 5, 4)]),
    "c2": ("sentence", "The/the/DET/DT/det/3 dark/dark/ADJ/JJ/amod/2 green/green/ADJ/JJ/amod/3 boat/boat/NOUN/NN/ROOT/3 ././PUNCT/./punct/3", [(0, 4, 3)]),
    "c3": ("sentence", "Five/five/NUM/CD/nummod/3 dark/dark/ADJ/JJ/amod/2 green/green/ADJ/JJ/amod/3 boats/boat/NOUN/NNS/ROOT/3 ././PUNCT/./punct/3", [(0, 4, 3)]),
    "c4": ("sentence", "Old/old/ADJ/JJ/amod/4 or/or/CCONJ/CC/cc/0 pale/pale/ADJ/JJ/amod/3 yellow/yellow/ADJ/JJ/conj/0 curtains/curtain/NOUN/NNS/ROOT/4 ././PUNCT/./punct/4", [(0, 5, 4)]),
    "c5": ("sentence", "That/that/DET/DT/det/1 girl/girl/NOUN/NN/nsubj/2 waits/wait/VERB/VBZ/ROOT/2 for/for/ADP/IN/prep/2 her/her/PRON/PRP$/poss/5 boat/boat/NOUN/NN/pobj/3 ././PUNCT/./punct/2", [(0, 2, 1), (4, 6, 5)]),
    "c6": ("sentence", "A/a/DET/DT/det/1 lamp/lamp/NOUN/NN/ROOT/1 on/on/ADP/IN/prep/1 top/top/NOUN/NN/pobj/2 of/of/ADP/IN/prep/3 the/the/DET/DT/det/6 desk/desk/NOUN/NN/pobj/4 ././PUNCT/./punct/1", [(0, 2, 1), (3, 4, 3), (5, 7, 6)]),
    "c7": ("sentence", "Cats/cat/NOUN/NNS/nsubj/1 sleep/sleep/VERB/VBP/ROOT/1 on/on/ADP/IN/prep/1 top/top/NOUN/NN/pobj/2 of/of/ADP/IN/prep/3 the/the/DET/DT/det/6 desk/desk/NOUN/NN/pobj/4 or/or/CCONJ/CC/cc/6 shelf/shelf/NOUN/NN/pobj/4 ././PUNCT/./punct/1", [(0, 1, 0), (5, 7, 6), (8, 9, 8)]),
    "c8": ("sentence", "Birds/bird/NOUN/NNS/nsubj/1 sing/sing/VERB/VBP/ROOT/1 ,/,/PUNCT/,/punct/1 dance/dance/VERB/VB/conj/1 and/and/CCONJ/CC/cc/3 follow/follow/VERB/VB/conj/3 girls/girl/NOUN/NNS/dobj/5 ././PUNCT/./punct/1", [(0, 1, 0), (6, 7, 6)]),
    "c9": ("sentence", "One/one/DET/DT/det/1 kite/kite/NOUN/NN/nsubjpass/3 was/be/AUX/VBD/auxpass/3 followed/follow/VERB/VBN/ROOT/3 by/by/ADP/IN/agent/3 birds/bird/NOUN/NNS/pobj/4 ././PUNCT/./punct/3", [(0, 2, 1), (5, 6, 5)]),
    "c10": ("sentence", "The/the/DET/DT/det/1 girl/girl/NOUN/NN/ROOT/1 carrying/carry/VERB/VBG/acl/1 a/a/DET/DT/det/4 lamp/lamp/NOUN/NN/dobj/2 ././PUNCT/./punct/1", [(0, 2, 1), (3, 5, 4)]),
    "c11": ("sentence", "On/on/ADP/IN/ROOT/0 top/top/NOUN/NN/pobj/0 of/of/ADP/IN/prep/1 the/the/DET/DT/det/4 shelf/shelf/NOUN/NN/pobj/2 ././PUNCT/./punct/0", [(3, 5, 4)]),
    "c12": ("sentence", "A/a/DET/DT/det/1 boat/boat/NOUN/NN/ROOT/1 near/near/ADP/IN/prep/1 the/the/DET/DT/det/4 bridge/bridge/NOUN/NN/pobj/2 and/and/CCONJ/CC/cc/4 tower/tower/NOUN/NN/conj/4 ././PUNCT/./punct/1", [(0, 2, 1), (3, 5, 4), (6, 7, 6)]),
}

#: What the rules must find, written by hand: mentions (type, text, first token, end), and edges (type, source, label, target, rule).
MENTIONS = {
    "c0": [("object", "cats", 2, 3), ("quantity", "Three", 0, 1), ("attribute", "striped", 1, 2), ("object", "kite", 5, 6), ("action", "follow", 3, 4)],
    "c1": [("object", "lamp", 1, 2), ("attribute", "red", 0, 1), ("object", "chairs", 4, 5), ("quantity", "five", 3, 4), ("attribute", "dancing", 6, 7)],
    "c2": [("object", "boat", 3, 4), ("attribute", "dark green", 1, 3)],
    "c3": [("object", "boats", 3, 4), ("quantity", "Five", 0, 1), ("attribute", "dark green", 1, 3)],
    "c4": [("object", "curtains", 4, 5), ("attribute", "Old", 0, 1), ("attribute", "pale yellow", 2, 4)],
    "c5": [("object", "girl", 1, 2), ("object", "boat", 5, 6), ("action", "waits for", 2, 4)],
    "c6": [("object", "lamp", 1, 2), ("object", "desk", 6, 7)],
    "c7": [("object", "Cats", 0, 1), ("object", "desk", 6, 7), ("object", "shelf", 8, 9), ("action", "sleep", 1, 2)],
    "c8": [("object", "Birds", 0, 1), ("object", "girls", 6, 7), ("action", "sing", 1, 2), ("action", "dance", 3, 4), ("action", "follow", 5, 6)],
    "c9": [("object", "kite", 1, 2), ("object", "birds", 5, 6), ("action", "followed", 3, 4)],
    "c10": [("object", "girl", 1, 2), ("object", "lamp", 4, 5), ("action", "carrying", 2, 3)],
    "c11": [("object", "shelf", 4, 5)],
    "c12": [("object", "boat", 1, 2), ("object", "bridge", 4, 5), ("object", "tower", 6, 7)],
}
EDGES = {
    "c0": [("has_quantity", "cats", "has_quantity", "Three", "R14"), ("has_attribute", "cats", "has_attribute", "striped", "R13"), ("event_role", "follow", "agent", "cats", "R16"), ("event_role", "follow", "patient", "kite", "R17")],
    "c1": [("has_attribute", "lamp", "has_attribute", "red", "R13"), ("has_quantity", "chairs", "has_quantity", "five", "R14")],
    "c2": [("has_attribute", "boat", "has_attribute", "dark green", "R13")],
    "c3": [("has_quantity", "boats", "has_quantity", "Five", "R14"), ("has_attribute", "boats", "has_attribute", "dark green", "R13")],
    "c4": [("has_attribute", "curtains", "has_attribute", "Old", "R13"), ("has_attribute", "curtains", "has_attribute", "pale yellow", "R13")],
    "c5": [("event_role", "waits for", "agent", "girl", "R16"), ("event_role", "waits for", "patient", "boat", "R17")],
    "c6": [("relation", "lamp", "on top of", "desk", "R18.1")],
    "c7": [("ambiguous_relation_candidate", "Cats", "on top of", "desk", "R18.1"), ("ambiguous_relation_candidate", "Cats", "on top of", "shelf", "R18.1"), ("event_role", "sleep", "agent", "Cats", "R16")],
    "c8": [("event_role", "sing", "agent", "Birds", "R16"), ("event_role", "follow", "patient", "girls", "R17"), ("event_role", "dance", "agent", "Birds", "R16.1"), ("event_role", "follow", "agent", "Birds", "R16.1")],
    "c9": [("event_role", "followed", "patient", "kite", "R17.1"), ("event_role", "followed", "agent", "birds", "R16.2")],
    "c10": [("event_role", "carrying", "agent", "girl", "R16.3"), ("event_role", "carrying", "patient", "lamp", "R17")],
    "c11": [("ambiguous_relation_candidate", "", "on top of", "shelf", "R18.1")],
    "c12": [("relation", "boat", "near", "bridge", "R18"), ("relation", "boat", "near", "tower", "R18")],
}

SINGULAR = {"cats": "cat", "chairs": "chair", "boats": "boat", "curtains": "curtain", "girls": "girl", "birds": "bird"}
OBJECTS = (*SINGULAR, "boat", "bridge", "desk", "girl", "kite", "lamp", "shelf", "top", "tower", "window")
ACTIONS = ("waits for", "follow", "sing", "dance", "sleep")
PHRASES = ("dark green", "pale yellow")
PREPOSITIONS = ("on top of", "top of", "ahead of")


def expected_sql(what: dict[str, list[tuple]], columns: str) -> str:
    """The expectation for every row of orders, which get the captions in turn."""
    text = lambda x: str(x) if isinstance(x, int) else "'" + x + "'"
    rows = ", ".join(f"({i}, {', '.join(map(text, row))})" for i, name in enumerate(CASES) for row in what[name])
    return f"WITH w(k, {columns}) AS (VALUES {rows}) SELECT 'c' || k || '-' || o_orderkey AS caption_id, {columns} FROM orders JOIN w ON o_orderkey % {len(CASES)} = k"


def _caption(name: str) -> tuple:
    shape, text, chunks = CASES[name]
    words = [w.rsplit("/", 5) for w in text.split(" ")]
    tokens, at = [], 0
    for i, (t, lemma, pos, tag, dep, head) in enumerate(words):
        space = "" if i + 1 == len(words) or words[i + 1][0] in (".", ",") else " "
        tokens.append((i, t, lemma, pos, tag, "", dep, int(head), words[int(head)][0], at, at + len(t), space))
        at += len(t) + len(space)
    caption = "".join(t[1] + t[11] for t in tokens)
    noun = [(caption[tokens[s][9] : tokens[e - 1][10]], r, *(words[r][k] for k in (0, 1, 2, 3, 4)), int(words[r][5]), words[int(words[r][5])][0], s, e, tokens[s][9], tokens[e - 1][10]) for s, e, r in chunks]
    segments = []
    if shape == "tag_list":
        begin = 0
        for end in [i for i, t in enumerate(tokens) if t[1] == ","] + [len(tokens)]:
            a, z = tokens[begin][9], tokens[end - 1][10]
            segments.append((f"t{len(segments)}", caption[a:z], caption[a:z], a, z, begin, end))
            begin = end + 1
    return (name, caption, shape, tokens, noun, segments)


def captions(spark: SparkSession, names: tuple[str, ...] = tuple(CASES)) -> DataFrame:
    return spark.createDataFrame([_caption(n) for n in names], ANNOTATED)


def _rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = sorted({k for r in rows for k in r})
    return spark.createDataFrame([(i, *(r.get(n, "") for n in names)) for i, r in enumerate(rows)], "_pos long, " + ", ".join(f"{n} string" for n in names))


def inventories(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    objects = [{"span_key": o, "selected_query": o, "selected_oewn_synset": f"s-{o}", "selected_oewn_lexfile": "noun.artifact", "decision_status": "chosen", "canonical_surface": SINGULAR.get(o, o), "synset_lemmas": SINGULAR.get(o, o), "parent_oewn_synsets": "p1", "parent_lemmas": "p1:thing"} for o in OBJECTS]
    actions = [{"span_key": a, "selected_query": a, "selected_oewn_synset": f"v-{a}", "decision_status": "chosen"} for a in ACTIONS]
    phrases = [{"span_key": p, "attribute_unit_type": "mwe", "span_token_count": "2", "anchor_token_offset": "1", "lookup_forms": p, "attribute_mwe_rule_version": files.ATTRIBUTE_RULE_VERSION, "decision_status": "chosen", "canonical_surface": p} for p in PHRASES]
    prepositions = [{"surface": p, "token_sequence": p, "canonical_relation": p, "relation_components": p.replace(" ", "|"), "initial_relation_token_offset": "0", "final_adp_token_offset": str(len(p.split()) - 1)} for p in PREPOSITIONS]
    return tuple(_rows(spark, x) for x in (objects, actions, phrases, prepositions))


def lexicons(spark: SparkSession) -> Lexicons:
    return files.lexicons(*inventories(spark))


def many(spark: SparkSession, ids: DataFrame, parts: int | None = None) -> DataFrame:
    """The captions over and over: one for each row of ``ids`` (a column ``n``), taken in turn. ``parts``: partitions that the ids are dealt into
    first, since a small file of ids is one task and its captions are many times larger."""
    some = captions(spark)
    names = F.array(*(F.lit(n) for n in CASES))
    turn = ids.select("n", F.get(names, F.col("n") % len(CASES)).alias("name"))
    turn = turn.repartition(parts, "n") if parts else turn
    rows = turn.join(F.broadcast(some), F.col("name") == F.col("caption_id"))  # a dozen captions
    return rows.select(F.concat_ws("-", "caption_id", F.col("n").cast("string")).alias("caption_id"), *(c for c in some.columns if c != "caption_id"))
