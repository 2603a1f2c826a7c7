"""Orders as annotated captions, and the queries of the inventory builders with their SQL.

Each line of an order is a noun chunk and a verb. A chunk: the quantity (lines of status F), the part's type, a comma (return flag A), the
two words of the part's name, the noun in the plural from 26 pieces on. The first word of the name modifies the noun (flag N), is a conjunct of
the type (A) or a determiner (R). The verb goes by the part's size; 'up' follows where 3 divides it, 'on' where 5 does. Every third order is
a tag list with a segment for each chunk. Word senses are a small lexicon below; how often and where its words occur comes from the tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import builders, inventory
from ..schema import ANNOTATED
from . import adapters
from .queries import _cut, query

#: What the parts' types are as words: text, lemma, part of speech, tag, relation.
TYPES = {"ECONOMY": ("economies", "economy", "NOUN", "NNS", "compound"), "STANDARD": ("standards", "standard", "NOUN", "NNS", "compound")}
VERBS = ("holds", "carries", "lifts", "spins")
NOUNS = ("ring", "bolt", "gear", "plate")

_TOKEN = "struct<i int, text string, lemma string, pos string, tag string, morph string, dep string, head_i int, head_text string, char_start int, char_end int, whitespace string>"


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotated captions."""
    line = adapters.lines(spark, sf_dir)
    kind = lambda i, other: F.expr("CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v[i]}'" for k, v in TYPES.items()) + f" ELSE {other} END")
    word = F.split("p_name", " ")
    many = F.col("quantity").cast("int") > 25
    first, comma = F.col("l_linestatus") == "F", F.col("l_returnflag") == "A"
    t1 = F.when(first, 1).otherwise(0)
    t2 = t1 + 1 + F.when(comma, 1).otherwise(0)
    cell = lambda text, lemma, pos, tag, dep, head: F.struct(*(x.alias(n) for n, x in zip(("text", "lemma", "pos", "tag", "dep", "head"), (text, lemma, F.lit(pos) if isinstance(pos, str) else pos, F.lit(tag) if isinstance(tag, str) else tag, F.lit(dep) if isinstance(dep, str) else dep, head.cast("int")), strict=True)))
    root = t2 + 1
    verb = F.element_at(F.array(*map(F.lit, VERBS)), F.col("p_size") % 4 + 1)
    noun = F.when(many, F.concat(word[1], F.lit("s"))).otherwise(word[1])
    none = F.lit(None).cast("struct<text:string,lemma:string,pos:string,tag:string,dep:string,head:int>")
    cells = F.array(
        F.when(first, cell(F.col("quantity"), F.col("quantity"), "NUM", "CD", "nummod", root)).otherwise(none),
        cell(kind(0, "lower(p_type)"), kind(1, "lower(p_type)"), kind(2, "'ADJ'"), kind(3, "'JJ'"), kind(4, "'amod'"), root),
        F.when(comma, cell(F.lit(","), F.lit(","), "PUNCT", ",", "punct", root)).otherwise(none),
        cell(word[0], word[0], "ADJ", "JJ", F.when(comma, "conj").when(F.col("l_returnflag") == "R", "det").otherwise("amod"), F.when(comma, t1).otherwise(root)),
        cell(noun, word[1], "NOUN", F.when(many, "NNS").otherwise("NN"), "dobj", root + 1),
        cell(verb, verb, "VERB", "VBZ", "ROOT", root + 1),
        F.when(F.col("p_size") % 3 == 0, cell(F.lit("up"), F.lit("up"), "ADP", "RP", "prt", root + 1)).otherwise(none),
        F.when(F.col("p_size") % 5 == 0, cell(F.lit("on"), F.lit("on"), "ADP", "IN", "prep", root + 1)).otherwise(none),
    )
    line = line.withColumns({"cells": F.filter(cells, lambda c: c.isNotNull()), "root": root})
    before = Window.partitionBy("caption_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("at", F.coalesce(F.sum(F.size("cells")).over(before), F.lit(0)).cast("int"))
    rows = line.groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("n", "at", "root", "cells"))).alias("l"))
    tokens = F.flatten(
        F.transform(
            "l",
            lambda x: F.transform(
                x.cells,
                lambda c, i: F.struct((x["at"] + i).cast("int").alias("i"), c.text.alias("text"), c.lemma.alias("lemma"), c.pos.alias("pos"), c.tag.alias("tag"), F.lit("").alias("morph"), c.dep.alias("dep"), (x["at"] + c["head"]).cast("int").alias("head_i"), F.lit("").alias("head_text"), F.lit(0).alias("char_start"), F.lit(0).alias("char_end"), F.lit(" ").alias("whitespace")),
            ),
        )
    ).cast(f"array<{_TOKEN}>")
    tag = F.col("caption_id").cast("bigint") % 3 == 0
    rows = rows.withColumns({"tokens": tokens, "caption_shape": F.when(tag, "tag_list").otherwise("sentence")})
    chunk = lambda x: F.struct(
        F.lit("").alias("text"), (x["at"] + x.root).cast("int").alias("root_i"), *(F.lit("").alias(n) for n in ("root_text", "root_lemma", "root_pos", "root_tag", "root_dep")), F.lit(0).alias("root_head_i"), F.lit("").alias("root_head_text"),
        x["at"].cast("int").alias("token_start"), (x["at"] + x.root + 1).cast("int").alias("token_end"), F.lit(0).alias("char_start"), F.lit(0).alias("char_end"),
    )
    segment = lambda x: F.struct(F.concat(F.lit("t"), x.n - 1).alias("segment_id"), F.lit("").alias("raw_text"), F.lit("").alias("text"), F.lit(0).alias("char_start"), F.lit(0).alias("char_end"), x["at"].cast("int").alias("token_start"), (x["at"] + x.root + 1).cast("int").alias("token_end"))
    out = rows.select("caption_id", F.array_join(F.transform("tokens", lambda t: t.text), " ").alias("caption"), "caption_shape", "tokens", F.transform("l", chunk).alias("noun_chunks"), F.when(tag, F.transform("l", segment)).otherwise(F.array()).alias("tag_segments"))
    kinds = dict(x.split(" ", 1) for x in _fields(ANNOTATED))
    return out.select(*(F.col(c).cast(kinds[c]).alias(c) for c in out.columns))


def _fields(schema: str) -> list[str]:
    """The columns of a schema string, those inside structs left whole."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


# A lexicon for the words of the captions. form, pos, synset:
LEMMAS = [
    ("small", "a", "a-small"), ("large", "a", "a-large"), ("large", "n", "n-large"), ("medium", "a", "a-medium"), ("medium", "a", "a-middle"), ("economies", "n", "n-savings"), ("economy", "n", "n-economy"),
    ("standards", "n", "n-standard"), ("standard", "n", "n-standard"), ("red", "n", "n-red"), ("red", "a", "a-red"), ("blue", "n", "n-blues"), ("hot", "a", "a-hot"), ("hot", "a", "a-spicy"), ("olden", "a", "a-olden"), ("newn", "n", "n-new"),
    ("small hot", "a", "p-exact"), ("large-red", "a", "p-hyphen"), ("medium_olden", "a", "p-base"), ("large blue", "a", "p-out"), ("economies new", "n", "p-doubtful"), ("small new widget", "n", "o-widget"), ("large_old_gizmo", "n", "o-gizmo"),
    ("hold", "v", "v-hold"), ("hold up", "v", "v-holdup"), ("carry", "v", "v-carry"), ("carry", "v", "v-bear"), ("carry on", "v", "v-goon"), ("lift", "v", "v-lift"), ("lif", "v", "v-lif"), ("lift up on", "v", "v-liftupon"),
]
# form, pos, base form:
MORPHY = [("economies", "n", "economy"), ("standards", "n", "standard"), ("old", "a", "olden"), ("new", "a", "newa"), ("new", "n", "newn"), ("widgets", "n", "widget"), ("holds", "v", "hold"), ("carries", "v", "carry"), ("lifts", "v", "lift"), ("lifts", "v", "lif")]
# synset, lexicographer file; all others are adj.all:
LEXFILES = {"n-large": "noun.attribute", "n-savings": "noun.act", "n-economy": "noun.attribute", "n-standard": "noun.attribute", "n-red": "noun.act", "n-blues": "noun.act", "n-new": "noun.state", "p-doubtful": "noun.animal", "o-widget": "noun.attribute", "o-gizmo": "noun.artifact"}
# synset, lemma, count:
COUNTS = [("a-large", "large", 5), ("n-large", "large", 2), ("a-medium", "medium", 3), ("a-middle", "medium", 3), ("n-red", "red", 9), ("a-red", "red", 1), ("v-carry", "carry", 2), ("v-bear", "carry", 2)]
# earlier decisions on attributes: unit, span_key, decision_status, selected, lexfile, canonical_surface
PRIOR = [("single_token", "small", "chosen", "a-tiny", "adj.all", "tiny"), ("mwe", "large blue", "excluded", "", "", ""), ("single_token", "hot", "needs_manual", "a-hot", "adj.all", "hot")]
# earlier decisions on actions by key, and by query
BY_KEY, BY_QUERY = [("spins up", "v-spinup"), ("holds on", "")], [("carry", "v-bear"), ("lif", "v-lif"), ("hold", "v-other")]

# the nouns: form, synset, lexicographer file, count; base forms; earlier rows
NOUN_SENSES = [("ring", "n-ring", "noun.artifact", 0), ("red ring", "n-redring", "noun.artifact", 0), ("gear", "n-gear", "noun.artifact", 3), ("gear", "n-stuff", "noun.artifact", 1), ("widget", "n-widget", "noun.artifact", 0), ("widget", "n-thing", "noun.artifact", 0), ("plate", "n-plating", "noun.act", 0), ("bolt", "n-bolt", "noun.artifact", 0)]
NOUN_BASES = [("gears", "n", "gear")]
NOUN_PRIOR = [("bolt", "chosen", "n-screw", "noun.artifact", "by_hand"), ("old rod", "excluded", None, None, "by_hand")]
# synset, lemma, and the frequency of names in n-grams: synset, surface_key, mean_frequency
NAMES = {
    "a-tiny": "tiny|small", "a-large": "large|big", "n-standard": "standard|criterion", "a-red": "red|reddish", "p-hyphen": "large-red|large_red", "p-exact": "small hot|small-hot", "p-base": "medium-olden|medium olden", "a-olden": "olden",
    "n-new": "novel|fresh", "v-hold": "hold|keep", "v-holdup": "hold_up", "v-bear": "bear|carry", "v-goon": "carry on|go on", "v-lif": "lif|lift", "v-spinup": "spin up|spins up",
}
NAME_COUNTS = [("p-hyphen", "large-red", 4), ("p-hyphen", "large_red", 1), ("p-exact", "small hot", 2), ("p-exact", "small-hot", 2), ("v-lif", "lif", 1), ("v-lif", "lift", 1)]
NGRAMS = [("n-new", "novel", 0.5), ("n-new", "fresh", 0.25), ("p-base", "medium-olden", 0.5), ("p-base", "medium olden", 0.5)]


def lexicon(spark: SparkSession) -> dict[str, DataFrame]:
    """The lexicon as dimension tables."""
    make = spark.createDataFrame
    senses = sorted({s for *_, s in LEMMAS})
    objects = [(k, k, k, "", "", [], [], [], f"s-{k}", "noun.artifact") for k in (*NOUNS, "red ring")]
    return {
        "lemmas": make(LEMMAS, "form string, pos string, synset string"),
        "morphy": make(MORPHY, "form string, pos string, lemma string"),
        "synsets": make([(s, LEXFILES.get(s, "adj.all")) for s in senses], "synset string, lexfile string"),
        "sense_counts": make(COUNTS, "synset string, lemma string, n int"),
        "prior": make(PRIOR, "unit string, span_key string, decision_status string, selected string, lexfile string, canonical_surface string"),
        "by_key": make(BY_KEY, "key string, synset string"),
        "by_query": make(BY_QUERY, "key string, synset string"),
        "objects": make(objects, "key string, query string, canonical_surface string, canonical_label_key string, canonical_selection_tag string, synset_lemmas array<string>, parent_lemmas array<string>, parent_synset_ids array<string>, selected_synset string, selected_lexfile string"),
        "synset_lemmas": make([(k, w) for k, v in NAMES.items() for w in v.split("|")], "synset string, lemma string"),
        "name_counts": make(NAME_COUNTS, "synset string, lemma string, n int"),
        "ngrams": make(NGRAMS, "synset string, surface_key string, mean_frequency double"),
        "prepositions": make([("up on", 2)], "key string, width int"),
    }


#: Chunks in SQL: caption_id, n, tag, first (quantity), flag, t1, t2, noun, plural, known, whole ('red ring').
CHUNK_SQL = f"""{adapters.GRAPH_SQL.split("ord AS (")[0].rstrip().rstrip(",")},
chunk AS (
  SELECT caption_id, n, cast(caption_id AS BIGINT) % 3 = 0 AS tag, l_linestatus = 'F' AS first, l_returnflag AS flag, p_size,
         CASE p_type WHEN 'ECONOMY' THEN 'economies' WHEN 'STANDARD' THEN 'standards' ELSE lower(p_type) END AS t1, p_type IN ('ECONOMY', 'STANDARD') AS plural,
         string_split(p_name, ' ')[1] AS t2, string_split(p_name, ' ')[2] AS base, string_split(p_name, ' ')[2] || CASE WHEN cast(quantity AS INTEGER) > 25 THEN 's' ELSE '' END AS noun,
         string_split(p_name, ' ')[2] IN ('ring', 'bolt', 'gear', 'plate') AS known, p_name = 'red ring' AND l_returnflag <> 'R' AS whole
  FROM line)"""

#: The decisions on all words that have any, written by hand: unit, span_key, lookup_case, query, synsets, selected, tag, gate, status, reason, forms, canonical.
ANSWERS = """answer(unit, span_key, lookup_case, query, synsets, selected, tag, gate, decision_status, decision_reason, lookup_forms, canonical_surface) AS (VALUES
 ('single_token', 'small', 'prior_attribute', 'small', 'a-small', 'a-tiny', 'prior_decision', 'attribute_compatible', 'chosen', 'prior_decision_reused', '', 'tiny'),
 ('single_token', 'large', 'exact', 'large', 'a-large|n-large', 'a-large', 'selected_by_wn30_attribute_compatible_lemma_count', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', '', ''),
 ('single_token', 'medium', 'exact', 'medium', 'a-medium|a-middle', '', 'ambiguous_attribute_compatible_wn30_tie', '', 'needs_manual', 'manual_synset_required', '', ''),
 ('single_token', 'economies', 'surface_query_conflict', 'economies|economy', 'n-savings|n-economy', '', 'ambiguous_observed_vs_surface_changed_query', '', 'needs_manual', 'manual_surface_query_conflict_required', '', ''),
 ('single_token', 'standards', 'exact', 'standards', 'n-standard', 'n-standard', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', '', ''),
 ('single_token', 'promo', 'unresolved', 'promo', '', '', 'unresolved_no_oewn_attribute_synset', '', 'chosen', 'no_oewn_attribute_synset', '', ''),
 ('single_token', 'red', 'exact', 'red', 'a-red|n-red', 'a-red', 'selected_by_wn30_attribute_compatible_lemma_count', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', '', ''),
 ('single_token', 'blue', 'exact', 'blue', 'n-blues', 'n-blues', 'single_oewn_attribute_synset', 'conditional', 'needs_manual', 'manual_attribute_gate_required', '', ''),
 ('single_token', 'hot', 'exact', 'hot', 'a-hot|a-spicy', '', 'ambiguous_wn30_all_zero_or_mapping_missing', '', 'needs_manual', 'manual_synset_required', '', ''),
 ('single_token', 'cold', 'unresolved', 'cold', '', '', 'unresolved_no_oewn_attribute_synset', '', 'chosen', 'no_oewn_attribute_synset', '', ''),
 ('single_token', 'old', 'morphy_a', 'olden', 'a-olden', 'a-olden', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', '', ''),
 ('single_token', 'new', 'morphy_n', 'newn', 'n-new', 'n-new', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', '', ''),
 ('mwe', 'small hot', 'mwe_exact', 'small hot', 'p-exact', 'p-exact', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', 'small hot', ''),
 ('mwe', 'large red', 'mwe_hyphen_variant', 'large-red', 'p-hyphen', 'p-hyphen', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', 'large red|large-red', ''),
 ('mwe', 'medium old', 'mwe_anchor_morphy_underscore', 'medium_olden', 'p-base', 'p-base', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', 'medium old|medium-old|medium_old|medium olden|medium-olden|medium_olden', ''),
 ('mwe', 'large blue', 'prior_attribute', 'large blue', 'p-out', '', 'prior_decision', '', 'excluded', 'prior_decision_reused', 'large blue', ''),
 ('mwe', 'economies new', 'mwe_exact', 'economies new', 'p-doubtful', 'p-doubtful', 'single_oewn_attribute_synset', 'conditional', 'needs_manual', 'manual_attribute_gate_required', 'economies new', ''),
 ('mwe', 'small new widget', 'mwe_exact', 'small new widget', 'o-widget', 'o-widget', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', 'small new widget', ''),
 ('mwe', 'small new widgets', 'mwe_anchor_morphy_space', 'small new widget', 'o-widget', 'o-widget', 'single_oewn_attribute_synset', 'attribute_compatible', 'chosen', 'selected_attribute_compatible', 'small new widgets|small-new-widgets|small_new_widgets|small new widget', ''),
 ('mwe', 'large old gizmo', 'mwe_underscore_variant', 'large_old_gizmo', 'o-gizmo', 'o-gizmo', 'single_oewn_attribute_synset', 'conditional', 'needs_manual', 'manual_attribute_gate_required', 'large old gizmo|large-old-gizmo|large_old_gizmo', ''))"""

_DECISION = ("lookup_case", "query", "synsets", "selected", "tag", "gate", "decision_status", "decision_reason", "lookup_forms", "canonical_surface")


def _flat(rows: DataFrame, *keys: str) -> DataFrame:
    lists = {c for c, t in rows.dtypes if t.startswith("array")}
    return rows.select(*keys, *((F.array_join(c, "|") if c in lists else F.coalesce(c, F.lit(""))).alias(c) for c in _DECISION if c in rows.columns))


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct type, name and size of the parts that lines have: few rows, made once for all branches of a look-up."""
    used = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    part = adapters.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_size")
    return _cut(part.join(used, "p_partkey", "left_semi").select("p_type", "p_name", "p_size").distinct())


def _lookup(spark: SparkSession):
    lex = lexicon(spark)
    return partial(builders.attribute_lookup, **{k: lex[k] for k in ("lemmas", "morphy", "synsets", "sense_counts", "prior")})


@query(
    "attribute_inventory",
    f"""WITH {CHUNK_SQL}, {ANSWERS},
phrase AS (SELECT *, t1 || ' ' || t2 AS k FROM chunk WHERE known AND NOT whole AND flag = 'N'),
blocked AS (SELECT caption_id, n FROM phrase WHERE k IN ('small hot', 'large red', 'medium old', 'economies new')),
single AS (
  SELECT caption_id, n, t1 AS k, 1 AS place FROM chunk WHERE known
  UNION ALL SELECT caption_id, n, t2, 2 FROM chunk WHERE known AND NOT whole AND flag <> 'R'),
loose AS (SELECT caption_id, n, t1 || ' ' || t2 || ' ' || noun AS k FROM chunk WHERE tag AND NOT known AND NOT first),
unit AS (
  SELECT mode, 'mwe' AS unit, caption_id, k FROM (SELECT caption_id, n, k FROM phrase UNION ALL SELECT caption_id, n, k FROM loose), (VALUES ('all'), ('mwe_only')) m(mode) WHERE k IN (SELECT span_key FROM answer WHERE unit = 'mwe')
  UNION ALL SELECT 'all', 'single_token', caption_id, k FROM single ANTI JOIN blocked USING (caption_id, n)
  UNION ALL SELECT 'single_token_only', 'single_token', caption_id, k FROM single)
SELECT mode, unit, k AS span_key, len(string_split(k, ' '))::INTEGER AS span_token_count, (len(string_split(k, ' ')) - 1)::INTEGER AS anchor_token_offset, k AS observed_surface, k AS example_surfaces, count(*) AS observed_count,
       count(DISTINCT caption_id) AS caption_count, array_to_string(list_slice(list_sort(list(DISTINCT caption_id)), 1, 5), '|') AS example_caption_ids, {", ".join(f"min(a.{c}) AS {c}" for c in _DECISION)}
FROM unit u JOIN answer a USING (unit) WHERE a.span_key = k GROUP BY mode, unit, k""",
)
def attribute_inventory(spark, sf_dir):
    cut, lex = adapters.kept(adapters.buckets_of(spark, sf_dir)), lexicon(spark)
    annotated = cut(captions(spark, sf_dir))
    found = []
    for mode, rows in builders.attribute_inventories(annotated, lex["objects"], lex["prepositions"], _lookup(spark), cut=cut).items():
        found.append(_flat(rows, F.lit(mode).alias("mode"), "unit", "span_key", "span_token_count", "anchor_token_offset", "observed_surface", "example_surfaces", "observed_count", "caption_count", "example_caption_ids"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "attribute_lookup",
    f"""WITH {CHUNK_SQL}, {ANSWERS},
asked AS (SELECT DISTINCT 'single_token' AS unit, unnest([t1, t2]) AS span_key FROM chunk UNION SELECT 'mwe', t1 || ' ' || t2 FROM chunk),
base AS (SELECT * FROM (VALUES ('old', ['olden']), ('new', ['newa', 'newn']), ('hot', []), ('cold', []), ('red', []), ('blue', []), ('small', []), ('large', [])) b(word, bases))
SELECT unit, a.span_key, coalesce(x.lookup_case, 'unresolved') AS lookup_case, coalesce(x.query, a.span_key) AS query, coalesce(x.synsets, '') AS synsets, coalesce(x.selected, '') AS selected,
       coalesce(x.tag, 'unresolved_no_oewn_attribute_mwe_synset') AS tag, coalesce(x.gate, '') AS gate, coalesce(x.decision_status, 'chosen') AS decision_status, coalesce(x.decision_reason, 'no_oewn_attribute_synset') AS decision_reason,
       coalesce(x.lookup_forms, array_to_string(flatten(list_transform(list_prepend(string_split(a.span_key, ' ')[2], bases), lambda w: [string_split(a.span_key, ' ')[1] || ' ' || w, string_split(a.span_key, ' ')[1] || '-' || w, string_split(a.span_key, ' ')[1] || '_' || w])), '|')) AS lookup_forms,
       coalesce(x.canonical_surface, '') AS canonical_surface
FROM asked a LEFT JOIN answer x USING (unit, span_key) LEFT JOIN base ON word = string_split(a.span_key, ' ')[2]""",
)
def attribute_lookup(spark, sf_dir):
    """Every type and name word, and every pair of them, looked up; types that are plural as such."""
    part = _kinds(spark, sf_dir).select("p_type", "p_name").distinct()
    t1 = F.expr("CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in TYPES.items()) + " ELSE lower(p_type) END")
    t2 = F.split("p_name", " ")[0]
    single = F.lit(builders.SINGLE).alias("unit")
    asked = part.select(single, t1.alias("span_key"), F.col("p_type").isin(*TYPES).alias("plural")).unionByName(part.select(single, t2.alias("span_key"), F.lit(False).alias("plural")))
    asked = asked.unionByName(part.select(F.lit(builders.PHRASE).alias("unit"), F.concat_ws(" ", t1, t2).alias("span_key"), F.lit(False).alias("plural")))
    return _flat(_lookup(spark)(asked), "unit", "span_key")


@query(
    "action_inventory",
    f"""WITH {CHUNK_SQL},
verb AS (SELECT caption_id, n, ['holds', 'carries', 'lifts', 'spins'][p_size % 4 + 1] AS v, p_size % 3 = 0 AND (p_size % 5 <> 0 OR tag) AS up, p_size % 5 = 0 AND (p_size % 3 <> 0 OR tag) AS onto FROM chunk),
pick AS (SELECT caption_id, CASE WHEN v = 'lifts' AND up AND onto THEN 'lifts up on' WHEN v IN ('holds', 'spins') AND up THEN v || ' up' WHEN v = 'carries' AND onto THEN 'carries on' ELSE v END AS k FROM verb),
answer(k, candidate_types, lookup_case, query, synsets, selected, tag, decision_status, decision_reason) AS (VALUES
 ('holds', 'verb_token', 'head_morphy', 'hold', 'v-hold', 'v-hold', 'single_oewn_verb_synset', 'chosen', 'selected_verb_synset'),
 ('holds up', 'verb_prt', 'head_morphy', 'hold up', 'v-holdup', 'v-holdup', 'single_oewn_verb_synset', 'chosen', 'selected_verb_synset'),
 ('carries', 'verb_token', 'head_morphy_prior_selected_query', 'carry', 'v-bear|v-carry', 'v-bear', 'selected_by_prior_action_selected_query', 'chosen', 'prior_action_selected_query_reused'),
 ('carries on', 'verb_prep', 'head_morphy', 'carry on', 'v-goon', 'v-goon', 'single_oewn_verb_synset', 'chosen', 'selected_verb_synset'),
 ('lifts', 'verb_token', 'head_morphy_ambiguous_prior_selected_query', 'lif', 'v-lif|v-lift', 'v-lif', 'selected_by_prior_action_selected_query', 'chosen', 'prior_action_selected_query_reused'),
 ('lifts up on', 'verb_prt_prep', 'head_morphy', 'lift up on', 'v-liftupon', 'v-liftupon', 'single_oewn_verb_synset', 'chosen', 'selected_verb_synset'),
 ('spins', 'verb_token', 'raw_fallback', 'spins', '', '', 'unresolved_no_oewn_verb_synset', 'raw_fallback', 'no_oewn_verb_synset'),
 ('spins up', 'verb_prt', 'prior_action', 'spins up', 'v-spinup', 'v-spinup', 'prior_decision', 'chosen', 'prior_decision_reused'))
SELECT k AS span_key, k AS observed_surface, k AS example_surfaces, count(*) AS observed_count, count(DISTINCT caption_id) AS caption_count, array_to_string(list_slice(list_sort(list(DISTINCT caption_id)), 1, 5), '|') AS example_caption_ids,
       min(a.candidate_types) AS candidate_types, min(a.lookup_case) AS lookup_case, min(a.query) AS query, min(a.synsets) AS synsets, min(a.selected) AS selected, min(a.tag) AS tag, min(a.decision_status) AS decision_status, min(a.decision_reason) AS decision_reason
FROM pick JOIN answer a USING (k) GROUP BY k""",
)
def action_inventory(spark, sf_dir):
    lex = lexicon(spark)
    lookup = partial(builders.action_lookup, **{k: lex[k] for k in ("lemmas", "morphy", "sense_counts", "by_key", "by_query")})
    cut = adapters.kept(adapters.buckets_of(spark, sf_dir))
    rows = builders.action_inventory(cut(captions(spark, sf_dir)), lex["prepositions"], lookup, cut)
    return _flat(rows, "span_key", "observed_surface", "example_surfaces", "observed_count", "caption_count", "example_caption_ids", "candidate_types")


@query(
    "canonical_variants",
    f"""WITH {CHUNK_SQL},
asked AS (SELECT DISTINCT 'attribute' AS kind, unnest([t1, t2, t1 || ' ' || t2]) AS span_key FROM chunk
          UNION SELECT 'action', unnest([v, v || ' up', v || ' on', v || ' up on']) FROM (SELECT DISTINCT ['holds', 'carries', 'lifts', 'spins'][p_size % 4 + 1] AS v FROM chunk)),
named(kind, span_key, canonical_surface, canonical_selection_tag, candidate_lemmas, blocker_reason) AS (VALUES
 ('attribute', 'small', 'small', 'selected_single_observed_variant_matched_synset_lemma', 'small', ''), ('attribute', 'large', 'large', 'selected_single_observed_variant_matched_synset_lemma', 'large', ''),
 ('attribute', 'standards', 'standard', 'selected_single_observed_variant_matched_synset_lemma', 'standard', ''), ('attribute', 'red', 'red', 'selected_single_observed_variant_matched_synset_lemma', 'red', ''),
 ('attribute', 'old', 'olden', 'selected_single_observed_variant_matched_synset_lemma', 'olden', ''), ('attribute', 'new', 'novel', 'selected_by_google_ngram_frequency_unique_max', '', ''),
 ('attribute', 'large red', 'large-red', 'selected_by_wn30_lemma_count_unique_positive_max', 'large-red|large_red', ''), ('attribute', 'small hot', 'small hot', 'selected_by_unique_observed_span_surface', 'small hot|small-hot', ''),
 ('attribute', 'medium old', '', 'ambiguous_wn30_mapping_missing_google_ngram_tie', 'medium olden|medium-olden', ''), ('attribute', 'large blue', '', 'not_applicable_excluded', '', ''),
 ('attribute', 'medium', '', '', '', 'pending_attribute_manual_decision_status'), ('attribute', 'economies', '', '', '', 'pending_attribute_manual_decision_status'), ('attribute', 'blue', '', '', '', 'pending_attribute_manual_decision_status'),
 ('attribute', 'hot', '', '', '', 'pending_attribute_manual_decision_status'), ('attribute', 'economies new', '', '', '', 'pending_attribute_manual_decision_status'),
 ('action', 'holds', 'hold', 'selected_single_observed_variant_matched_synset_lemma', 'hold', ''), ('action', 'holds up', 'hold_up', 'selected_single_observed_variant_matched_synset_lemma', 'hold_up', ''),
 ('action', 'carries', 'carry', 'selected_single_observed_variant_matched_synset_lemma', 'carry', ''), ('action', 'carries on', 'carry on', 'selected_single_observed_variant_matched_synset_lemma', 'carry on', ''),
 ('action', 'lifts', '', 'ambiguous_wn30_tie_google_ngram_evidence_missing', 'lif|lift', ''), ('action', 'lifts up on', '', 'ambiguous_selected_synset_lookup_error', '', ''),
 ('action', 'spins up', 'spins up', 'selected_single_observed_variant_matched_synset_lemma', 'spins up', ''))
SELECT kind, span_key, coalesce(canonical_surface, '') AS canonical_surface, coalesce(candidate_lemmas, '') AS candidate_lemmas, coalesce(blocker_reason, '') AS blocker_reason,
       coalesce(canonical_selection_tag, CASE kind WHEN 'action' THEN 'not_applicable_raw_fallback_no_selected_synset' ELSE 'not_applicable_no_selected_synset' END) AS canonical_selection_tag
FROM asked LEFT JOIN named USING (kind, span_key)""",
)
def canonical_variants(spark, sf_dir):
    """Names of all attributes and verb phrases that the lines' words make, and the rows that stand in the way."""
    lex = lexicon(spark)
    part = _kinds(spark, sf_dir)
    t1 = F.expr("CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in TYPES.items()) + " ELSE lower(p_type) END")
    t2 = F.split("p_name", " ")[0]
    single = F.lit(builders.SINGLE).alias("unit")
    asked = part.select(single, t1.alias("span_key"), F.col("p_type").isin(*TYPES).alias("plural")).unionByName(part.select(single, t2.alias("span_key"), F.lit(False).alias("plural")))
    asked = asked.unionByName(part.select(F.lit(builders.PHRASE).alias("unit"), F.concat_ws(" ", t1, t2).alias("span_key"), F.lit(False).alias("plural")))
    verb = F.element_at(F.array(*map(F.lit, VERBS)), F.col("p_size") % 4 + 1)
    verbs = part.select(F.explode(F.array(verb, F.concat(verb, F.lit(" up")), F.concat(verb, F.lit(" on")), F.concat(verb, F.lit(" up on")))).alias("key"))
    actions = builders.action_lookup(verbs, **{k: lex[k] for k in ("lemmas", "morphy", "sense_counts", "by_key", "by_query")}).withColumnRenamed("key", "span_key").withColumn("unit", F.lit(""))
    found = []
    for kind, rows in (("attribute", _lookup(spark)(asked)), ("action", actions)):
        rows = _cut(rows.withColumns({"observed_surface": F.col("span_key"), "example_surfaces": F.col("span_key")}))
        blocked = builders.canonical_blockers(rows, kind)
        named = builders.canonical_variants(rows.join(blocked, "span_key", "left_anti"), kind, ["unit", "span_key"], lex["synset_lemmas"], lex["name_counts"], lex["morphy"], lex["ngrams"])
        out = named.select("span_key", "canonical_surface", "canonical_selection_tag", F.array_join("candidate_lemmas", "|").alias("candidate_lemmas"), F.lit("").alias("blocker_reason"))
        blank = F.lit("")
        found.append(out.unionByName(blocked.select("span_key", blank.alias("canonical_surface"), blank.alias("canonical_selection_tag"), blank.alias("candidate_lemmas"), "blocker_reason")).withColumn("kind", F.lit(kind)))
    return found[0].unionByName(found[1])


@query(
    "object_inventory",
    f"""WITH {CHUNK_SQL},
pick AS (
  SELECT caption_id, CASE WHEN base = 'ring' AND t2 = 'red' AND flag <> 'R' THEN 'red ' || noun WHEN noun = 'rod' AND t2 = 'old' AND flag <> 'R' THEN 'old rod' ELSE noun END AS k, base FROM chunk),
answer(k, lookup_case, query, synsets, selected, tag, gate, decision_status, decision_reason, reused) AS (VALUES
 ('ring', 'exact', 'ring', 'n-ring', 'n-ring', 'single_synset', 'object_compatible', 'chosen', 'selected_object_compatible', false), ('rings', 'exact', 'ring', 'n-ring', 'n-ring', 'single_synset', 'object_compatible', 'chosen', 'selected_object_compatible', false),
 ('red ring', 'exact', 'red ring', 'n-redring', 'n-redring', 'single_synset', 'object_compatible', 'chosen', 'selected_object_compatible', false), ('red rings', 'exact', 'red ring', 'n-redring', 'n-redring', 'single_synset', 'object_compatible', 'chosen', 'selected_object_compatible', false),
 ('gear', 'exact', 'gear', 'n-gear|n-stuff', 'n-gear', 'max_sense_count', 'object_compatible', 'chosen', 'selected_object_compatible', false), ('gears', 'morphy', 'gear', 'n-gear|n-stuff', 'n-gear', 'max_sense_count', 'object_compatible', 'chosen', 'selected_object_compatible', false),
 ('widget', 'exact', 'widget', 'n-thing|n-widget', '', 'ambiguous', '', 'needs_manual', 'manual_synset_required', false), ('widgets', 'exact', 'widget', 'n-thing|n-widget', '', 'ambiguous', '', 'needs_manual', 'manual_synset_required', false),
 ('plate', 'exact', 'plate', 'n-plating', 'n-plating', 'single_synset', 'hard_conflict', 'needs_manual', 'manual_objectness_required', false), ('plates', 'exact', 'plate', 'n-plating', 'n-plating', 'single_synset', 'hard_conflict', 'needs_manual', 'manual_objectness_required', false),
 ('bolt', '', '', '', 'n-screw', '', '', 'chosen', 'by_hand', true), ('bolts', 'exact', 'bolt', 'n-bolt', 'n-bolt', 'single_synset', 'object_compatible', 'chosen', 'selected_object_compatible', false),
 ('old rod', '', '', '', '', '', '', 'excluded', 'by_hand', true))
SELECT (row_number() OVER (ORDER BY count(*) DESC, k))::INTEGER AS position, k AS span_key, k AS observed_surface, count(*) AS observed_count, count(DISTINCT caption_id) AS caption_count, array_to_string(list_slice(list_sort(list(DISTINCT caption_id)), 1, 5), '|') AS example_caption_ids,
       coalesce(min(a.lookup_case), 'unresolved') AS lookup_case, coalesce(min(a.query), '') AS query, coalesce(min(a.synsets), '') AS synsets, coalesce(min(a.selected), '') AS selected, coalesce(min(a.tag), 'unresolved_no_oewn_noun_synset') AS tag,
       coalesce(min(a.gate), '') AS gate, coalesce(min(a.decision_status), 'excluded') AS decision_status, coalesce(min(a.decision_reason), 'no_oewn_noun_synset') AS decision_reason, coalesce(bool_or(a.reused), false) AS reused
FROM pick LEFT JOIN answer a USING (k) GROUP BY k""",
)
def object_inventory(spark, sf_dir):
    """Objects of all captions with earlier rows, senses or their root alone, in the order of files."""
    from pyspark.sql import Window

    make = spark.createDataFrame
    lemmas = make([(f, "n", s) for f, s, *_ in NOUN_SENSES], "form string, pos string, synset string")
    synsets = make(sorted({(s, lex) for _, s, lex, _ in NOUN_SENSES}), "synset string, lexfile string")
    uses = make([(s, f, n) for f, s, _, n in NOUN_SENSES], "synset string, lemma string, n int")
    morphy = make(NOUN_BASES, "form string, pos string, lemma string")
    prior = make(NOUN_PRIOR, "key string, decision_status string, selected string, lexfile string, decision_reason string")
    lookup = partial(builders.object_lookup, lemmas=lemmas, morphy=morphy, synsets=synsets, sense_counts=uses)
    cut = adapters.kept(adapters.buckets_of(spark, sf_dir))
    rows = _cut(builders.ordered(builders.object_inventory(cut(captions(spark, sf_dir)), lookup, prior, cut)))
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))  # a row for each noun of the lexicon
    return _flat(rows.withColumn("position", place), "position", "span_key", "observed_surface", "observed_count", "caption_count", "example_caption_ids", "reused")
