"""Raw concept graphs from annotated captions, inside each caption where the lexicons are small, else by joins on (caption, token).

Of the joins, every step is a table keyed by caption_id, so after the first exchange on it the steps share one partitioning. Steps run in an order
that matters, because later ones leave alone the tokens that earlier ones took: prepositional phrases, objects with their modifiers,
phrase relations, actions, roles, inherited agents, single prepositions. Ids are given at the very end, in the order of
emission, by one window over the caption.

The lexicons are dimension tables (see sources.lexicons). A lexicon row that still needs a decision fails the job before
extraction begins. Token numbers are places in the caption's token array."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_query, separator_key, surface_variant_keys
from ..schema import MISSING_SOURCE, MISSING_TARGET, RAW_EDGE, RAW_MENTION
from . import caption_graph
from .fold import closure, dimension, first_per_key, greedy_spans, longest_spans

# Dependencies and parts of speech that the rules name.
BLOCKED_START_DEPS = ("case", "cc", "det", "mark", "punct")
BLOCKED_START_POS = ("ADP", "CCONJ", "DET", "PART", "PRON", "PUNCT", "SCONJ", "SPACE", "SYM")
ATTRIBUTE_DEPS = ("amod", "compound", "nmod")
QUANTITY_DEPS = ("nummod",)
PATIENT_DEPS = ("obj", "dobj")
PASSIVE_SUBJECT_DEPS = ("nsubjpass", "csubjpass")
PASSIVE_BY_DEPS = ("agent", "prep")
PASSIVE_SIGNS = ("nsubjpass", "auxpass", "agent")
MWE_BOUNDARY_DEPS = ("cc", "punct")
MWE_BOUNDARY_POS = ("CCONJ", "PUNCT", "SPACE")
FLOATING_POS = ("ADJ", "ADV")
FLOATING_TAGS = ("JJ", "JJR", "JJS", "VBG", "VBN")


@dataclass
class Lexicons:
    """The dimension tables of extraction.

    objects: key, query, canonical_surface, canonical_label_key, canonical_selection_tag, synset_lemmas[], parent_lemmas[],
    parent_synset_ids[], selected_synset, selected_lexfile · actions: key, query, synset · action_queries: key, synset ·
    attribute_phrases: key, span_key, canonical_surface · prepositions: key, width, canonical_relation, components[], initial_offset, final_offset"""

    objects: DataFrame
    actions: DataFrame
    action_queries: DataFrame
    attribute_phrases: DataFrame
    prepositions: DataFrame


def _key(*parts: Column | str) -> Column:
    return F.concat_ws("_", *parts)


def _order(*parts) -> Column:
    """The place of an emission: a phase, then up to five numbers."""
    cells = [p if isinstance(p, Column) else F.col(p) if isinstance(p, str) else F.lit(p) for p in parts]
    return F.array(*(c.cast("int") for c in cells))


def _is_quantity() -> Column:
    return F.col("dep").isin(*QUANTITY_DEPS) | (F.col("pos") == "NUM")


def tokens_of(annotated: DataFrame) -> DataFrame:
    return annotated.select("caption_id", "caption_shape", F.inline("tokens"))


def children(tokens: DataFrame) -> DataFrame:
    """(caption_id, parent, child…): each token under its head; a token that is its own head is under none."""
    return tokens.where("i <> head_i").select("caption_id", F.col("head_i").alias("parent"), *(F.col(c).alias(f"c_{c}") for c in ("i", "text", "lemma", "pos", "tag", "dep")))


def preposition_matches(annotated: DataFrame, prepositions: DataFrame) -> DataFrame:
    """caption_id, start, end, key…: phrases of the lexicon in sentences, longest first, then earliest, none overlapping.

    Only widths that the lexicon has are looked up."""
    widths = sorted(r["width"] for r in prepositions.select("width").distinct().collect())  # a few numbers
    if not widths:
        widths = [2]
    sentence = annotated.where("caption_shape = 'sentence'").select("caption_id", F.transform("tokens", lambda t: F.lower(t.text)).alias("w"))

    def grams(k: int) -> Column:
        starts = F.when(F.size("w") >= k, F.sequence(F.lit(0), F.size("w") - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(s.alias("start"), (s + k).alias("end"), F.array_join(F.slice(F.col("w"), s + 1, k), " ").alias("key")))

    found = sentence.select("caption_id", F.inline(F.concat(*map(grams, widths)))).join(dimension(prepositions), "key")
    return longest_spans(found, ["caption_id"], "start", "end")


def _surface(tokens: Column, field: str = "text") -> Column:
    return F.array_join(F.transform(tokens, lambda t: t[field]), " ")


def _written(tokens: Column) -> Column:
    """Tokens as they stand in the caption."""
    return F.trim(F.array_join(F.transform(tokens, lambda t: F.concat(t.text, F.coalesce(t.whitespace, F.lit("")))), ""))


def _core(tokens: Column, groups: list[Column]) -> Column:
    """Places (from, to) in ``tokens`` of the longest suffix whose text or lemmas are among the candidates of the first group that matches; all without a match."""
    n = F.size(tokens)

    def of(candidates: Column) -> Column:
        keys = F.array_distinct(F.flatten(F.transform(candidates, surface_variant_keys)))
        suffix = lambda j: F.slice(tokens, j + 1, n - j)
        hits = F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.arrays_overlap(F.concat(surface_variant_keys(_surface(suffix(j))), surface_variant_keys(_surface(suffix(j), "lemma"))), keys))
        return F.when(F.size(candidates) > 0, F.get(hits, F.lit(0)))

    return F.coalesce(*(of(g) for g in groups), F.lit(0))


def object_spans(annotated: DataFrame, objects: DataFrame) -> DataFrame:
    """For each noun chunk its best object: the longest span up to the root that the inventory knows, cut to its core."""
    chunks = annotated.select("caption_id", "tokens", F.posexplode("noun_chunks").alias("chunk_ix", "chunk"))
    chunks = chunks.withColumns({"root_i": F.col("chunk.root_i"), "c_start": F.col("chunk.token_start"), "c_end": F.col("chunk.token_end")})
    starts = chunks.where("root_i >= c_start and root_i < c_end").select("*", F.explode(F.sequence("c_start", "root_i")).alias("start"))
    starts = starts.withColumn("span", F.slice("tokens", F.col("start") + 1, F.col("root_i") - F.col("start") + 1)).withColumn("first", F.col("span")[0])
    fine = (F.col("start") == F.col("root_i")) | ~(F.coalesce(F.col("first.dep").isin(*BLOCKED_START_DEPS), F.lit(False)) | F.coalesce(F.col("first.pos").isin(*BLOCKED_START_POS), F.lit(False)))
    raw = _written(F.col("span"))
    last = F.element_at("span", -1)
    words = F.split(normalize_query(raw), " ")
    lemma = F.array_join(F.concat(F.slice(words, 1, F.size(words) - 1), F.array(normalize_query(last.lemma))), " ")
    surfaces = F.array_distinct(F.array(normalize_query(raw), F.when(F.coalesce(last.lemma, F.lit("")) != "", lemma).otherwise(normalize_query(raw))))
    tried = starts.where(fine).select("caption_id", "chunk_ix", "chunk", "root_i", "c_start", "c_end", "start", "span", normalize_query(raw).alias("exact"), F.posexplode(surfaces).alias("n", "key"))
    hits = tried.join(dimension(objects), "key")
    hits = first_per_key(hits, ["caption_id", "chunk_ix"], ["start", F.when(normalize_query("query") == F.col("exact"), 0).otherwise(1), "n"])
    some = lambda *cs: F.filter(F.array(*(F.coalesce(c, F.lit("")) for c in cs)), lambda x: x != "")
    none = F.array().cast("array<string>")
    groups = [some(F.col("canonical_surface"), F.col("canonical_label_key")), F.coalesce("synset_lemmas", none), some(F.col("query"))]
    hits = hits.withColumn("cut", _core(F.col("span"), groups)).withColumn("core", F.slice("span", F.col("cut") + 1, F.size("span") - F.col("cut")))
    return hits.withColumns({"core_start": F.col("start") + F.col("cut"), "core_end": F.col("root_i") + 1}).drop("span", "cut", "n", "exact")


def accepted_objects(spans: DataFrame, taken: DataFrame) -> DataFrame:
    """Objects in chunk order that touch neither a prepositional phrase nor an object before."""
    t = taken.select(F.col("caption_id").alias("cid"), F.col("i").alias("t"))
    free = spans.join(t, (F.col("caption_id") == F.col("cid")) & (F.col("t") >= F.col("core_start")) & (F.col("t") < F.col("core_end")), "left_anti")
    return greedy_spans(free, ["caption_id"], "core_start", "core_end", ["chunk_ix"])


def _spread(df: DataFrame, start: str, end: str, *columns: Column | str) -> DataFrame:
    return df.select("caption_id", F.explode(F.sequence(F.col(start), F.col(end) - 1)).alias("i"), *columns)


def modifiers(tokens: DataFrame, kids: DataFrame, objects: DataFrame, taken: DataFrame, phrases: DataFrame, cut) -> DataFrame:
    """Attributes and quantities of accepted objects: chunk_ix, kind, tokens (as places), order key."""
    inside = tokens.join(objects.select("caption_id", "chunk_ix", "c_start", "c_end", "core_start", "core_end"), "caption_id").where("i >= c_start and i < c_end")
    t = taken.select("caption_id", "i").withColumn("taken", F.lit(True))
    inside = inside.join(t, ["caption_id", "i"], "left")
    inside = inside.withColumn("excluded", F.coalesce("taken", F.lit(False)) | ((F.col("i") >= F.col("core_start")) & (F.col("i") < F.col("core_end"))))
    inside = cut(inside.withColumn("quantity", _is_quantity()))
    usable = inside.where("not excluded")
    key = ["caption_id", "chunk_ix"]
    roots = usable.where(F.col("dep").isin(*ATTRIBUTE_DEPS) & ~F.col("quantity")).select(*key, F.col("i").alias("root"), F.col("i").alias("node"))
    steps = usable.where((F.col("dep") == "conj") & ~F.col("quantity") & (F.col("i") != F.col("head_i"))).select(*key, F.col("head_i").alias("node"), F.col("i").alias("next"))
    anchors = cut(closure(roots, steps, key, cut))
    # phrases that end at an anchor; what stands between must be free of borders
    border = F.col("excluded") | F.col("quantity") | F.coalesce(F.col("dep").isin(*MWE_BOUNDARY_DEPS), F.lit(False)) | F.coalesce(F.col("pos").isin(*MWE_BOUNDARY_POS), F.lit(False))
    run = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    marked = inside.withColumn("border", border).withColumn("open", F.coalesce(F.max(F.when(F.col("border"), F.col("i"))).over(run) + 1, F.col("c_start")))
    ends = marked.where("not border").join(anchors.select(*key, F.col("node").alias("i")).distinct(), [*key, "i"]).where("open < i")
    words = inside.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("i", "text", "lemma"))).alias("words"), F.min("i").alias("base"))
    spans = ends.join(words, key).select(*key, "i", "base", "words", F.explode(F.sequence(F.col("open"), F.col("i") - 1)).alias("start"))
    part = F.slice("words", F.col("start") - F.col("base") + 1, F.col("i") - F.col("start") + 1)
    spans = spans.select(*key, "start", (F.col("i") + 1).alias("end"), F.col("i").alias("anchor"), separator_key(_surface(part)).alias("key"), _surface(part).alias("text"), _surface(part, "lemma").alias("lemma"))
    chosen = cut(greedy_spans(spans.join(dimension(phrases), "key"), key, "start", "end", [F.col("start") - F.col("end"), -F.col("anchor"), F.col("start")]))
    covered = chosen.select(*key, F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("i"))
    whole = chosen.select(*key, F.lit("attribute").alias("kind"), "start", "end", "text", "lemma", F.lit("mwe").alias("unit"), "span_key", F.lit("attribute_mwe").alias("source"), _order(1, "chunk_ix", 1, "start").alias("ord"))
    single = usable.join(covered, [*key, "i"], "left_anti")
    count = single.where("quantity").select(*key, F.lit("quantity").alias("kind"), F.col("i").alias("start"), (F.col("i") + 1).alias("end"), "text", "lemma", F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("span_key"), F.lit(None).cast("string").alias("source"), _order(1, "chunk_ix", 1, "i").alias("ord"))
    from_free = anchors.join(covered.withColumnRenamed("i", "root"), [*key, "root"], "left_anti")  # a phrase keeps its head's conjuncts to itself
    named = from_free.join(single.select(*key, F.col("i").alias("node"), "text", "lemma"), [*key, "node"])
    place = F.concat(_order(1, "chunk_ix", 1, "root", "depth"), F.col("path"))
    one = named.select(*key, F.lit("attribute").alias("kind"), F.col("node").alias("start"), (F.col("node") + 1).alias("end"), "text", "lemma", F.lit("single_token").alias("unit"), F.lit(None).cast("string").alias("span_key"), F.when(F.col("depth") > 0, "conj_of_attribute_modifier").alias("source"), place.alias("ord"))
    return whole.unionByName(count).unionByName(one)


def floating_attributes(annotated: DataFrame, tokens: DataFrame, objects: DataFrame, phrases: DataFrame) -> DataFrame:
    """Attributes of tag segments without an object: a known phrase that is the whole segment, or a single describing word."""
    segments = annotated.where("caption_shape = 'tag_list'").select("caption_id", F.posexplode("tag_segments").alias("seg_ix", "seg")).select("caption_id", "seg_ix", F.col("seg.segment_id").alias("segment_id"), F.col("seg.token_start").alias("s"), F.col("seg.token_end").alias("e"))
    o = objects.select(F.col("caption_id").alias("cid"), "core_start")
    bare = segments.join(o, (F.col("caption_id") == F.col("cid")) & (F.col("core_start") >= F.col("s")) & (F.col("core_start") < F.col("e")), "left_anti")
    words = tokens.join(bare, "caption_id").where("i >= s and i < e").where(~F.coalesce(F.col("pos").isin("PUNCT", "SPACE"), F.lit(False)))
    lists = words.groupBy("caption_id", "seg_ix", "segment_id").agg(F.array_sort(F.collect_list(F.struct("i", "text", "lemma", "pos", "tag"))).alias("w")).withColumn("key", separator_key(_surface(F.col("w"))))
    known = lists.join(dimension(phrases), "key", "left")
    first, last = F.col("w")[0], F.element_at("w", -1)
    is_phrase = (F.size("w") >= 2) & F.col("span_key").isNotNull()
    is_word = (F.size("w") == 1) & (F.coalesce(first.pos.isin(*FLOATING_POS), F.lit(False)) | F.coalesce(first.tag.isin(*FLOATING_TAGS), F.lit(False)))
    return known.where(is_phrase | is_word).select(
        "caption_id", "segment_id", first.i.alias("start"), (last.i + 1).alias("end"), _surface(F.col("w")).alias("text"), _surface(F.col("w"), "lemma").alias("lemma"),
        F.when(is_phrase, "mwe").otherwise("single_token").alias("unit"), F.when(is_phrase, F.col("span_key")).alias("span_key"),
        F.when(is_phrase, "tag_list_unattached_attribute_mwe").otherwise("tag_list_unattached_attribute").alias("source"), _order(1, first.i, 0).alias("ord"),
    )


def action_candidates(verbs: DataFrame, kids: DataFrame, taken: DataFrame) -> DataFrame:
    """caption_id, head, lemma, rank, parts[] (tokens), preps[], key, text: for each verb token the verb alone, with a preposition under it, with
    a particle, and with both; words that are taken are no parts."""
    t = taken.select("caption_id", "i")
    verbs = verbs.select("caption_id", F.col("i").alias("head"), "text", "lemma")
    loose = kids.join(t.withColumnRenamed("i", "c_i"), ["caption_id", "c_i"], "left_anti")
    is_prep = (F.col("c_dep") == "prep") | (F.col("c_pos") == "ADP")
    loose = loose.withColumn("c_prep", F.coalesce(is_prep, F.lit(False)))
    prt = loose.where("c_dep = 'prt' or c_tag = 'RP'").select("caption_id", F.col("parent").alias("head"), F.col("c_i").alias("p"), F.col("c_text").alias("p_text"), F.col("c_prep").alias("p_prep"))
    prep = loose.where("c_prep").select("caption_id", F.col("parent").alias("over"), F.col("c_i").alias("q"), F.col("c_text").alias("q_text"))
    direct = verbs.join(prep.withColumnRenamed("over", "head"), ["caption_id", "head"]).where("q > head")
    particle = verbs.join(prt, ["caption_id", "head"])
    under = particle.join(prep.withColumnRenamed("over", "p"), ["caption_id", "p"]).where("q > head")
    both = particle.join(direct.select("caption_id", "head", "q", "q_text"), ["caption_id", "head"]).where("p <> q")

    def kind(df: DataFrame, rank: int, parts: Column, preps: Column, text: Column) -> DataFrame:
        return df.select("caption_id", "head", "lemma", F.lit(rank).alias("rank"), parts.alias("parts"), preps.alias("preps"), normalize_query(text).alias("key"), text.alias("text"))

    no = F.array().cast("array<int>")
    return reduce(
        DataFrame.unionByName,
        [
            kind(verbs, 3, F.array("head"), no, F.col("text")),
            kind(direct, 2, F.array("head", "q"), F.array("q"), F.concat_ws(" ", "text", "q_text")),
            kind(particle, 1, F.array("head", "p"), F.when(F.col("p_prep"), F.array("p")).otherwise(no), F.concat_ws(" ", "text", "p_text")),
            kind(both.unionByName(under.select(both.columns)), 0, F.array("head", "p", "q"), F.when(F.col("p_prep"), F.array("p", "q")).otherwise(F.array("q")), F.concat_ws(" ", "text", "p_text", "q_text")),
        ],
    ).distinct()


def actions(tokens: DataFrame, kids: DataFrame, taken: DataFrame, lexicons: Lexicons) -> DataFrame:
    """caption_id, head, parts[] (tokens), preps[], text, synset: the best known verb phrase of each free verb."""
    free = tokens.join(taken.select("caption_id", "i"), ["caption_id", "i"], "left_anti")
    all_ = action_candidates(free.where("pos = 'VERB' and caption_shape = 'sentence'"), kids, taken)
    known = all_.join(dimension(lexicons.actions.select("key", "synset")), "key", "left")
    good = F.when(F.coalesce("synset", F.lit("")) != "", 0).otherwise(1)
    bare = F.when(good == 1, F.when(F.col("rank") == 3, 0).otherwise(1)).otherwise(0)  # without a sense: the bare verb
    return first_per_key(known, ["caption_id", "head"], [good, bare, -F.size("parts"), "rank", "parts"])


def extract(annotated: DataFrame, lexicons: Lexicons, cut=lambda df: df.checkpoint()) -> tuple[DataFrame, DataFrame]:
    """Raw mentions and raw edges. ``cut``: how lineage is cut between steps.

    Small lexicons travel to the captions, which are then read once (see caption_graph); larger ones are joined with their tokens."""
    graph = _small(lexicons)
    if graph is None:
        return extract_joined(annotated, lexicons, cut)
    rows = cut(caption_graph.graphs(annotated, graph))
    return rows.select("caption_id", F.inline("mentions")), rows.select("caption_id", F.inline("edges"))


def extract_rows(annotated: DataFrame, lexicons: Lexicons, cut=lambda df: df.checkpoint()) -> DataFrame:
    """caption_id, mentions[], edges[]: the graph of each caption in a row; captions without any may be left out."""
    graph = _small(lexicons)
    if graph is not None:
        return caption_graph.graphs(annotated, graph)
    mentions, edges = extract_joined(annotated, lexicons, cut)
    lists = [df.groupBy("caption_id").agg(F.collect_list(F.struct(*df.columns[1:])).alias(name)) for df, name in ((mentions, "mentions"), (edges, "edges"))]
    return lists[0].join(lists[1], "caption_id", "full")


def _small(lexicons: Lexicons) -> caption_graph.Graph | None:
    """The lexicons as dictionaries, if all of them are counted to be small."""
    found = {}
    for name, lexicon in (("objects", lexicons.objects), ("actions", lexicons.actions.select("key", "synset")), ("phrases", lexicons.attribute_phrases.select("key", "span_key")), ("prepositions", lexicons.prepositions)):
        found[name] = caption_graph.small(lexicon, caption_graph.LEXICON_ROWS)
        if found[name] is None:
            return None
    found["actions"] = {k: r["synset"] for k, r in found["actions"].items()}
    return caption_graph.Graph(found, sorted({r["width"] for r in found["prepositions"].values()}))


def extract_joined(annotated: DataFrame, lexicons: Lexicons, cut=lambda df: df.checkpoint()) -> tuple[DataFrame, DataFrame]:
    """``extract`` by joins on (caption, token), for lexicons of any size."""
    annotated = cut(annotated.repartition("caption_id"))
    tokens = tokens_of(annotated)
    kids = children(tokens)
    phrases = cut(preposition_matches(annotated, lexicons.prepositions))
    taken = _spread(phrases, "start", "end").distinct()
    objects = cut(accepted_objects(object_spans(annotated, lexicons.objects), taken))
    by_token = cut(_spread(objects, "core_start", "core_end", _key(F.lit("o"), "chunk_ix").alias("obj")))
    mods = cut(modifiers(tokens, kids, objects, taken, lexicons.attribute_phrases, cut))
    floating = floating_attributes(annotated, tokens, objects, lexicons.attribute_phrases)
    acts = cut(actions(tokens, kids, taken, lexicons))
    places = tokens.select("caption_id", "i", "char_start", "char_end")

    # mentions
    act_key = _key(F.lit("v"), "head")
    mod_key = _key(F.lit("a"), "chunk_ix", "start", "end")
    raw_text = _written(F.col("core"))
    is_one = F.size("core") == 1
    found = [
        objects.select("caption_id", _key(F.lit("o"), "chunk_ix").alias("key"), F.lit("object").alias("mention_type"), raw_text.alias("text"), F.when(is_one, F.col("core")[0]["lemma"]).otherwise(normalize_query(raw_text)).alias("lemma"), F.lit("R12").alias("rule_id"), F.col("core_start").alias("token_start"), F.col("core_end").alias("token_end"), "canonical_surface", "canonical_selection_tag", "parent_lemmas", "parent_synset_ids", "selected_synset", "selected_lexfile", _order(1, "chunk_ix", 0).alias("ord")),
        mods.select("caption_id", mod_key.alias("key"), F.col("kind").alias("mention_type"), "text", "lemma", F.when(F.col("kind") == "quantity", "R14").otherwise("R13").alias("rule_id"), F.col("start").alias("token_start"), F.col("end").alias("token_end"), F.col("unit").alias("attribute_unit_type"), F.col("span_key").alias("inventory_span_key"), F.col("source").alias("modifier_source"), "ord"),
        floating.select("caption_id", _key(F.lit("f"), "start").alias("key"), F.lit("attribute").alias("mention_type"), "text", "lemma", F.lit("R13").alias("rule_id"), F.col("start").alias("token_start"), F.col("end").alias("token_end"), F.col("unit").alias("attribute_unit_type"), F.col("span_key").alias("inventory_span_key"), F.col("source").alias("modifier_source"), "ord"),
        acts.select("caption_id", act_key.alias("key"), F.lit("action").alias("mention_type"), "text", F.when(F.size("parts") == 1, F.col("lemma")).otherwise(F.col("key")).alias("lemma"), F.lit("R15").alias("rule_id"), F.array_min("parts").alias("token_start"), (F.array_max("parts") + 1).alias("token_end"), F.col("parts").alias("token_indices"), F.col("synset").alias("selected_synset"), _order(4, "head").alias("ord")),
    ]
    # a chunk in a tag list is placed by its tokens, so that objects and loose attributes of a caption interleave
    tag = annotated.where("caption_shape = 'tag_list'").select("caption_id").withColumn("tag", F.lit(True))
    chunk_at = objects.join(tag, "caption_id").select("caption_id", F.col("chunk_ix").alias("cx"), "c_start")
    moved = F.when(F.col("c_start").isNotNull(), F.concat(F.array(F.col("ord")[0], F.col("c_start")), F.slice("ord", 3, 99))).otherwise(F.col("ord"))
    found[:2] = [df.withColumn("cx", F.col("ord")[1]).join(chunk_at, ["caption_id", "cx"], "left").withColumn("ord", moved).drop("cx", "c_start") for df in found[:2]]
    mentions = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    ids = Window.partitionBy("caption_id").orderBy("ord", "key")
    mentions = cut(mentions.withColumn("mention_id", F.concat(F.lit("m"), (F.row_number().over(ids) - 1).cast("string"))))
    segments = annotated.where("caption_shape = 'tag_list'").select("caption_id", F.inline("tag_segments")).select(F.col("caption_id").alias("cid"), "segment_id", F.col("token_start").alias("s"), F.col("token_end").alias("e"))
    first = places.select("caption_id", F.col("i").alias("token_start"), "char_start")
    last = places.select("caption_id", (F.col("i") + 1).alias("token_end"), "char_end")
    full = mentions.join(first, ["caption_id", "token_start"], "left").join(last, ["caption_id", "token_end"], "left")
    full = full.join(segments, (F.col("caption_id") == F.col("cid")) & (F.col("token_start") >= F.col("s")) & (F.col("token_start") < F.col("e")), "left").drop("cid")
    full = full.withColumns({"stage": F.lit("stage4"), "confidence": F.lit("high"), "token_indices": F.coalesce("token_indices", F.sequence("token_start", F.col("token_end") - 1))})
    raw_mentions = _fit(full, RAW_MENTION)

    # edges: (caption_id, edge_type, src, dst, label, rule_id, …, ord) between mention keys
    chunk = _key(F.lit("o"), "chunk_ix")
    owned = mods.select("caption_id", F.concat(F.lit("has_"), "kind").alias("edge_type"), chunk.alias("src"), mod_key.alias("dst"), F.concat(F.lit("has_"), "kind").alias("label"), F.when(F.col("kind") == "quantity", "R14").otherwise("R13").alias("rule_id"), "ord")

    conj_steps = kids.where("c_dep = 'conj'").join(by_token.select("caption_id", F.col("i").alias("c_i")), ["caption_id", "c_i"]).select("caption_id", F.col("parent").alias("node"), F.col("c_i").alias("next"))
    pobj = kids.where("c_dep = 'pobj'").join(by_token.select("caption_id", F.col("i").alias("c_i")), ["caption_id", "c_i"]).select("caption_id", F.col("parent").alias("prep"), F.col("c_i").alias("base"))
    bases = pobj.select("caption_id", F.col("base").alias("root"), F.col("base").alias("node")).distinct()
    reach = closure(bases, conj_steps, ["caption_id"], cut).join(by_token.withColumnRenamed("i", "node"), ["caption_id", "node"])
    reach = cut(first_per_key(reach, ["caption_id", "root", "obj"], ["depth", "path"]))  # a mention once for each base
    targets = pobj.join(reach.withColumnRenamed("root", "base"), ["caption_id", "base"]).select("caption_id", "prep", "base", "obj", "depth", "path")

    m = phrases.select("caption_id", "start", "key", "canonical_relation", "components", (F.col("start") + F.col("initial_offset")).alias("initial"), (F.col("start") + F.col("final_offset")).alias("final"), F.sequence("start", F.col("end") - 1).alias("matched"))
    t = lambda name, *more: tokens.select("caption_id", F.col("i").alias(name), *more)
    m = m.join(t("final", F.col("pos").alias("f_pos")), ["caption_id", "final"]).where("f_pos = 'ADP'").join(t("initial", F.col("head_i").alias("at")), ["caption_id", "initial"]).join(t("at", F.col("pos").alias("h_pos")), ["caption_id", "at"])
    straight = m.join(by_token.withColumnRenamed("i", "at"), ["caption_id", "at"], "left")
    of_head = kids.join(by_token.withColumnRenamed("i", "c_i"), ["caption_id", "c_i"]).select("caption_id", F.col("parent").alias("at"), F.col("c_i").alias("s_i"), F.col("obj").alias("s_obj"))
    via_head = straight.where("obj is null and h_pos in ('VERB', 'AUX')").join(of_head, ["caption_id", "at"]).groupBy("caption_id", "start").agg(F.collect_list(F.struct("s_i", "s_obj")).alias("raw"))
    sources = straight.join(via_head, ["caption_id", "start"], "left")
    one_each = F.filter(F.array_sort("raw"), lambda x, k: ~F.exists(F.array_sort(F.col("raw")), lambda y: (y["s_obj"] == x["s_obj"]) & (y["s_i"] < x["s_i"])))
    sources = sources.withColumn("sources", F.when(F.col("obj").isNotNull(), F.array("obj")).otherwise(F.coalesce(F.transform(one_each, lambda x: x["s_obj"]), F.array().cast("array<string>"))))
    goals = targets.groupBy("caption_id", F.col("prep").alias("final")).agg(F.array_sort(F.collect_list(F.struct("base", "depth", "path", "obj"))).alias("goals"), F.count_distinct("base").alias("bases"))
    edges_m = sources.join(goals, ["caption_id", "final"], "left").withColumns({"ns": F.size("sources"), "nt": F.coalesce("bases", F.lit(0))})
    scope = (
        F.when((F.col("ns") == 0) & (F.col("nt") == 0), "source_and_target_missing").when(F.col("ns") == 0, "source_missing").when(F.col("nt") == 0, "target_missing")
        .when((F.col("ns") > 1) & (F.col("nt") > 1), "source_and_target").when(F.col("ns") > 1, "source").when(F.col("nt") > 1, "target").otherwise("none")
    )
    ends = F.when(F.col("ns") == 0, F.array(F.lit(MISSING_SOURCE))).otherwise(F.col("sources"))
    tips = F.when(F.coalesce(F.size("goals"), F.lit(0)) <= 0, F.array(F.lit(MISSING_TARGET))).otherwise(F.transform("goals", lambda g: g["obj"]))
    edges_m = edges_m.select("*", scope.alias("ambiguity_scope"), F.posexplode(ends).alias("sn", "src"), tips.alias("tips")).select("*", F.posexplode("tips").alias("tn", "dst"))
    phrase_edges = edges_m.select("caption_id", F.when((F.col("ns") == 1) & (F.col("nt") == 1), "relation").otherwise("ambiguous_relation_candidate").alias("edge_type"), "src", "dst", F.col("canonical_relation").alias("label"), F.lit("R18.1").alias("rule_id"), F.col("key").alias("raw_span_surface"), F.transform("matched", lambda x: x.cast("string")).alias("matched_token_indices"), F.col("components").alias("relation_components"), "ambiguity_scope", _order(2, "start", "sn", "tn").alias("ord"))

    heads = acts.select("caption_id", "head", act_key.alias("src"))
    on_object = kids.join(by_token.withColumnRenamed("i", "c_i"), ["caption_id", "c_i"])
    role = heads.join(on_object.withColumnRenamed("parent", "head"), ["caption_id", "head"])
    passive = F.col("c_dep").isin(*PASSIVE_SUBJECT_DEPS)
    label = F.when(F.col("c_dep") == "nsubj", "agent").when(passive | F.col("c_dep").isin(*PATIENT_DEPS), "patient")
    rule = F.when(F.col("c_dep") == "nsubj", "R16").when(passive, "R17.1").otherwise("R17")
    direct = cut(role.withColumn("label", label).where("label is not null").select("caption_id", F.lit("event_role").alias("edge_type"), "src", F.col("obj").alias("dst"), "label", rule.alias("rule_id"), F.when(passive, "theme").alias("raw_role"), F.when(passive, "passive_to_active").alias("voice_normalization"), "head", F.col("c_dep"), _order(5, "head", 0, "c_i").alias("ord")))
    turned = direct.where("rule_id = 'R17.1'").select("caption_id", "head", "src").distinct()
    by = kids.where(F.col("c_dep").isin(*PASSIVE_BY_DEPS) & ((F.lower("c_lemma") == "by") | (F.lower("c_text") == "by"))).select("caption_id", F.col("parent").alias("head"), F.col("c_i").alias("by_i"))
    goal = on_object.where("c_dep = 'pobj'").select("caption_id", F.col("parent").alias("by_i"), F.col("c_i").alias("t_i"), "obj")
    by_agent = turned.join(by, ["caption_id", "head"]).join(goal, ["caption_id", "by_i"]).select("caption_id", F.lit("event_role").alias("edge_type"), "src", F.col("obj").alias("dst"), F.lit("agent").alias("label"), F.lit("R16.2").alias("rule_id"), F.lit("by_agent_or_causer").alias("raw_role"), F.lit("passive_to_active").alias("voice_normalization"), "head", _order(5, "head", 1, "by_i", "t_i").alias("ord"))
    used = acts.select("caption_id", "head", act_key.alias("src"), F.explode("preps").alias("by_i"))
    by_prep = first_per_key(used, ["caption_id", "by_i"], [F.desc("head")]).join(goal, ["caption_id", "by_i"]).select("caption_id", F.lit("event_role").alias("edge_type"), "src", F.col("obj").alias("dst"), F.lit("patient").alias("label"), F.lit("R17").alias("rule_id"), "head", _order(6, "by_i", "t_i").alias("ord"))
    roles = [direct.drop("c_dep"), by_agent, by_prep]
    put = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)

    signs = kids.where(F.col("c_dep").isin(*PASSIVE_SIGNS)).select("caption_id", F.col("parent").alias("head")).distinct()
    active = heads.join(tokens.select("caption_id", F.col("i").alias("head"), "dep", "tag", "head_i"), ["caption_id", "head"]).join(signs, ["caption_id", "head"], "left_anti")
    agents = cut(put([direct, by_agent]).where("label = 'agent'").select("caption_id", "head", F.col("dst").alias("obj")))
    lonely = active.where("dep = 'acl' and tag = 'VBG'").join(agents, ["caption_id", "head"], "left_anti")
    acl = cut(lonely.join(by_token.withColumnRenamed("i", "head_i"), ["caption_id", "head_i"]).select("caption_id", F.lit("event_role").alias("edge_type"), "src", F.col("obj").alias("dst"), F.lit("agent").alias("label"), F.lit("R16.3").alias("rule_id"), "head", _order(7, "head").alias("ord")))
    agents = agents.unionByName(acl.select("caption_id", "head", F.col("dst").alias("obj")))
    waiting = active.where("dep = 'conj'").select("caption_id", "head", "src", F.col("head_i").alias("from"))
    inherited, number = [], 0
    while True:  # as many rounds as the longest chain of conjuncts
        number += 1
        single = agents.groupBy("caption_id", F.col("head").alias("from")).agg(F.count_distinct("obj").alias("n"), F.min("obj").alias("obj")).where("n = 1")
        new = waiting.join(agents.select("caption_id", "head"), ["caption_id", "head"], "left_anti").join(single, ["caption_id", "from"]).where(F.col("head") != F.col("from"))
        new = cut(new.select("caption_id", F.lit("event_role").alias("edge_type"), "src", F.col("obj").alias("dst"), F.lit("agent").alias("label"), F.lit("R16.1").alias("rule_id"), "head", _order(8, number, "head").alias("ord")))
        if not new.limit(1).count():
            break
        inherited.append(new)
        agents = cut(agents.unionByName(new.select("caption_id", "head", F.col("dst").alias("obj"))))

    eaten = acts.select("caption_id", F.explode("preps").alias("i")).unionByName(taken)
    adp = tokens.where("pos = 'ADP' and caption_shape = 'sentence'").join(eaten, ["caption_id", "i"], "left_anti").join(by_token.select("caption_id", F.col("i").alias("head_i"), F.col("obj").alias("src")), ["caption_id", "head_i"])
    single_adp = adp.select("caption_id", F.col("i").alias("prep"), F.coalesce(F.nullif(F.col("lemma"), F.lit("")), "text").alias("label"), "src").join(targets, ["caption_id", "prep"])
    adp_edges = single_adp.select("caption_id", F.lit("relation").alias("edge_type"), "src", F.col("obj").alias("dst"), "label", F.lit("R18").alias("rule_id"), F.concat(_order(9, "prep", "base", "depth"), F.col("path")).alias("ord"))

    edges = put([owned, phrase_edges, *(r.drop("head") for r in [*roles, acl, *inherited]), adp_edges])
    names = mentions.select("caption_id", "key", "mention_id")
    for end in ("src", "dst"):
        n = names.select("caption_id", F.col("key").alias(end), F.col("mention_id").alias(f"{end}_id"))
        edges = edges.join(n, ["caption_id", end], "left")
    edges = edges.withColumns({"source_mention_id": F.coalesce("src_id", "src"), "target_mention_id": F.coalesce("dst_id", "dst"), "stage": F.lit("stage4"), "confidence": F.lit("high")})
    edges = edges.withColumn("edge_id", F.concat(F.lit("e"), (F.row_number().over(Window.partitionBy("caption_id").orderBy("ord", "src", "dst")) - 1).cast("string")))
    return raw_mentions, _fit(edges, RAW_EDGE)


def _fit(df: DataFrame, schema: str) -> DataFrame:
    fields = [x.strip().split(" ", 1) for x in schema.split(", ")]
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in fields))
