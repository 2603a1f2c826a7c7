"""Building inventories of attributes and actions from annotated captions.

Both builders go the same way: candidates come out of the captions, which meet each other only inside a caption; each distinct surface
is looked up once, in dimension tables (see ``inventory``); the answers go back to the candidates, the captions' choices are made, and
what was chosen is counted by key. So look-ups grow with the words, not with the captions, and a caption is exchanged once.

WordNet enters as ``lemmas(form, pos, synset)``, ``synsets(synset, lexfile)``, ``sense_counts(synset, lemma, n)``, ``morphy(form, pos, lemma)``.

Defined cases: captions without chunks, chunks without a known object and verbs that a prepositional phrase took give nothing; blank
surfaces are left out; null fields of tokens match no rule; empty tables give empty inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import status
from ..functions.text import display_surface, normalize_query, pipe_join, separator_key, separator_variants, surface_key, surface_variant_keys
from . import caption_graph, inventory
from .extract import ATTRIBUTE_DEPS, BLOCKED_START_DEPS, BLOCKED_START_POS, MWE_BOUNDARY_DEPS, MWE_BOUNDARY_POS, QUANTITY_DEPS, _spread, _surface, _written, object_spans, preposition_matches
from .fold import dimension, first_per_key, greedy_spans

# Modes of the attribute builder, kinds of units, parts of speech of base forms in their order, separators of phrases.
MODES = ("all", "mwe_only", "single_token_only")
SINGLE, PHRASE = "single_token", "mwe"
MORPHY_POS = ("a", "n", "v", "r")
SEPARATORS = ((" ", "exact", "space"), ("-", "hyphen_variant", "hyphen"), ("_", "underscore_variant", "underscore"))
PLURAL_TAGS = ("NNS",)
# The order of verb phrases of one length.
ACTION_TYPES = ("verb_prt_prep", "verb_prt", "verb_prep", "verb_token")
RANKS = {"needs_manual": 4}


# --- looking up attributes


def forms(lemmas: DataFrame, pos: str | None = None) -> DataFrame:
    """query, synsets[]: the senses of every form."""
    rows = lemmas if pos is None else lemmas.where(F.col("pos") == pos)
    return rows.groupBy(F.col("form").alias("query")).agg(F.array_sort(F.collect_set("synset")).alias("synsets"))


def attribute_senses(hits: DataFrame, synsets: DataFrame, sense_counts: DataFrame) -> DataFrame:
    """query, selected, lexfile, tag for rows (query, synsets[]).

    A single sense is chosen. Of several, those that describe compete first, then doubtful ones, then the rest: in each group the one with
    the highest count of the query, if it is above zero and no other has it; a tie above zero ends the search without a choice."""
    each = hits.select("query", F.size("synsets").alias("n_synsets"), F.explode("synsets").alias("synset"))
    each = each.join(synsets.select("synset", "lexfile"), "synset", "left").join(sense_counts.select("synset", F.col("lemma").alias("query"), F.col("n").alias("uses")), ["synset", "query"], "left")
    gate = status.gate(F.col("lexfile"), status.ATTRIBUTE)
    group = F.when(gate == "attribute_compatible", 0).when(gate == "conditional", 1).otherwise(2)
    each = each.withColumns({"group": group, "uses": F.coalesce("uses", F.lit(0)), "lexfile": F.coalesce("lexfile", F.lit(""))})
    top = Window.partitionBy("query", "group")
    each = each.withColumn("most", F.max("uses").over(top))
    groups = each.groupBy("query", "group").agg(
        F.max("most").alias("most"), F.count_if(F.col("uses") == F.col("most")).alias("n_top"), F.min(F.when(F.col("uses") == F.col("most"), F.struct("synset", "lexfile"))).alias("best"), F.max("n_synsets").alias("n_synsets")
    )
    first = first_per_key(groups, ["query"], [F.when((F.col("n_synsets") == 1) | (F.col("most") > 0), F.col("group")).otherwise(9), "group"])
    name = F.element_at(F.array(*map(F.lit, ("attribute_compatible", "conditional", "other"))), F.col("group") + 1)
    only, found = F.col("n_synsets") == 1, (F.col("most") > 0) & (F.col("n_top") == 1)
    tag = F.when(only, "single_oewn_attribute_synset").when(found, F.concat(F.lit("selected_by_wn30_"), name, F.lit("_lemma_count")))
    tag = tag.when(F.col("most") > 0, F.concat(F.lit("ambiguous_"), name, F.lit("_wn30_tie"))).otherwise("ambiguous_wn30_all_zero_or_mapping_missing")
    chosen = only | found
    return first.select("query", F.when(chosen, F.col("best.synset")).alias("selected"), F.when(chosen, F.col("best.lexfile")).alias("lexfile"), tag.alias("tag"))


def _base_forms(keys: DataFrame, word: Column, morphy: DataFrame) -> DataFrame:
    """Rows of ``keys`` with every base form of a word: place, pos, lemma; each form once, where it comes first."""
    order = F.array_position(F.array(*map(F.lit, MORPHY_POS)), F.col("pos"))
    bases = morphy.where(F.col("pos").isin(*MORPHY_POS)).select(F.col("form").alias("_word"), "pos", order.alias("place"), normalize_query("lemma").alias("lemma")).where("lemma <> ''")
    rows = keys.withColumn("_word", word).join(bases, "_word").drop("_word")
    return first_per_key(rows, [*keys.columns, "lemma"], ["place"])


def attribute_lookup(surfaces: DataFrame, lemmas: DataFrame, morphy: DataFrame, synsets: DataFrame, sense_counts: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """The decision on every attribute surface: unit, span_key, plural, lookup_case, query, synsets[], selected, lexfile, tag, gate,
    decision_status, decision_reason, lookup_forms[], canonical_surface, reused.

    surfaces: unit, span_key, plural (whether a single word stood in the plural). prior: unit, span_key, decision_status, selected,
    lexfile, canonical_surface of earlier decisions, which go before any look-up unless they are still open.

    A single word is looked up as it is, then by its base forms. In the plural both are tried: if they lead to different senses, that
    is a conflict and needs a decision. A phrase is tried with blanks, hyphens and underscores, then the same with the base forms of
    its last word."""
    keys = surfaces.where("span_key <> ''").select("unit", "span_key", F.coalesce("plural", F.lit(False)).alias("plural")).distinct()
    by = ["unit", "span_key", "plural"]
    words = F.split("span_key", " ")
    single, phrase = keys.where(F.col("unit") == SINGLE), keys.where((F.col("unit") == PHRASE) & (F.size(words) >= 2))
    no = F.lit(None).cast("int")
    exact = single.select(*by, F.lit(0).alias("rank"), F.lit("exact").alias("lookup_case"), F.col("span_key").alias("query"))
    based = _base_forms(single, F.col("span_key"), morphy).where("lemma <> span_key")
    order = Window.partitionBy(*by).orderBy("place", "lemma")
    based = based.select(*by, F.row_number().over(order).alias("rank"), F.concat(F.lit("morphy_"), "pos").alias("lookup_case"), F.col("lemma").alias("query"))

    def variants(rows: DataFrame, text: Column, rank: Column, case: int, prefix: str) -> DataFrame:
        made = F.array(*(F.struct((rank * 3 + i).alias("rank"), F.lit(f"{prefix}_{names[case]}").alias("lookup_case"), F.array_join(text, sep).alias("query")) for i, (sep, *names) in enumerate(SEPARATORS)))
        return rows.select(*by, F.inline(made))

    whole = variants(phrase, words, F.lit(0), 0, "mwe")
    last = _base_forms(phrase, F.element_at(words, -1), morphy).where(F.col("lemma") != F.element_at(words, -1))
    last = last.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("place", "lemma")))
    ended = variants(last, F.concat(F.slice(words, 1, F.size(words) - 1), F.array("lemma")), F.col("r"), 1, "mwe_anchor_morphy")
    tried = reduce(DataFrame.unionByName, [exact, based, whole, ended])
    known = tried.join(dimension(forms(lemmas)), "query", "left")
    senses = attribute_senses(known.where("synsets is not null").select("query", "synsets").distinct(), synsets, sense_counts)
    known = known.join(dimension(senses), "query", "left")
    hit = F.struct("rank", "lookup_case", "query", "synsets", "selected", "lexfile", "tag")
    per = known.groupBy(*by).agg(
        F.min(F.when(F.col("synsets").isNotNull(), hit)).alias("first"),
        F.array_sort(F.collect_list(F.when(F.col("synsets").isNotNull() & (F.col("unit") == SINGLE), hit))).alias("hits"),
        F.array_sort(F.collect_list(F.struct("rank", "query"))).alias("tried"),
    )
    per = keys.join(per, by, "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<struct<rank:int,lookup_case:string,query:string,synsets:array<string>,selected:string,lexfile:string,tag:string>>")))
    main = F.col("first")
    against = F.filter("hits", lambda h: (h.rank > 0) & h.selected.isNotNull() & (h.selected != main.selected))
    conflict = F.col("plural") & (main.rank == 0) & main.selected.isNotNull() & (F.size(against) > 0)
    both = F.concat(F.array(main), against)
    per = per.withColumns({"conflict": F.coalesce(conflict, F.lit(False)), "both": both})
    clash, found, pick = F.col("conflict"), main.isNotNull(), main.selected.isNotNull() & ~F.col("conflict")
    lexfile = F.when(pick, main.lexfile)
    gate = F.when(pick, status.gate(main.lexfile, status.ATTRIBUTE)).otherwise("")
    n = F.when(found, F.size(main.synsets)).otherwise(0)
    unresolved = F.when(F.col("unit") == PHRASE, F.when(F.size(words) < 2, "unresolved_not_multi_token_attribute").otherwise("unresolved_no_oewn_attribute_mwe_synset")).otherwise("unresolved_no_oewn_attribute_synset")
    attempts = F.transform(F.filter("tried", lambda t: ~found | (t.rank <= main.rank)), lambda t: t.query)
    out = per.select(
        *by,
        F.when(clash, "surface_query_conflict").when(found, main.lookup_case).otherwise("unresolved").alias("lookup_case"),
        F.when(clash, F.array_join(F.array_distinct(F.transform("both", lambda h: h.query)), "|")).when(found, main.query).otherwise(F.col("span_key")).alias("query"),
        F.when(clash, F.array_distinct(F.flatten(F.transform("both", lambda h: h.synsets)))).when(found, main.synsets).otherwise(F.array().cast("array<string>")).alias("synsets"),
        F.when(pick, main.selected).alias("selected"),
        lexfile.alias("lexfile"),
        F.when(clash, "ambiguous_observed_vs_surface_changed_query").when(found, main.tag).otherwise(unresolved).alias("tag"),
        gate.alias("gate"),
        F.when(clash, status.PENDING).otherwise(status.selection_status(F.when(pick, main.selected), n, gate, status.ATTRIBUTE)).alias("decision_status"),
        F.when(clash, "manual_surface_query_conflict_required").otherwise(status.selection_reason(F.when(pick, main.selected), n, gate, status.ATTRIBUTE)).alias("decision_reason"),
        F.when(F.col("unit") == PHRASE, F.array_distinct(attempts)).otherwise(F.array().cast("array<string>")).alias("lookup_forms"),
    )
    if prior is None:
        return out.withColumns({"canonical_surface": F.lit(""), "reused": F.lit(False)})
    p = prior.where(F.col("decision_status").isin(*status.FINAL)).select("unit", "span_key", F.struct("decision_status", "selected", "lexfile", "canonical_surface").alias("p"))
    out = out.join(dimension(first_per_key(p, ["unit", "span_key"], ["p"])), ["unit", "span_key"], "left")
    reused = F.col("p").isNotNull()
    own = F.nullif(F.col("p.selected"), F.lit(""))
    return out.select(
        *by,
        F.when(reused, "prior_attribute").otherwise(F.col("lookup_case")).alias("lookup_case"),
        "query",
        F.when(reused & own.isNotNull() & (F.size("synsets") == 0), F.array(own)).otherwise(F.col("synsets")).alias("synsets"),
        F.when(reused, own).otherwise(F.col("selected")).alias("selected"),
        F.when(reused, F.col("p.lexfile")).otherwise(F.col("lexfile")).alias("lexfile"),
        F.when(reused, "prior_decision").otherwise(F.col("tag")).alias("tag"),
        F.when(reused, status.gate(F.col("p.lexfile"), status.ATTRIBUTE)).otherwise(F.col("gate")).alias("gate"),
        F.when(reused, F.col("p.decision_status")).otherwise(F.col("decision_status")).alias("decision_status"),
        F.when(reused, "prior_decision_reused").otherwise(F.col("decision_reason")).alias("decision_reason"),
        "lookup_forms",
        F.when(reused, F.coalesce("p.canonical_surface", F.lit(""))).otherwise("").alias("canonical_surface"),
        reused.alias("reused"),
    )


# --- attributes of captions


def chunk_words(annotated: DataFrame, objects: DataFrame, taken: DataFrame) -> DataFrame:
    """caption_id, chunk_ix, root_i, base, w[] of every noun chunk with a known object: its tokens, marked excluded (the object's own, or
    those of a prepositional phrase), quantity, and anchor (a modifier, or a conjunct of one through conjuncts)."""
    found = object_spans(annotated, objects).select("caption_id", "chunk_ix", "root_i", "c_start", "c_end", "core_start", "core_end")
    held = taken.groupBy("caption_id").agg(F.collect_set("i").alias("taken"))
    rows = found.join(annotated.select("caption_id", "tokens"), "caption_id").join(held, "caption_id", "left")
    part = F.slice("tokens", F.col("c_start") + 1, F.col("c_end") - F.col("c_start"))
    quantity = lambda t: F.coalesce(t.dep.isin(*QUANTITY_DEPS), F.lit(False)) | F.coalesce(t.pos == "NUM", F.lit(False))
    excluded = lambda t: ((t.i >= F.col("core_start")) & (t.i < F.col("core_end"))) | F.coalesce(F.array_contains("taken", t.i), F.lit(False))
    word = lambda t: F.struct(
        t.i.alias("i"), t.text.alias("text"), t.dep.alias("dep"), t.pos.alias("pos"), t.tag.alias("tag"), t.head_i.alias("head_i"), excluded(t).alias("excluded"), quantity(t).alias("quantity")
    )
    rows = rows.select("caption_id", "chunk_ix", "root_i", F.col("c_start").alias("base"), F.transform(part, word).alias("w"))
    usable = lambda t: ~t.excluded & ~t.quantity
    at = lambda i: F.get(F.col("w"), i - F.col("base"))  # noqa: E731 - null outside the chunk, or before it (get of a negative place)
    here = lambda t: (t >= F.col("base")) & (t < F.col("base") + F.size("w"))

    def anchor(t: Column) -> Column:
        """Heads are followed from conjunct to conjunct, at most once round the chunk, up to a modifier."""
        start = F.struct(t.i.alias("at"), F.lit(False).alias("yes"))

        def up(s: Column, _: Column) -> Column:
            now = at(s["at"])
            fine = F.coalesce(here(s["at"]) & usable(now), F.lit(False))
            on = fine & F.coalesce(now.dep == "conj", F.lit(False)) & (now.head_i != now.i)
            return F.when(s.yes, s).when(fine & F.coalesce(now.dep.isin(*ATTRIBUTE_DEPS), F.lit(False)), F.struct(s["at"].alias("at"), F.lit(True).alias("yes"))).otherwise(F.struct(F.when(on, now.head_i).otherwise(-1).alias("at"), F.lit(False).alias("yes")))

        return F.aggregate(F.sequence(F.lit(1), F.size("w")), start, up).yes

    border = lambda t: t.excluded | t.quantity | F.coalesce(t.dep.isin(*MWE_BOUNDARY_DEPS), F.lit(False)) | F.coalesce(t.pos.isin(*MWE_BOUNDARY_POS), F.lit(False))
    marked = lambda t: F.struct(t.i.alias("i"), t.text.alias("text"), t.tag.alias("tag"), border(t).alias("border"), (usable(t) & anchor(t)).alias("anchor"))
    return rows.withColumn("w", F.transform("w", marked))


def attribute_candidates(annotated: DataFrame, objects: DataFrame, prepositions: DataFrame, mode: str = "all") -> DataFrame:
    """Every span that may be an attribute: caption_id, place (chunk or segment), unit, start, end, anchor, surface, plural, objectless.

    Phrases of two tokens and more end at an anchor and cross no border; single words are the anchors. Tag segments of two words and
    more without a known object are phrases as wholes. Small lexicons travel to the captions, larger ones are joined with them."""
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    known = [caption_graph.small(x, caption_graph.LEXICON_ROWS) for x in (objects.select("key", "query", "canonical_surface", "canonical_label_key", "synset_lemmas"), prepositions)]
    if None in known:
        return attribute_candidates_joined(annotated, objects, prepositions, mode)
    return caption_graph.candidates(annotated, caption_graph.Candidates(*known, mode))


def attribute_candidates_joined(annotated: DataFrame, objects: DataFrame, prepositions: DataFrame, mode: str = "all") -> DataFrame:
    """``attribute_candidates`` by joins, for lexicons of any size."""
    matches = preposition_matches(annotated, prepositions)
    taken = _spread(matches, "start", "end").distinct()
    words = chunk_words(annotated, objects, taken)
    ends = words.select("caption_id", "chunk_ix", "base", "w", F.explode(F.filter("w", lambda t: t.anchor)).alias("a"))
    at = F.col("a.i") - F.col("base")
    before = F.transform(F.slice("w", 1, at), lambda t: F.when(t.border, t.i))
    first = F.coalesce(F.array_max(before) + 1, F.col("base"))  # after the last border before the anchor
    starts = ends.where(~F.col("a.border")).withColumn("first", first).where("first < a.i").withColumn("start", F.explode(F.sequence("first", F.col("a.i") - 1)))
    part = F.slice("w", F.col("start") - F.col("base") + 1, F.col("a.i") - F.col("start") + 1)
    columns = ["caption_id", F.concat(F.lit("c"), "chunk_ix").alias("place")]
    phrases = starts.select(*columns, F.lit(PHRASE).alias("unit"), "start", (F.col("a.i") + 1).alias("end"), F.col("a.i").alias("anchor"), _surface(part).alias("surface"), F.lit(False).alias("plural"), F.lit(False).alias("objectless"))
    plural = F.coalesce(F.col("a.tag").isin(*PLURAL_TAGS), F.lit(False))
    singles = ends.select(*columns, F.lit(SINGLE).alias("unit"), F.col("a.i").alias("start"), (F.col("a.i") + 1).alias("end"), F.col("a.i").alias("anchor"), F.col("a.text").alias("surface"), plural.alias("plural"), F.lit(False).alias("objectless"))
    segments = annotated.where("caption_shape = 'tag_list'").select("caption_id", "tokens", F.posexplode("tag_segments").alias("seg_ix", "seg")).withColumns({"s": F.col("seg.token_start"), "e": F.col("seg.token_end")})
    roots = words.select(F.col("caption_id").alias("cid"), "root_i")
    bare = segments.join(roots, (F.col("caption_id") == F.col("cid")) & (F.col("root_i") >= F.col("s")) & (F.col("root_i") < F.col("e")), "left_anti")
    held = taken.groupBy(F.col("caption_id")).agg(F.collect_set("i").alias("taken"))
    content = F.filter(F.slice("tokens", F.col("s") + 1, F.col("e") - F.col("s")), lambda t: ~F.coalesce(t.pos.isin("PUNCT", "SPACE"), F.lit(False)))
    bare = bare.withColumn("c", content).join(held, "caption_id", "left").where("size(c) >= 2")
    blocked = F.exists("c", lambda t: F.coalesce(t.dep.isin(*QUANTITY_DEPS), F.lit(False)) | F.coalesce(t.pos == "NUM", F.lit(False)) | F.coalesce(F.array_contains("taken", t.i), F.lit(False)))
    last = F.element_at("c", -1)
    loose = bare.where(~blocked).select("caption_id", F.concat(F.lit("s"), "seg_ix").alias("place"), F.lit(PHRASE).alias("unit"), F.col("c")[0]["i"].alias("start"), (last.i + 1).alias("end"), last.i.alias("anchor"), _surface(F.col("c")).alias("surface"), F.lit(False).alias("plural"), F.lit(True).alias("objectless"))
    out = {"all": [phrases, singles, loose], "mwe_only": [phrases, loose], "single_token_only": [singles]}[mode]
    return reduce(DataFrame.unionByName, out).withColumn("span_key", normalize_query("surface")).where("span_key <> ''")


def attribute_inventory(annotated: DataFrame, objects: DataFrame, prepositions: DataFrame, lookup, mode: str = "all", cut=lambda df: df.checkpoint()) -> DataFrame:
    """The inventory of one mode; see ``attribute_inventories``."""
    return attribute_inventories(annotated, objects, prepositions, lookup, (mode,), cut)[mode]


def attribute_inventories(annotated: DataFrame, objects: DataFrame, prepositions: DataFrame, lookup, modes=MODES, cut=lambda df: df.checkpoint()) -> dict[str, DataFrame]:
    """The observed attributes with their decisions: unit, span_key, span_token_count, anchor_token_offset, observed_surface, example_surfaces,
    observed_count, caption_count, example_caption_ids and the columns of ``attribute_lookup``.

    ``lookup``: surfaces -> decisions, such as a partial of attribute_lookup. In a chunk the longest known phrases win, then those that end
    last; their tokens are no single attributes. Phrases that a decision excludes are counted, but block nothing. Several modes share the
    candidates, of which each takes its units, and what was looked up."""
    for mode in modes:
        if mode not in MODES:
            raise ValueError(f"no such mode: {mode}")
    found = cut(attribute_candidates(annotated, objects, prepositions, modes[0] if len(modes) == 1 else "all"))
    answers = cut(lookup(found.select("unit", "span_key", "plural").distinct()))
    units = {"all": F.lit(True), "mwe_only": F.col("unit") == PHRASE, "single_token_only": F.col("unit") == SINGLE}
    return {mode: _attribute_units(found.where(units[mode]), answers.where(units[mode])) for mode in modes}


def _attribute_units(found: DataFrame, answers: DataFrame) -> DataFrame:
    """The inventory of the candidates ``found``, all of which ``answers`` decide."""
    known = found.join(dimension(answers), ["unit", "span_key", "plural"])
    phrases = known.where((F.col("unit") == PHRASE) & (F.size("synsets") > 0))
    out_ = F.col("decision_status") == "excluded"
    chosen = greedy_spans(phrases.where(~out_ & ~F.col("objectless")), ["caption_id", "place"], "start", "end", [F.col("start") - F.col("end"), -F.col("anchor"), F.col("start")])
    covered = chosen.select("caption_id", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("start"), "place").distinct()
    singles = known.where(F.col("unit") == SINGLE).join(covered, ["caption_id", "place", "start"], "left_anti")
    columns = known.columns
    units = reduce(DataFrame.unionByName, [x.select(columns) for x in (chosen, phrases.where(out_ | F.col("objectless")), singles)])
    return _counted(units.withColumns({"span_token_count": F.size(F.split("surface", " ")), "anchor_token_offset": F.when(F.col("unit") == PHRASE, F.size(F.split("surface", " ")) - 1).otherwise(0)}), ["unit", "span_key"], ["span_token_count", "anchor_token_offset"], answers, ["unit", "span_key"])


def _counted(units: DataFrame, key: list[str], also: list[str], answers: DataFrame, on: list[str]) -> DataFrame:
    """Units counted by key with surfaces and captions, and of their decisions the one that asks most: open, chosen, found, none."""
    totals = units.groupBy(*key).agg(F.count(F.lit(1)).alias("observed_count"), F.count_distinct("caption_id").alias("caption_count"), *(F.max(c).alias(c) for c in also))
    captions = units.select(*key, "caption_id").distinct().withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy("caption_id"))).where("r <= 5")
    captions = captions.groupBy(*key).agg(pipe_join(F.array_sort(F.collect_list("caption_id"))).alias("example_caption_ids"))
    surfaces = units.groupBy(*key, "surface").agg(F.count(F.lit(1)).alias("n"))
    surfaces = surfaces.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("n"), "surface"))).where("r <= 5")
    surfaces = surfaces.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "surface"))), lambda x: x.surface).alias("s"))
    surfaces = surfaces.select(*key, F.col("s")[0].alias("observed_surface"), pipe_join("s").alias("example_surfaces"))
    rank = F.when(F.col("decision_status") == status.PENDING, 4).when(F.col("selected").isNotNull(), 3).when(F.size("synsets") > 0, 2).otherwise(1)
    seen = units.select(*key, *(c for c in ("plural",) if c in units.columns)).distinct()
    best = first_per_key(answers.join(seen, seen.columns, "left_semi"), on, [F.desc(rank), *(c for c in ("plural",) if c in units.columns)]).drop("plural")
    return totals.join(surfaces, key).join(captions, key).join(best, on, "left")


# --- actions


def action_lookup(keys: DataFrame, lemmas: DataFrame, morphy: DataFrame, sense_counts: DataFrame, by_key: DataFrame | None = None, by_query: DataFrame | None = None) -> DataFrame:
    """The decision on every verb phrase: key, lookup_case, query, synsets[], selected, tag, decision_status, decision_reason.

    An earlier decision on the same key goes first (``by_key``: key, synset; blank means none). Then the phrase is looked up as it is, then
    with the base forms of its verb; several base forms that hit need a decision. What is found so takes over the sense that
    earlier rows with its query agree on (``by_query``: key, synset), if it is among the senses found."""
    keys = keys.select("key").where("key <> ''").distinct()
    senses = dimension(forms(lemmas, "v"))
    words = F.split("key", " ")
    exact = keys.select("key", F.lit(0).alias("rank"), F.lit("exact").alias("lookup_case"), F.col("key").alias("query")).join(senses, "query")
    bases = morphy.where("pos = 'v'").select(F.col("form").alias("_w"), "lemma")
    based = keys.withColumn("_w", words[0]).join(bases, "_w").select("key", F.lit(1).alias("rank"), F.lit("head_morphy").alias("lookup_case"), normalize_query(F.array_join(F.concat(F.array("lemma"), F.slice(words, 2, F.size(words))), " ")).alias("query"))
    based = based.where("query <> key").distinct().join(senses, "query")
    hits = exact.unionByName(based.join(exact.select("key"), "key", "left_anti"))
    per = hits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "query", "lookup_case", "synsets"))).alias("hits"))
    each = hits.select("query", F.explode("synsets").alias("synset"), F.size("synsets").alias("n")).distinct()
    counted = each.join(sense_counts.select("synset", F.col("lemma").alias("query"), F.col("n").alias("uses")), ["synset", "query"], "left").fillna(0, ["uses"])
    counted = counted.withColumn("most", F.max("uses").over(Window.partitionBy("query")))
    best = counted.groupBy("query").agg(F.max("n").alias("n"), F.max("most").alias("most"), F.count_if(F.col("uses") == F.col("most")).alias("tops"), F.min(F.when(F.col("uses") == F.col("most"), F.col("synset"))).alias("top"))
    sure = (F.col("n") == 1) | ((F.col("most") > 0) & (F.col("tops") == 1))
    tag = F.when(F.col("n") == 1, "single_oewn_verb_synset").when(sure, "selected_by_wn30_lemma_count").when(F.col("most") > 0, "ambiguous_wn30_tie").otherwise("ambiguous_wn30_all_zero_or_mapping_missing")
    best = best.select("query", F.when(sure, F.col("top")).alias("selected"), tag.alias("tag"))
    one = per.withColumns({"n": F.size("hits"), "query": F.array_join(F.transform("hits", lambda h: h.query), "|"), "synsets": F.array_distinct(F.flatten(F.transform("hits", lambda h: h.synsets))), "lookup_case": F.when(F.size("hits") == 1, F.col("hits")[0]["lookup_case"]).otherwise("head_morphy_ambiguous")})
    one = one.join(dimension(best), "query", "left")
    tag = F.when(F.col("n") > 1, "ambiguous_multiple_head_morphy").otherwise(F.col("tag"))
    out = one.select("key", "lookup_case", "query", "synsets", "selected", tag.alias("tag"), F.when(F.col("selected").isNull(), status.PENDING).otherwise("chosen").alias("decision_status"), F.when(F.col("selected").isNull(), "manual_synset_required").otherwise("selected_verb_synset").alias("decision_reason"))
    if by_query is not None:  # the senses that earlier rows with one of the queries agree on
        asked = out.select("key", "synsets", F.posexplode(F.split("query", "[|]")).alias("at", "q")).join(dimension(by_query.select(F.col("key").alias("q"), F.col("synset").alias("old"))), "q")
        agreed = asked.groupBy("key").agg(F.count_distinct("old").alias("kinds"), F.min("old").alias("old"), F.min_by("q", "at").alias("q"), F.first("synsets").alias("s")).where("kinds = 1 and array_contains(s, old)")
        out = out.join(agreed.select("key", "old", "q"), "key", "left")
        taken = F.col("old").isNotNull()
        out = out.select(
            "key", F.when(taken, F.concat("lookup_case", F.lit("_prior_selected_query"))).otherwise(F.col("lookup_case")).alias("lookup_case"), F.when(taken, F.col("q")).otherwise(F.col("query")).alias("query"), "synsets",
            F.coalesce("old", "selected").alias("selected"), F.when(taken, "selected_by_prior_action_selected_query").otherwise(F.col("tag")).alias("tag"),
            F.when(taken, "chosen").otherwise(F.col("decision_status")).alias("decision_status"), F.when(taken, "prior_action_selected_query_reused").otherwise(F.col("decision_reason")).alias("decision_reason"),
        )
    out = keys.join(out, "key", "left")
    if by_key is not None:
        out = out.join(dimension(by_key.select("key", F.col("synset").alias("own"))), "key", "left")
        mine, sense = F.col("own").isNotNull(), F.nullif(F.col("own"), F.lit(""))
        none = F.array().cast("array<string>")
        out = out.select(
            "key", F.when(mine, "prior_action").otherwise(F.col("lookup_case")).alias("lookup_case"), F.when(mine, F.col("key")).otherwise(F.col("query")).alias("query"),
            F.when(mine, F.when(sense.isNotNull(), F.array(sense)).otherwise(none)).otherwise(F.col("synsets")).alias("synsets"), F.when(mine, sense).otherwise(F.col("selected")).alias("selected"),
            F.when(mine, "prior_decision").otherwise(F.col("tag")).alias("tag"), F.when(mine, F.when(sense.isNotNull(), "chosen").otherwise("raw_fallback")).otherwise(F.col("decision_status")).alias("decision_status"),
            F.when(mine, "prior_decision_reused").otherwise(F.col("decision_reason")).alias("decision_reason"),
        )
    fill = {"lookup_case": "raw_fallback", "tag": "unresolved_no_oewn_verb_synset", "decision_status": "raw_fallback", "decision_reason": "no_oewn_verb_synset"}
    return out.fillna(fill).withColumns({"query": F.coalesce("query", "key"), "synsets": F.coalesce("synsets", F.array().cast("array<string>"))})


def action_phrases(annotated: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows of ``action_candidates`` for all verbs, made from each caption's own tokens: nothing but the taken words meets a caption."""
    held = taken.groupBy("caption_id").agg(F.collect_set("i").alias("taken"))
    rows = annotated.select("caption_id", "tokens").join(held, "caption_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    is_prep = lambda t: yes((t.dep == "prep") | (t.pos == "ADP"))
    word = lambda t: F.struct(t.i.alias("i"), t.head_i.alias("head_i"), t.text.alias("text"), is_prep(t).alias("prep"))
    loose = F.filter("tokens", lambda t: yes(t.i != t.head_i) & ~yes(F.array_contains("taken", t.i)) & (is_prep(t) | yes((t.dep == "prt") | (t.tag == "RP"))))
    particles = F.transform(F.filter("loose", lambda t: yes((t.dep == "prt") | (t.tag == "RP"))), word)
    rows = rows.withColumn("loose", loose).select("caption_id", F.filter("tokens", lambda t: yes(t.pos == "VERB")).alias("verbs"), particles.alias("prt"), F.transform(F.filter("loose", is_prep), word).alias("prep"))
    no = F.array().cast("array<int>")

    def kind(v: Column, rank: int, parts: Column, preps: Column, text: Column) -> Column:
        return F.struct(v.i.alias("head"), v.lemma.alias("lemma"), F.lit(rank).alias("rank"), parts.alias("parts"), preps.alias("preps"), text.alias("text"))

    def of(v: Column) -> Column:
        under = lambda w: F.filter("prep", lambda q: yes((q.head_i == w.i) & (q.i > v.i)))
        mine = F.filter("prt", lambda p: yes(p.head_i == v.i))
        both = lambda p: F.concat(F.filter(under(v), lambda q: q.i != p.i), under(p))
        three = lambda p: F.transform(both(p), lambda q: kind(v, 0, F.array(v.i, p.i, q.i), F.when(p.prep, F.array(p.i, q.i)).otherwise(F.array(q.i)), F.concat_ws(" ", v.text, p.text, q.text)))
        return F.concat(
            F.array(kind(v, 3, F.array(v.i), no, v.text)),
            F.transform(under(v), lambda q: kind(v, 2, F.array(v.i, q.i), F.array(q.i), F.concat_ws(" ", v.text, q.text))),
            F.transform(mine, lambda p: kind(v, 1, F.array(v.i, p.i), F.when(p.prep, F.array(p.i)).otherwise(no), F.concat_ws(" ", v.text, p.text))),
            F.flatten(F.transform(mine, three)),
        )

    found = rows.select("caption_id", F.inline(F.array_distinct(F.flatten(F.transform("verbs", of)))))
    return found.select("caption_id", "head", "lemma", "rank", "parts", "preps", normalize_query("text").alias("key"), "text")


def action_inventory(annotated: DataFrame, prepositions: DataFrame, lookup, cut=lambda df: df.checkpoint()) -> DataFrame:
    """The observed verb phrases with their decisions: span_key, observed_surface, example_surfaces, observed_count, caption_count,
    example_caption_ids, candidate_types and the columns of ``action_lookup``.

    ``lookup``: keys -> decisions. Of a verb's candidates that have senses the longest is counted, of equally long ones by ACTION_TYPES and
    place; without any the bare verb. Words of prepositional phrases are no parts of verb phrases."""
    taken = _spread(preposition_matches(annotated, prepositions), "start", "end").distinct()
    found = cut(action_phrases(annotated, taken))
    answers = cut(lookup(found.select("key").distinct()))
    known = found.join(dimension(answers), "key")
    good = F.when(F.size("synsets") > 0, 0).otherwise(1)
    bare = F.when(good == 1, F.when(F.col("rank") == 3, 0).otherwise(1)).otherwise(0)
    chosen = first_per_key(known, ["caption_id", "head"], [good, bare, -F.size("parts"), "rank", "parts"]).where("key <> ''")
    units = chosen.withColumns({"surface": F.col("text"), "type": F.element_at(F.array(*map(F.lit, ACTION_TYPES)), F.col("rank") + 1)})
    types = units.groupBy("key").agg(pipe_join(F.array_sort(F.collect_set("type"))).alias("candidate_types"))
    return _counted(units, ["key"], [], answers, ["key"]).join(types, "key").withColumnRenamed("key", "span_key")


# --- canonical names of actions and attributes

# Decisions that a row may be named with, parts of speech of base forms, by kind.
READY = {"action": ("chosen", "raw_fallback"), "attribute": ("chosen", "excluded")}
NAME_POS = {"action": ("v",), "attribute": MORPHY_POS}


def canonical_blockers(rows: DataFrame, kind: str) -> DataFrame:
    """Rows that must be decided before any is named, with blocker_reason. rows: decision_status, selected."""
    state, sense = F.trim(F.coalesce("decision_status", F.lit(""))), F.coalesce("selected", F.lit("")) != ""
    if kind == "attribute":
        state = F.when(state == "no_synset", "chosen").otherwise(state)  # an older word for chosen without a sense
    reason = F.when(~state.isin(*READY[kind]), f"pending_{kind}_manual_decision_status")
    if kind == "action":
        reason = reason.when((state == "chosen") & ~sense, "chosen_action_missing_selected_synset").when((state == "raw_fallback") & sense, "raw_fallback_must_not_have_selected_synset")
    return rows.withColumn("blocker_reason", reason).where("blocker_reason is not null")


def canonical_variants(rows: DataFrame, kind: str, keys: list[str], synset_lemmas: DataFrame, sense_counts: DataFrame, morphy: DataFrame, ngrams: DataFrame) -> DataFrame:
    """keys, canonical_surface, canonical_selection_tag, candidate_lemmas[] of decided rows: keys, observed_surface, example_surfaces (piped),
    query, decision_status, selected and, of attributes, unit.

    Lemmas of the sense compete that are a spelling of something observed, or of its base form (of a phrase: of its last word). One such
    is the name; of several the one counted most, else the one that was observed letter by letter, else by its key, else the most
    frequent in n-grams; a tie leaves the row unnamed, with the reason. Without such a lemma the only lemma is the name, or n-grams
    decide among all. Excluded rows, raw fall-backs and rows without a sense have none; a sense without lemmas is an error of the row."""
    none = F.lit("")
    phrase = (F.col("unit") == PHRASE) if kind == "attribute" else F.lit(False)
    seen = F.array_distinct(F.filter(F.concat(F.array("observed_surface"), F.split("example_surfaces", "[|]")), lambda x: F.trim(x) != ""))
    r = rows.withColumns({"seen": seen, "phrase": phrase})
    spoken = r.select(*keys, "phrase", F.explode(F.array_distinct(F.concat("seen", F.filter(F.array(F.coalesce("query", none)), lambda x: x != "")))).alias("surface")).distinct()
    keyed = spoken.withColumn("k", surface_key("surface"))
    spelled = lambda c: F.when(F.col("phrase"), separator_variants(c)).otherwise(surface_variant_keys(c))
    direct = keyed.select(*keys, "phrase", F.explode(spelled(F.col("k"))).alias("key"))
    bases = morphy.where(F.col("pos").isin(*NAME_POS[kind])).select(F.col("form").alias("_w"), normalize_query("lemma").alias("_l")).distinct()
    words = F.split(separator_key("k"), " ")
    whole = direct.where("not phrase").join(bases, F.col("key") == F.col("_w")).select(*keys, "phrase", F.col("_l").alias("text"))
    ended = keyed.where("phrase").withColumn("words", words).where("size(words) >= 2").withColumn("_w", F.element_at("words", -1)).join(bases, "_w")
    ended = ended.select(*keys, "phrase", F.array_join(F.concat(F.slice("words", 1, F.size("words") - 1), F.array("_l")), " ").alias("text"))
    support = direct.select(*keys, "key").unionByName(whole.unionByName(ended).select(*keys, F.explode(spelled(F.col("text"))).alias("key"))).distinct()
    named = r.where("decision_status = 'chosen' and coalesce(selected, '') <> ''").select(*keys, F.col("selected").alias("synset"))
    lemmas = synset_lemmas.select("synset", "lemma", surface_key("lemma").alias("key")).distinct()
    each = named.join(dimension(lemmas), "synset").join(support.withColumn("spoken", F.lit(True)), [*keys, "key"], "left")
    each = each.join(sense_counts.select("synset", "lemma", "n"), ["synset", "lemma"], "left").join(ngrams.select("synset", F.col("surface_key").alias("key"), "mean_frequency"), ["synset", "key"], "left")
    cell = F.struct("lemma", "key", F.coalesce("n", F.lit(-1)).alias("n"), F.coalesce(F.col("mean_frequency").cast("double"), F.lit(-1.0)).alias("f"), F.coalesce("spoken", F.lit(False)).alias("spoken"))
    lists = each.groupBy(*keys).agg(F.array_sort(F.collect_list(cell)).alias("all"))
    heard = keyed.join(r.select(*keys, F.explode("seen").alias("surface")), [*keys, "surface"], "left_semi").groupBy(*keys).agg(F.collect_set("k").alias("exact_keys"), F.collect_set(display_surface("surface")).alias("exact"))
    lists = lists.join(heard, keys, "left")
    all_ = F.col("all")
    mine = F.filter(all_, lambda x: x.spoken)
    cand = F.when((F.size(mine) == 0) & (F.size(all_) == 1), all_).otherwise(mine)
    lists = lists.withColumn("cand", cand)
    c = F.col("cand")
    top = lambda xs, f: F.filter(xs, lambda x: x[f] == F.array_max(F.transform(xs, lambda y: y[f])))
    best = F.array_max(F.transform(c, lambda x: x.n))
    exact = F.filter(c, lambda x: F.array_contains("exact", display_surface(x.lemma)))
    by_key = F.filter(c, lambda x: F.array_contains("exact_keys", x.key))
    scored = F.filter(F.when(F.size(c) > 0, c).otherwise(all_), lambda x: x.f >= 0)
    fallback = F.when(F.size(c) == 0, "ambiguous_no_observed_surface_variant_matched_oewn_lemma").when(best < 0, "ambiguous_wn30_mapping_missing").when(best == 0, "ambiguous_wn30_all_zero_or_missing").otherwise("ambiguous_wn30_tie")
    steps = [  # condition, name, tag
        (F.size(c) == 1, c[0]["lemma"], F.lit("selected_single_observed_variant_matched_synset_lemma")),
        ((best > 0) & (F.size(top(c, "n")) == 1), top(c, "n")[0]["lemma"], F.lit("selected_by_wn30_lemma_count_unique_positive_max")),
        (F.size(exact) == 1, exact[0]["lemma"], F.lit("selected_by_unique_observed_span_surface")),
        (F.size(by_key) == 1, by_key[0]["lemma"], F.lit("selected_by_unique_observed_span_surface_key")),
        (F.size(scored) == 1, scored[0]["key"], F.lit("selected_by_single_available_google_ngram")),
        (F.size(scored) < 2, none, F.concat(fallback, F.lit("_google_ngram_evidence_missing"))),
        (F.size(top(scored, "f")) == 1, top(scored, "f")[0]["key"], F.lit("selected_by_google_ngram_frequency_unique_max")),
    ]
    name, tag = none, F.concat(fallback, F.lit("_google_ngram_tie"))
    for fine, value, why in reversed(steps):
        fine = F.coalesce(fine, F.lit(False))
        name, tag = F.when(fine, value).otherwise(name), F.when(fine, why).otherwise(tag)
    lists = lists.select(*keys, name.alias("name"), tag.alias("why"), F.transform("cand", lambda x: x.lemma).alias("candidate_lemmas"))
    out = r.join(lists, keys, "left")
    state, sense = F.col("decision_status"), F.coalesce("selected", none) != ""
    why = F.when(state == "excluded", "not_applicable_excluded").when(state == "raw_fallback", "not_applicable_raw_fallback_no_selected_synset").when(~sense, "not_applicable_no_selected_synset").when(F.col("why").isNull(), "ambiguous_selected_synset_lookup_error").otherwise(F.col("why"))
    fine = why == F.col("why")
    return out.select(*keys, F.when(fine, F.col("name")).otherwise("").alias("canonical_surface"), why.alias("canonical_selection_tag"), F.when(fine, F.col("candidate_lemmas")).otherwise(F.array().cast("array<string>")).alias("candidate_lemmas"))


# --- objects


def object_lookup(keys: DataFrame, lemmas: DataFrame, morphy: DataFrame, synsets: DataFrame, sense_counts: DataFrame) -> DataFrame:
    """The decision on every noun phrase that has senses: key, lookup_case, query, synsets[], selected, lexfile, tag, gate, decision_status, decision_reason."""
    asked = keys.select(F.col("key").alias("span_key")).where("span_key <> ''").distinct()
    hits = inventory.synset_hits(asked, lemmas, morphy, "n")
    chosen = inventory.decided(hits.join(inventory.sense_choice(hits, sense_counts), "span_key"), synsets)
    return chosen.select(F.col("span_key").alias("key"), "lookup_case", "query", "synsets", F.col("selected_oewn_synset").alias("selected"), F.col("selected_oewn_lexfile").alias("lexfile"), F.col("synset_selection_tag").alias("tag"), "gate", "decision_status", "decision_reason")


def object_inventory(annotated: DataFrame, lookup, prior: DataFrame | None = None, cut=lambda df: df.checkpoint()) -> DataFrame:
    """The observed objects with their decisions: span_key, observed_surface, example_surfaces, observed_count, caption_count,
    example_caption_ids, the columns of ``object_lookup`` and reused.

    Of a noun chunk the longest span that ends at its root counts which an earlier row has (``prior``: key and the columns of object_lookup), or
    whose text, or else whose text with the root's base form, has senses; without any the root alone. ``lookup``: keys -> decisions."""
    spans = cut(chunk_spans(annotated))
    keys = spans.select(F.explode("keys").alias("key")).distinct()
    answers = lookup(keys).where(F.size("synsets") > 0)
    columns = [c for c in answers.columns if c != "key"]
    answers = answers.select("key", F.struct(*columns).alias("d"), F.lit(False).alias("old"))
    if prior is not None:
        empty = F.array().cast("array<string>")
        fill = {c: F.col(c) if c in prior.columns else (empty if c == "synsets" else F.lit(None).cast("string")) for c in columns}
        answers = answers.unionByName(first_per_key(prior, ["key"], ["decision_status"]).select("key", F.struct(*(v.alias(c) for c, v in fill.items())).alias("d"), F.lit(True).alias("old")))
    answers = cut(answers)
    tried = spans.select("caption_id", "chunk_ix", "start", "surface", F.posexplode("keys").alias("n", "key"))
    found = tried.join(dimension(answers), "key").where("not old or n = 0")
    best = first_per_key(found, ["caption_id", "chunk_ix"], ["start", F.when(F.col("old"), 0).otherwise(1), "n"]).select("caption_id", "chunk_ix", "surface", "d", "old")
    roots = spans.where("alone").select("caption_id", "chunk_ix", F.col("surface").alias("root"))
    units = roots.join(best, ["caption_id", "chunk_ix"], "left").withColumn("surface", F.coalesce("surface", "root"))
    units = units.select("caption_id", "surface", normalize_query("surface").alias("key"), *(F.col(f"d.{c}").alias(c) for c in columns), F.coalesce("old", F.lit(False)).alias("reused")).where("key <> ''")
    none = F.col("decision_status").isNull()
    fill = {"lookup_case": "unresolved", "tag": "unresolved_no_oewn_noun_synset", "decision_status": status.OBJECT.without_sense, "decision_reason": status.OBJECT.none_reason, "query": "", "gate": ""}
    units = cut(units.withColumns({**{c: F.when(none, v).otherwise(F.coalesce(c, F.lit(""))) for c, v in fill.items()}, "synsets": F.coalesce("synsets", F.array().cast("array<string>"))}))
    return _counted(units, ["key"], [], units.select("key", *columns, "reused").distinct(), ["key"]).withColumnRenamed("key", "span_key")


def chunk_spans(annotated: DataFrame) -> DataFrame:
    """caption_id, chunk_ix, start, surface, keys[], alone: the spans of each noun chunk that end at its root and may begin where they do; their
    text, and the keys of their text and of it with the root's base form."""
    chunks = annotated.select("caption_id", "tokens", F.posexplode("noun_chunks").alias("chunk_ix", "c")).where("c.root_i >= c.token_start and c.root_i < c.token_end")
    starts = chunks.select("caption_id", "chunk_ix", "tokens", F.col("c.root_i").alias("root_i"), F.explode(F.sequence("c.token_start", "c.root_i")).alias("start"))
    span = F.slice("tokens", F.col("start") + 1, F.col("root_i") - F.col("start") + 1)
    starts = starts.withColumn("span", span).drop("tokens")
    first, last = F.col("span")[0], F.element_at("span", -1)
    alone = F.col("start") == F.col("root_i")
    fine = alone | ~(F.coalesce(first.dep.isin(*BLOCKED_START_DEPS), F.lit(False)) | F.coalesce(first.pos.isin(*BLOCKED_START_POS), F.lit(False)))
    raw = _written(F.col("span"))
    words = F.split(normalize_query(raw), " ")
    based = F.array_join(F.concat(F.slice(words, 1, F.size(words) - 1), F.array(normalize_query(last.lemma))), " ")
    keys = F.array_distinct(F.array(normalize_query(raw), F.when(F.coalesce(last.lemma, F.lit("")) != "", based).otherwise(normalize_query(raw))))
    return starts.where(fine).select("caption_id", "chunk_ix", "start", raw.alias("surface"), keys.alias("keys"), alone.alias("alone"))


def ordered(rows: DataFrame) -> DataFrame:
    """Inventory rows as files hold them: the most frequent first, then by key."""
    return rows.orderBy(F.desc("observed_count"), "span_key")
