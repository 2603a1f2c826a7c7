"""Inventories of observed spans: building, deciding, naming, overlaying, merging, exporting.

WordNet enters as dimension tables: ``lemmas(form, pos, synset)``, ``synsets(synset, lexfile)``, ``synset_lemmas(synset, lemma)``,
``hypernyms(child, parent)``, ``sense_counts(synset, lemma, n)`` and ``morphy(form, pos, lemma)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import status
from ..functions.text import lookup_queries, normalize_query, pipe_join, separator_variants, surface_key
from .fold import first_per_key, unique_maximum

# The order in which look-ups are tried.
LOOKUP_ORDER = ("exact", "separator", "joined", "morphy")


def observed(spans: DataFrame, key: str = "span_key", keep: int = 5) -> DataFrame:
    """key, observed_count, caption_count, the ``keep`` most frequent surfaces (of equally frequent ones those seen first).
    spans: (key, surface, caption_id, position)."""
    totals = spans.groupBy(key).agg(F.count(F.lit(1)).alias("observed_count"), F.count_distinct("caption_id").alias("caption_count"))
    surfaces = spans.groupBy(key, "surface").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first_seen"))
    place = Window.partitionBy(key).orderBy(F.desc("n"), "first_seen")
    best = surfaces.withColumn("r", F.row_number().over(place)).where(F.col("r") <= keep)
    best = best.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "surface"))), lambda x: x["surface"]).alias("example_surfaces"))
    return totals.join(best, key).withColumns({"observed_surface": F.col("example_surfaces")[0], "example_surfaces": pipe_join("example_surfaces")})


def synset_hits(keys: DataFrame, lemmas: DataFrame, morphy: DataFrame, pos: str) -> DataFrame:
    """span_key, lookup_case, query, synsets[]: the first look-up that finds senses, in LOOKUP_ORDER."""
    forms = lemmas.where(F.col("pos") == pos).groupBy(F.col("form").alias("query")).agg(F.array_sort(F.collect_set("synset")).alias("synsets"))
    tried = keys.select("span_key", F.inline(lookup_queries("span_key")))
    base = keys.join(morphy.where(F.col("pos") == pos), keys["span_key"] == morphy["form"]).select("span_key", F.lit("morphy").alias("kind"), F.col("lemma").alias("query"))
    hits = tried.unionByName(base).join(forms, "query")
    order = F.array_position(F.array(*map(F.lit, LOOKUP_ORDER)), F.col("kind"))
    return first_per_key(hits, ["span_key"], [order, "query"]).select("span_key", F.col("kind").alias("lookup_case"), "query", "synsets")


def verb_hits(keys: DataFrame, lemmas: DataFrame, morphy: DataFrame) -> DataFrame:
    """Senses of a verb phrase by its exact lemma or, for one base form only, by that; several base forms need a decision."""
    forms = lemmas.where("pos = 'v'").groupBy(F.col("form").alias("query")).agg(F.array_sort(F.collect_set("synset")).alias("synsets"))
    exact = keys.select("span_key", F.col("span_key").alias("query"), F.lit("exact").alias("lookup_case"))
    based = keys.join(morphy.where("pos = 'v'"), keys["span_key"] == morphy["form"]).select("span_key", F.col("lemma").alias("query"), F.lit("morphy").alias("lookup_case"))
    hits = exact.unionByName(based).join(forms, "query").distinct()
    w = Window.partitionBy("span_key")
    hits = hits.withColumn("bases", F.size(F.collect_set(F.when(F.col("lookup_case") == "morphy", F.col("query"))).over(w)))
    out = first_per_key(hits, ["span_key"], [F.when(F.col("lookup_case") == "exact", 0).otherwise(1), "query"])
    return out.select("span_key", "lookup_case", "query", "synsets", ((F.col("lookup_case") == "morphy") & (F.col("bases") > 1)).alias("needs_manual"))


def sense_choice(hits: DataFrame, sense_counts: DataFrame) -> DataFrame:
    """One sense for each key: the only one, else the one with the highest positive count of the query, if no other has it too."""
    each = hits.select("span_key", "query", F.explode("synsets").alias("synset"), F.size("synsets").alias("n"))
    counted = each.join(sense_counts.select("synset", F.col("lemma").alias("query"), F.col("n").alias("uses")), ["synset", "query"], "left").fillna(0, ["uses"])
    top = unique_maximum(counted, ["span_key"], "uses").groupBy("span_key").agg(F.min("synset").alias("synset"), F.max("n").alias("n"), F.max("uses").alias("uses"), F.min("unique").alias("unique"))
    tag = F.when(F.col("n") == 1, "single_synset").when(F.col("unique") & (F.col("uses") > 0), "max_sense_count").otherwise("ambiguous")
    return top.select("span_key", F.when(tag != "ambiguous", F.col("synset")).alias("selected_oewn_synset"), tag.alias("synset_selection_tag"), F.col("n").alias("n_synsets"))


def decided(rows: DataFrame, synsets: DataFrame, kind: status.Kind = status.OBJECT) -> DataFrame:
    """Gate, status and reason of chosen senses. rows: selected_oewn_synset, n_synsets, lookup_case (joined hits need a decision)."""
    out = rows.join(synsets.select(F.col("synset").alias("selected_oewn_synset"), F.col("lexfile").alias("selected_oewn_lexfile")), "selected_oewn_synset", "left")
    gate = status.gate(F.col("selected_oewn_lexfile"), kind)
    out = out.withColumn("gate", gate)
    joined = F.coalesce(F.col("lookup_case") == "joined", F.lit(False))
    n = F.coalesce("n_synsets", F.lit(0))
    return out.withColumns(
        {
            "decision_status": F.when(joined & (n > 0), status.PENDING).otherwise(status.selection_status(F.col("selected_oewn_synset"), n, F.col("gate"), kind)),
            "decision_reason": F.when(joined & (n > 0), "manual_joined_variant_required").otherwise(status.selection_reason(F.col("selected_oewn_synset"), n, F.col("gate"), kind)),
        }
    )


def parents(rows: DataFrame, hypernyms: DataFrame, synset_lemmas: DataFrame) -> DataFrame:
    """Adds the direct hypernyms of the chosen sense: ids, and ``id:lemma; lemma`` labels, both sorted by id."""
    names = synset_lemmas.groupBy("synset").agg(F.array_join(F.array_sort(F.collect_set("lemma")), "; ").alias("names"))
    up = hypernyms.join(names, F.col("parent") == F.col("synset"), "left").groupBy("child").agg(F.array_sort(F.collect_set(F.struct("parent", F.coalesce("names", F.lit("")).alias("names")))).alias("p"))
    out = rows.join(up, F.col("selected_oewn_synset") == F.col("child"), "left").drop("child")
    p = F.coalesce("p", F.array().cast("array<struct<parent:string,names:string>>"))
    return out.withColumns({"parent_oewn_synsets": pipe_join(F.transform(p, lambda x: x["parent"])), "parent_lemmas": pipe_join(F.transform(p, lambda x: F.concat(x["parent"], F.lit(":"), x["names"])))}).drop("p")


def canonical_surface(rows: DataFrame, synset_lemmas: DataFrame, sense_counts: DataFrame, ngrams: DataFrame) -> DataFrame:
    """span_key, canonical_surface, canonical_selection_tag for rows (span_key, selected_oewn_synset).

    The lemmas of the sense compete: the only one; the one used most by its counts; the one that is the span itself; the one that
    is the span after folding; the one most frequent in n-grams; else it is ambiguous."""
    each = rows.where("coalesce(selected_oewn_synset, '') <> ''").select("span_key", F.col("selected_oewn_synset").alias("synset")).join(synset_lemmas, "synset")
    each = each.join(sense_counts.select("synset", "lemma", "n"), ["synset", "lemma"], "left").withColumn("surface", F.translate("lemma", "_", " "))
    each = each.withColumn("surface_key", surface_key("surface")).join(ngrams.select(F.col("selected_oewn_synset").alias("synset"), "surface_key", "mean_frequency"), ["synset", "surface_key"], "left")
    w = Window.partitionBy("span_key")
    most, freq = F.max("n").over(w), F.max("mean_frequency").over(w)
    marks = each.withColumns({"only": F.count(F.lit(1)).over(w) == 1, "used": (F.col("n") == most) & (most > 0), "same": normalize_query("surface") == F.col("span_key"), "folded": F.col("surface_key") == surface_key("span_key"), "often": F.col("mean_frequency") == freq})
    tags = ("only", "used", "same", "folded", "often")
    marks = marks.withColumns({f"{t}_n": F.count_if(t).over(w) for t in tags})
    names = {"only": "single_lemma", "used": "max_sense_count", "same": "exact_surface", "folded": "folded_surface", "often": "max_ngram_frequency"}
    tag = reduce(lambda a, t: F.when(F.col(f"{t}_n") == 1, names[t]).otherwise(a), reversed(tags), F.lit("ambiguous"))
    hit = reduce(lambda a, t: F.when(F.col(f"{t}_n") == 1, F.coalesce(t, F.lit(False))).otherwise(a), reversed(tags), F.lit(False))
    return marks.withColumns({"tag": tag, "hit": hit}).groupBy("span_key").agg(F.coalesce(F.max(F.when(F.col("hit"), F.col("surface"))), F.lit("")).alias("canonical_surface"), F.min("tag").alias("canonical_selection_tag"))


def missing_evidence(rows: DataFrame, synset_lemmas: DataFrame, ngrams: DataFrame) -> DataFrame:
    """(synset, surface_key) pairs that have no n-gram frequency yet."""
    asked = rows.select(F.col("selected_oewn_synset").alias("synset")).distinct().join(synset_lemmas, "synset").select("synset", surface_key(F.translate("lemma", "_", " ")).alias("surface_key"))
    return asked.join(ngrams.select(F.col("selected_oewn_synset").alias("synset"), "surface_key"), ["synset", "surface_key"], "left_anti").distinct()


def overlay(rows: DataFrame, decisions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with the decisions' columns in place of their own; both must have exactly the same keys, or the job fails."""
    lost = key_differences(rows, decisions, key)
    if (n := lost.limit(1).count()) > 0:
        raise ValueError(f"keys differ, for example {lost.first()[key]!r} ({n})")
    d = decisions.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_d_{c}") for c in columns))
    out = rows.join(d, F.col(key) == F.col("_k"))
    return out.withColumns({c: F.col(f"_d_{c}") for c in columns}).select(*rows.columns)


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables has, with ``side`` removed (only in the first) or added."""
    gone = a.select(key).subtract(b.select(key)).withColumn("side", F.lit("removed"))
    return gone.unionByName(b.select(key).subtract(a.select(key)).withColumn("side", F.lit("added")))


def edits(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows with the non-null cells of ``changes`` (a subset of keys and columns) written over theirs."""
    columns = [c for c in changes.columns if c != key]
    c = changes.select(F.col(key).alias("_k"), *(F.col(x).alias(f"_c_{x}") for x in columns))
    out = rows.join(c, F.col(key) == F.col("_k"), "left")
    return out.withColumns({x: F.coalesce(f"_c_{x}", x) for x in columns}).select(*rows.columns)


def reopen(rows: DataFrame, keys: DataFrame, key: str = "span_key") -> DataFrame:
    """Rows of some keys put back to needs_manual."""
    return edits(rows, keys.select(key).distinct().withColumns({"decision_status": F.lit(status.PENDING), "decision_reason": F.lit("reopened")}), key)


def merge_prior(files: list[DataFrame], key: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row for each key, from the first file that has it; and the keys whose values differ between files."""
    rows = reduce(DataFrame.unionByName, [f.withColumn("_file", F.lit(i)) for i, f in enumerate(files)])
    merged = first_per_key(rows, [key], ["_file", *values]).drop("_file")
    conflicts = rows.groupBy(key).agg(F.count_distinct(F.struct(*values)).alias("variants"), F.count_distinct("_file").alias("files")).where("variants > 1 and files > 1")
    return merged, conflicts


def reuse_prior(spans: DataFrame, prior: DataFrame, key: str = "span_key") -> DataFrame:
    """Observed spans with an earlier decision where there is one."""
    return spans.join(prior.withColumn("reused", F.lit(True)), key, "left").fillna(False, ["reused"])


def reuse_by_query(actions: DataFrame, prior: DataFrame) -> DataFrame:
    """Actions without a decision of their own take that of their query, if all earlier rows with the query agree."""
    agreed = prior.where("decision_status = 'chosen' and selected_oewn_synset <> ''").groupBy("selected_query").agg(F.count_distinct("selected_oewn_synset").alias("n"), F.min("selected_oewn_synset").alias("_synset")).where("n = 1").drop("n")
    out = actions.join(agreed, "selected_query", "left")
    take = F.col("_synset").isNotNull() & (F.coalesce("selected_oewn_synset", F.lit("")) == "")
    return out.withColumns({"selected_oewn_synset": F.when(take, F.col("_synset")).otherwise(F.col("selected_oewn_synset")), "reused": take}).drop("_synset")


def without_plural_heads(prior: DataFrame, plurals: DataFrame) -> DataFrame:
    """Earlier rows but those whose key is seen as the plural head of a span."""
    return prior.join(plurals.select(F.col("span_key")).distinct(), "span_key", "left_anti")


def add_rows(rows: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Both; an added row replaces the row of the same key."""
    return rows.join(extra.select(*keys), keys, "left_anti").unionByName(extra, allowMissingColumns=True)


def recount(rows: DataFrame, mentions: DataFrame) -> DataFrame:
    """Inventory phrases with the occurrences and captions that extraction found of them."""
    seen = mentions.where("attribute_unit_type = 'mwe'").groupBy(F.col("inventory_span_key").alias("span_key")).agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("caption_id").alias("_c"))
    return rows.drop("observed_count", "caption_count").join(seen, "span_key", "left").withColumns({"observed_count": F.coalesce("_n", F.lit(0)), "caption_count": F.coalesce("_c", F.lit(0))}).drop("_n", "_c")


def export_lexicon(rows: DataFrame, fields: tuple[str, ...] = ("span_key", "observed_surface", "selected_query", "canonical_label_key")) -> DataFrame:
    """raw, canonical: every name of a chosen row leads to its canonical surface; a name with two canonicals fails the job."""
    names = F.array_distinct(F.filter(F.array(*(normalize_query(F.coalesce(f, F.lit(""))) for f in fields if f in rows.columns)), lambda x: x != ""))
    each = rows.where("decision_status = 'chosen' and canonical_surface <> ''").select(F.explode(names).alias("raw"), "canonical_surface")
    out = each.groupBy("raw").agg(F.count_distinct("canonical_surface").alias("n"), F.min("canonical_surface").alias("canonical"))
    fail = F.raise_error(F.concat(F.lit("one name, two canonicals: "), F.col("raw")))
    return out.select("raw", F.when(F.col("n") == 1, F.col("canonical")).otherwise(fail).alias("canonical"))


def preposition_inventory(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """surface, sources, n_tokens of prepositional phrases from several lists (each with a column ``surface``)."""
    rows = reduce(DataFrame.unionByName, [df.select(normalize_query("surface").alias("surface"), F.lit(name).alias("source")) for name, df in sources])
    out = rows.where("surface <> ''").groupBy("surface").agg(pipe_join(F.array_sort(F.collect_set("source"))).alias("sources"), F.count_distinct("source").alias("n_sources"))
    return out.withColumn("n_tokens", F.size(F.split("surface", " "))).where("n_tokens >= 2")


def label_candidates(labels: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Senses of dataset labels through any spelling of them: label, synset, and the spellings that hit."""
    tried = labels.select("label", F.explode(separator_variants("label")).alias("form"))
    return tried.join(lemmas.select(F.translate("form", "_", " ").alias("form"), "synset"), "form").groupBy("label", "synset").agg(pipe_join(F.array_sort(F.collect_set("form"))).alias("forms"))


def label_conflicts(decisions: DataFrame) -> DataFrame:
    """Labels to which datasets give different senses. decisions: (dataset, label, synset)."""
    return decisions.groupBy("label").agg(F.count_distinct("synset").alias("synsets"), pipe_join(F.array_sort(F.collect_set("dataset"))).alias("datasets")).where("synsets > 1")


def source_histograms(rows: DataFrame, by: str, kinds: list[str]) -> DataFrame:
    """by, kind, value, n, occurrences: for each value of ``by`` and each kind column its values with their counts. Values stay rows, so
    no key's values are ever held in one row."""
    total = rows.groupBy(by).agg(F.count(F.lit(1)).alias("occurrences"))
    each = [rows.where(F.col(k).isNotNull()).groupBy(by, F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")) for k in kinds]
    return reduce(DataFrame.unionByName, each).join(total, by)


def series_statistics(rows: DataFrame, key: str, series: str) -> DataFrame:
    """Mean, maximum and non-zero members of a frequency series (an array column)."""
    s = F.col(series)
    total = F.aggregate(s, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0)))
    mean: Column = F.when(F.size(s) > 0, total / F.size(s))
    return rows.select(key, mean.alias("mean_frequency"), F.array_max(s).cast("double").alias("max_frequency"), F.size(F.filter(s, lambda x: x > 0)).alias("nonzero_years"))


def bundle_problems(paths: dict[str, str], required: tuple[str, ...], ready: dict[str, DataFrame]) -> list[str]:
    """Why an inventory bundle must not be published: absent components, and components that still have open decisions.
    ready: for each component its blocking rows."""
    missing = [f"missing: {n}" for n in required if not paths.get(n)]
    return missing + [f"open decisions: {n}" for n, rows in ready.items() if rows.limit(1).count()]
