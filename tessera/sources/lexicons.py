"""Dimension tables: inventories and lexicons, read from TSV files or given as DataFrames, with the checks that they must pass.

Row order counts in these files (the first, or the last, row of a key wins), so readers number the rows. Files of this kind are
small; they are read as one partition to keep their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import status
from ..functions.text import lexicon_key, normalize_query, pipe_split, separator_key
from ..operators.extract import Lexicons
from ..operators.fold import first_per_key
from ..schema import require

# The version that attribute inventories must carry, and the columns that they must have.
ATTRIBUTE_RULE_VERSION = "r11.1-attribute-mwe-v2"
ATTRIBUTE_COLUMNS = ("attribute_unit_type", "span_token_count", "anchor_token_offset", "lookup_forms", "attribute_mwe_rule_version")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, null as '', and in ``_pos`` where each row stands: file, split of the file, place. Rows are ordered by it as they
    stand in the files (files by name), whatever tasks read them."""
    rows = spark.read.options(sep="\t", header=True, quote="\u0000", encoding="UTF-8").csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return rows.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.lstrip("﻿")) for c in rows.columns), place.alias("_pos"))


def _col(rows: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in rows.columns else F.lit("")


def _first(rows: DataFrame, *names: str) -> Column:
    """The first non-blank of some columns."""
    return F.coalesce(*(F.nullif(F.trim(_col(rows, n)), F.lit("")) for n in names), F.lit(""))


def _span_key(rows: DataFrame) -> Column:
    return F.coalesce(F.nullif(_col(rows, "span_key"), F.lit("")), normalize_query(_col(rows, "observed_surface")))


def decisions(rows: DataFrame) -> Column:
    return status.decision_status(_col(rows, "decision_status"), _col(rows, "extraction_status"), _col(rows, "selection_status"))


def blockers(rows: DataFrame, kind: str = "object") -> DataFrame:
    """Rows that extraction must not run with, and why: no decision, or a chosen sense without a canonical surface."""
    decision = decisions(rows)
    unnamed = (decision == "chosen") & (_col(rows, "selected_oewn_synset") != "") & (_col(rows, "canonical_surface") == "") & (_col(rows, "canonical_selection_tag") != "not_applicable_no_selected_synset")
    reason = F.when(decision == status.PENDING, "needs_manual").when(decision == "", "no_decision")
    if kind == "object":
        reason = reason.when(unnamed, "chosen_without_canonical")
    return rows.withColumn("blocker", reason).where("blocker is not null")


def require_ready(rows: DataFrame, kind: str = "object") -> None:
    """Fails if any row of the inventory, met in a caption or not, still needs a decision."""
    found = [r["span_key"] for r in blockers(rows, kind).select(_span_key(rows).alias("span_key")).limit(5).collect()]
    if found:
        raise ValueError(f"{kind} inventory rows need a decision first: {found}")


def object_inventory(rows: DataFrame) -> DataFrame:
    """The first row of each key, in the form that extraction looks up."""
    require_ready(rows, "object")
    out = rows.select(
        "_pos",
        _span_key(rows).alias("key"),
        _first(rows, "selected_query", "span_key").alias("query"),
        *(_col(rows, c).alias(c) for c in ("canonical_surface", "canonical_label_key", "canonical_selection_tag")),
        F.transform(pipe_split(_col(rows, "synset_lemmas")), lambda x: F.trim(x)).alias("synset_lemmas"),
        pipe_split(_col(rows, "parent_lemmas")).alias("parent_lemmas"),
        pipe_split(_col(rows, "parent_oewn_synsets")).alias("parent_synset_ids"),
        _col(rows, "selected_oewn_synset").alias("selected_synset"),
        _col(rows, "selected_oewn_lexfile").alias("selected_lexfile"),
        decisions(rows).alias("decision"),
        status.gate(_col(rows, "selected_oewn_lexfile")).alias("gate"),
    )
    return first_per_key(out.where("key <> ''"), ["key"], ["_pos"]).drop("_pos")


def action_inventory(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Actions by their key, and by their query where all rows that could be reused agree on the sense."""
    require_ready(rows, "action")
    named = rows.select("_pos", _span_key(rows).alias("key"), normalize_query(_col(rows, "selected_query")).alias("query"), _first(rows, "selected_oewn_synset", "all_oewn_synsets").alias("synset"), _col(rows, "selected_oewn_synset").alias("selected"), decisions(rows).alias("decision"))
    by_key = first_per_key(named.where("key <> ''"), ["key"], ["_pos"]).select("key", "query", F.when(F.col("decision") == "excluded", "").otherwise(F.col("synset")).alias("synset"))
    reusable = named.where("decision = 'chosen' and selected <> '' and query <> ''")
    by_query = reusable.groupBy(F.col("query").alias("key")).agg(F.count_distinct("selected").alias("n"), F.min_by("selected", "_pos").alias("synset")).where("n = 1").drop("n")
    return by_key, by_query


def attribute_phrases(rows: DataFrame) -> DataFrame:
    """key, span_key, canonical_surface of chosen multi-word attributes. Exact forms own a key before aliases do; two rows with
    one form but different identities fail the job, as do a missing column, another rule version and an impossible structure."""
    missing = [c for c in ATTRIBUTE_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"the attribute inventory lacks {missing}")
    version = require(F.col("attribute_mwe_rule_version") == ATTRIBUTE_RULE_VERSION, F.concat(F.lit("another rule version: "), F.col("attribute_mwe_rule_version")), F.col("attribute_unit_type"))
    count, anchor = F.expr("try_cast(span_token_count as int)"), F.expr("try_cast(anchor_token_offset as int)")
    chosen = rows.withColumn("attribute_unit_type", version).where("attribute_unit_type = 'mwe' and trim(decision_status) = 'chosen'")
    key = require((count >= 2) & (anchor >= 1) & (anchor < count), F.concat(F.lit("impossible phrase: "), F.col("span_key")), normalize_query("span_key"))
    chosen = chosen.withColumns({"id_key": key, "id_name": normalize_query(_col(rows, "canonical_surface"))})
    forms = lambda *cs: F.array_distinct(F.transform(F.filter(F.flatten(F.array(*(F.split(_col(rows, c), "[|]") for c in cs))), lambda x: F.trim(x) != ""), separator_key))
    each = chosen.select("_pos", "id_key", "id_name", F.lit(0).alias("rank"), F.explode(forms("span_key", "observed_surface", "example_surfaces")).alias("key"))
    each = each.unionByName(chosen.select("_pos", "id_key", "id_name", F.lit(1).alias("rank"), F.explode(forms("lookup_forms")).alias("key"))).where("key <> ''")
    best = each.groupBy("key").agg(F.min("rank").alias("rank"))
    owners = each.join(best, ["key", "rank"]).groupBy("key").agg(F.count_distinct("id_key", "id_name").alias("n"), F.max_by(F.struct("id_key", "id_name"), "_pos").alias("id"))
    fine = require(F.col("n") == 1, F.concat(F.lit("conflicting phrases: "), F.col("key")), F.col("id"))
    return owners.withColumn("id", fine).select("key", F.col("id.id_key").alias("span_key"), F.col("id.id_name").alias("canonical_surface"))


def value_lexicon(rows: DataFrame, key: str = "raw", value: str = "canonical") -> DataFrame:
    """raw, canonical: stripped, lower-case keys; rows with a blank cell are left out, a repeated key fails the job."""
    out = rows.select(lexicon_key(key).alias("raw"), F.trim(F.col(value)).alias("canonical")).where("raw <> '' and canonical <> ''")
    out = out.groupBy("raw").agg(F.count(F.lit(1)).alias("n"), F.first("canonical").alias("canonical"))
    return out.select("raw", require(F.col("n") == 1, F.concat(F.lit("repeated lexicon key: "), F.col("raw")), F.col("canonical")).alias("canonical"))


def multi_lexicon(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, values[] in file order; a repeated (key, value) fails the job."""
    out = rows.select("_pos", lexicon_key(key).alias("key"), F.trim(F.col(value)).alias("v")).where("key <> '' and v <> ''")
    out = out.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("_pos", "v"))).alias("all"))
    values = F.transform("all", lambda x: x["v"])
    return out.select("key", require(F.size(F.array_distinct(values)) == F.size(values), F.concat(F.lit("repeated value of "), F.col("key")), values).alias("values"))


#: File names of a lexicon bundle; all of them must be there.
BUNDLE = {
    "object_synonyms": ("raw", "canonical"), "object_parents": ("canonical", "parent"), "attribute_synonyms": ("raw", "canonical"),
    "attribute_types": ("canonical", "attribute_type"), "action_synonyms": ("raw", "canonical"), "action_types": ("canonical", "action_type"),
}


def lexicon_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = {}
    for name, (key, value) in BUNDLE.items():
        rows = read_tsv(spark, f"{folder}/{name}.tsv")
        out[name] = value_lexicon(rows) if value == "canonical" else multi_lexicon(rows, key, value)
    return out


def prepositions(rows: DataFrame) -> DataFrame:
    """key, width, canonical_relation, components[], initial_offset, final_offset of phrases of two words or more."""
    key = F.lower(_first(rows, "token_sequence", "surface"))
    words = F.split(F.replace(key, F.lit("|"), F.lit(" ")), r"\s+")
    n = F.size(words)
    initial = F.coalesce(F.expr("try_cast(initial_relation_token_offset as int)") if "initial_relation_token_offset" in rows.columns else F.lit(None), F.lit(0))
    final = F.coalesce(F.expr("try_cast(final_adp_token_offset as int)") if "final_adp_token_offset" in rows.columns else F.lit(None), n - 1)
    parts = pipe_split(_col(rows, "relation_components"))
    out = rows.select("_pos", F.array_join(words, " ").alias("key"), n.alias("width"), _first(rows, "canonical_relation", "surface").alias("canonical_relation"), F.when(F.size(parts) > 0, parts).otherwise(words).alias("components"), initial.alias("initial_offset"), final.alias("final_offset"))
    fine = (F.col("width") >= 2) & F.col("initial_offset").between(0, F.col("width") - 1) & F.col("final_offset").between(0, F.col("width") - 1)
    out = out.withColumn("width", require(fine, F.concat(F.lit("impossible prepositional phrase: "), F.col("key")), F.col("width")))
    return first_per_key(out, ["key"], ["_pos"]).drop("_pos")


def ngram_evidence(rows: DataFrame) -> DataFrame:
    """selected_oewn_synset, surface_key, mean_frequency; what is no number is left out, the last row of a key wins."""
    out = rows.select("_pos", "selected_oewn_synset", "surface_key", F.expr("try_cast(mean_frequency as double)").alias("mean_frequency")).where("mean_frequency is not null")
    return out.groupBy("selected_oewn_synset", "surface_key").agg(F.max_by("mean_frequency", "_pos").alias("mean_frequency"))


def lexicons(objects: DataFrame, actions: DataFrame, attributes: DataFrame, phrases: DataFrame) -> Lexicons:
    """All dimension tables of extraction from the four inventories (rows numbered in ``_pos``)."""
    by_key, by_query = action_inventory(actions)
    return Lexicons(object_inventory(objects), by_key, by_query, attribute_phrases(attributes), prepositions(phrases))
