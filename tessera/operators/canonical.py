"""Canonical graphs: raw mentions and edges looked up in lexicons; no row is added or lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lexicon_key
from ..schema import MISSING_SOURCE, MISSING_TARGET, require
from .facts import with_ends

# The rule that gave the canonical label of each type of mention, of parents, and of relations.
CANONICAL_RULES = {"object": "R19", "attribute": "R20", "quantity": "R21", "action": "R22"}
PARENT_RULE, RELATION_RULE = "R23", "R24"


def parent_labels(lemmas: str, ids: str):
    """Display labels of parents: what follows the first colon of ``id:lemma; lemma``, lists joined by ``; ``; the ids without any."""
    label = lambda x: F.array_join(F.filter(F.transform(F.split(F.regexp_replace(x, "^[^:]*:", ""), ";"), lambda p: F.trim(p)), lambda p: p != ""), "; ")
    labels = F.filter(F.transform(F.coalesce(lemmas, F.array().cast("array<string>")), label), lambda x: x != "")
    return F.when(F.size(labels) > 0, labels).otherwise(F.coalesce(ids, F.array().cast("array<string>")))


def canonicalize_mentions(raw: DataFrame, attributes: DataFrame, actions: DataFrame) -> DataFrame:
    """Objects take their inventory's surface, attributes and actions a synonym (``raw``, ``canonical``), quantities their text.

    The lexicons are dimension tables; the optimiser broadcasts them while their size allows."""
    label = lexicon_key("text")
    label = require(label != "", "a mention without a label", label)
    lexicon = attributes.select(F.lit("attribute").alias("k"), lexicon_key("raw").alias("r"), F.col("canonical").alias("found"))
    lexicon = lexicon.unionByName(actions.select(F.lit("action").alias("k"), lexicon_key("raw").alias("r"), F.col("canonical").alias("found")))
    rows = raw.withColumn("label", label)
    rows = rows.join(lexicon, (F.col("mention_type") == F.col("k")) & (F.col("label") == F.col("r")), "left")
    is_object = F.col("mention_type") == "object"
    inventory = F.when(is_object, F.nullif(F.col("canonical_surface"), F.lit("")))
    source = F.when(inventory.isNotNull(), "observed_inventory").when(F.col("found").isNotNull(), "lexicon").otherwise("raw_fallback")
    none = F.array().cast("array<string>")
    parents = F.when(is_object, parent_labels("parent_lemmas", "parent_synset_ids")).otherwise(none)
    ids = F.when(is_object, F.coalesce("parent_synset_ids", none)).otherwise(none)
    rule = F.create_map(*(F.lit(x) for pair in CANONICAL_RULES.items() for x in pair))
    return rows.select(
        "caption_id",
        "mention_id",
        "mention_type",
        F.col("text").alias("raw_text"),
        F.col("lemma").alias("raw_lemma"),
        F.coalesce(inventory, "found", "label").alias("canonical"),
        parents.alias("parent_concepts"),
        ids.alias("parent_synset_ids"),
        rule[F.col("mention_type")].alias("canonical_rule_id"),
        F.when(F.size(parents) > 0, PARENT_RULE).alias("parent_rule_id"),
        source.alias("canonical_source"),
        F.when(F.size(ids) > 0, "selected_oewn_hypernym").alias("parent_source"),
        F.when(source == "raw_fallback", "medium").otherwise("high").alias("confidence"),
    )


def canonicalize_edges(raw: DataFrame, mentions: DataFrame) -> DataFrame:
    """Both ends looked up in the canonical mentions. An unknown end fails the job; a missing one is named so."""
    out = with_ends(mentions, raw, F.struct("canonical"))
    for end, side, missing in (("source", "s", MISSING_SOURCE), ("target", "t", MISSING_TARGET)):
        key = f"{end}_mention_id"
        found = F.when(F.col(key) == missing, f"{end}_missing").otherwise(F.col(side)["canonical"])
        out = out.withColumn(f"{end}_canonical", require(found.isNotNull(), F.concat(F.lit("no such mention: "), F.col("caption_id"), F.lit(" "), F.col(key)), found)).drop(side)
    related = F.col("edge_type").isin("relation", "ambiguous_relation_candidate")
    return out.withColumns(
        {
            "canonical_label": F.col("label"),
            "canonical_rule_id": F.when(related, RELATION_RULE),
            "relation_policy": F.when(related & (F.col("rule_id") == "R18.1"), "preposition_mwe_preserved").when(related, "single_adp_raw_preserving"),
        }
    )


def summary(mentions: DataFrame) -> DataFrame:
    """Mentions by type and source, with and without parents."""
    return mentions.groupBy("mention_type", "canonical_source").agg(
        F.count(F.lit(1)).alias("mentions"), F.count_if(F.size("parent_concepts") > 0).alias("with_parent"), F.count_if(F.size("parent_concepts") == 0).alias("without_parent")
    )
