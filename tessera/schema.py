"""The tables of the concept graph and the rules that their rows keep.

A graph is two tables. ``mentions`` are the nodes and ``edges`` the edges of each caption; ids are local to the caption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that rows may hold.
SHAPES = ("sentence", "tag_list")
MENTION_TYPES = ("object", "attribute", "quantity", "action")
EDGE_TYPES = ("has_attribute", "has_quantity", "event_role", "relation", "ambiguous_relation_candidate")
CONFIDENCES = ("high", "medium", "low")
MISSING_SOURCE, MISSING_TARGET = "__missing_source__", "__missing_target__"

_TOKEN = "struct<i int, text string, lemma string, pos string, tag string, morph string, dep string, head_i int, head_text string, char_start int, char_end int, whitespace string>"
_CHUNK = "struct<text string, root_i int, root_text string, root_lemma string, root_pos string, root_tag string, root_dep string, root_head_i int, root_head_text string, token_start int, token_end int, char_start int, char_end int>"

CAPTION_SOURCE = "key string, caption string, caption_type string"
CAPTION = "caption_id string, caption string, caption_shape string, skipped boolean, skip_reason string, pipeline_version string, rule_ids array<string>, meta string"
ANNOTATED = (
    f"caption_id string, caption string, caption_shape string, tokens array<{_TOKEN}>, noun_chunks array<{_CHUNK}>, "
    f"tag_segments array<struct<segment_id string, raw_text string, text string, char_start int, char_end int, token_start int, token_end int>>"
)
RAW_MENTION = (
    "caption_id string, mention_id string, mention_type string, text string, lemma string, rule_id string, stage string, confidence string, "
    "char_start int, char_end int, token_start int, token_end int, segment_id string, token_indices array<int>, canonical_surface string, canonical_selection_tag string, "
    "parent_lemmas array<string>, parent_synset_ids array<string>, selected_synset string, selected_lexfile string, attribute_unit_type string, inventory_span_key string, modifier_source string"
)
RAW_EDGE = (
    "caption_id string, edge_id string, edge_type string, source_mention_id string, target_mention_id string, label string, rule_id string, stage string, confidence string, "
    "raw_role string, voice_normalization string, raw_span_surface string, matched_token_indices array<string>, relation_components array<string>, ambiguity_scope string"
)
MENTION = (
    "caption_id string, mention_id string, mention_type string, raw_text string, raw_lemma string, canonical string, parent_concepts array<string>, parent_synset_ids array<string>, "
    "canonical_rule_id string, parent_rule_id string, canonical_source string, parent_source string, confidence string"
)
EDGE = (
    "caption_id string, edge_id string, edge_type string, source_mention_id string, target_mention_id string, label string, canonical_label string, source_canonical string, target_canonical string, "
    "rule_id string, canonical_rule_id string, confidence string, raw_role string, voice_normalization string, raw_span_surface string, matched_token_indices array<string>, relation_components array<string>"
)


def require(condition: Column, message: str | Column, value: Column) -> Column:
    """``value`` where the condition holds; the job fails with the message where it does not."""
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(F.lit(message) if isinstance(message, str) else message))


def required_text(name: str) -> Column:
    return require(F.length(F.col(name)) > 0, f"{name} must not be empty", F.col(name)).alias(name)


def one_of(name: str, allowed: tuple[str, ...]) -> Column:
    return require(F.col(name).isin(*allowed), F.concat(F.lit(f"{name} has no such value: "), F.coalesce(F.col(name), F.lit("null"))), F.col(name)).alias(name)


def span(start: str, end: str) -> tuple[Column, Column]:
    """Both ends of a half-open span, absent together or in order."""
    fine = (F.col(start).isNull() & F.col(end).isNull()) | ((F.col(start) >= 0) & (F.col(start) <= F.col(end)))
    return tuple(require(fine, f"{start}, {end} are no span", F.col(x)).alias(x) for x in (start, end))  # a null value passes as null


def checked_mentions(mentions: DataFrame) -> DataFrame:
    """The same rows; fails on an empty id or an unknown type."""
    return mentions.withColumns({**{x: required_text(x) for x in ("caption_id", "mention_id")}, "mention_type": one_of("mention_type", MENTION_TYPES)})


def checked_edges(edges: DataFrame) -> DataFrame:
    """The same rows; fails on an empty id, an unknown type, or a missing end on anything but an ambiguous candidate."""
    ends = ~F.col("source_mention_id").eqNullSafe(MISSING_SOURCE) & ~F.col("target_mention_id").eqNullSafe(MISSING_TARGET)
    whole = ends | (F.col("edge_type") == "ambiguous_relation_candidate")
    named = {x: required_text(x) for x in ("caption_id", "edge_id", "source_mention_id", "target_mention_id")}
    return edges.withColumns({**named, "edge_type": one_of("edge_type", EDGE_TYPES)}).withColumn("label", require(whole, "only ambiguous candidates may miss an end", F.col("label")))
