"""Comparison of tables, and of labels with an outside vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import band, relative_difference
from ..functions.text import inflections, normalize_query, separator_variants, stems


def table_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two tables has more often than the other, with ``side`` left or right."""
    left = a.exceptAll(b.select(*a.columns)).withColumn("side", F.lit("left"))
    return left.unionByName(b.select(*a.columns).exceptAll(a).withColumn("side", F.lit("right")))


def matched_labels(labels: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """label, match, match_kind: exactly, else by another separator, else by a base form of the label, else by an inflected form of it; the
    first kind that hits wins."""
    forms = [
        labels.select("label", F.lit(0).alias("rank"), normalize_query("label").alias("form")),
        labels.select("label", F.lit(1).alias("rank"), F.explode(separator_variants("label")).alias("form")),
        labels.select("label", F.lit(2).alias("rank"), F.explode(stems("label")).alias("form")),
        labels.select("label", F.lit(3).alias("rank"), F.explode(inflections("label")).alias("form")),
    ]
    tried = reduce(DataFrame.unionByName, forms)
    hits = tried.join(vocabulary.select(normalize_query("term").alias("form"), F.col("term").alias("match")), "form")
    place = Window.partitionBy("label").orderBy("rank", "match")
    best = hits.withColumn("n", F.row_number().over(place)).where("n = 1")
    kind = F.when(F.col("rank") == 0, "exact").when(F.col("rank") == 1, "separator").when(F.col("rank") == 2, "stem").otherwise("inflection")
    return labels.join(best.select("label", "match", kind.alias("match_kind")), "label", "left")


def overlapping(rows: DataFrame, column: str, aliases: list[str]) -> DataFrame:
    """Rows whose list meets the aliases, with what they share."""
    wanted = F.array(*map(F.lit, aliases)) if aliases else F.array().cast("array<string>")
    return rows.where(F.arrays_overlap(column, wanted)).withColumn("shared", F.array_sort(F.array_intersect(column, wanted)))


def count_comparison(ours: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """Counts of both sides for each key (0 where one has none), their relative difference and its band."""
    both = ours.select(key, F.col("caption_count").alias("ours")).join(theirs.select(key, F.col("caption_count").alias("theirs")), key, "full").fillna(0, ["ours", "theirs"])
    d = relative_difference(F.col("ours"), F.col("theirs"))
    return both.withColumns({"difference": d, "band": band(d)})


def coverage(mentions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Labels of mentions that are conjuncts of attributes, with their occurrences and whether the lexicon knows them."""
    seen = mentions.where("modifier_source = 'conj_of_attribute_modifier'").groupBy(normalize_query("text").alias("label")).agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("caption_id").alias("captions"))
    known = lexicon.select(normalize_query("raw").alias("label")).distinct().withColumn("known", F.lit(True))
    return seen.join(known, "label", "left").fillna(False, ["known"])


def overlapping_mentions(mentions: DataFrame) -> DataFrame:
    """Pairs of attribute mentions of a caption that share tokens; extraction makes none."""
    a = mentions.where("mention_type = 'attribute'").select("caption_id", F.col("mention_id").alias("a"), F.col("token_start").alias("as"), F.col("token_end").alias("ae"))
    b = a.select("caption_id", F.col("a").alias("b"), F.col("as").alias("bs"), F.col("ae").alias("be"))
    return a.join(b, "caption_id").where("a < b and `as` < be and bs < ae").select("caption_id", "a", "b")


def phrase_parity(raw: DataFrame, canonical: DataFrame, facts: DataFrame) -> DataFrame:
    """stage, mentions: multi-word attributes in raw mentions, canonical mentions and facts; all three should be equal."""
    keys = raw.where("attribute_unit_type = 'mwe'").select("caption_id", "mention_id")
    ids = facts.select("caption_id", F.explode("source_mention_ids").alias("mention_id"))
    count = lambda df, name: df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("mentions"))
    both = count(keys, "raw").unionByName(count(canonical.join(keys, ["caption_id", "mention_id"], "left_semi"), "canonical"))
    return both.unionByName(count(ids.join(keys, ["caption_id", "mention_id"], "left_semi"), "facts"))


def completeness(tables: dict[str, DataFrame], expected: list[str]) -> list[str]:
    """Expected tables that are not there."""
    return [name for name in expected if name not in tables]
