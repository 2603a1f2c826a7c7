"""Decisions made by hand that rewrite rows through other rows, and audits of what an update of a report has moved."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import PENDING
from ..functions.text import normalize_query
from .fold import dimension

#: Rewrites are followed through this column of a resolved row.
THROUGH = "replacement"


def follow(links: DataFrame, cut=lambda df: df.checkpoint()) -> DataFrame:
    """key, target, cycle for links (key, target), each key once: where a chain of links ends, or that it never does.

    Pointers are doubled, so a chain of n links takes log n joins; what still leads to a key after as many rounds as all links could
    need goes round in a cycle. The target is then the row's own."""
    first = cut(links.select("key", "target"))
    n = first.count()
    now = first
    for _ in range(max(1, math.ceil(math.log2(n + 1)))):
        now = cut(now.join(now.select(F.col("key").alias("target"), F.col("target").alias("_next")), "target", "left").select("key", F.coalesce("_next", "target").alias("target")))
    keys = first.select(F.col("key").alias("target")).withColumn("cycle", F.lit(True))
    now = now.join(keys, "target", "left").withColumn("cycle", F.coalesce("cycle", F.lit(False)))
    own = first.select("key", F.col("target").alias("_own"))
    return now.join(own, "key").select("key", F.when(F.col("cycle"), F.col("_own")).otherwise(F.col("target")).alias("target"), "cycle")


def head_lookup(surfaces: DataFrame, rows: DataFrame, key: str = "span_key") -> DataFrame:
    """surface, head for surfaces without a row of their own: the longest ending of theirs, by whole words, that has one."""
    words = F.split(normalize_query("surface"), " ")
    ends = surfaces.select("surface").distinct().withColumn("w", words).where("size(w) >= 2").select("surface", F.posexplode(F.transform(F.sequence(F.lit(2), F.size("w")), lambda i: F.array_join(F.slice("w", i, F.size("w") - i + 1), " "))).alias("n", "head"))
    found = ends.join(dimension(rows.select(F.col(key).alias("head")).distinct()), "head")
    return found.groupBy("surface").agg(F.min_by("head", "n").alias("head"))


def resolve_manual(full: DataFrame, resolved: DataFrame, fields: list[str], cut=lambda df: df.checkpoint()) -> DataFrame:
    """The inventory with its open rows decided. full: span_key, decision_status, decision_reason and ``fields``; resolved the same, and
    replacement: another surface whose row this one takes over ('' for none).

    Exactly the open rows must be resolved, or it fails. A replacement leads to its row, or, without one, to the row of its head; from
    there on along the replacements of that row. A chain takes over the fields of its last row. A cycle, an end without a row and an end
    that is itself open leave the row open, with the reason."""
    open_ = full.where(F.trim("decision_status") == PENDING).select("span_key")
    wrong = open_.exceptAll(resolved.select("span_key")).withColumn("side", F.lit("unresolved")).unionByName(resolved.select("span_key").exceptAll(open_).withColumn("side", F.lit("not open")))
    if found := wrong.limit(5).collect():
        raise ValueError(f"resolved rows are not the open rows: {[tuple(r) for r in found]}")
    via = F.trim(F.coalesce(THROUGH, F.lit("")))
    direct, led = resolved.where(via == ""), resolved.where(via != "").withColumn("_to", normalize_query(THROUGH))
    keys = full.select(F.col("span_key").alias("_to")).distinct().withColumn("_there", F.lit(True))
    heads = head_lookup(led.select(F.col("_to").alias("surface")), full).withColumnsRenamed({"surface": "_to", "head": "_head"})
    links = cut(led.join(keys, "_to", "left").join(heads, "_to", "left").select("span_key", F.when(F.col("_there"), F.col("_to")).otherwise(F.col("_head")).alias("target"), F.col("_there").isNull().alias("by_head")))
    ends = follow(links.where("target is not null").select(F.col("span_key").alias("key"), "target"), cut)
    columns = ["decision_status", *fields]
    decided = full.where(F.trim("decision_status") != PENDING).select("span_key", *columns).unionByName(direct.select("span_key", *columns))
    source = decided.select(F.col("span_key").alias("target"), F.struct(*columns).alias("_row"))
    out = links.drop("target").join(ends.withColumnRenamed("key", "span_key"), "span_key", "left").join(source, "target", "left")
    cycle, none = F.coalesce("cycle", F.lit(False)), F.col("target").isNull()
    fine = ~cycle & F.col("_row").isNotNull() & (F.col("_row.decision_status") != PENDING)
    reason = F.when(cycle, "rewrite_cycle").when(none, "rewrite_target_missing").when(~fine, "rewrite_target_open").when(F.col("by_head"), "rewritten_through_head").otherwise("rewritten_through_row")
    rewritten = out.select("span_key", F.when(fine, F.col("_row.decision_status")).otherwise(PENDING).alias("decision_status"), reason.alias("decision_reason"), *(F.when(fine, F.col(f"_row.{c}")).alias(c) for c in fields))
    wanted = ["span_key", "decision_status", "decision_reason", *fields]
    kept = full.where(F.trim("decision_status") != PENDING).select(*wanted)
    return kept.unionByName(direct.select(*wanted)).unionByName(rewritten)


# --- what an update has moved


def moves(old: DataFrame, new: DataFrame) -> DataFrame:
    """mention_type, from_key, to_key, mentions, captions: mentions whose canonical name differs between two versions of a graph (those
    that only one of them has come from, or go to, null)."""
    side = lambda df, name: df.select("caption_id", "mention_id", "mention_type", F.col("canonical").alias(name))
    both = side(old, "from_key").join(side(new, "to_key"), ["caption_id", "mention_id", "mention_type"], "full").where(~F.col("from_key").eqNullSafe(F.col("to_key")))
    return both.groupBy("mention_type", "from_key", "to_key").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("caption_id").alias("captions"))


def unexplained(old_view: DataFrame, new_view: DataFrame, moved: DataFrame, label: str) -> DataFrame:
    """label, old_count, new_count, came, went of rows whose counts differ by anything else than what has moved."""
    a = old_view.groupBy(F.col(label).alias("label")).agg(F.sum("count").alias("old_count"))
    b = new_view.groupBy(F.col(label).alias("label")).agg(F.sum("count").alias("new_count"))
    came = moved.groupBy(F.col("to_key").alias("label")).agg(F.sum("mentions").alias("came"))
    went = moved.groupBy(F.col("from_key").alias("label")).agg(F.sum("mentions").alias("went"))
    out = a.join(b, "label", "full").join(came, "label", "left").join(went, "label", "left").fillna(0, ["old_count", "new_count", "came", "went"])
    return out.where("new_count <> old_count + came - went")


def mapping_audit(mappings: DataFrame, view: DataFrame, index: DataFrame, view_name: str = "attributes", label: str = "canonical_attribute", surfaces: str = "attribute_raw_surfaces") -> DataFrame:
    """raw, canonical, rows, status, mismatches for every synonym (raw, canonical) that an update was to bring in: the rows of the view that
    show it, and how many of them have not as many captions in the index as they say."""
    rows = view.select("_row_id", F.col(label).alias("canonical"), F.explode(F.array_distinct(F.transform(F.split(surfaces, "[|]"), normalize_query))).alias("raw"), "caption_count")
    there = index.where(F.col("view_name") == view_name).groupBy(F.col("row_id").alias("_row_id")).agg(F.count_distinct("caption_id").alias("indexed"))
    asked = mappings.select(normalize_query("raw").alias("raw"), "canonical").distinct()
    found = rows.join(dimension(asked), ["raw", "canonical"]).join(there, "_row_id", "left").fillna(0, ["indexed"])
    per = found.groupBy("raw", "canonical").agg(F.count_distinct("_row_id").alias("rows"), F.count_if(F.col("indexed") != F.col("caption_count")).alias("mismatches"))
    out = asked.join(per, ["raw", "canonical"], "left").fillna(0, ["rows", "mismatches"])
    return out.withColumn("status", F.when(F.col("rows") == 0, "missing").when(F.col("mismatches") > 0, "index_differs").otherwise("complete"))


def lexicon_comparison(old: DataFrame, new: DataFrame, counts: DataFrame) -> DataFrame:
    """change (added, removed, renamed), raw, old, new, count: how two lexicons (raw, canonical) differ, with the occurrences of each name."""
    both = old.select("raw", F.col("canonical").alias("old")).join(new.select("raw", F.col("canonical").alias("new")), "raw", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("renamed")
    return both.withColumn("change", change).join(counts.select("raw", "count"), "raw", "left").fillna(0, ["count"]).select("change", "raw", F.coalesce("old", F.lit("")).alias("old"), F.coalesce("new", F.lit("")).alias("new"), "count")
