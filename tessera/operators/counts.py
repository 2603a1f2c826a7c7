"""Count tables: one aggregate, ten specifications; triples, merges of partial tables, integrity."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import partition_of, pipe_join
from ..schema import require
from .facts import with_ends

#: Captions that stand as examples of a row.
EXAMPLES = 5
COUNT_RULE = "R25"


@dataclass(frozen=True)
class CountSpec:
    """A count table: the facts it counts, its key columns, and the columns whose values are brought together."""

    name: str
    fact_type: str
    prefix: str
    keys: tuple[str, ...]
    extras: tuple[str, ...] = ()


_ENDS = tuple(f"{end}_parent_{what}" for end in ("source", "target") for what in ("concepts", "synset_ids"))

# The count tables with their columns.
SPECS = (
    CountSpec("object_counts", "entity_exists", "object", ("object",), ("parent_concepts", "parent_synset_ids")),
    CountSpec("attribute_counts", "attribute_exists", "attribute", ("attribute", "attribute_kind")),
    CountSpec("object_parent_counts", "object_parent", "object_parent", ("object", "parent"), ("parent_synset_id",)),
    CountSpec("object_attribute_pair_counts", "has_attribute", "object_attribute_pair", ("object", "attribute", "attribute_kind"), ("object_parent_concepts", "object_parent_synset_ids")),
    CountSpec("action_counts", "action_event", "action", ("action",)),
    CountSpec("agent_patient_pair_counts", "event_role", "event_role", ("action", "role", "target"), ("target_parent_concepts", "target_parent_synset_ids", "raw_role", "voice_normalization")),
    CountSpec("relation_triple_counts", "relation", "relation", ("source", "relation", "target"), _ENDS),
    CountSpec("relation_component_counts", "relation_component", "relation_component", ("relation", "component_index", "component")),
    CountSpec("ambiguous_relation_candidate_counts", "ambiguous_relation_candidate", "ambiguous_relation_candidate", ("source_status", "relation", "target_status"), ("candidate_sources", "candidate_targets", "candidate_pair_count")),
    CountSpec("object_cooccurrence_pair_counts", "object_pair_in_caption", "object_pair_in_caption", ("source_object", "target_object"), _ENDS),
)
BY_NAME = {s.name: s for s in SPECS}


def distinct_sorted(facts: DataFrame, name: str) -> Column:
    """Sorted distinct values of a string column, or of the members of an array column, over a group."""
    if facts.schema[name].dataType.typeName() == "array":
        found = F.array_distinct(F.flatten(F.collect_set(name)))
    else:
        found = F.collect_set(name)
    return F.array_sort(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def count_table(facts: DataFrame, spec: CountSpec) -> DataFrame:
    """count, caption_count, the smallest EXAMPLES captions, and distinct evidence of each key.

    Facts are first counted by key and evidence as it stands, which hash aggregation does map-side without building any list; lists
    are united only over the distinct combinations. Captions are counted and chosen without ever holding a key's captions
    together: a window group limit keeps EXAMPLES of a key in every task. The key is one struct throughout, so that the aggregates come out
    partitioned alike and are joined without another exchange."""
    evidence, key = [*spec.extras, "raw_variants"], F.struct(*spec.keys).alias("k")
    rules = [c for c in facts.columns if c == "rule_ids" or c.startswith("rules_")]
    once = facts.groupBy(key, *evidence, *rules).agg(F.count(F.lit(1)).alias("_n"))
    all_rules = F.concat(*(F.flatten(F.collect_set(r)) for r in rules), F.array(F.lit(COUNT_RULE)))
    main = once.groupBy("k").agg(
        F.sum("_n").alias("count"),
        *(distinct_sorted(facts, x).alias(x) for x in evidence),
        F.array_sort(F.array_compact(F.array_distinct(all_rules))).alias("rule_ids"),
    )
    seen = facts.select(key, "caption_id").distinct()
    few = seen.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("caption_id"))).where(F.col("n") <= EXAMPLES)
    few = few.groupBy("k").agg(F.array_sort(F.collect_list("caption_id")).alias("example_caption_ids"))
    total = seen.groupBy("k").agg(F.count(F.lit(1)).alias("caption_count"))
    out = main.join(few, "k", "left").join(total, "k", "left").select("k.*", *evidence, "count", "caption_count", "example_caption_ids", "rule_ids")
    name = F.concat_ws(":", F.lit(spec.prefix), *spec.keys)
    return out.select(name.alias("count_key"), *spec.keys, *spec.extras, "count", "caption_count", "example_caption_ids", "raw_variants", "rule_ids")


def ordered(table: DataFrame) -> DataFrame:
    """Count descending, then key in code-point order."""
    return table.orderBy(F.desc("count"), "count_key")


def flat(table: DataFrame) -> DataFrame:
    """Arrays as pipe-joined strings, as files hold them."""
    return table.select(*(pipe_join(c).alias(c) if kind.startswith("array") else F.col(c) for c, kind in table.dtypes))


def count_tables(facts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {s.name: count_table(facts[s.fact_type], s) for s in SPECS}


TRIPLE = CountSpec("patient_action_agent_triples", "triple", "patient_action_agent", ("patient", "action", "agent"))


def triple_facts(edges: DataFrame, mentions: DataFrame) -> DataFrame:
    """caption_id, patient, action, agent: the agents of each action mention times its patients."""
    roles = with_ends(mentions, edges.where("edge_type = 'event_role'"), F.struct("canonical")).where("s is not null and t is not null")
    of = lambda role: F.collect_list(F.when(F.col("canonical_label") == role, F.struct(F.col("t.canonical").alias("name")))).alias(role)
    acts = roles.groupBy("caption_id", F.col("source_mention_id").alias("act")).agg(F.first("s.canonical").alias("action"), of("agent"), of("patient"))
    each = acts.select("caption_id", "action", "patient", F.explode("agent").alias("agent")).select("caption_id", "action", "agent", F.explode("patient").alias("patient"))
    return each.select("caption_id", F.col("patient.name").alias("patient"), "action", F.col("agent.name").alias("agent"))


def triples(edges: DataFrame, mentions: DataFrame) -> DataFrame:
    """The table of patient, action, agent."""
    none = F.array().cast("array<string>")
    return count_table(triple_facts(edges, mentions).withColumns({"raw_variants": none, "rule_ids": none}), TRIPLE).drop("raw_variants")


def merge(parts: list[DataFrame], spec: CountSpec) -> DataFrame:
    """Count tables of disjoint sets of captions as one: counts add up, evidence is united.

    A key whose columns differ between parts fails the job."""
    rows = reduce(DataFrame.unionByName, parts)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    values = F.struct(*spec.keys)
    out = rows.groupBy("count_key").agg(
        F.min(values).alias("low"),
        F.max(values).alias("high"),
        F.sum("count").alias("count"),
        F.sum("caption_count").alias("caption_count"),
        F.slice(union("example_caption_ids"), 1, EXAMPLES).alias("example_caption_ids"),  # EXAMPLES of each part
        *(union(c).alias(c) for c in (*spec.extras, "raw_variants", "rule_ids")),
    )
    kept = require(F.col("low").eqNullSafe(F.col("high")), F.concat(F.lit("one key with different values: "), F.col("count_key")), F.col("low"))
    out = out.withColumn("low", kept)
    return out.select("count_key", *(F.col(f"low.{k}").alias(k) for k in spec.keys), *spec.extras, "count", "caption_count", "example_caption_ids", "raw_variants", "rule_ids")


def merge_partitioned(parts: list[DataFrame], spec: CountSpec, n: int) -> DataFrame:
    """The same, dealt by crc32 of the key and in key order."""
    rows = [p.repartition(n, partition_of("count_key", n)) for p in parts]
    return merge(rows, spec).orderBy("count_key")


def duplicate_captions(parts: list[DataFrame]) -> DataFrame:
    """Captions that more than one part has; partial tables of such parts must not be merged."""
    each = [p.select("caption_id").distinct() for p in parts]
    return reduce(DataFrame.unionByName, each).groupBy("caption_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")


def integrity(facts: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """For each kind of fact its facts, the sum of its table's counts, and whether they agree."""
    known = {s.fact_type: s.name for s in SPECS}
    unknown = sorted(set(facts) - set(known))
    if unknown:
        raise ValueError(f"no count table for {unknown}")
    there = reduce(DataFrame.unionByName, [f.groupBy("fact_type").agg(F.count(F.lit(1)).alias("facts")) for f in facts.values()])
    counted = reduce(DataFrame.unionByName, [tables[known[k]].agg(F.lit(k).alias("kind"), F.coalesce(F.sum("count"), F.lit(0)).alias("counted")) for k in facts])
    both = counted.join(there, F.col("kind") == F.col("fact_type"), "left")
    facts_ = F.coalesce("facts", F.lit(0))
    return both.select(F.col("kind").alias("fact_type"), facts_.alias("facts"), "counted", (facts_ == F.col("counted")).alias("agree"))


def top_k(rows: DataFrame, key: str, value: str, position: str, k: int) -> DataFrame:
    """The k most frequent values of each key; of equally frequent ones, those seen first."""
    counts = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("count"), F.min(position).alias("first_seen"))
    place = Window.partitionBy(key).orderBy(F.desc("count"), "first_seen")
    return counts.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def requested_captions(facts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """For each requested term the captions and the facts that have it; terms without any count zero."""
    hit = facts.select(F.lower(F.col(key)).alias("term"), "caption_id")
    asked = terms.select(F.lower(F.trim("term")).alias("term")).distinct()
    found = hit.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("count"), F.count_distinct("caption_id").alias("caption_count"))
    return asked.join(found, "term", "left").fillna(0, ["count", "caption_count"])


def requested_pairs(facts: DataFrame, pairs: DataFrame, first: str, second: str) -> DataFrame:
    """For each requested pair of labels (first, second) the captions that have it, and those that have either label at all; zero without any.

    Labels are trimmed and lower-cased on both sides; a pair asked for twice is one."""
    label = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    asked = pairs.select(label("first").alias("first"), label("second").alias("second")).distinct()
    seen = facts.select("caption_id", label(first).alias("first"), label(second).alias("second")).where("first <> '' and second <> ''")
    out = asked
    for keys, name in ((["first", "second"], "caption_count"), (["first"], "first_captions"), (["second"], "second_captions")):
        hit = seen.join(asked.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.count_distinct("caption_id").alias(name))
        out = out.join(hit, keys, "left").fillna(0, [name])
    return out


def caption_sets(facts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """term, caption_id: the captions of each requested term, each once. Rows stay rows, so a frequent term needs no large list."""
    asked = terms.select(F.lower(F.trim("term")).alias("term")).distinct()
    return facts.select(F.lower(F.col(key)).alias("term"), "caption_id").join(asked, "term", "left_semi").distinct()
