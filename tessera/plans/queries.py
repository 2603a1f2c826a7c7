"""Every registered query of the caption engine, and the SQL that it is held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import band, relative_difference, summary
from ..functions.status import decision_status
from ..functions.text import display_surface, lookup_queries, normalize_query, partition_of, pipe_join, sense_key, separator_key, separator_variants, surface_key, surface_variant_keys
from ..operators import canonical, compare, counts, fold, inventory, report, segments, shape, tokens
from ..operators.extract import extract, extract_rows, preposition_matches
from ..operators.facts import all_facts, object_pairs_by_join
from . import adapters, golden

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function as a query."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _count_query(spec: counts.CountSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return counts.flat(counts.count_table(all_facts(*adapters.graph(spark, sf_dir), united=False)[spec.fact_type], spec))

    return run


for _spec in counts.SPECS:
    query(_spec.name, adapters.count_sql(_spec))(_count_query(_spec))


def _facts(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return all_facts(*adapters.graph(spark, sf_dir))[kind]


def _lists(columns: str) -> str:
    return ", ".join(f"coalesce(array_to_string({c}, '|'), '') AS {c}" for c in columns.split(", "))


#: The text adapter in SQL: key, caption, caption_type.
TEXT_SQL = """
src AS (SELECT cast(doc_id AS VARCHAR) AS key, text AS caption,
        CASE WHEN doc_id % 10 = 0 THEN 'tag' WHEN n_chars <= 200 THEN 'short' WHEN n_chars <= 2000 THEN 'medium' ELSE 'long' END AS caption_type FROM documents)"""

# --- captions and tokens


@query("shape_routing", f"WITH {TEXT_SQL} SELECT key AS caption_id, CASE caption_type WHEN 'tag' THEN 'tag_list' ELSE 'sentence' END AS caption_shape, CASE caption_type WHEN 'tag' THEN 'R1|R1.1' ELSE 'R1' END AS rule_ids, length(caption) AS n_chars FROM src")
def shape_routing(spark, sf_dir):
    rows = shape.route(adapters.captions(spark, sf_dir))
    return rows.select("caption_id", "caption_shape", pipe_join("rule_ids").alias("rule_ids"), F.length("caption").cast("long").alias("n_chars"))


@query("stage1_summary", f"WITH {TEXT_SQL} SELECT CASE caption_type WHEN 'tag' THEN 'tag_list' ELSE 'sentence' END AS caption_shape, caption_type, '' AS skip_reason, count(*) AS captions FROM src GROUP BY 1, 2")
def stage1_summary(spark, sf_dir):
    return shape.summary(shape.route(adapters.captions(spark, sf_dir)))


@query(
    "tag_segments",
    f"""WITH {TEXT_SQL}, p AS (SELECT key, generate_subscripts(string_split(caption, ','), 1) - 1 AS n, unnest(string_split(caption, ',')) AS raw FROM src WHERE caption_type = 'tag'),
q AS (SELECT *, coalesce(sum(length(raw) + 1) OVER (PARTITION BY key ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS text FROM p)
SELECT key AS caption_id, 't' || n AS segment_id, text, cast(b + length(raw) - length(regexp_replace(raw, '^\\s+', '')) AS INTEGER) AS char_start,
       cast(b + length(raw) - length(regexp_replace(raw, '^\\s+', '')) + length(text) AS INTEGER) AS char_end FROM q WHERE text <> ''""",
)
def tag_segments(spark, sf_dir):
    _, tags = shape.split(shape.route(adapters.captions(spark, sf_dir)))
    return segments.tag_segments(tags).select("caption_id", "segment_id", "text", "char_start", "char_end")


@query("segment_offsets", f"""WITH {TEXT_SQL}, s AS (SELECT key AS caption_id, generate_subscripts(string_split(caption, ','), 1) - 1 AS n, trim(unnest(string_split(caption, ','))) AS text FROM src WHERE caption_type = 'tag'),
w AS (SELECT *, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\s]')) AS k FROM s WHERE regexp_matches(text, '\\S'))
SELECT caption_id, 't' || n AS segment_id, cast(sum(k) OVER (PARTITION BY caption_id ORDER BY n) - k AS INTEGER) AS first_token, cast(sum(k) OVER (PARTITION BY caption_id ORDER BY n) - 1 AS INTEGER) AS last_token FROM w""")  # fmt: skip
def segment_offsets(spark, sf_dir):
    _, tags = shape.split(shape.route(adapters.captions(spark, sf_dir)))
    seg = segments.tag_segments(tags)
    local = tokens.tokenize(seg.select(F.concat_ws("\t", "caption_id", "segment_id").alias("caption_id"), F.col("text").alias("caption")))
    local = local.select(F.split("caption_id", "\t")[0].alias("caption_id"), F.split("caption_id", "\t")[1].alias("segment_id"), "i", F.col("i").alias("head_i"), "char_start", "char_end")
    return segments.rebase(local, seg).groupBy("caption_id", "segment_id").agg(F.min("i").alias("first_token"), F.max("i").alias("last_token"))


@query("quote_spans", f"""WITH {TEXT_SQL}, q AS (
SELECT key, unnest(regexp_extract_all(caption, '"[^"]*"')) AS text FROM src UNION ALL SELECT key, unnest(regexp_extract_all(caption, '“[^“”]*”')) FROM src)
SELECT key AS caption_id, count(*) AS spans, cast(sum(length(text)) AS BIGINT) AS chars FROM q GROUP BY key""")  # fmt: skip
def quote_spans(spark, sf_dir):
    toks = _cut(tokens.quote_marks(tokens.token_lists(shape.route(adapters.captions(spark, sf_dir)).select("caption_id", "caption"))))
    spans = tokens.quote_spans(toks)
    ends = toks.select("caption_id", (F.col("i") + 1).alias("token_end"), "char_end")
    out = spans.join(toks.select("caption_id", F.col("i").alias("token_start"), "char_start"), ["caption_id", "token_start"]).join(ends, ["caption_id", "token_end"])
    return out.groupBy("caption_id").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("char_end") - F.col("char_start")).alias("chars"))


_PART = "\\p{N}*\\p{L}[\\p{L}\\p{N}]*"


@query("hyphen_words", f"""WITH {TEXT_SQL}, h AS (SELECT key, unnest(regexp_extract_all(caption, '{_PART}(?:-{_PART})+')) AS text FROM src)
SELECT key AS caption_id, count(*) AS words, cast(sum(length(text)) AS BIGINT) AS chars FROM h WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]{{2}}') GROUP BY key""")  # fmt: skip
def hyphen_words(spark, sf_dir):
    toks = _cut(tokens.near_hyphens(tokens.token_lists(shape.route(adapters.captions(spark, sf_dir)).select("caption_id", "caption"))))
    spans = tokens.hyphen_spans(toks)
    inside = spans.join(toks, "caption_id").where("i >= token_start and i < token_end").groupBy("caption_id", "token_start").agg((F.max("char_end") - F.min("char_start")).alias("n"))
    return inside.groupBy("caption_id").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("chars"))


@query("protected_spans")
def protected_spans(spark, sf_dir):
    lists = tokens.protected_lists(shape.route(adapters.captions(spark, sf_dir)).select("caption_id", "caption"))
    spans = lists.select("caption_id", F.inline("protected_spans"))
    return spans.select("caption_id", "char_start", "char_end", "token_start", "token_end", "kind", "rule_id", "text", "final_start", "final_end")


# --- scalar functions


@query("norm_query", "SELECT p_partkey, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS norm_query, trim(regexp_replace(lower(p_name), '[\\s_-]+', ' ', 'g')) AS separator_key FROM part")
def norm_query(spark, sf_dir):
    return adapters.table(spark, sf_dir, "part").select("p_partkey", normalize_query("p_name").alias("norm_query"), separator_key("p_name").alias("separator_key"))


_SPACED = "trim(regexp_replace(lower(p_name), '[\\s_-]+', ' ', 'g'))"


@query("separator_variants", f"SELECT p_partkey, CASE WHEN contains({_SPACED}, ' ') THEN {_SPACED} || '|' || replace({_SPACED}, ' ', '-') || '|' || replace({_SPACED}, ' ', '_') ELSE {_SPACED} END AS variants FROM part")
def separator_variants_query(spark, sf_dir):
    return adapters.table(spark, sf_dir, "part").select("p_partkey", pipe_join(separator_variants("p_name")).alias("variants"))


@query("surface_variant_keys", f"SELECT p_partkey, array_to_string(list_sort(list_distinct([trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')), {_SPACED}, replace({_SPACED}, ' ', ''), replace({_SPACED}, ' ', '_')])), '|') AS keys FROM part")
def surface_variant_keys_query(spark, sf_dir):
    return adapters.table(spark, sf_dir, "part").select("p_partkey", pipe_join(F.array_sort(surface_variant_keys("p_name"))).alias("keys"))


@query("lookup_queries", f"""WITH q AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS exact, {_SPACED} AS sep FROM part)
SELECT p_partkey, 'exact' AS kind, exact AS query FROM q WHERE exact <> '' UNION ALL SELECT p_partkey, 'separator', sep FROM q WHERE sep <> '' AND sep <> exact
UNION ALL SELECT p_partkey, 'joined', replace(sep, ' ', '') FROM q WHERE replace(sep, ' ', '') NOT IN ('', exact, sep)""")  # fmt: skip
def lookup_queries_query(spark, sf_dir):
    return adapters.table(spark, sf_dir, "part").select("p_partkey", F.inline(lookup_queries("p_name")))


_FOLDED = "translate(text, '‘’‛ʼ“”‐‑‒–—−', repeat(chr(39), 4) || repeat(chr(34), 2) || '------')"


@query("surface_key", f"""WITH f AS (SELECT item_id, regexp_replace({_FOLDED}, '\\s*([-' || chr(39) || '])\\s*', '\\1', 'g') AS t FROM benchmark)
SELECT item_id, trim(regexp_replace(lower(strip_accents(t)), '\\s+', ' ', 'g')) AS surface_key, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS display_surface FROM f""")  # fmt: skip
def surface_key_query(spark, sf_dir):
    return adapters.table(spark, sf_dir, "benchmark").select("item_id", surface_key("text").alias("surface_key"), display_surface("text").alias("display_surface"))


@query("sense_keys", "SELECT n_nationkey, n_name || '%1:0' || (n_regionkey % 10) || ':00::' AS sense_key FROM nation")
def sense_keys(spark, sf_dir):
    n = adapters.table(spark, sf_dir, "nation")
    return n.select("n_nationkey", sense_key(F.concat(F.lit("oewn-"), "n_name", F.lit("__1.0"), (F.col("n_regionkey") % 10).cast("string"), F.lit(".00.."))).alias("sense_key"))


@query("decision_status", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'chosen' WHEN o_orderstatus = 'O' THEN CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'chosen' WHEN '2' THEN 'needs_manual' WHEN '3' THEN 'excluded' WHEN '4' THEN 'needs_manual' ELSE '' END ELSE 'needs_manual' END AS status FROM orders""")
def decision_status_query(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    explicit = F.when(F.col("o_orderstatus") == "F", "selected").when(F.col("o_orderstatus") == "P", "raw_fallback").otherwise("")
    first = F.substring("o_orderpriority", 1, 1)
    old = F.when(first == "1", "selected").when(first == "2", "ambiguous").when(first == "3", "rejected").when(first == "4", "something").otherwise("")
    return o.select("o_orderkey", decision_status(explicit, F.lit(None).cast("string"), old).alias("status"))


def _remainders() -> str:
    """The 256 remainders of the CRC-32 polynomial, as a SQL list."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(str(n))
    return "[" + ", ".join(out) + "]::BIGINT[]"


@query("crc_partitions", f"""WITH b AS (SELECT p_partkey, p_name, list_prepend(4294967295::BIGINT, list_transform(string_split(p_name, ''), lambda c: ascii(c)::BIGINT)) AS bytes, {_remainders()} AS remainders FROM part)
SELECT p_partkey, cast(xor(list_reduce(bytes, lambda crc, c: xor(crc >> 8, remainders[cast((xor(crc, c) & 255) + 1 AS INTEGER)])), 4294967295::BIGINT) % 16 AS INTEGER) AS part, sha256(p_name) AS digest FROM b""")  # fmt: skip
def crc_partitions(spark, sf_dir):
    return adapters.table(spark, sf_dir, "part").select("p_partkey", partition_of("p_name", 16).cast("int").alias("part"), F.sha2("p_name", 256).alias("digest"))


@query("compare_statistics", """SELECT l_returnflag, count(*) AS n, round(avg(abs(l_extendedprice - l_quantity * 1000)), 4) AS mae, round(avg(abs((l_extendedprice - l_quantity * 1000) * 100 / nullif(l_quantity * 1000, 0))), 6) AS mape,
round(corr(l_extendedprice, l_quantity * 1000), 8) AS pearson_r, round(corr(l_extendedprice, l_quantity * 1000) ** 2, 8) AS r_squared FROM lineitem GROUP BY 1""")  # fmt: skip
def compare_statistics(spark, sf_dir):
    rows = adapters.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1000).alias("ref"))
    out = summary(rows, "l_extendedprice", "ref", "l_returnflag")
    return out.select("l_returnflag", "n", F.round("mae", 4).alias("mae"), F.round("mape", 6).alias("mape"), F.round("pearson_r", 8).alias("pearson_r"), F.round("r_squared", 8).alias("r_squared"))


@query("difference_bands", """WITH d AS (SELECT (p_size - 25) * 100.0 / 25 AS d FROM part) SELECT CASE WHEN d = 0 THEN 'equal' WHEN abs(d) <= 5 THEN '<=5' WHEN abs(d) <= 10 THEN '<=10' WHEN abs(d) <= 25 THEN '<=25' WHEN abs(d) <= 50 THEN '<=50' WHEN abs(d) <= 100 THEN '<=100' ELSE '>100' END AS band, count(*) AS parts FROM d GROUP BY 1""")
def difference_bands(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    return p.select(band(relative_difference(F.col("p_size").cast("double"), F.lit(25.0))).alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("parts"))


# --- facts and counts


@query("object_parent_facts", f"WITH {adapters.GRAPH_SQL}, fact AS ({adapters.FACT_SQL['object_parent']}) SELECT caption_id, object, parent, parent_synset_id[1] AS parent_synset_id, raw_variants[1] AS raw_variant, count(*) AS facts FROM fact GROUP BY ALL")
def object_parent_facts(spark, sf_dir):
    f = _facts(spark, sf_dir, "object_parent")
    return f.groupBy("caption_id", "object", "parent", "parent_synset_id", F.col("raw_variants")[0].alias("raw_variant")).agg(F.count(F.lit(1)).alias("facts"))


@query("relation_component_facts", f"WITH {adapters.GRAPH_SQL}, fact AS ({adapters.FACT_SQL['relation_component']}) SELECT caption_id, relation, component_index, component, count(*) AS facts FROM fact GROUP BY ALL")
def relation_component_facts(spark, sf_dir):
    f = _facts(spark, sf_dir, "relation_component")
    return f.groupBy("caption_id", "relation", "component_index", "component").agg(F.count(F.lit(1)).alias("facts"))


@query("ambiguous_candidates", f"WITH {adapters.GRAPH_SQL}, fact AS ({adapters.FACT_SQL['ambiguous_relation_candidate']}) SELECT caption_id, source_status, relation, target_status, array_to_string(list_sort(candidate_sources), '|') AS candidate_sources, array_to_string(list_sort(candidate_targets), '|') AS candidate_targets, candidate_pair_count[1] AS candidate_pair_count FROM fact")
def ambiguous_candidates(spark, sf_dir):
    f = _facts(spark, sf_dir, "ambiguous_relation_candidate")
    return f.select("caption_id", "source_status", "relation", "target_status", pipe_join("candidate_sources").alias("candidate_sources"), pipe_join("candidate_targets").alias("candidate_targets"), "candidate_pair_count")


@query("patient_action_agent_triples", f"""WITH {adapters.GRAPH_SQL}, r AS (SELECT caption_id, src, label, s, t FROM joined WHERE edge_type = 'event_role')
SELECT concat_ws(':', 'patient_action_agent', p.t, p.s, a.t) AS count_key, p.t AS patient, p.s AS action, a.t AS agent, count(*) AS count, count(DISTINCT p.caption_id) AS caption_count, array_to_string(list_slice(list_sort(list(DISTINCT p.caption_id)), 1, 5), '|') AS example_caption_ids
FROM r p JOIN r a ON p.caption_id = a.caption_id AND p.src = a.src AND p.label = 'patient' AND a.label = 'agent' GROUP BY 2, 3, 4""")  # fmt: skip
def patient_action_agent_triples(spark, sf_dir):
    mentions, edges = adapters.graph(spark, sf_dir)
    return counts.flat(counts.triples(edges, mentions).drop("rule_ids"))


@query("object_pairs_by_join", f"WITH {adapters.GRAPH_SQL}, {adapters.OBJECTS_SQL} SELECT a.canonical AS source_object, b.canonical AS target_object, count(*) AS captions FROM ob a JOIN ob b ON a.caption_id = b.caption_id AND a.canonical <> b.canonical GROUP BY 1, 2")
def object_pairs_by_join_query(spark, sf_dir):
    return object_pairs_by_join(adapters.graph(spark, sf_dir)[0]).groupBy("source_object", "target_object").agg(F.count(F.lit(1)).alias("captions"))


def _halves(spark, sf_dir, spec):
    f = all_facts(*adapters.graph(spark, sf_dir), united=False)[spec.fact_type]
    return [counts.count_table(f.where(F.pmod(F.col("caption_id").cast("long"), F.lit(2)) == i), spec) for i in (0, 1)]


@query("merge_partial_counts", adapters.count_sql(counts.BY_NAME["object_attribute_pair_counts"]))
def merge_partial_counts(spark, sf_dir):
    spec = counts.BY_NAME["object_attribute_pair_counts"]
    return counts.flat(counts.merge(_halves(spark, sf_dir, spec), spec))


@query("merge_partitioned_counts", adapters.count_sql(counts.BY_NAME["relation_triple_counts"]))
def merge_partitioned_counts(spark, sf_dir):
    spec = counts.BY_NAME["relation_triple_counts"]
    return counts.flat(counts.merge_partitioned(_halves(spark, sf_dir, spec), spec, 8))


@query("count_integrity", f"WITH {adapters.GRAPH_SQL}, {adapters.OBJECTS_SQL} " + " UNION ALL ".join(f"SELECT '{k}' AS fact_type, count(*) AS facts, count(*) AS counted, true AS agree FROM ({q}) x" for k, q in adapters.FACT_SQL.items()))
def count_integrity(spark, sf_dir):
    facts = all_facts(*adapters.graph(spark, sf_dir), united=False)
    return counts.integrity(facts, counts.count_tables(facts))


@query("top_surfaces", """WITH c AS (SELECT p_brand, p_type, count(*) AS count, min(p_partkey) AS first_seen FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY count DESC, first_seen) AS rank FROM c) SELECT p_brand, p_type, count, first_seen, cast(rank AS INTEGER) AS rank FROM r WHERE rank <= 2""")
def top_surfaces(spark, sf_dir):
    return counts.top_k(adapters.table(spark, sf_dir, "part"), "p_brand", "p_type", "p_partkey", 2)


@query("requested_terms", f"""WITH {adapters.GRAPH_SQL}, t AS (SELECT DISTINCT lower(trim(p_brand)) AS term FROM part UNION SELECT 'no such object'), obj AS (SELECT lower(canonical) AS term, caption_id FROM mention WHERE mention_type = 'object')
SELECT t.term, count(obj.caption_id) AS count, count(DISTINCT obj.caption_id) AS caption_count FROM t LEFT JOIN obj ON t.term = obj.term GROUP BY t.term""")  # fmt: skip
def requested_terms(spark, sf_dir):
    terms = adapters.table(spark, sf_dir, "part").select(F.col("p_brand").alias("term")).unionByName(spark.createDataFrame([(" No such object ",)], "term string"))
    return counts.requested_captions(_facts(spark, sf_dir, "entity_exists"), terms, "object")


@query("duplicate_captions", "SELECT cast(o_orderkey AS VARCHAR) AS caption_id, 2 AS parts FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 4 = 0")
def duplicate_captions(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("caption_id"))
    n = F.col("caption_id").cast("long")
    return counts.duplicate_captions([o.where(n % 10 == 0), o.where(n % 4 == 0)])


# --- canonicalization

_SYNONYMS = [("r", "returned"), ("a", "accepted"), ("1-urgent", "hurry")]


def _raw(spark, sf_dir):
    mentions, edges = adapters.graph(spark, sf_dir)
    raw = mentions.select("caption_id", "mention_id", "mention_type", F.col("raw_text").alias("text"), F.col("raw_lemma").alias("lemma"), F.when(F.col("canonical") != "Brand#1", F.col("canonical")).alias("canonical_surface"), F.transform("parent_concepts", lambda p: F.concat(F.lit("id:"), p)).alias("parent_lemmas"), "parent_synset_ids")
    words = spark.createDataFrame(_SYNONYMS, "raw string, canonical string")
    return raw, edges, canonical.canonicalize_mentions(raw, words.where("raw <> '1-urgent'"), words.where("raw = '1-urgent'"))


_CANON_SQL = f"""{adapters.GRAPH_SQL}, canon AS (SELECT caption_id, mention_id, mention_type, lower(trim(raw_text)) AS raw,
  CASE mention_type WHEN 'object' THEN CASE canonical WHEN 'Brand#1' THEN lower(trim(raw_text)) ELSE canonical END WHEN 'attribute' THEN CASE lower(trim(raw_text)) WHEN 'r' THEN 'returned' WHEN 'a' THEN 'accepted' ELSE lower(trim(raw_text)) END
       WHEN 'action' THEN CASE lower(trim(raw_text)) WHEN '1-urgent' THEN 'hurry' ELSE lower(trim(raw_text)) END ELSE lower(trim(raw_text)) END AS canonical,
  CASE mention_type WHEN 'object' THEN array_to_string(parent_concepts, '|') ELSE '' END AS parent_concepts,
  CASE WHEN mention_type = 'object' AND canonical = 'Brand#1' THEN 'raw_fallback' WHEN mention_type = 'object' THEN 'observed_inventory' WHEN mention_type = 'attribute' AND lower(trim(raw_text)) IN ('r', 'a') THEN 'lexicon' WHEN mention_type = 'action' AND lower(trim(raw_text)) = '1-urgent' THEN 'lexicon' ELSE 'raw_fallback' END AS canonical_source FROM mention)"""


@query("canonicalize_mentions", f"WITH {_CANON_SQL} SELECT caption_id, mention_id, canonical, parent_concepts, canonical_source, CASE canonical_source WHEN 'raw_fallback' THEN 'medium' ELSE 'high' END AS confidence, CASE WHEN parent_concepts <> '' THEN 'R23' ELSE '' END AS parent_rule_id FROM canon")
def canonicalize_mentions(spark, sf_dir):
    _, _, m = _raw(spark, sf_dir)
    return m.select("caption_id", "mention_id", "canonical", pipe_join("parent_concepts").alias("parent_concepts"), "canonical_source", "confidence", F.coalesce("parent_rule_id", F.lit("")).alias("parent_rule_id"))


@query("canonicalize_edges", f"WITH {_CANON_SQL} SELECT e.caption_id, e.edge_id, e.label AS canonical_label, s.canonical AS source_canonical, t.canonical AS target_canonical, CASE WHEN e.edge_type IN ('relation', 'ambiguous_relation_candidate') THEN 'R24' ELSE '' END AS canonical_rule_id, CASE WHEN e.edge_type NOT IN ('relation', 'ambiguous_relation_candidate') THEN '' WHEN list_contains(e.rules, 'R18.1') THEN 'preposition_mwe_preserved' ELSE 'single_adp_raw_preserving' END AS relation_policy FROM edge e JOIN canon s ON s.caption_id = e.caption_id AND s.mention_id = e.src JOIN canon t ON t.caption_id = e.caption_id AND t.mention_id = e.dst")
def canonicalize_edges(spark, sf_dir):
    _, edges, m = _raw(spark, sf_dir)
    raw = edges.drop("source_canonical", "target_canonical", "canonical_label", "canonical_rule_id")
    out = canonical.canonicalize_edges(raw, m)
    return out.select("caption_id", "edge_id", "canonical_label", "source_canonical", "target_canonical", F.coalesce("canonical_rule_id", F.lit("")).alias("canonical_rule_id"), F.coalesce("relation_policy", F.lit("")).alias("relation_policy"))


@query("canonical_summary", f"WITH {_CANON_SQL} SELECT mention_type, canonical_source, count(*) AS mentions, count(*) FILTER (parent_concepts <> '') AS with_parent, count(*) FILTER (parent_concepts = '') AS without_parent FROM canon GROUP BY 1, 2")
def canonical_summary(spark, sf_dir):
    return canonical.summary(_raw(spark, sf_dir)[2])


# --- report


def _pair_view(spark, sf_dir):
    facts = all_facts(*adapters.graph(spark, sf_dir), united=False)
    table = counts.count_table(facts["has_attribute"], counts.BY_NAME["object_attribute_pair_counts"])
    none = F.array().cast("array<string>")
    view = table.select("object", none.alias("object_raw_surfaces"), F.col("object_parent_concepts"), "attribute", "attribute_kind", none.alias("attribute_raw_surfaces"), "count", "caption_count", "example_caption_ids")
    return facts, report.numbered(view, "attribute_object_pairs", _cut)


_PAIR_SQL = f"""{adapters.GRAPH_SQL}, fact AS ({adapters.FACT_SQL['has_attribute']}),
v AS (SELECT row_number() OVER (ORDER BY count(*) DESC, object, attribute, attribute_kind) AS row_id, object, attribute, attribute_kind, count(*) AS count, count(DISTINCT caption_id) AS caption_count FROM fact GROUP BY 2, 3, 4)"""


@query("view_rows_page", f"WITH {_PAIR_SQL}, w AS (SELECT * FROM v WHERE contains(lower(object || chr(31) || attribute || chr(31) || attribute_kind), 'brand#1') AND attribute_kind IN ('quantity')) SELECT (row_number() OVER (ORDER BY caption_count, row_id) - 20)::INTEGER AS position, row_id, object, attribute, attribute_kind, count, caption_count, (SELECT count(*) FROM w) AS total FROM w ORDER BY caption_count, row_id LIMIT 20 OFFSET 20")
def view_rows_page(spark, sf_dir):
    _, view = _pair_view(spark, sf_dir)
    searched = view.drop("object_parent_concepts", "example_caption_ids", "object_raw_surfaces", "attribute_raw_surfaces")
    page = report.rows(searched, q="BRAND#1", filters={"attribute_kind": ["quantity"], "no_such": ["x"]}, sort="caption_count", direction="asc", page=2, page_size=20)
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).alias("position")  # a page, in the order it came
    return page.select(place, F.col("_row_id").alias("row_id"), "object", "attribute", "attribute_kind", "count", "caption_count", F.col("total").cast("long").alias("total"))


@query("filter_values", f"WITH {_PAIR_SQL} SELECT attribute AS value, count(*) AS row_count, cast(sum(count) AS BIGINT) AS total FROM v WHERE contains(lower(attribute), '1') GROUP BY 1 ORDER BY total DESC, value LIMIT 10")
def filter_values(spark, sf_dir):
    return report.filter_values(_pair_view(spark, sf_dir)[1], "attribute", q="1", page_size=5)


@query("caption_index", f"WITH {_PAIR_SQL} SELECT DISTINCT 'attribute_object_pairs' AS view_name, v.row_id, f.caption_id FROM fact f JOIN v USING (object, attribute, attribute_kind)")
def caption_index(spark, sf_dir):
    facts, view = _pair_view(spark, sf_dir)
    return report.caption_index(facts, {"attribute_object_pairs": view})


@query("triple_index", f"""WITH {adapters.GRAPH_SQL}, r AS (SELECT caption_id, src, label, s, t FROM joined WHERE edge_type = 'event_role'),
tf AS (SELECT p.caption_id, p.t AS patient, p.s AS action, a.t AS agent FROM r p JOIN r a ON p.caption_id = a.caption_id AND p.src = a.src AND p.label = 'patient' AND a.label = 'agent'),
tv AS (SELECT row_number() OVER (ORDER BY count(*) DESC, patient, action, agent) AS row_id, patient, action, agent FROM tf GROUP BY 2, 3, 4)
SELECT DISTINCT 'patient_action_agent_triples' AS view_name, row_id, caption_id FROM tf JOIN tv USING (patient, action, agent)""")  # fmt: skip
def triple_index(spark, sf_dir):
    mentions, edges = adapters.graph(spark, sf_dir)
    none = F.array().cast("array<string>")
    view = counts.triples(edges, mentions).withColumnsRenamed({"patient": "patient_object", "agent": "agent_object"})
    view = view.withColumns({f"{x}_raw_surfaces": none for x in ("patient_object", "action", "agent_object")})
    numbered = report.numbered(view, "patient_action_agent_triples", _cut)
    return report.caption_index({"triple": counts.triple_facts(edges, mentions)}, {"patient_action_agent_triples": numbered})


@query("row_captions", f"WITH {_PAIR_SQL}, c AS (SELECT DISTINCT f.caption_id FROM fact f JOIN v USING (object, attribute, attribute_kind) WHERE v.row_id = 3 ORDER BY 1 LIMIT 10 OFFSET 10) SELECT caption_id, o_orderpriority AS caption FROM ord JOIN c USING (caption_id)")
def row_captions(spark, sf_dir):
    facts, view = _pair_view(spark, sf_dir)
    index = report.caption_index(facts, {"attribute_object_pairs": view})
    texts = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("caption_id"), F.col("o_orderpriority").alias("caption"))
    return report.row_captions(index, texts, "attribute_object_pairs", 3, page=2, page_size=10)


@query("index_validation", f"WITH {_PAIR_SQL} SELECT row_id, caption_count + 1 AS caption_count, caption_count AS indexed FROM v WHERE row_id <= 3")
def index_validation(spark, sf_dir):
    facts, view = _pair_view(spark, sf_dir)
    index = report.caption_index(facts, {"attribute_object_pairs": view})
    broken = view.withColumn("caption_count", F.col("caption_count") + F.when(F.col("_row_id") <= 3, 1).otherwise(0))
    return report.index_mismatches(broken, index, "attribute_object_pairs")


@query("kind_collisions", f"WITH {adapters.GRAPH_SQL}, fact AS (SELECT canonical AS attribute, mention_type AS kind FROM mention WHERE mention_type IN ('attribute', 'quantity') UNION ALL SELECT '7', 'attribute') SELECT attribute, array_to_string(list_sort(list(DISTINCT kind)), '|') AS kinds, count(*) AS count FROM fact GROUP BY 1 HAVING count(DISTINCT kind) > 1")
def kind_collisions(spark, sf_dir):
    f = _facts(spark, sf_dir, "attribute_exists").select("attribute", "attribute_kind").unionByName(spark.createDataFrame([("7", "attribute")], "attribute string, attribute_kind string"))
    table = f.groupBy("attribute", "attribute_kind").agg(F.count(F.lit(1)).alias("count"))
    return counts.flat(report.kind_collisions(table))


_VIEW_KEYS = {
    "objects": ("entity_exists", "object", ""), "attributes": ("attribute_exists", "attribute, attribute_kind", ""), "actions": ("action_event", "action", ""),
    "relations": ("relation", "source, relation, target", ""), "object_cooccurrence": ("object_pair_in_caption", "source_object, target_object", ""),
    "attribute_object_pairs": ("has_attribute", "object, attribute, attribute_kind", ""), "patient_action_pairs": ("event_role", "target, action", "WHERE role = 'patient'"),
    "agent_action_pairs": ("event_role", "target, action", "WHERE role = 'agent'"), "relation_components": ("relation_component", "relation, component_index, component", ""),
}
_VIEWS_SQL = f"WITH {adapters.GRAPH_SQL}, {adapters.OBJECTS_SQL}, r AS (SELECT caption_id, src, label, s, t FROM joined WHERE edge_type = 'event_role'), "
_VIEWS_SQL += ", ".join(f"v_{v} AS (SELECT count(*) AS n FROM ({adapters.FACT_SQL[k]}) x {w} GROUP BY {c})" for v, (k, c, w) in _VIEW_KEYS.items())
_VIEWS_SQL += ", v_patient_action_agent_triples AS (SELECT count(*) AS n FROM r p JOIN r a ON p.caption_id = a.caption_id AND p.src = a.src AND p.label = 'patient' AND a.label = 'agent' GROUP BY p.t, p.s, a.t) "
_VIEWS_SQL += " UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS rows, cast(sum(n) AS BIGINT) AS total FROM v_{v}" for v in (*_VIEW_KEYS, "patient_action_agent_triples"))


@query("report_views", _VIEWS_SQL)
def report_views(spark, sf_dir):
    mentions, edges = adapters.graph(spark, sf_dir)
    facts = all_facts(mentions, edges, united=False)
    tables = {name: _cut(t) for name, t in counts.count_tables(facts).items()}  # several views read each of them
    views = report.views(tables, _cut(counts.triples(edges, mentions)))
    rows = [v.agg(F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("rows"), F.sum("count").alias("total")) for name, v in views.items()]
    return reduce(DataFrame.unionByName, rows)


# --- ranking, selection, overlays


@query("first_row_per_key", "SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1")
def first_row_per_key(spark, sf_dir):
    return fold.first_per_key(adapters.table(spark, sf_dir, "part"), ["p_brand"], ["p_partkey"]).select("p_brand", "p_partkey", "p_name")


@query("best_candidate", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) = 1")
def best_candidate(spark, sf_dir):
    return fold.first_per_key(adapters.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderpriority", F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("unique_max", 'WITH t AS (SELECT p_brand, p_partkey, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part) SELECT p_brand, p_partkey, p_size, count(*) OVER (PARTITION BY p_brand) = 1 AS "unique" FROM t WHERE r = 1')
def unique_max(spark, sf_dir):
    return fold.unique_maximum(adapters.table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], "p_size")


@query("greedy_spans", """WITH RECURSIVE s AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, cast(l_partkey % 100 AS INTEGER) AS s, cast(l_partkey % 100 + l_quantity AS INTEGER) AS e FROM lineitem),
g AS (SELECT k, n, s, e, true AS kept, [{'s': s, 'e': e}] AS have FROM s WHERE n = 1
 UNION ALL SELECT x.k, x.n, x.s, x.e, len(list_filter(g.have, lambda h: h.s < x.e AND x.s < h.e)) = 0, CASE WHEN len(list_filter(g.have, lambda h: h.s < x.e AND x.s < h.e)) = 0 THEN list_append(g.have, {'s': x.s, 'e': x.e}) ELSE g.have END FROM g JOIN s x ON x.k = g.k AND x.n = g.n + 1)
SELECT k, n, s, e FROM g WHERE kept""")  # fmt: skip
def greedy_spans(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    start = (F.col("l_partkey") % 100).cast("int")
    rows = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.row_number().over(order).alias("n"), start.alias("s"), (start + F.col("l_quantity")).cast("int").alias("e"))
    return fold.greedy_spans(rows, ["k"], "s", "e", ["n"]).withColumn("n", F.col("n").cast("long"))


def _overlay_tables(spark, sf_dir):
    labels, docs = adapters.table(spark, sf_dir, "labels"), adapters.table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", F.lit("needs_manual").alias("decision_status"))
    given = labels.groupBy("doc_id").agg(F.max("quality").alias("q")).select("doc_id", F.when(F.col("q") == 1, "chosen").otherwise("excluded").alias("decision_status"))
    return rows, given


@query("manual_overlay", "WITH g AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) SELECT d.doc_id, d.lang, CASE q WHEN 1 THEN 'chosen' WHEN 0 THEN 'excluded' ELSE 'needs_manual' END AS decision_status FROM documents d LEFT JOIN g USING (doc_id)")
def manual_overlay(spark, sf_dir):
    rows, given = _overlay_tables(spark, sf_dir)
    return inventory.edits(rows, given, "doc_id")


@query("full_overlay", "WITH g AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) SELECT d.doc_id, d.lang, CASE q WHEN 1 THEN 'chosen' ELSE 'excluded' END AS decision_status FROM documents d JOIN g USING (doc_id)")
def full_overlay(spark, sf_dir):
    rows, given = _overlay_tables(spark, sf_dir)
    return inventory.overlay(rows.join(given.select("doc_id"), "doc_id", "left_semi"), given, "doc_id", ["decision_status"])


@query("key_set_diff", "SELECT doc_id, 'removed' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'added' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def key_set_diff(spark, sf_dir):
    return inventory.key_differences(adapters.table(spark, sf_dir, "documents"), adapters.table(spark, sf_dir, "labels"), "doc_id")


@query("prior_merge_conflicts", """WITH a AS (SELECT DISTINCT p_brand AS k, min(p_type) OVER (PARTITION BY p_brand) AS v FROM part), b AS (SELECT DISTINCT p_brand AS k, max(p_type) OVER (PARTITION BY p_brand) AS v FROM part)
SELECT k, count(DISTINCT v) AS variants, 2 AS files FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY k HAVING count(DISTINCT v) > 1""")  # fmt: skip
def prior_merge_conflicts(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    files = [p.groupBy(F.col("p_brand").alias("k")).agg(f("p_type").alias("v")) for f in (F.min, F.max)]
    return inventory.merge_prior(files, "k", ["v"])[1]


@query("sense_choice", """WITH c AS (SELECT p_brand AS span_key, p_type AS synset, max(p_size) AS uses FROM part GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY span_key ORDER BY uses DESC) AS r, count(*) OVER (PARTITION BY span_key) AS n FROM c),
t AS (SELECT span_key, min(synset) AS synset, count(*) AS k, max(n) AS n FROM r WHERE r = 1 GROUP BY 1)
SELECT span_key, CASE WHEN n = 1 OR k = 1 THEN synset ELSE '' END AS selected_oewn_synset, CASE WHEN n = 1 THEN 'single_synset' WHEN k = 1 THEN 'max_sense_count' ELSE 'ambiguous' END AS synset_selection_tag, cast(n AS INTEGER) AS n_synsets FROM t""")  # fmt: skip
def sense_choice(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    hits = p.groupBy(F.col("p_brand").alias("span_key")).agg(F.first("p_brand").alias("query"), F.array_sort(F.collect_set("p_type")).alias("synsets"))
    uses = p.groupBy(F.col("p_type").alias("synset"), F.col("p_brand").alias("lemma")).agg(F.max("p_size").alias("n"))
    return inventory.sense_choice(hits, uses).fillna("", ["selected_oewn_synset"])


@query("observed_inventory", """WITH t AS (SELECT p_brand AS span_key, count(*) AS observed_count, count(DISTINCT p_size) AS caption_count FROM part GROUP BY 1), s AS (SELECT p_brand AS span_key, p_type, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY span_key ORDER BY n DESC, f) AS r FROM s)
SELECT span_key, observed_count, caption_count, string_agg(p_type, '|' ORDER BY r) AS example_surfaces, min_by(p_type, r) AS observed_surface FROM r JOIN t USING (span_key) WHERE r <= 3 GROUP BY 1, 2, 3""")  # fmt: skip
def observed_inventory(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part").select(F.col("p_brand").alias("span_key"), F.col("p_type").alias("surface"), F.col("p_size").alias("caption_id"), F.col("p_partkey").alias("position"))
    return inventory.observed(p, keep=3)


@query("table_differences", "SELECT l_returnflag, l_linestatus, l_quantity, 'left' AS side FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 0 EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 1) UNION ALL SELECT l_returnflag, l_linestatus, l_quantity, 'right' FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 1 EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_orderkey % 2 = 0)")
def table_differences(spark, sf_dir):
    rows = adapters.table(spark, sf_dir, "lineitem")
    half = lambda i: rows.where(F.col("l_orderkey") % 2 == i).select("l_returnflag", "l_linestatus", "l_quantity")
    return compare.table_differences(half(0), half(1))


@query("count_comparison", f"""WITH {adapters.GRAPH_SQL}, obj AS (SELECT canonical AS object, caption_id, l FROM (SELECT m.canonical, m.caption_id, cast(m.caption_id AS BIGINT) % 2 AS l FROM mention m WHERE mention_type = 'object')),
c AS (SELECT object, count(DISTINCT caption_id) FILTER (l = 0) AS ours, count(DISTINCT caption_id) FILTER (l = 1) AS theirs FROM obj GROUP BY 1)
SELECT object, ours, theirs, round((ours - theirs) * 100.0 / nullif(theirs, 0), 8) AS difference, CASE WHEN theirs = 0 THEN 'undefined' WHEN ours = theirs THEN 'equal' WHEN abs((ours - theirs) * 100.0 / theirs) <= 5 THEN '<=5' WHEN abs((ours - theirs) * 100.0 / theirs) <= 10 THEN '<=10' WHEN abs((ours - theirs) * 100.0 / theirs) <= 25 THEN '<=25' WHEN abs((ours - theirs) * 100.0 / theirs) <= 50 THEN '<=50' WHEN abs((ours - theirs) * 100.0 / theirs) <= 100 THEN '<=100' ELSE '>100' END AS band FROM c""")  # fmt: skip
def count_comparison(spark, sf_dir):
    halves = _halves(spark, sf_dir, counts.BY_NAME["object_counts"])
    return compare.count_comparison(*halves, "object").withColumn("difference", F.round("difference", 8))


#: Words of the vocabulary that the labels are matched with, beside those that the labels are made of.
_TERMS = "WITH t AS (SELECT DISTINCT lower(p_type) || ' ' || w AS term FROM part, (VALUES ('box'), ('berry'), ('person'), ('walk'), ('bake')) v(w) UNION SELECT DISTINCT replace(lower(p_type), ' ', '-') || '-traffic-light' FROM part)"
_MADE = "lower(p_type) || ' ' || CASE p_partkey % 8 WHEN 0 THEN 'box' WHEN 1 THEN 'boxes' WHEN 2 THEN 'berries' WHEN 3 THEN 'people' WHEN 4 THEN 'walked' WHEN 5 THEN 'baking' WHEN 6 THEN 'traffic light' ELSE 'zebra' END"


@query("label_matches", f"""{_TERMS}, l AS (SELECT DISTINCT {_MADE} AS label, p_partkey % 8 AS k, lower(p_type) AS p FROM part)
SELECT label, CASE k WHEN 0 THEN label WHEN 1 THEN p || ' box' WHEN 2 THEN p || ' berry' WHEN 3 THEN p || ' person' WHEN 4 THEN p || ' walk' WHEN 5 THEN p || ' bake' WHEN 6 THEN replace(p, ' ', '-') || '-traffic-light' END AS match,
       CASE WHEN k = 0 THEN 'exact' WHEN k = 6 THEN 'separator' WHEN k < 6 THEN 'stem' END AS match_kind FROM l""")  # fmt: skip
def label_matches(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    words = p.select(F.lower("p_type").alias("t"), F.explode(F.array(*map(F.lit, ("box", "berry", "person", "walk", "bake")))).alias("w"))
    hyphens = p.select(F.concat(F.replace(F.lower("p_type"), F.lit(" "), F.lit("-")), F.lit("-traffic-light")).alias("term"))
    return compare.matched_labels(p.select(F.expr(_MADE).alias("label")).distinct(), words.select(F.concat_ws(" ", "t", "w").alias("term")).unionByName(hyphens).distinct())


@query("caption_sets", f"WITH {adapters.GRAPH_SQL} SELECT DISTINCT lower(canonical) AS term, caption_id FROM mention WHERE mention_type = 'object' AND canonical IN ('Brand#1', 'Brand#7')")
def caption_sets(spark, sf_dir):
    terms = spark.createDataFrame([("BRAND#1 ",), ("brand#7",), ("none",)], "term string")
    return counts.caption_sets(_facts(spark, sf_dir, "entity_exists"), terms, "object")


@query("interleave", "SELECT cast(doc_id AS VARCHAR) AS caption_id, doc_id AS caption_index, CASE WHEN doc_id % 10 = 0 THEN 'tag_list' ELSE 'sentence' END AS caption_shape FROM documents")
def interleave(spark, sf_dir):
    rows = shape.route(adapters.captions(spark, sf_dir))
    order = adapters.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("caption_id"), F.col("doc_id").alias("caption_index"))
    return shape.interleave(order, *shape.split(rows)).select("caption_id", "caption_index", "caption_shape")


@query("label_conflicts", "SELECT p_brand AS label, count(DISTINCT p_type) AS synsets, array_to_string(list_sort(list(DISTINCT 'set' || (p_size % 3))), '|') AS datasets FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def label_conflicts(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    return inventory.label_conflicts(p.select(F.concat(F.lit("set"), (F.col("p_size") % 3).cast("string")).alias("dataset"), F.col("p_brand").alias("label"), F.col("p_type").alias("synset")))


@query("series_statistics", "SELECT vec_id, round(list_avg(list_transform(embedding, lambda x: x::DOUBLE)), 9) AS mean_frequency, round(list_max(embedding)::DOUBLE, 9) AS max_frequency, cast(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS nonzero_years FROM embeddings")
def series_statistics(spark, sf_dir):
    out = inventory.series_statistics(adapters.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return out.select("vec_id", F.round("mean_frequency", 9).alias("mean_frequency"), F.round("max_frequency", 9).alias("max_frequency"), "nonzero_years")


@query("preposition_inventory", """WITH s AS (SELECT lower(p_name) AS surface, 'small' AS source FROM part WHERE p_size < 30 UNION ALL SELECT lower(p_name), 'large' FROM part WHERE p_size > 20)
SELECT surface, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources, count(DISTINCT source) AS n_sources, cast(len(string_split(surface, ' ')) AS INTEGER) AS n_tokens FROM s GROUP BY 1 HAVING n_tokens >= 2""")  # fmt: skip
def preposition_inventory(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part").withColumn("surface", F.upper("p_name"))
    return inventory.preposition_inventory([("small", p.where("p_size < 30")), ("large", p.where("p_size > 20"))])


@query("export_lexicon", "SELECT DISTINCT lower(p_name) AS raw, lower(p_name) || ' x' AS canonical FROM part UNION SELECT DISTINCT 'q ' || lower(p_name), lower(p_name) || ' x' FROM part")
def export_lexicon(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part").select(F.upper("p_name").alias("span_key"), F.concat(F.lit("Q  "), "p_name").alias("selected_query"), F.concat(F.lower("p_name"), F.lit(" x")).alias("canonical_surface"), F.lit("chosen").alias("decision_status"))
    return inventory.export_lexicon(p)


@query("source_histograms", " UNION ALL ".join(f"SELECT p_brand, '{k}' AS kind, cast({k} AS VARCHAR) AS value, count(*) AS n, cast(sum(count(*)) OVER (PARTITION BY p_brand) AS BIGINT) AS occurrences FROM part GROUP BY p_brand, {k}" for k in ("p_type", "p_size")))
def source_histograms(spark, sf_dir):
    return inventory.source_histograms(adapters.table(spark, sf_dir, "part"), "p_brand", ["p_type", "p_size"])


@query("reuse_by_query", """WITH a AS (SELECT p_brand, min(p_type) AS syn FROM part WHERE p_size > 45 GROUP BY 1 HAVING count(DISTINCT p_type) = 1)
SELECT p_partkey, CASE WHEN p_size <= 10 AND syn IS NOT NULL THEN syn WHEN p_size > 10 THEN 'own' ELSE '' END AS selected_oewn_synset FROM part LEFT JOIN a USING (p_brand)""")  # fmt: skip
def reuse_by_query(spark, sf_dir):
    p = adapters.table(spark, sf_dir, "part")
    prior = p.where("p_size > 45").select(F.col("p_brand").alias("selected_query"), F.col("p_type").alias("selected_oewn_synset"), F.lit("chosen").alias("decision_status"))
    rows = p.select("p_partkey", F.col("p_brand").alias("selected_query"), F.when(F.col("p_size") > 10, "own").otherwise("").alias("selected_oewn_synset"))
    return inventory.reuse_by_query(rows, prior).select("p_partkey", "selected_oewn_synset")


@query("json_events", "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE contains(props, '{') GROUP BY 1")
def json_events(spark, sf_dir):
    e = adapters.table(spark, sf_dir, "events").where(F.contains("props", F.lit("{")))
    parsed = e.select("event_type", "user_id", F.from_json("props", "map<string,string>").alias("p")).where("p is not null")
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))


# --- extraction


def _golden(spark, sf_dir, cut=None):
    """The graph of one golden caption for each order."""
    buckets = adapters.buckets_of(spark, sf_dir)
    rows = golden.many(spark, adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n")), buckets)
    return extract(rows, golden.lexicons(spark), cut or adapters.kept(buckets))


@query("golden_graph_mentions", golden.expected_sql(golden.MENTIONS, "mention_type, text, token_start, token_end"))
def golden_graph_mentions(spark, sf_dir):
    return _golden(spark, sf_dir, lambda df: df)[0].select("caption_id", "mention_type", "text", "token_start", "token_end")


@query("golden_graph_edges", golden.expected_sql(golden.EDGES, "edge_type, source, label, target, rule_id"))
def golden_graph_edges(spark, sf_dir):
    rows = golden.many(spark, adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n")), adapters.buckets_of(spark, sf_dir))
    rows = extract_rows(rows, golden.lexicons(spark), adapters.kept(adapters.buckets_of(spark, sf_dir)))
    named = F.transform("mentions", lambda m: F.struct(m.mention_id.alias("mention_id"), m.text.alias("text")))
    edges = rows.select("caption_id", named.alias("named"), F.explode("edges").alias("e")).select("caption_id", "named", "e.*")
    text = lambda end: F.coalesce(F.get(F.filter("named", lambda m: m.mention_id == F.col(f"{end}_mention_id")), F.lit(0)).text, F.lit("")).alias(end)
    return edges.select("caption_id", "edge_type", text("source"), "label", text("target"), "rule_id")


@query("annotated_to_counts", """WITH c AS (SELECT o_orderkey % 13 AS k FROM orders), o(k, object, n) AS (VALUES (0, 'cat', 1), (0, 'kite', 1), (1, 'lamp', 1), (1, 'chair', 1), (2, 'boat', 1), (3, 'boat', 1), (4, 'curtain', 1), (5, 'girl', 1), (5, 'boat', 1), (6, 'lamp', 1), (6, 'desk', 1), (7, 'cat', 1), (7, 'desk', 1), (7, 'shelf', 1), (8, 'bird', 1), (8, 'girl', 1), (9, 'kite', 1), (9, 'bird', 1), (10, 'girl', 1), (10, 'lamp', 1), (11, 'shelf', 1), (12, 'boat', 1), (12, 'bridge', 1), (12, 'tower', 1))
SELECT object, count(*) AS count, count(*) AS caption_count FROM c JOIN o USING (k) GROUP BY 1""")  # fmt: skip
def annotated_to_counts(spark, sf_dir):
    """The whole path, from annotated captions (one for each order) to a count table."""
    raw_mentions, raw_edges = _golden(spark, sf_dir, lambda df: df)  # objects are facts of mentions: edges are not made
    none = spark.createDataFrame([], "raw string, canonical string")
    m = adapters.kept(adapters.buckets_of(spark, sf_dir))(canonical.canonicalize_mentions(raw_mentions, none, none))
    found = all_facts(m, canonical.canonicalize_edges(raw_edges, m), united=False)
    return counts.count_table(found["entity_exists"], counts.BY_NAME["object_counts"]).select("object", "count", "caption_count")


@query("preposition_matches", f"""WITH {TEXT_SQL}, t AS (SELECT key AS caption_id, regexp_extract_all(lower(caption), '[\\p{{L}}\\p{{N}}]+|[^\\s]') AS w FROM src WHERE caption_type <> 'tag'),
g AS (SELECT caption_id, unnest(range(len(w) - 1)) AS s, w FROM t WHERE len(w) > 1) SELECT caption_id, cast(s AS INTEGER) AS start, cast(s + 2 AS INTEGER) AS "end", w[s + 1] || ' ' || w[s + 2] AS key FROM g WHERE w[s + 1] || ' ' || w[s + 2] IN ('of the', 'que de', 'der die')""")  # fmt: skip
def preposition_matches_query(spark, sf_dir):
    rows = shape.route(adapters.captions(spark, sf_dir))
    lists = tokens.token_lists(rows.select("caption_id", "caption_shape", "caption"))
    words = spark.createDataFrame([(k, 2) for k in ("of the", "que de", "der die")], "key string, width int")
    return preposition_matches(lists, words).select("caption_id", "start", "end", "key")


def _cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint; where the session has no folder for them, one of our own."""
    adapters.shared(df.sparkSession)
    return df.checkpoint()
