"""Queries of patches, published bundles, resumed runs, rewritten decisions and audits, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts, report, rewrite
from ..operators.facts import all_facts
from ..sources import versions
from ..streaming import incremental
from . import adapters
from .queries import _cut, query
from .round_trips import _folder

_NEW_ORDERS = """
kept AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, round(o_totalprice * 100)::BIGINT + CASE WHEN o_orderkey % 101 = 5 AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS cents FROM orders WHERE o_orderkey % 97 <> 0 OR o_orderstatus = 'P'),
fresh AS (SELECT c_custkey + 100000000 AS o_orderkey, 'F' AS o_orderstatus, c_mktsegment AS o_orderpriority, round(c_acctbal * 100)::BIGINT AS cents FROM customer)"""


@query(
    "patched_table",
    f"""WITH {_NEW_ORDERS}, n AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh)
SELECT o_orderstatus, count(*) AS row_count, sum(cents)::BIGINT AS cents, CASE o_orderstatus WHEN 'P' THEN 1 ELSE 2 END AS written_in, 2 AS version, 0 AS changed_again, true AS valid FROM n GROUP BY o_orderstatus""",
)
def patched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, patched to a changed state; the same patch once more changes nothing, and partitions without changes are not written."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    old = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", cents.alias("cents"))
    free = F.col("o_orderstatus") == "P"
    kept = old.where((F.col("o_orderkey") % 97 != 0) | free).withColumn("cents", F.col("cents") + F.when((F.col("o_orderkey") % 101 == 5) & ~free, 1).otherwise(0))
    fresh = adapters.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 100_000_000).alias("o_orderkey"), F.lit("F").alias("o_orderstatus"), F.col("c_mktsegment").alias("o_orderpriority"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    new, path, keys = kept.unionByName(fresh), f"{_folder(spark)}/orders", ["o_orderstatus", "o_orderkey"]
    versions.create(spark, path, old, "o_orderstatus", keys)
    patch = _cut(versions.export_patch(old, new, keys))
    versions.apply_patch(spark, path, patch)
    number, again = versions.apply_patch(spark, path, patch)
    first, last = (versions.Versions(spark, path).manifest(i)["partitions"] for i in (1, number))
    written = spark.createDataFrame([(v, 1 if n == first.get(v) else number) for v, n in last.items()], "o_orderstatus string, written_in int")
    now = versions.read(spark, path)
    valid = not now.exceptAll(new.select(now.columns)).limit(1).count() and not new.select(now.columns).exceptAll(now).limit(1).count()
    out = now.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"), F.sum("cents").alias("cents")).join(F.broadcast(written), "o_orderstatus")
    return out.withColumns({"version": F.lit(number), "changed_again": F.lit(len(again)), "valid": F.lit(valid)})


@query(
    "published_bundles",
    """SELECT 1 AS version, 'first' AS label, 'objects' AS component, count(*) AS row_count, true AS intact, true AS second_was_refused FROM part
UNION ALL SELECT 1, 'first', 'attributes', count(*), true, true FROM supplier UNION ALL SELECT 2, 'second', 'objects', count(*), true, true FROM part WHERE p_size > 10 UNION ALL SELECT 2, 'second', 'attributes', count(*), true, true FROM supplier""",
)
def published_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishers stage bundles over the same version: one wins, the other is refused and publishes over the new version."""
    part, supplier, path = adapters.table(spark, sf_dir, "part"), adapters.table(spark, sf_dir, "supplier"), f"{_folder(spark)}/bundle"
    need = ("objects", "attributes")
    one = versions.stage(spark, path, {"objects": part, "attributes": supplier}, need)
    two = versions.stage(spark, path, {"objects": part.where("p_size > 10"), "attributes": supplier}, need)
    versions.publish(spark, path, one, 0, "first")
    try:
        versions.publish(spark, path, two, 0, "second")
        refused = False
    except versions.Conflict:
        refused = True
    versions.publish(spark, path, two, 1, "second")
    found = []
    for number in (1, 2):
        fine = versions.verify(spark, path, number)
        label = versions.Versions(spark, path).manifest(number)["label"]
        for name, rows in versions.bundle(spark, path, number).items():
            found.append(rows.agg(F.lit(number).alias("version"), F.lit(label).alias("label"), F.lit(name).alias("component"), F.count(F.lit(1)).alias("row_count"), F.lit(fine[name]).alias("intact"), F.lit(refused).alias("second_was_refused")))
    return reduce(DataFrame.unionByName, found)


@query(
    "resumed_counts",
    f"WITH {adapters.GRAPH_SQL} SELECT canonical AS object, count(*) AS count, count(DISTINCT caption_id) AS caption_count, true AS resumed, true AS other_rules_refused FROM mention WHERE mention_type = 'object' GROUP BY 1",
)
def resumed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object counts over a stream that stops half way and is taken up again; the same checkpoint with another rules' version is refused."""
    facts = all_facts(*adapters.graph(spark, sf_dir))["entity_exists"]
    spec, path = counts.BY_NAME["object_counts"], _folder(spark)
    half = F.pmod(F.xxhash64("caption_id"), F.lit(2))
    run = lambda rules: incremental.keep_counts(spark.readStream.schema(facts.schema).parquet(f"{path}/in"), spec, f"{path}/out", f"{path}/run", rules=rules)
    marks = []
    for i in (0, 1):
        facts.where(half == i).write.mode("append").parquet(f"{path}/in")
        run("v1").awaitTermination()
        marks.append(incremental.repeated(spark, f"{path}/out").count() == 0)
    try:
        run("v2").stop()
        refused = False
    except incremental.OtherRun:
        refused = True
    done = incremental.merged(spark, spec, f"{path}/out").select("object", "count", "caption_count")
    return done.withColumns({"resumed": F.lit(all(marks)), "other_rules_refused": F.lit(refused)})


@query(
    "manual_rewrites",
    """WITH p AS (SELECT p_partkey AS k, p_partkey % 50 AS m, p_partkey // 50 * 50 AS b, p_name FROM part),
n AS (SELECT max(k) AS top FROM p)
SELECT 'p' || k AS span_key,
  CASE WHEN m IN (10, 11) AND b + 11 <= top OR m = 21 OR (m = 10 AND b + 11 > top) THEN 'needs_manual' WHEN m IN (1, 2, 3) AND b + 4 > top THEN 'needs_manual' ELSE 'chosen' END AS decision_status,
  CASE WHEN m IN (1, 2, 3) THEN CASE WHEN b + 4 <= top THEN 'rewritten_through_row' ELSE 'rewrite_target_missing' END WHEN m IN (10, 11) THEN CASE WHEN b + 11 <= top THEN 'rewrite_cycle' ELSE 'rewrite_target_missing' END
       WHEN m = 20 THEN 'rewritten_through_head' WHEN m = 21 THEN 'rewrite_target_missing' WHEN m = 30 THEN 'by_hand' ELSE 'automatic' END AS decision_reason,
  CASE WHEN m IN (1, 2, 3) AND b + 4 <= top THEN 'name ' || (b + 4) WHEN m IN (1, 2, 3, 10, 11, 21) THEN '' WHEN m = 20 THEN 'a ring' WHEN m = 30 THEN 'hand ' || k ELSE 'name ' || k END AS canonical_surface
FROM p, n UNION ALL SELECT 'ring', 'chosen', 'automatic', 'a ring'""",
)
def manual_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an inventory: of every fifty, a chain of three rows to a decided one, a cycle of two, one through its head, one without a row."""
    part = adapters.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k")).withColumn("m", F.col("k") % 50)
    name = F.concat(F.lit("p"), F.col("k").cast("string"))
    is_open = F.col("m").isin(1, 2, 3, 10, 11, 20, 21, 30)
    full = part.select(name.alias("span_key"), F.when(is_open, "needs_manual").otherwise("chosen").alias("decision_status"), F.when(is_open, "manual_synset_required").otherwise("automatic").alias("decision_reason"), F.when(is_open, "").otherwise(F.concat(F.lit("name "), F.col("k").cast("string"))).alias("canonical_surface"))
    full = full.unionByName(spark.createDataFrame([("ring", "chosen", "automatic", "a ring")], full.schema))
    to = lambda k: F.concat(F.lit("P"), k.cast("string"))
    via = F.when(F.col("m").isin(1, 2, 3, 10), to(F.col("k") + 1)).when(F.col("m") == 11, to(F.col("k") - 1)).when(F.col("m") == 20, "old red ring").when(F.col("m") == 21, "nothing here").otherwise("")
    resolved = part.where(is_open).select(name.alias("span_key"), F.lit("chosen").alias("decision_status"), F.lit("by_hand").alias("decision_reason"), F.when(F.col("m") == 30, F.concat(F.lit("hand "), F.col("k").cast("string"))).otherwise("").alias("canonical_surface"), via.alias("replacement"))
    return rewrite.resolve_manual(full, resolved, ["canonical_surface"], _cut).fillna("", ["canonical_surface"])


@query(
    "update_moves",
    f"""WITH {adapters.GRAPH_SQL}, m AS (SELECT caption_id, mention_type, canonical AS c, variant FROM mention)
SELECT 'object' AS mention_type, c AS from_key, 'Brand#merged' AS to_key, count(*) AS mentions, count(DISTINCT caption_id) AS captions, 0::BIGINT AS unexplained FROM m WHERE mention_type = 'object' AND c IN ('Brand#1', 'Brand#2') GROUP BY c
UNION ALL SELECT 'attribute', 'a', 'accepted', count(*), count(DISTINCT caption_id), 0 FROM m WHERE mention_type = 'attribute' AND c = 'a'""",
)
def update_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two brands and a return flag renamed: what moved where, and rows of the object view whose counts that does not explain."""
    old, edges = adapters.graph(spark, sf_dir)
    old = _cut(old)
    name = F.when((F.col("mention_type") == "object") & F.col("canonical").isin("Brand#1", "Brand#2"), "Brand#merged").when((F.col("mention_type") == "attribute") & (F.col("canonical") == "a"), "accepted").otherwise(F.col("canonical"))
    new = old.withColumn("canonical", name)
    moved = _cut(rewrite.moves(old, new))
    view = lambda m: counts.count_table(all_facts(m, edges, united=False)["entity_exists"], counts.BY_NAME["object_counts"])
    left = rewrite.unexplained(view(old), view(new), moved.where("mention_type = 'object'"), "object").count()
    return moved.withColumn("unexplained", F.lit(left).cast("long"))


@query(
    "mapping_audit",
    f"""WITH {adapters.GRAPH_SQL}, a AS (SELECT DISTINCT variant AS raw, canonical FROM mention WHERE mention_type IN ('attribute', 'quantity')),
asked AS (SELECT DISTINCT lower(l_returnflag) AS raw, lower(l_returnflag) AS canonical FROM lineitem UNION SELECT 'fresh', 'r' UNION SELECT 'a', 'n')
SELECT asked.raw, asked.canonical, count(a.raw) AS row_count, CASE WHEN count(a.raw) = 0 THEN 'missing' ELSE 'complete' END AS status, 0::BIGINT AS mismatches FROM asked LEFT JOIN a USING (raw, canonical) GROUP BY 1, 2""",
)
def mapping_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether synonyms have arrived in the attribute view, and whether its rows have the captions that they say."""
    mentions, edges = adapters.graph(spark, sf_dir)
    facts = all_facts(mentions, edges, united=False)
    table = counts.count_table(facts["attribute_exists"], counts.BY_NAME["attribute_counts"])
    rows = table.select(F.col("attribute").alias("canonical_attribute"), "attribute_kind", F.col("raw_variants").alias("attribute_raw_surfaces"), "count", "caption_count", "example_caption_ids")
    view = _cut(report.numbered(rows, "attributes", _cut))
    index = report.caption_index(facts, {"attributes": view})
    flags = adapters.table(spark, sf_dir, "lineitem").select(F.lower("l_returnflag").alias("raw")).distinct().withColumn("canonical", F.col("raw"))
    asked = flags.unionByName(spark.createDataFrame([("Fresh", "r"), ("a", "n")], "raw string, canonical string"))
    return rewrite.mapping_audit(asked, view, index).withColumnRenamed("rows", "row_count")


@query(
    "lexicon_comparison",
    """WITH o AS (SELECT DISTINCT p_name AS raw, min(p_brand) AS c FROM part WHERE p_partkey % 7 <> 0 GROUP BY 1), n AS (SELECT p_name AS raw, min(p_brand) AS c FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1), k AS (SELECT p_name AS raw, count(*) AS count FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1)
SELECT CASE WHEN o.c IS NULL THEN 'added' WHEN n.c IS NULL THEN 'removed' ELSE 'renamed' END AS change, raw, coalesce(o.c, '') AS old, coalesce(n.c, '') AS new, coalesce(count, 0) AS count
FROM o FULL JOIN n USING (raw) LEFT JOIN k USING (raw) WHERE o.c IS DISTINCT FROM n.c""",
)
def lexicon_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lexicons from parts of the part table, how they differ, and how often the names occur in lines."""
    part, line = adapters.table(spark, sf_dir, "part"), adapters.table(spark, sf_dir, "lineitem")
    lexicon = lambda n: part.where(F.col("p_partkey") % n != 0).groupBy(F.col("p_name").alias("raw")).agg(F.min("p_brand").alias("canonical"))
    uses = line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_name").alias("raw")).agg(F.count(F.lit(1)).alias("count"))
    return rewrite.lexicon_comparison(lexicon(7), lexicon(5), uses)


@query(
    "requested_pairs",
    f"""WITH {adapters.GRAPH_SQL}, fact AS ({adapters.FACT_SQL["has_attribute"]}), l AS (SELECT caption_id, lower(object) AS a, lower(attribute) AS b FROM fact),
asked AS (SELECT DISTINCT lower(p_brand) AS a, unnest(['a', 'r', '7', 'nothing']) AS b FROM part WHERE p_size < 5 UNION SELECT 'no brand', 'a')
SELECT asked.a AS first, asked.b AS second, (SELECT count(DISTINCT caption_id) FROM l WHERE l.a = asked.a AND l.b = asked.b) AS caption_count, (SELECT count(DISTINCT caption_id) FROM l WHERE l.a = asked.a) AS first_captions,
       (SELECT count(DISTINCT caption_id) FROM l WHERE l.b = asked.b) AS second_captions FROM asked""",
)
def requested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions of requested object and attribute pairs, and of either label."""
    facts = all_facts(*adapters.graph(spark, sf_dir), united=False)["has_attribute"]
    brands = adapters.table(spark, sf_dir, "part").where("p_size < 5").select(F.concat(F.lit(" "), F.upper("p_brand")).alias("first"))
    asked = brands.select("first", F.explode(F.array(*map(F.lit, ("A", "r ", "7", "nothing")))).alias("second")).unionByName(spark.createDataFrame([("no brand", "a")], "first string, second string"))
    return counts.requested_pairs(facts, asked, "object", "attribute")
