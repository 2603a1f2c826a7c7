import pytest
from pyspark.sql import functions as F

from tessera import schema
from tessera.operators import counts, facts, fold, inventory, shape
from tessera.operators.extract import extract
from tessera.plans import adapters, golden
from tessera.sources import lexicons


def test_interleave_wants_each_caption_once(spark):
    order = spark.createDataFrame([("a", 0), ("b", 1)], "caption_id string, caption_index int")
    a, b = (spark.createDataFrame([(x,)], "caption_id string") for x in "ab")
    assert [r["caption_id"] for r in shape.interleave(order, b, a).collect()] == ["a", "b"]
    for s, t in ((a, a), (a, b.limit(0)), (a, b.unionByName(spark.createDataFrame([("c",)], "caption_id string")))):
        with pytest.raises(Exception, match="not exactly once"):
            shape.interleave(order, s, t).collect()


def test_shard_sizes():
    assert shape.shard_sizes(10, 4) == [3, 3, 2, 2]


def test_dimension_is_broadcast_only_while_small(spark):
    small, large = (spark.range(n).selectExpr("id as k") for n in (10, 1000))
    facts_ = spark.range(5).selectExpr("id as k")
    plan = lambda d: facts_.hint("merge").join(fold.dimension(d, 100), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(small)
    assert "strategy=broadcast" not in plan(large)


def test_lexicon_bundle_and_publishing(spark, tmp_path):
    for name, (key, value) in lexicons.BUNDLE.items():
        (tmp_path / f"{name}.tsv").write_text(f"{key}\t{value}\tsource\tnotes\n A \tx\t\t\n\ty\t\t\nb\t\t\t\n")
    found = lexicons.lexicon_bundle(spark, str(tmp_path))
    assert [tuple(r) for r in found["action_synonyms"].collect()] == [("a", "x")]
    assert [tuple(r) for r in found["object_parents"].collect()] == [("a", ["x"])]
    (tmp_path / "object_parents.tsv").unlink()
    with pytest.raises(Exception, match="(?i)path"):
        lexicons.lexicon_bundle(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "needs_manual")], "span_key string, decision_status string")
    assert inventory.bundle_problems({"a": "x"}, ("a", "b"), {"a": lexicons.blockers(rows)}) == ["missing: b", "open decisions: a"]


def test_schema_checks(spark, sf):
    mentions, edges = adapters.graph(spark, sf)
    assert schema.checked_mentions(mentions).count() == mentions.count()
    assert schema.checked_edges(edges).count() == edges.count()
    with pytest.raises(Exception, match="must not be empty"):
        schema.checked_mentions(mentions.withColumn("mention_id", F.lit(""))).collect()
    with pytest.raises(Exception, match="may miss an end"):
        schema.checked_edges(edges.withColumn("source_mention_id", F.lit(schema.MISSING_SOURCE))).collect()


def test_rules_united_early_or_late(spark, sf):
    graph = adapters.graph(spark, sf)
    early, late = facts.all_facts(*graph), facts.all_facts(*graph, united=False)
    for spec in counts.SPECS:
        a, b = (counts.flat(counts.count_table(f[spec.fact_type], spec)) for f in (early, late))
        assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_repeated_captions_extract_alike(spark):
    rows = golden.many(spark, spark.range(26).selectExpr("id as n"))
    mentions, edges = extract(rows, golden.lexicons(spark))
    name = F.substring_index("caption_id", "-", 1)
    assert mentions.groupBy(name.alias("c"), "mention_id").count().where("count <> 2").count() == 0
    assert edges.groupBy(name.alias("c"), "edge_id").count().where("count <> 2").count() == 0
    assert mentions.count() == 2 * extract(golden.captions(spark), golden.lexicons(spark))[0].count()


def test_manual_edits(spark):
    rows = spark.createDataFrame([("a", "chosen", "x"), ("b", "chosen", "y")], "span_key string, decision_status string, decision_reason string")
    assert {tuple(r) for r in inventory.reopen(rows, rows.where("span_key = 'b'")).collect()} == {("a", "chosen", "x"), ("b", "needs_manual", "reopened")}
    merged, conflicts = inventory.merge_prior([rows, rows.withColumn("decision_reason", F.lit("z"))], "span_key", ["decision_status", "decision_reason"])
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in rows.collect()}
    assert conflicts.count() == 2
    assert [r["span_key"] for r in inventory.without_plural_heads(rows, spark.createDataFrame([("a",)], "span_key string")).collect()] == ["b"]
    assert inventory.add_rows(rows, rows.where("span_key = 'a'").withColumn("decision_status", F.lit("excluded")), ["span_key"]).where("decision_status = 'excluded'").count() == 1
