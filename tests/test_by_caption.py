"""Tables in buckets by caption: what works by caption reads them without an exchange, and makes the same rows as before."""

from pyspark.sql import functions as F

from tessera.operators import canonical, counts
from tessera.operators.facts import all_facts
from tessera.plans import adapters


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange ")


def test_facts_need_no_exchange(spark, sf):
    mentions, edges = adapters.graph(spark, sf)
    facts = all_facts(mentions, edges, united=False)
    assert {name for name, f in facts.items() if exchanges(f)} == set()
    assert exchanges(counts.triple_facts(edges, mentions)) == 0
    assert exchanges(canonical.canonicalize_edges(edges.drop("canonical_label", "canonical_rule_id", "source_canonical", "target_canonical"), mentions)) == 0


def test_lines_are_exchanged_once(spark, sf):
    rows = adapters.lines(spark, sf)
    assert exchanges(rows.groupBy("caption_id").count()) == 0
    assert "lineitem" not in plan(rows)


def test_empty_tables(spark, sf, tmp_path):
    for t in ("lineitem", "orders", "part"):
        adapters.table(spark, sf, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    mentions, edges = adapters.graph(spark, str(tmp_path))
    assert [f.count() for f in all_facts(mentions, edges).values()] == [0] * 10
    assert counts.triple_facts(edges, mentions).count() == 0


def test_triples_of_missing_ends(spark):
    mentions = spark.createDataFrame([("c", "a", "run"), ("c", "1", "cat"), ("c", "2", None), ("c", None, "x"), ("d", "a", "sit")], "caption_id string, mention_id string, canonical string")
    edges = spark.createDataFrame([("c", "a", "1", "agent"), ("c", "a", "2", "patient"), ("c", "a", "9", "patient"), ("c", "b", "1", "agent"), ("d", "a", "1", "agent")], "caption_id string, source_mention_id string, target_mention_id string, canonical_label string").withColumn("edge_type", F.lit("event_role"))
    assert [tuple(r) for r in counts.triple_facts(edges, mentions).collect()] == [("c", None, "run", "cat")]
