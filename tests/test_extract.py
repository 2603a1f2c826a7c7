"""Golden graphs: exact mentions and edges of small annotated captions."""

import pytest

from tessera.operators import canonical, counts
from tessera.operators.extract import extract
from tessera.operators.facts import all_facts
from tessera.plans import golden
from tessera.sources import lexicons as files


@pytest.fixture(scope="module")
def graph(spark):
    mentions, edges = extract(golden.captions(spark), golden.lexicons(spark))
    return mentions.persist(), edges.persist()


@pytest.fixture(scope="module")
def by_caption(graph):
    out = {name: ([], []) for name in golden.CASES}
    for i, (df, key) in enumerate(zip(graph, ("mention_id", "edge_id"), strict=True)):
        for r in sorted(df.collect(), key=lambda r: int(r[key][1:])):
            out[r["caption_id"]][i].append(r)
    return out


@pytest.mark.parametrize("name", sorted(golden.CASES))
def test_expected_graph(by_caption, name):
    """Every mention and edge, in the order in which they are numbered, as written down by hand."""
    mentions, edges = by_caption[name]
    text = {m["mention_id"]: m["text"] for m in mentions}
    assert [(m["mention_type"], m["text"], m["token_start"], m["token_end"]) for m in mentions] == golden.MENTIONS[name]
    got = [(e["edge_type"], text.get(e["source_mention_id"], ""), e["label"], text.get(e["target_mention_id"], ""), e["rule_id"]) for e in edges]
    assert sorted(got) == sorted(golden.EDGES[name])


def test_prepositional_phrase_tokens(by_caption):
    assert by_caption["c6"][1][0]["matched_token_indices"] == ["2", "3", "4"]


def test_ambiguous_targets(by_caption):
    found = [e for e in by_caption["c7"][1] if e["edge_type"] == "ambiguous_relation_candidate"]
    assert [e["ambiguity_scope"] for e in found] == ["target", "target"]


def test_gates(spark):
    objects, actions, phrases, prepositions = golden.inventories(spark)
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="need a decision"):
        files.object_inventory(objects.withColumn("decision_status", F.when(F.col("span_key") == "window", "needs_manual").otherwise("chosen")))
    with pytest.raises(ValueError, match="need a decision"):
        files.object_inventory(objects.withColumn("canonical_surface", F.lit("")))
    with pytest.raises(Exception, match="another rule version"):
        files.attribute_phrases(phrases.withColumn("attribute_mwe_rule_version", F.lit("old"))).count()
    with pytest.raises(Exception, match="conflicting phrases"):
        files.attribute_phrases(phrases.unionByName(phrases.withColumn("canonical_surface", F.lit("other")))).collect()
    with pytest.raises(Exception, match="repeated lexicon key"):
        files.value_lexicon(spark.createDataFrame([("A ", "x"), ("a", "y")], "raw string, canonical string")).collect()


def test_whole_path_and_integrity(spark, graph):
    none = spark.createDataFrame([("old", "aged")], "raw string, canonical string")
    mentions = canonical.canonicalize_mentions(graph[0], none, none.limit(0))
    edges = canonical.canonicalize_edges(graph[1], mentions)
    assert mentions.where("canonical = 'aged' and canonical_source = 'lexicon'").count() == 1
    facts = all_facts(mentions, edges)
    checked = counts.integrity(facts, counts.count_tables(facts)).collect()
    assert len(checked) == 10
    assert all(r["agree"] for r in checked)
    statuses = {(r["source_status"], r["target_status"]) for r in facts["ambiguous_relation_candidate"].collect()}
    assert statuses == {("source_missing", "target_resolved"), ("source_resolved", "target_ambiguous")}
