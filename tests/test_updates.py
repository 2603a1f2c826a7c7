"""Patches, bundles, resumed runs, rewrites and the builders' hard cases."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import builders, counts, rewrite
from tessera.plans import annotated
from tessera.sources import versions
from tessera.streaming import incremental

TABLE = "part string, id long, v string"


def state(spark, path, number=None):
    return sorted(tuple(r) for r in versions.read(spark, path, number).collect())


def test_patch_is_applied_once(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["part", "id"]
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, "y"), ("c", 4, "z")], TABLE)
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "now"), ("b", 3, "y"), ("d", 5, None)], TABLE)
    versions.create(spark, path, old, "part", keys)
    patch = versions.export_patch(old, new, keys)
    assert sorted(tuple(r) for r in patch.collect()) == [("delete", "c", 4, "z"), ("upsert", "a", 2, "now"), ("upsert", "d", 5, None)]
    number, effect = versions.apply_patch(spark, path, patch)
    assert number == 2 and {r["part"]: (r["inserted"], r["updated"], r["deleted"]) for r in effect} == {"a": (0, 1, 0), "c": (0, 0, 1), "d": (1, 0, 0)}
    assert state(spark, path) == sorted(tuple(r) for r in new.collect()) and state(spark, path, 1) == sorted(tuple(r) for r in old.collect())
    assert versions.apply_patch(spark, path, patch) == (2, [])
    first, second = (versions.Versions(spark, path).manifest(i)["partitions"] for i in (1, 2))
    assert first["b"] == second["b"] and "c" not in second
    with pytest.raises(ValueError, match="two rows"):
        versions.apply_patch(spark, path, patch.unionByName(patch))
    assert versions.apply_patch(spark, path, patch.limit(0)) == (2, [])
    assert versions.export_patch(old, old, keys).count() == 0


def test_one_publisher_wins_and_a_damaged_bundle_shows(spark, tmp_path):
    path = f"{tmp_path}/b"
    rows = spark.range(5)
    staged = versions.stage(spark, path, {"x": rows}, ("x",))
    assert versions.Versions(spark, path).number() == 0
    assert versions.publish(spark, path, staged, 0) == 1
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, staged, 0)
    assert versions.verify(spark, path) == {"x": True}
    with pytest.raises(ValueError, match="not ready"):
        versions.stage(spark, path, {"x": rows}, ("x", "y"))
    with pytest.raises(ValueError, match="open decisions"):
        versions.stage(spark, path, {"x": rows}, ("x",), {"x": rows})
    place = versions.Versions(spark, path).manifest()["components"]["x"]["path"]
    spark.range(1).write.mode("append").parquet(f"{path}/{place}")
    assert versions.verify(spark, path) == {"x": False}


def test_a_commit_between_look_and_rename_is_refused(spark, tmp_path, monkeypatch):
    there = versions.Versions(spark, f"{tmp_path}/c")
    assert there.commit(0, {"a": 1}) == 1
    late = versions.Versions(spark, f"{tmp_path}/c")
    monkeypatch.setattr(late, "number", lambda: 0)
    with pytest.raises(versions.Conflict):
        late.commit(0, {"a": 2})
    assert there.manifest() == {"a": 1} and there.number() == 1


def test_resume_refuses_another_run(spark, tmp_path):
    spec = counts.BY_NAME["object_counts"]
    facts = spark.createDataFrame([], "caption_id string, object string")
    mark = incremental.fingerprint(facts, spec, "v1", input="here")
    assert incremental.same_run(spark, f"{tmp_path}/run", mark) is False
    assert incremental.same_run(spark, f"{tmp_path}/run", mark) is True
    for other in (incremental.fingerprint(facts, spec, "v2", input="here"), incremental.fingerprint(facts, spec, "v1"), incremental.fingerprint(facts.drop("object"), spec, "v1", input="here")):
        with pytest.raises(incremental.OtherRun):
            incremental.same_run(spark, f"{tmp_path}/run", other)


@pytest.mark.parametrize("n", [1, 2, 3, 17])
def test_chains_and_cycles_of_any_length(spark, n):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(n)]
    cycle = [(f"o{i}", f"o{(i + 1) % n}") for i in range(n)]
    tail = [("t", "o0")]
    got = {r["key"]: (r["target"], r["cycle"]) for r in rewrite.follow(spark.createDataFrame(chain + cycle + tail, "key string, target string")).collect()}
    assert all(got[f"c{i}"] == (f"c{n}", False) for i in range(n))
    assert all(got[k] == (t, True) for k, t in cycle + tail)


def test_open_rows_must_be_the_resolved_rows(spark):
    full = spark.createDataFrame([("a", "needs_manual", "", ""), ("b", "chosen", "", "B")], "span_key string, decision_status string, decision_reason string, canonical_surface string")
    resolved = spark.createDataFrame([("b", "chosen", "", "B", "")], "span_key string, decision_status string, decision_reason string, canonical_surface string, replacement string")
    with pytest.raises(ValueError, match="not the open rows"):
        rewrite.resolve_manual(full, resolved, ["canonical_surface"])


def test_attribute_lookup_cases(spark):
    lex = annotated.lexicon(spark)
    asked = spark.createDataFrame([("single_token", "economies", True), ("single_token", "economies", False), ("single_token", "standards", True), ("single_token", "", False), ("mwe", "alone", False), ("single_token", "small", None)], "unit string, span_key string, plural boolean")
    rows = builders.attribute_lookup(asked, *(lex[k] for k in ("lemmas", "morphy", "synsets", "sense_counts"))).collect()
    got = {(r["span_key"], r["plural"]): (r["lookup_case"], r["selected"], r["decision_status"]) for r in rows}
    assert got == {
        ("economies", True): ("surface_query_conflict", None, "needs_manual"), ("economies", False): ("exact", "n-savings", "needs_manual"), ("standards", True): ("exact", "n-standard", "chosen"),
        ("alone", False): ("unresolved", None, "chosen"), ("small", False): ("exact", "a-small", "chosen"),
    }


def test_builders_take_empty_captions(spark, sf):
    lex = annotated.lexicon(spark)
    none = annotated.captions(spark, sf).limit(0)
    assert builders.attribute_inventory(none, lex["objects"], lex["prepositions"], annotated._lookup(spark)).count() == 0
    lookup = lambda keys: builders.action_lookup(keys, lex["lemmas"], lex["morphy"], lex["sense_counts"])
    assert builders.action_inventory(none, lex["prepositions"], lookup).count() == 0
    with pytest.raises(ValueError):
        builders.attribute_candidates(none, lex["objects"], lex["prepositions"], "some")


def test_conjuncts_of_conjuncts_are_anchors_and_cycles_end(spark, sf):
    """big -> red -> old are a chain of conjuncts; two tokens that are each other's head are no anchors."""
    lex = annotated.lexicon(spark)
    cell = lambda i, text, dep, head, pos="ADJ": (i, text, text, pos, "JJ", "", dep, head, "", 0, 0, " ")
    tokens = [cell(0, "big", "amod", 6), cell(1, "red", "conj", 0), cell(2, "old", "conj", 1), cell(3, "odd", "conj", 4), cell(4, "sad", "conj", 3), cell(5, "two", "nummod", 6, "NUM"), cell(6, "ring", "ROOT", 6, "NOUN")]
    chunk = ("", 6, "", "", "", "", "", 6, "", 0, 7, 0, 0)
    df = spark.createDataFrame([("k", "", "sentence", tokens, [chunk], [])], annotated.ANNOTATED)
    found = builders.attribute_candidates(df, lex["objects"], lex["prepositions"]).select("unit", "surface").collect()
    assert sorted(tuple(r) for r in found) == [("mwe", "big red"), ("mwe", "big red old"), ("mwe", "red old"), ("single_token", "big"), ("single_token", "old"), ("single_token", "red")]


def test_a_view_with_two_rows_for_a_key_is_refused(spark):
    from tessera.operators import report

    view = spark.createDataFrame([(1, "cat"), (2, "cat")], "_row_id long, canonical_object string")
    facts = {"entity_exists": spark.createDataFrame([("c", "cat")], "caption_id string, object string")}
    with pytest.raises(Exception, match="two rows of objects"):
        report.caption_index(facts, {"objects": view}).collect()


def test_moves_from_nowhere(spark):
    make = lambda rows: spark.createDataFrame(rows, "caption_id string, mention_id string, mention_type string, canonical string")
    old, new = make([("c", "m1", "object", "a"), ("c", "m2", "object", None)]), make([("c", "m1", "object", "b"), ("c", "m3", "object", "b")])
    assert sorted((r["from_key"] or "", r["to_key"] or "", r["mentions"]) for r in rewrite.moves(old, new).where(F.col("from_key").isNotNull() | F.col("to_key").isNotNull()).collect()) == [("", "b", 1), ("a", "b", 1)]
