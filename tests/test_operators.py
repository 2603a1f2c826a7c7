import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import annotate, compare, counts, fold, inventory, report, segments, shape, tokens
from tessera.operators.facts import all_facts, object_pairs, object_pairs_by_join, with_rules
from tessera.plans import adapters
from tessera.streaming import incremental


def test_unknown_shape_fails(spark):
    with pytest.raises(Exception, match="no such caption_type"):
        shape.route(spark.createDataFrame([("1", "a, b", "list")], "key string, caption string, caption_type string")).collect()


def test_quotes_and_hyphens(spark):
    rows = spark.createDataFrame([("1", 'a "no entry" sign, “well-known” black-and-white x-y 3-4 "'), ("2", None)], "caption_id string, caption string")
    toks = tokens.tokenize(rows)
    spans = tokens.protected_spans(toks)
    assert sorted((r["kind"], r["text"]) for r in spans.collect()) == [("hyphen_word", "black-and-white"), ("quote", '"no entry"'), ("quote", "“well-known”")]
    merged = tokens.merged_tokens(toks, spans)
    assert [r["text"] for r in merged.where("caption_id = '1'").orderBy("i").collect()] == ["a", '"no entry"', "sign", ",", "“well-known”", "black-and-white", "x", "-", "y", "3", "-", "4", '"']
    assert tokens.attach(spans, merged).where("final_start is null").count() == 0


def test_tag_segments(spark):
    rows = spark.createDataFrame([("1", " dog,, two cats ,")], "caption_id string, caption string")
    assert [(r["segment_id"], r["text"], r["char_start"], r["char_end"]) for r in segments.tag_segments(rows).orderBy("segment_ix").collect()] == [("t0", "dog", 1, 4), ("t2", "two cats", 7, 15)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 6)), min_size=1, max_size=12))
def test_greedy_equals_loop(spark, spans):
    rows = [("c", i, s, s + n) for i, (s, n) in enumerate(spans)]
    got = {r["i"] for r in fold.longest_spans(spark.createDataFrame(rows, "k string, i int, s int, e int"), ["k"], "s", "e").collect()}
    taken, want = [], []
    for _, i, s, e in sorted(rows, key=lambda r: (r[2] - r[3], r[2], r[1])):
        if all(e <= a or s >= z for a, z in taken):
            taken.append((s, e))
            want.append(i)
    assert sorted((rows[i][2], rows[i][3]) for i in got) == sorted((rows[i][2], rows[i][3]) for i in want)


def test_pairs_two_ways(spark, sf):
    mentions, _ = adapters.graph(spark, sf)
    a = object_pairs(with_rules(mentions)).select("caption_id", "source_object", "target_object")
    assert compare.table_differences(a, object_pairs_by_join(mentions)).count() == 0


def test_merge_rejects_different_values(spark):
    spec = counts.BY_NAME["object_counts"]
    schema = "count_key string, object string, parent_concepts array<string>, parent_synset_ids array<string>, count long, caption_count long, example_caption_ids array<string>, raw_variants array<string>, rule_ids array<string>"
    row = lambda o: spark.createDataFrame([("object:a", o, [], [], 1, 1, ["c"], ["a|b"], [])], schema)
    assert counts.merge([row("a"), row("a")], spec).first()["raw_variants"] == ["a|b"]
    with pytest.raises(Exception, match="different values"):
        counts.merge([row("a"), row("A")], spec).collect()


def test_dropped_counts_are_seen(spark, sf):
    facts = {k: v for k, v in all_facts(*adapters.graph(spark, sf)).items() if k == "entity_exists"}
    table = counts.count_table(facts["entity_exists"], counts.BY_NAME["object_counts"])
    assert not counts.integrity(facts, {"object_counts": table.limit(3)}).first()["agree"]


def test_unknown_end_fails(spark, sf):
    mentions, edges = adapters.graph(spark, sf)
    with pytest.raises(Exception, match="no such mention"):
        all_facts(mentions.where("mention_type <> 'attribute'"), edges)["has_attribute"].collect()


def test_overlay_wants_equal_keys(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x")], "k string, v string")
    assert {tuple(r) for r in inventory.overlay(rows, rows.withColumn("v", F.lit("y")), "k", ["v"]).collect()} == {("a", "y"), ("b", "y")}
    with pytest.raises(ValueError, match="keys differ"):
        inventory.overlay(rows, rows.limit(1), "k", ["v"])


def test_lookup_cascade_and_canonical(spark):
    keys = spark.createDataFrame([("fire truck",), ("dogs",), ("unknown",)], "span_key string")
    lemmas = spark.createDataFrame([("firetruck", "n", "s1"), ("dog", "n", "s2"), ("dog", "n", "s3")], "form string, pos string, synset string")
    morphy = spark.createDataFrame([("dogs", "n", "dog")], "form string, pos string, lemma string")
    hits = inventory.synset_hits(keys, lemmas, morphy, "n")
    assert {(r["span_key"], r["lookup_case"], tuple(r["synsets"])) for r in hits.collect()} == {("fire truck", "joined", ("s1",)), ("dogs", "morphy", ("s2", "s3"))}
    uses = spark.createDataFrame([("s2", "dog", 5), ("s3", "dog", 2)], "synset string, lemma string, n int")
    chosen = inventory.sense_choice(hits, uses)
    assert {(r["span_key"], r["selected_oewn_synset"], r["synset_selection_tag"]) for r in chosen.collect()} == {("fire truck", "s1", "single_synset"), ("dogs", "s2", "max_sense_count")}
    lexfiles = spark.createDataFrame([("s1", "noun.artifact"), ("s2", "noun.animal")], "synset string, lexfile string")
    done = inventory.decided(chosen.join(hits.select("span_key", "lookup_case"), "span_key"), lexfiles)
    assert {(r["span_key"], r["decision_status"]) for r in done.collect()} == {("fire truck", "needs_manual"), ("dogs", "chosen")}
    words = spark.createDataFrame([("s2", "dog"), ("s2", "domestic_dog")], "synset string, lemma string")
    ngrams = spark.createDataFrame([("s2", "dog", 0.5)], "selected_oewn_synset string, surface_key string, mean_frequency double")
    named = inventory.canonical_surface(chosen.where("span_key = 'dogs'"), words, uses, ngrams).first()
    assert (named["canonical_surface"], named["canonical_selection_tag"]) == ("dog", "max_sense_count")


def test_labels(spark):
    got = compare.matched_labels(spark.createDataFrame([("Boxes",), ("traffic light",), ("nothing",)], "label string"), spark.createDataFrame([("box",), ("traffic-light",)], "term string"))
    assert {(r["label"], r["match"]) for r in got.collect()} >= {("traffic light", "traffic-light"), ("nothing", None)}


def test_incremental_counts(spark, sf, tmp_path):
    facts = all_facts(*adapters.graph(spark, sf))["action_event"]
    spec = counts.BY_NAME["action_counts"]
    half = F.pmod(F.col("caption_id").cast("long"), F.lit(2))
    for i in (0, 1):
        facts.where(half == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(facts.schema).parquet(f"{tmp_path}/in")
        incremental.keep_counts(stream, spec, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert incremental.repeated(spark, f"{tmp_path}/out").count() == 0
    a, b = counts.flat(incremental.merged(spark, spec, f"{tmp_path}/out")), counts.flat(counts.count_table(facts, spec))
    assert compare.table_differences(a, b.select(*a.columns)).count() == 0


class _Words:
    def annotate(self, texts):
        return [{"tokens": [{"i": i, "text": w, "lemma": w.lower(), "pos": "NOUN", "tag": "NN", "morph": "", "dep": "dep", "head_i": i, "head_text": w, "char_start": 0, "char_end": len(w), "whitespace": " "} for i, w in enumerate(t.split())]} for t in texts]


def test_annotator(spark):
    rows = spark.createDataFrame([("1", "a dog", "sentence"), ("2", "cats", "sentence")], "caption_id string, caption string, caption_shape string")
    got = annotate.annotate(rows, lambda: _words())
    assert annotate.summary(got).first()["tokens"] == 3
    assert annotate.component_list([" ner", "ner ", "", "lemmatizer"]) == ["ner", "lemmatizer"]


def _words():
    return _Words()


def test_view_merge_and_search(spark):
    v = spark.createDataFrame([("dog", "dog|hound", "animal", 2, 1, "c1"), ("cat", "cat", "", 1, 1, "c2")], "canonical_object string, object_raw_surfaces string, object_parent_concepts string, count long, caption_count long, example_caption_ids string")
    both = report.merge_rows(v, v.where("canonical_object = 'dog'").withColumn("object_raw_surfaces", F.lit("puppy")), "objects")
    assert both.where("canonical_object = 'dog'").first()["object_raw_surfaces"] == "dog|hound|puppy"
    assert [r["canonical_object"] for r in report.rows(v.withColumn("_row_id", F.lit(1)), q="HOU").collect()] == ["dog"]
