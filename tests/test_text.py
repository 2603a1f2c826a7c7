import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import status, text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("raw", ["  Two Brown  dogs\n", "", "a\x1cb", "É  É"])
def test_normalize_query(spark, raw):
    assert one(spark, raw, text.normalize_query("v")) == " ".join(raw.lower().split())


def test_separator_forms(spark):
    assert one(spark, "Fire_Truck - red", text.separator_key("v")) == "fire truck red"
    assert one(spark, "Fire Truck", text.separator_variants("v")) == ["fire truck", "fire-truck", "fire_truck"]
    assert one(spark, "Dog", text.separator_variants("v")) == ["dog"]
    assert one(spark, "Fire-Truck", text.surface_variant_keys("v")) == ["fire-truck", "fire truck", "firetruck", "fire_truck"]
    assert [tuple(x) for x in one(spark, "fire truck", text.lookup_queries("v"))] == [("exact", "fire truck"), ("joined", "firetruck")]


def test_surface_key_strips_accents_and_folds(spark):
    assert one(spark, "Café – Crème ’s", text.surface_key("v")) == "cafe-creme's"


def test_stems(spark):
    for label, base in (("dogs", "dog"), ("red berries", "red berry"), ("boxes", "box"), ("walked", "walk"), ("baked", "bake"), ("running", "run"), ("stopped", "stop"), ("two people", "two person"), ("carried", "carry")):
        assert base in one(spark, label, text.stems("v"))
    assert one(spark, "glass", text.stems("v")) == []


def test_inflections(spark):
    assert {"boxes", "boxed", "boxing"} <= set(one(spark, "box", text.inflections("v")))
    assert {"red berries", "red berried"} <= set(one(spark, "red berry", text.inflections("v")))
    assert {"running", "ran"} <= set(one(spark, "run", text.inflections("v")))


@settings(max_examples=15, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs",), max_codepoint=0x2FF), max_size=20))
def test_display_keeps_letters(spark, raw):
    got = one(spark, raw, text.normalize_display("v"))
    assert "".join(got.split()) == "".join(unicodedata.normalize("NFC", raw).split())


def test_statuses(spark):
    rows = spark.createDataFrame([("selected", "", ""), ("raw_fallback", "", ""), ("", "rejected", ""), ("", "", "ambiguous"), (None, None, None)], "a string, b string, c string")
    got = [r["s"] for r in rows.select(status.decision_status(F.col("a"), F.col("b"), F.col("c")).alias("s")).collect()]
    assert got == ["chosen", "needs_manual", "excluded", "needs_manual", ""]
    gates = spark.createDataFrame([("noun.animal",), ("noun.group",), ("verb.motion",), ("",)], "f string").select(status.gate(F.col("f")).alias("g"))
    assert [r["g"] for r in gates.collect()] == ["object_compatible", "conditional", "hard_conflict", ""]
