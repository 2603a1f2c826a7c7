"""The caption index lies as its facts lie; caption entries take little disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import report, stage5
from tessera.plans import adapters
from tessera.plans.queries import _pair_view


def test_the_index_exchanges_no_facts(spark, sf):
    facts, view = _pair_view(spark, sf)
    index = report.caption_index(facts, {"attribute_object_pairs": view})
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "caption_id" in x]
    assert index.count() == index.distinct().count() > 0


def test_a_row_of_two_kinds_is_indexed_once(spark):
    facts = spark.createDataFrame([("c", "few", "attribute"), ("c", "few", "quantity"), ("d", "few", "quantity")], "caption_id string, attribute string, attribute_kind string")
    view = spark.createDataFrame([(1, "few", "attribute|quantity")], "_row_id long, canonical_attribute string, attribute_kind string")
    index = report.caption_index({"attribute_exists": facts}, {"attributes": view})
    assert sorted(map(tuple, index.collect())) == [("attributes", 1, "c"), ("attributes", 1, "d")]


def test_written_rows_are_the_same(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("caption_id"), F.array(F.lit("a"), F.lit(None).cast("string")).alias("k"))
    again = adapters.written(rows)
    assert again.dtypes == rows.dtypes and not again.exceptAll(rows).count() and again.count() == 1000
    assert "Range" not in again._jdf.queryExecution().executedPlan().toString()
