"""Look-ups ask for the kinds of parts that lines have, made once: no branch of the look-up reads the lines again."""

from tessera.plans import annotated


def test_lookup_reads_no_lines(spark, sf):
    kinds = annotated._kinds(spark, sf)
    assert kinds.count() == kinds.distinct().count() > 0
    plan = annotated.attribute_lookup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" not in plan and "lineitem" not in plan
