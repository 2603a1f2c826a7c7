from collections import defaultdict

import pytest

from tessera.llm.exact_dedup import exact_dedup


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 200])  # many partitions make every repeated text a hot one
def test_groups(spark, edge, edge_rows, keep, partitions):
    groups = defaultdict(list)
    for r in edge_rows:
        groups[lower(r[1])].append(r[0])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = exact_dedup(edge, keep=keep).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(edge_rows)
    for text, ids in groups.items():
        rows = [r for r in got if lower(r["row"]["text"]) == text]
        best = (min if keep == "min" else max)([i for i in ids if i is not None], default=None)
        assert {r["keep_id"] for r in rows} == {best}
        assert {r["group_size"] for r in rows} == {len(ids)}
        assert [r["row"]["doc_id"] for r in rows if r["kept"]] == [best]
        assert rows[0]["row"]["norm"] == "x"


def test_empty(empty):
    assert exact_dedup(empty).count() == 0


def test_no_python_in_the_plan(docs):
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
