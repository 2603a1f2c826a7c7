"""Steps leave no shuffle files behind, and lines are numbered alike however little of them is exchanged."""

from __future__ import annotations

import datetime
import random

import __spark_entry__ as entry
from tessera.plans import adapters


def test_shuffle_files_are_cleared_while_a_query_is_made(spark, monkeypatch):
    seen = []
    monkeypatch.setitem(entry._graph.QUERIES, "probe", lambda s, _: seen.append(s.conf.get(adapters.CLEANUP, "false")))
    before = spark.conf.get(adapters.CLEANUP, "false")
    entry.queries()["probe"](spark, "")
    assert seen == ["true"] and spark.conf.get(adapters.CLEANUP, "false") == before


def _tables(spark, folder, repeats):
    r, day = random.Random(3), datetime.datetime(2020, 1, 1)
    rows = [(o, r.randrange(3), r.randrange(2), r.randrange(2), float(r.randrange(1, 3)), r.choice([None, 1.5, 2.5]), r.choice([0.0, 0.1]), 0.0, r.choice("ANR"), r.choice("FO"), day + datetime.timedelta(r.randrange(3))) for o in range(40) for _ in range(repeats)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rows = [(o, p, s, k, *rest) for o, p, s, k, *rest in rows]
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"name {i}", f"Brand#{i}", "SMALL", i) for i in range(3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    low = lambda x: (x is not None, x or 0)  # noqa: E731 - nulls first, as in Spark
    want = []
    for o in range(40):
        mine = sorted((x for x in rows if x[0] == o), key=lambda x: (x[3], x[1], x[2], x[4], low(x[5]), x[6], x[7], x[10]))
        want += [(str(o), n, x[1], str(int(x[4])), x[5], x[10], x[8], x[9]) for n, x in enumerate(mine, 1)]
    return want


def test_lines_of_one_number_and_part_are_in_order(spark, tmp_path, monkeypatch):
    want = _tables(spark, tmp_path, 12)
    full = {}  # lines equal in all that orders them may stand in any order
    for caption, n, part, quantity, price, day, flag, status in want:
        full.setdefault(caption, []).append((n, f"Brand#{part}", quantity))
    for limit in (300_000, 5):  # ties carried by tied lines alone, by all lines
        monkeypatch.setattr(adapters, "DIMENSION_ROWS", limit)
        got = {}
        for x in adapters.lines(spark, str(tmp_path)).collect():
            got.setdefault(x.caption_id, []).append((x.n, x.p_brand, x.quantity))
        assert {k: sorted(v) for k, v in got.items()} == full


def test_lines_carry_what_breaks_ties_only_where_there_are_ties(spark, tmp_path):
    """The exchange by caption has one nullable column for it; before, all lines carried six."""
    _tables(spark, tmp_path, 2)
    seen = []
    real = adapters.bucketed
    try:
        adapters.bucketed = lambda rows, *a: seen.append(rows) or real(rows, *a)
        adapters.lines(spark, str(tmp_path))
    finally:
        adapters.bucketed = real
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    by_caption = next(x for x in plan.splitlines() if "RepartitionByExpression [caption_id" in x)
    assert "_tie" in plan and "_tied" in plan and by_caption


def test_golden_graphs_are_cut_into_tables_by_caption(spark, sf, monkeypatch):
    from tessera.plans import queries

    made = []
    monkeypatch.setattr(queries, "extract", lambda rows, lex, cut: made.append(cut(rows.select("caption_id"))) or (rows, rows))
    queries._golden(spark, sf)
    assert "tessera_" in made[0]._jdf.queryExecution().executedPlan().toString()  # a table of ours; before, an uncompressed checkpoint
