"""Greedy choice of spans, and transitive closure over token trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _c


#: Rows of a dimension table that may be broadcast.
DIMENSION_ROWS = 300_000


def dimension(df: DataFrame, rows: int = DIMENSION_ROWS) -> DataFrame:
    """A dimension table for a join: broadcast if it is counted to be small, else left to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def greedy_spans(spans: DataFrame, by: Sequence[str], start: str, end: str, order: Sequence[Column | str]) -> DataFrame:
    """Rows of each group taken in the given order, each kept unless it overlaps one kept before.

    A fold over the group's sorted array; groups are the spans of one caption."""
    keys = [_c(o).alias(f"_k{i}") for i, o in enumerate(order)]
    payload = F.struct(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.struct(*(F.col(c) for c in spans.columns if c not in by)).alias("_row"))
    lists = spans.groupBy(*by).agg(F.array_sort(F.collect_list(payload)).alias("_all"))
    empty = F.slice("_all", 1, 0)
    kept = F.aggregate("_all", empty, lambda acc, x: F.when(F.exists(acc, lambda y: (x["_s"] < y["_e"]) & (y["_s"] < x["_e"])), acc).otherwise(F.concat(acc, F.array(x))))
    return lists.select(*by, F.explode(kept).alias("_x")).select(*by, "_x._row.*")


def longest_spans(spans: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Longest first, then earliest."""
    return greedy_spans(spans, by, start, end, [F.col(start) - F.col(end), F.col(start)])


def first_per_key(rows: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(place)).where("_n = 1").drop("_n")


def unique_maximum(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For each key the rows with the highest value, marked ``unique`` where there is just one."""
    w = Window.partitionBy(*keys)
    top = rows.withColumn("_r", F.rank().over(w.orderBy(F.desc(value)))).where("_r = 1").drop("_r")
    return top.withColumn("unique", F.count(F.lit(1)).over(w) == 1)


def closure(roots: DataFrame, steps: DataFrame, by: Sequence[str], cut=lambda df: df.checkpoint()) -> DataFrame:
    """Everything reached from roots(by…, root, node) along steps(by…, node, next).

    Adds via (the node before), depth and path (nodes from the root); rounds end when nothing new is reached, so a chain of
    length n takes n rounds. Trees are assumed: a node has one way to it."""
    level = cut(roots.withColumns({"via": F.lit(None).cast("int"), "depth": F.lit(0), "path": F.array("node")}))
    out = level
    while True:
        level = level.join(steps, [*by, "node"]).select(*by, "root", F.col("next").alias("node"), F.col("node").alias("via"), (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("next")).alias("path"))
        level = cut(level.where(~F.array_contains(F.slice("path", 1, F.size("path") - 1), F.col("node"))))
        if not level.limit(1).count():
            return out
        out = out.unionByName(level)
