"""Exact dedup by content sort, in DataFrame operations only.

Sampled splitters range-partition the rows on the first characters of the normalised text and a content hash; each
partition is sorted by the whole normalised text (Spark's external sort), so equals are adjacent, and the window
operator compares neighbouring keys in full. Texts so frequent that one of them would fill a partition are counted
first; they are aggregated map-side instead of being sorted together, and only rows that share their text and the winning id meet in one task,
where a window streams over them.

Defined cases: a null text counts as empty; a null id ranks behind all others; of rows with the same text and the same
winning id exactly one is kept; an empty table gives an empty result; other columns are carried, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_az

#: Leading characters of the normalised text in the range key.
PREFIX = 48
#: A text with more than 1/(HOT * partitions) of all rows is hot, so there are at most HOT * partitions hot texts.
HOT = 2


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with keep_id, group_size, kept, text_sha256 (of the normalised text).

    keep: "min" or "max", which identifier of equal texts stays."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("id").desc_nulls_last() if keep == "max" else F.col("id").asc_nulls_last()
    rows = docs.select(F.struct("*").alias("row"), docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("raw"))
    rows = rows.withColumn("h", F.xxhash64(lower_az(F.col("raw"))))
    total = docs.count()
    hot = rows.groupBy("h").count().where(F.col("count") > max(1, total // (HOT * parts))).select("h").collect()  # HOT * parts at most
    usual = rows
    if hot:
        keys = F.broadcast(spark.createDataFrame(hot, "h long"))
        usual = rows.join(keys, "h", "left_anti")
    usual = usual.withColumn("front", lower_az(F.substring("raw", 1, PREFIX))).repartitionByRange("front", "h")
    usual = usual.withColumn("norm", lower_az(F.col("raw"))).drop("raw")
    same = Window.partitionBy("front", "h", "norm").orderBy(order)
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = usual.select(
        "row",
        F.first("id").over(every).alias("keep_id"),
        F.count(F.lit(1)).over(every).alias("group_size"),
        (F.row_number().over(same) == 1).alias("kept"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    if not hot:
        return found
    often = rows.join(keys, "h", "left_semi").withColumn("norm", lower_az(F.col("raw")))
    best = F.max("id") if keep == "max" else F.min("id")
    groups = often.groupBy("norm").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    marked = often.select("row", "id", F.sha2("norm", 256).alias("text_sha256")).join(F.broadcast(groups), "text_sha256")  # a row for each hot text: HOT * parts, and those whose hashes collide with one
    first = Window.partitionBy("text_sha256").orderBy("id")
    top = marked.where(F.col("id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.row_number().over(first) == 1)
    rest = marked.where(~F.col("id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.lit(False))
    columns = ("row", "keep_id", "group_size", "kept", "text_sha256")
    return found.unionByName(top.select(*columns)).unionByName(rest.select(*columns))
