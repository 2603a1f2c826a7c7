"""Caption shapes: routing of source rows to sentences and tag lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SHAPES

# Caption types of each shape.
SENTENCE_TYPES = ("short", "medium", "long")
TAG_TYPES = ("tag",)
VERSION = "v1"


def route(rows: DataFrame) -> DataFrame:
    """Caption records from source rows (key, caption, caption_type, …); an unknown type fails the job, it is never guessed."""
    kind = F.col("caption_type")
    shape = F.when(kind.isin(*SENTENCE_TYPES), "sentence").when(kind.isin(*TAG_TYPES), "tag_list")
    shape = shape.otherwise(F.raise_error(F.concat(F.lit("no such caption_type: "), F.coalesce(kind, F.lit("null")))))
    meta = F.to_json(F.struct(*sorted(c for c in rows.columns if c not in ("caption", "key"))))
    return rows.select(
        F.col("key").alias("caption_id"),
        "caption",
        shape.alias("caption_shape"),
        F.lit(False).alias("skipped"),
        F.lit(None).cast("string").alias("skip_reason"),
        F.lit(VERSION).alias("pipeline_version"),
        F.when(shape == "tag_list", F.array(F.lit("R1"), F.lit("R1.1"))).otherwise(F.array(F.lit("R1"))).alias("rule_ids"),
        meta.alias("meta"),
        "caption_type",
    )


def checked_shape(rows: DataFrame) -> DataFrame:
    """Rows whose explicit shape is a known one; any other fails the job."""
    ok = F.col("caption_shape").isin(*SHAPES)
    return rows.withColumn("caption_shape", F.when(ok, F.col("caption_shape")).otherwise(F.raise_error(F.lit("no such caption_shape"))))


def split(captions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sentences and tag lists."""
    return captions.where("caption_shape = 'sentence'"), captions.where("caption_shape = 'tag_list'")


def sentences_only(captions: DataFrame) -> DataFrame:
    """The same rows; a tag list fails the job."""
    fine = F.col("caption_shape") == "sentence"
    return captions.withColumn("caption_shape", F.when(fine, F.col("caption_shape")).otherwise(F.raise_error(F.lit("tag lists have a path of their own"))))


def interleave(order: DataFrame, sentences: DataFrame, tags: DataFrame) -> DataFrame:
    """Sentence and tag rows brought back into the order of ``order`` (caption_id, caption_index); a caption that is lost, foreign or
    there twice fails the job."""
    both = sentences.unionByName(tags, allowMissingColumns=True)
    n = both.groupBy("caption_id").agg(F.count(F.lit(1)).alias("_n"))
    place = order.select("caption_id", "caption_index").join(n, "caption_id", "full")
    fine = (F.col("_n") == 1) & F.col("caption_index").isNotNull()
    place = place.select("caption_id", F.when(F.coalesce(fine, F.lit(False)), F.col("caption_index")).otherwise(F.raise_error(F.concat(F.lit("not exactly once: "), F.col("caption_id")))).alias("caption_index"))
    return place.join(both, "caption_id", "left").orderBy("caption_index")


def shard_sizes(n: int, shards: int) -> list[int]:
    """Sizes of contiguous shards of n rows, the first ones larger by one where n does not divide."""
    return [n // shards + (i < n % shards) for i in range(shards)]


def summary(captions: DataFrame) -> DataFrame:
    return captions.groupBy("caption_shape", "caption_type", F.coalesce("skip_reason", F.lit("")).alias("skip_reason")).agg(F.count(F.lit(1)).alias("captions"))
