"""Tag lists: segments of a caption and their places."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def tag_segments(captions: DataFrame) -> DataFrame:
    """One row for each non-blank part between commas: segment_id counts blank parts too; places are those of the stripped text."""
    parts = captions.select("caption_id", F.posexplode(F.split("caption", ",")).alias("n", "raw_text"))
    before = Window.partitionBy("caption_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("raw_text") + 1).over(before), F.lit(0))
    text = strip("raw_text")
    left = F.length("raw_text") - F.length(F.regexp_replace("raw_text", r"(?U)^[\s\x1c-\x1f]+", ""))
    rows = parts.withColumns({"begin": begin, "text": text, "left": left}).where("text <> ''")
    start = (F.col("begin") + F.col("left")).cast("int")
    return rows.select("caption_id", F.concat(F.lit("t"), F.col("n").cast("string")).alias("segment_id"), F.col("n").alias("segment_ix"), "raw_text", "text", start.alias("char_start"), (start + F.length("text")).alias("char_end"))


def rebase(tokens: DataFrame, segments: DataFrame) -> DataFrame:
    """Tokens annotated segment by segment (caption_id, segment_id, i, head_i, char_start, char_end, …) as tokens of the caption:
    numbers are shifted by the tokens of the segments before, characters by the segment's place."""
    sizes = tokens.groupBy("caption_id", "segment_id").agg((F.max("i") + 1).alias("n_tokens"))
    before = Window.partitionBy("caption_id").orderBy("segment_ix").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.join(sizes, ["caption_id", "segment_id"], "left").withColumn("shift", F.coalesce(F.sum(F.coalesce("n_tokens", F.lit(0))).over(before), F.lit(0)).cast("int"))
    rows = tokens.join(places.select("caption_id", "segment_id", "shift", F.col("char_start").alias("at")), ["caption_id", "segment_id"])
    moved = {"i": F.col("i") + F.col("shift"), "head_i": F.col("head_i") + F.col("shift"), "char_start": F.col("char_start") + F.col("at"), "char_end": F.col("char_end") + F.col("at")}
    return rows.withColumns(moved).drop("shift", "at")
