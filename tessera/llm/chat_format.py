"""Chat formatting by multi-party perspective rotation, in DataFrame operations only.

For every participant of a dialogue the whole dialogue is rendered once with that speaker as ``assistant``, every other
speaker as a named ``user``, and only the assistant's contents (with their end mark) inside the training spans.

A dialogue is rendered in segments of SEGMENT messages, so a row holds a bounded number of them however long a dialogue is; the
segments of a perspective, in order, joined, are the whole dialogue, and start_char and all spans count from its beginning. Messages are
numbered without bringing a dialogue into one task: rows are range-partitioned by their order, numbered inside each partition, and
shifted by the counts of the partitions before. A segment's perspectives are rendered LANE at a time.

Defined cases: a null speaker is the participant ``unknown``; a null text is empty; a null turn number comes first; a null
conv_id is one dialogue of its own; equal turn numbers are ordered by speaker, then by the sha256 of the text, and repeated rows
all stay; ``<|`` in a text or a name is written ``<\\|`` and a line break in a name as a space, so that no content can open or end a
message; ``system`` rows stay system and take no perspective, so a dialogue of those only, and an empty table, give no rows;
other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small, written

#: Messages in a segment, and perspectives that one task renders of a segment.
SEGMENT, LANE = 512, 64
MINE, SYSTEM, OTHER, STOP = "<|im_start|>assistant\n", "<|im_start|>system\n", "<|im_start|>user name=", "<|im_end|>\n"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("<\\|"))


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """conv_id, perspective, segment, start_char, n_messages, n_trained, rendered, mask (a 0 or 1 for each message), train_spans
    (``start-end`` character places in the whole dialogue, joined with ``;``)."""
    name = F.regexp_replace(_safe(F.coalesce(turns[speaker], F.lit("unknown"))), r"[\r\n]+", " ")
    body = F.coalesce(turns[text], F.lit(""))
    rows = turns.select(turns[conv].alias("conv_id"), turns[turn].cast("long").alias("turn"), name.alias("speaker"), _safe(body).alias("text"), F.sha2(body, 256).alias("digest"), F.spark_partition_id().alias("task"))
    order = ("conv_id", "turn", "speaker", "digest", "task")  # the task deals rows that are equal, too
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "digest", "task")
    rows = written(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    spans = rows.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = cut(spans.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift")))
    rows = rows.join(small(spans, spans.count()), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    rows = rows.select("conv_id", (F.col("at") + F.col("shift")).alias("i"), "speaker", "text").withColumn("segment", F.floor(F.col("i") / segment))

    # who speaks, and how long each segment is for each of them
    head = F.when(F.col("speaker") == "system", F.lit(len(SYSTEM))).otherwise(F.length("speaker") + len(OTHER) + 1)
    spoken = cut(rows.groupBy("conv_id", "segment", "speaker").agg(F.count(F.lit(1)).alias("n"), F.sum(head + F.length("text") + len(STOP)).alias("chars")))
    people = spoken.where("speaker <> 'system'").select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    lengths = spoken.groupBy("conv_id", "segment").agg(F.sum("chars").alias("chars"))
    pairs = lengths.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own = spoken.where("speaker <> 'system'").select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), F.col("speaker").alias("who"), (F.col("n") * (len(MINE) - len(OTHER) - 1 - F.length("speaker"))).alias("less"))
    pairs = pairs.join(own, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")) & (F.col("perspective") == F.col("who")), "left")
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("chars") + F.coalesce("less", F.lit(0))).over(earlier), F.lit(0))
    lanes = people.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / LANE).alias("lanes"))
    pairs = pairs.select(F.col("conv_id").alias("cid"), "perspective", F.col("segment").alias("sid"), start.alias("start_char"))
    pairs = pairs.join(lanes, F.col("cid").eqNullSafe(F.col("c"))).select("cid", "perspective", "sid", "start_char", F.pmod(F.xxhash64("perspective"), "lanes").alias("lane"))

    lines = rows.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("i", "speaker", "text"))).alias("lines"))  # SEGMENT at most
    lines = lines.join(lanes, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "segment", "lines", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)).alias("l"))
    each = lines.join(pairs, F.col("conv_id").eqNullSafe(F.col("cid")) & (F.col("segment") == F.col("sid")) & (F.col("l") == F.col("lane")))
    mine = lambda x: x.speaker == F.col("perspective")
    top = lambda x: F.when(mine(x), F.lit(MINE)).when(x.speaker == "system", F.lit(SYSTEM)).otherwise(F.concat(F.lit(OTHER), x.speaker, F.lit("\n")))
    each = each.withColumn("parts", F.transform("lines", lambda x: F.struct(top(x).alias("head"), F.concat(x.text, F.lit(STOP)).alias("body"), mine(x).alias("mine"))))

    def step(acc, x):
        begin = acc.pos + F.length(x.head)
        end = begin + F.length(x.body)
        span = F.concat(begin.cast("string"), F.lit("-"), (end - 1).cast("string"))  # the end mark, not the line break after it
        return F.struct(end.alias("pos"), F.when(x.mine, F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans"))

    first = F.struct(F.col("start_char").alias("pos"), F.array().cast("array<string>").alias("spans"))
    return each.select(
        "conv_id",
        "perspective",
        "segment",
        "start_char",
        F.size("parts").cast("long").alias("n_messages"),
        F.size(F.filter("parts", lambda x: x.mine)).cast("long").alias("n_trained"),
        F.array_join(F.transform("parts", lambda x: F.concat(x.head, x.body)), "").alias("rendered"),
        F.array_join(F.transform("parts", lambda x: F.when(x.mine, "1").otherwise("0")), "").alias("mask"),
        F.array_join(F.aggregate("parts", first, step).spans, ";").alias("train_spans"),
    )
