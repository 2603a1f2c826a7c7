"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks. Of sources with the weights w of W in all, block k is released at slot floor(k W / w)
and due by ceil((k + 1) W / w); earliest deadline first among released blocks fills the slots, so that at any slot no source
is a whole block away from its share. Weights are taken as they are: every float is a fraction, and all windows are whole-number
arithmetic on those fractions, so the bound holds against the given weights however long the table and however small a
weight. When a source runs out, a new phase goes on with the others. Every row is placed exactly once.

The driver holds a number for each block and each source, no rows. Blocks have BLOCK_ROWS rows, or as many more as keep their number
within BLOCKS, which bounds the slots that are sent to the executors (12 bytes for a block).

Rows are numbered inside their source without bringing a source into one task: they are range-partitioned by (source,
hash, id, task), numbered inside each partition, and shifted by the counts of the partitions before.

Defined cases: a null source is a source of its own; a null id sorts first; repeated ids are numbered one after the other;
sources without a weight get DEFAULT; a weight that is not positive and finite is an error; an empty table gives no rows; other
columns are ignored, or carried inside ``row``."""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written

BLOCK_ROWS = 16
#: Blocks at most, besides one for each source; larger tables have larger blocks.
BLOCKS = 1 << 20
#: Weight of a source that the weights do not name.
DEFAULT = 1.0


def whole(weights: list[float]) -> list[int]:
    """Weights as whole numbers in exactly the same proportion."""
    for w in weights:
        if not (math.isfinite(w) and w > 0):
            raise ValueError(f"a weight must be positive and finite: {w}")
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(x.denominator for x in exact)) if exact else 1
    return [int(x * scale) for x in exact]


def schedule(blocks: list[int], weights: list[float]) -> tuple[list[list[int]], list[int]]:
    """The slots of each source's blocks, in order, and the first slot of each phase."""
    units, slots, starts, base = whole(weights), [[] for _ in blocks], [], 0
    left = {i: n for i, n in enumerate(blocks) if n}
    while left:
        total = sum(units[i] for i in left)
        starts.append(base)
        done = dict.fromkeys(left, 0)
        waiting: list[tuple[int, int]] = []  # (release, source)
        ready = [(-(-total // units[i]), i) for i in left]  # (deadline, source)
        heapq.heapify(ready)
        slot, over = 0, None
        while over is None:
            while waiting and waiting[0][0] <= slot:
                _, i = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(done[i] + 1) * total // units[i]), i))
            _, i = heapq.heappop(ready)
            slots[i].append(base + slot)
            done[i] += 1
            slot += 1
            if done[i] == left[i]:
                over = i
            else:
                heapq.heappush(waiting, (done[i] * total // units[i], i))
        left = {i: n - done[i] for i, n in left.items() if n > done[i]}
        base += slot
    return slots, starts


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source", carry: bool = False) -> DataFrame:
    """doc_id, source, phase, block, slot, position for every row, and the whole row as ``row`` if ``carry``; ordered by position,
    the rows are mixed. weights: any positive numbers; None: the square root of each source's rows."""
    spark = docs.sparkSession
    whole_row = [F.struct("*").alias("row")] if carry else []
    rows = docs.select(*whole_row, docs[id_col].alias("doc_id"), docs[source_col].alias("source"), F.xxhash64(docs[id_col]).alias("h"), F.spark_partition_id().alias("task"))
    order = ("source", "h", "doc_id", "task")  # the task deals rows with equal ids, too
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "task")
    rows = written(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    spans = rows.groupBy("source", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = written(spans.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")))
    found = spans.groupBy("source").agg(F.sum("n").alias("n")).collect()  # a row for each source
    found.sort(key=lambda r: (r["source"] is not None, r["source"]))
    names, counts = [r["source"] for r in found], [r["n"] for r in found]
    size = max(block_rows, -(-sum(counts) // BLOCKS))
    given = [n**0.5 for n in counts] if weights is None else [float(weights.get(k, DEFAULT)) for k in names]
    slots, starts = schedule([-(-n // size) for n in counts], given)
    phases, number = [], 0
    for turn in slots:
        number, own = 0, []
        for s in turn:
            while number + 1 < len(starts) and starts[number + 1] <= s:
                number += 1
            own.append(number)
        phases.append(own)
    kind = docs.schema[source_col].dataType.simpleString()
    plan = pa.table({"s": pa.array(names, pa.string()), "slots": pa.array(slots, pa.list_(pa.int64())), "phases": pa.array(phases, pa.list_(pa.int32()))})
    plan = spark.createDataFrame(plan, "s string, slots array<long>, phases array<int>").withColumn("s", F.col("s").cast(kind))
    spans = spans.select(F.col("source").alias("src"), F.col("part").alias("pt"), "shift")
    numbered = rows.join(small(spans, spans.count()), F.col("source").eqNullSafe(F.col("src")) & (F.col("part") == F.col("pt")))
    numbered = numbered.withColumn("number", F.col("at") + F.col("shift")).withColumn("block", F.floor(F.col("number") / size))
    placed = numbered.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("s")))  # BLOCKS slots and the sources' names
    place = F.col("block").cast("int")
    placed = placed.withColumns({"slot": F.get("slots", place), "phase": F.get("phases", place)})
    columns = ["doc_id", "source", "phase", "block", "slot", (F.col("slot") * size + F.col("number") % size).alias("position")]
    return placed.select(*(["row"] if carry else []), *columns)
