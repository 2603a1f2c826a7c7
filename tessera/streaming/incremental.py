"""Count tables over a stream of fact files.

The file source's checkpoint remembers what has been read, so a stopped run goes on where it was. Every micro-batch becomes a partial
count table of its own, written under the batch's number: a batch that is tried again writes over itself. Partial
tables are merged when they are read. Counts are right as long as no caption comes in two batches; ``repeated`` finds those.

A run that is taken up again must be the same run: beside the checkpoint lies a fingerprint of what it counts (the stream's schema, the
count table, the rules' version, and what the caller names, such as the inputs). One that differs is refused before anything is read."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.counts import CountSpec, count_table, merge
from ..sources.sinks import write_text


class OtherRun(ValueError):
    """The checkpoint belongs to a run with another fingerprint."""


def fingerprint(facts: DataFrame, spec: CountSpec, rules: str = "", **more: str) -> dict[str, str]:
    """What a run is told by."""
    return {"schema": hashlib.sha256(facts.schema.json().encode()).hexdigest(), "table": spec.name, "keys": "|".join(spec.keys), "rules": rules, **more}


def same_run(spark: SparkSession, checkpoint: str, mark: dict[str, str]) -> bool:
    """Whether the checkpoint has been used before, by a run with this fingerprint; another one fails."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}.run.json")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        write_text(spark, f"{checkpoint}.run.json", json.dumps(mark, sort_keys=True))
        return False
    stream = fs.open(place)
    try:
        there = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if differ := sorted(k for k in mark.keys() | there.keys() if mark.get(k) != there.get(k)):
        raise OtherRun(f"{checkpoint} belongs to another run; these differ: {differ}")
    return True


def keep_counts(facts: DataFrame, spec: CountSpec, path: str, checkpoint: str, rules: str = "", **more: str) -> StreamingQuery:
    """Starts counting a stream of facts, or takes the same run up again; ends when all there is has been read."""
    same_run(facts.sparkSession, checkpoint, fingerprint(facts, spec, rules, **more))

    def one(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            count_table(batch, spec).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")
            batch.select("caption_id").distinct().write.mode("overwrite").parquet(f"{path}/captions/batch={number}")
        finally:
            batch.unpersist()

    return facts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, spec: CountSpec, path: str) -> DataFrame:
    """The count table of all batches so far."""
    return merge([spark.read.parquet(f"{path}/counts").drop("batch")], spec)


def repeated(spark: SparkSession, path: str) -> DataFrame:
    """Captions that came in more than one batch."""
    return spark.read.parquet(f"{path}/captions").groupBy("caption_id").agg(F.count_distinct("batch").alias("batches")).where("batches > 1")
