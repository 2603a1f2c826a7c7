"""Writers: JSON lines, count tables, facts, report tables, case reports, summaries."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import flat, ordered


def write_jsonl(df: DataFrame, path: str, sort_keys: bool = False, compression: str | None = None) -> None:
    """One object a line; fields in column order, or sorted."""
    cols = sorted(df.columns) if sort_keys else df.columns
    df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path, compression=compression)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written beside its place on the same file system, then renamed."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options
    how = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    how[0] = getattr(options, "Rename").OVERWRITE  # replaces the old file in one step, so there is always one of them
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(target), how)


def write_count_table(table: DataFrame, path: str) -> None:
    """Tab-separated part files, in order: lists pipe-joined, most frequent first, a header in each, and one there even without rows. The
    global sort stays distributed; no task sees the whole table."""
    flat(ordered(table)).write.mode("overwrite").options(sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="").csv(path)


def write_facts(facts: DataFrame, path: str, mode: str = "write") -> None:
    """``write`` keeps the facts as Parquet by type; ``discard`` computes nothing."""
    if mode not in ("write", "discard"):
        raise ValueError(f"no such mode: {mode}")
    if mode == "write":
        facts.write.mode("overwrite").partitionBy("fact_type").parquet(path)


def write_report(views: dict[str, DataFrame], captions: DataFrame, index: DataFrame, path: str) -> None:
    """A report's tables as Parquet; the caption index is partitioned by view, so a look-up reads one view's files."""
    for name, view in views.items():
        view.write.mode("overwrite").parquet(f"{path}/views/{name}")
    captions.write.mode("overwrite").parquet(f"{path}/captions")
    index.dropDuplicates(["view_name", "row_id", "caption_id"]).write.mode("overwrite").partitionBy("view_name").parquet(f"{path}/caption_index")


def write_lexicons(lexicons: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Lexicon files and a state file with their sizes."""
    sizes = {}
    for name, rows in lexicons.items():
        rows.write.mode("overwrite").options(sep="\t", header=True, quote="").csv(f"{path}/{name}.tsv")
        sizes[name] = rows.count()
    write_text(next(iter(lexicons.values())).sparkSession, f"{path}/state.json", json.dumps(sizes, sort_keys=True))
    return sizes


def case_report(captions: DataFrame, mentions: DataFrame, edges: DataFrame, limit: int = 50) -> Iterable[str]:
    """Markdown for the first captions: their mentions and edges."""
    some = captions.orderBy("caption_id").limit(limit)
    m = mentions.join(some.select("caption_id"), "caption_id", "left_semi").groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("mention_id", "mention_type", "canonical"))).alias("m"))
    e = edges.join(some.select("caption_id"), "caption_id", "left_semi").groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("edge_id", "source_canonical", "canonical_label", "target_canonical"))).alias("e"))
    for r in some.join(m, "caption_id", "left").join(e, "caption_id", "left").orderBy("caption_id").toLocalIterator():
        yield f"## {r['caption_id']}\n\n{r['caption']}\n"
        yield "\n".join(f"- {x['mention_id']} {x['mention_type']}: {x['canonical']}" for x in r["m"] or ()) + "\n"
        yield "\n".join(f"- {x['edge_id']}: {x['source_canonical']} -{x['canonical_label']}-> {x['target_canonical']}" for x in r["e"] or ()) + "\n"


def write_summary(spark: SparkSession, path: str, summary: dict) -> None:
    write_text(spark, path, json.dumps(summary, indent=2, sort_keys=True))
