"""Queries that write files into the shared folder and read them back, and summaries over annotated captions, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, canonical, compare, counts, report
from ..operators.extract import extract
from ..operators.facts import all_facts, as_one
from ..sources import archives, lexicons, readers, sinks
from . import adapters, golden
from .queries import TEXT_SQL, _cut, query


def _folder(spark: SparkSession) -> str:
    """A new folder where driver and executors can reach it."""
    _cut(spark.range(1))  # sees to a shared folder
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


@query("json_lines", "SELECT p_partkey, p_name, p_size FROM part")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_jsonl(adapters.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), path, sort_keys=True, compression="gzip")
    return readers.jsonl(spark, path, "p_partkey long, p_name string, p_size int")


@query("caption_files", f"WITH {TEXT_SQL} SELECT key, caption, caption_type FROM src")
def caption_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = adapters.captions(spark, sf_dir).select("key", "caption", "caption_type"), _folder(spark)
    for kind in ("tag", "sentence"):
        sinks.write_jsonl(rows.where((F.col("caption_type") == "tag") == F.lit(kind == "tag")), f"{path}/{kind}")
    return readers.captions(spark, [f"{path}/tag", f"{path}/sentence"]).select("key", "caption", "caption_type")


@query("front_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def front_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 rows are the feature: fewer would fail the job."""
    return readers.front(adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 100, ["o_orderkey"])


@query("count_table_file", f"SELECT count_key, object, count, caption_count, example_caption_ids, rule_ids FROM ({adapters.count_sql(counts.BY_NAME['object_counts'])}) x")
def count_table_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_count_table(counts.count_table(all_facts(*adapters.graph(spark, sf_dir), united=False)["entity_exists"], counts.BY_NAME["object_counts"]), path)
    return readers.count_tsv(spark, path).select("count_key", "object", "count", "caption_count", "example_caption_ids", "rule_ids")


@query("fact_files", f"WITH {adapters.GRAPH_SQL}, {adapters.OBJECTS_SQL} " + " UNION ALL ".join(f"SELECT '{k}' AS fact_type, count(*) AS facts FROM ({q}) x" for k, q in adapters.FACT_SQL.items()))
def fact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_facts(as_one(all_facts(*adapters.graph(spark, sf_dir))), path)
    return spark.read.parquet(path).groupBy("fact_type").agg(F.count(F.lit(1)).alias("facts"))


@query("lexicon_files", "SELECT DISTINCT p_brand AS raw, p_type AS canonical FROM part")
def lexicon_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    words = adapters.table(spark, sf_dir, "part").select(F.col("p_brand").alias("raw"), F.col("p_type").alias("canonical")).distinct()
    sinks.write_lexicons({"words": words}, path)
    return lexicons.read_tsv(spark, f"{path}/words.tsv").select("raw", "canonical")


def _counted(of: str) -> str:
    """SQL of the golden captions with a number for each, over all orders."""
    return ", ".join(f"({i}, '{golden.CASES[n][0]}', {', '.join(map(str, _sizes(n)))})" for i, n in enumerate(golden.CASES)) + f") v(k, caption_shape, {of}"


def _sizes(name: str) -> tuple[int, int, int]:
    shape, text, chunks = golden.CASES[name]
    return len(text.split(" ")), len(chunks), text.count(" ,/,/") + 1 if shape == "tag_list" else 0


@query("annotation_summary", f"WITH w AS (SELECT * FROM (VALUES {_counted('t, n, s')})) SELECT caption_shape, count(*) AS captions, cast(sum(t) AS BIGINT) AS tokens, cast(sum(n) AS BIGINT) AS noun_chunks, cast(sum(s) AS BIGINT) AS segments FROM orders JOIN w ON o_orderkey % {len(golden.CASES)} = k GROUP BY 1")
def annotation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.summary(golden.many(spark, adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))))


@query("phrase_parity", "SELECT stage, (SELECT count(*) FROM orders WHERE o_orderkey % 13 IN (2, 3, 4)) AS mentions FROM (VALUES ('raw'), ('canonical'), ('facts')) v(stage)")
def phrase_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every multi-word attribute of the golden captions is found again in each stage."""
    buckets = adapters.buckets_of(spark, sf_dir)
    rows = golden.many(spark, adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n")), buckets)
    mentions, edges = extract(rows, golden.lexicons(spark), lambda df: df)  # attributes are facts of mentions: edges are not made
    mentions = adapters.kept(buckets)(mentions)
    none = spark.createDataFrame([], "raw string, canonical string")
    m = canonical.canonicalize_mentions(mentions, none, none)
    with adapters.together(spark):  # three numbers, made here
        return _cut(compare.phrase_parity(mentions, m, all_facts(m, canonical.canonicalize_edges(edges, m))["attribute_exists"]))


@query("shared_aliases", "SELECT o_orderkey, array_to_string(list_sort(list_filter([o_orderstatus, o_orderpriority], lambda x: x IN ('F', '1-URGENT'))), '|') AS shared FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'")
def shared_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = adapters.table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("names"))
    return counts.flat(compare.overlapping(o, "names", ["F", "1-URGENT"]).select("o_orderkey", "shared"))


@query("captions_in_order", "SELECT cast(o_orderkey AS VARCHAR) AS caption_id, o_orderpriority AS caption FROM orders WHERE o_orderkey IN (7, 1, 5)")
def captions_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("caption_id"), F.col("o_orderpriority").alias("caption"))
    return report.captions_in_order(texts, ["7", "1", "5"])


@query(
    "archive_members",
    "SELECT kind, doc_id, sha256(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes FROM documents, (VALUES ('tar'), ('zip')) k(kind)",
)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through sharded tars and zips, a member each, read back in splits of a megabyte."""
    docs = adapters.table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"))
    path, found = _folder(spark), []
    for kind in ("tar", "zip"):
        archives.write(docs, f"{path}/{kind}", kind)
        rows = archives.members(spark, f"{path}/{kind}", "[.]txt$", split=1 << 20)
        found.append(rows.where("part = 0").select(F.lit(kind).alias("kind"), F.regexp_extract("member", "([0-9]+)[.]txt$", 1).cast("long").alias("doc_id"), F.sha2("content", 256).alias("digest"), F.col("size").alias("bytes")))
    return found[0].unionByName(found[1])


@query(
    "caption_shards",
    f"WITH {TEXT_SQL}, s AS (SELECT key, caption, caption_type, cast(key AS BIGINT) // 400 AS shard FROM src) SELECT key, caption, caption_type, 'part-' || lpad(cast(shard AS VARCHAR), 6, '0') || '.tar' AS shard, key || '.json' AS shard_member, row_number() OVER (PARTITION BY shard ORDER BY cast(key AS BIGINT)) - 1 AS record_index FROM s",
)
def caption_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captions as JSON members of tars of 400 captions each, among members of another kind, read back with their place in the shard."""
    rows, path = adapters.captions(spark, sf_dir).select("key", "caption", "caption_type"), _folder(spark)
    both = rows.select(F.concat("key", F.lit(".json")).alias("member"), F.to_json(F.struct("key", "caption", "caption_type"), {"ignoreNullFields": "false"}).alias("content"), F.col("key").cast("long").alias("n"), F.lit(0).alias("o"))
    both = both.unionByName(rows.select(F.concat("key", F.lit(".jpg")).alias("member"), F.repeat("key", F.lit(50)).alias("content"), F.col("key").cast("long").alias("n"), F.lit(1).alias("o")))
    last = rows.agg(F.coalesce(F.max(F.col("key").cast("long")), F.lit(0))).first()[0]
    dealt = both.repartitionById(last // 400 + 1, F.floor(F.col("n") / 400).cast("int")).sortWithinPartitions("n", "o")
    archives.write(dealt, path)
    return archives.caption_shards(spark, path, split=200_000).drop("split_dir")
