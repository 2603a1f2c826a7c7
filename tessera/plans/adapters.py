"""The star-schema and text tables as captions, so that every operator can run on them.

Graph adapter: an order is a caption. Each of its lines mentions an object (the part's brand; raw text: the part's name; parents:
its type and size class, an id only for the first), an attribute (return flag) and a quantity; the order mentions an action (its
priority), with agents (lines of status F) and patients (status O). Neighbouring lines are related by a preposition that depends on
the order's status. Orders with two F lines and an O line hold an ambiguous relation between all of them.

Text adapter: documents are captions, their type given by id and length."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.fold import DIMENSION_ROWS
from ..schema import EDGE, MENTION

#: Lines of orders in a bucket, about.
BUCKET_ROWS = 250_000
#: Spark's setting that removes the shuffle files of a job as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting that exchanges both sides of a join by caption and token although they are dealt out by caption.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed(df: DataFrame, schema: str) -> DataFrame:
    """Columns of the schema in its order; those that are not there are null."""
    fields = [x.strip().split(" ", 1) for x in schema.split(", ")]
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in fields))


def shared(spark: SparkSession) -> str:
    """The folder for checkpoints and tables of our own; where the session has none, one is made."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoint-"))  # one machine: a local folder is shared
    return context.getCheckpointDir()


def _removed(spark: SparkSession, name: str, path: str) -> None:
    """Drops a table of ours with its files, if the session is still there."""
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - the session has ended; whoever owns the shared folder clears it
        return


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go when it has run, not when the driver happens to collect its garbage. For steps that end in
    a table, a checkpoint or a number; the session's own setting holds again afterwards."""
    with _held(spark, CLEANUP, "true"):
        yield


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is planned in here."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def together(spark: SparkSession) -> Iterator[None]:
    """Joins by caption and more, of what is made in here, take tables in buckets by caption as they lie."""
    with _held(spark, ALL_KEYS, "false"):
        yield


def bucketed(rows: DataFrame, buckets: int, *order: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, in buckets by caption: joins, windows and aggregates by caption read it without an
    exchange, and only the columns that they need. Rows that are dealt so already are not exchanged to be written, and joins by caption and
    token inside the rows' plan take what lies together by caption as it lies."""
    spark, name = rows.sparkSession, f"tessera_{uuid.uuid4().hex}"
    path = f"{shared(spark)}/{name}"
    with _held(spark, ALL_KEYS, "false"):
        rows.repartition(buckets, "caption_id").write.bucketBy(buckets, "caption_id").sortBy("caption_id", *order).option("compression", "zstd").option("path", path).saveAsTable(name)
    atexit.register(_removed, spark, name, path)
    return spark.table(name)


def written(rows: DataFrame, name: str = "") -> DataFrame:
    """The rows as compressed Parquet in the shared folder: a cut in the lineage that takes a fraction of a checkpoint's disk. Their order is
    not kept."""
    spark, name = rows.sparkSession, name or f"tessera_{uuid.uuid4().hex}"
    path = f"{shared(spark)}/{name}"
    rows.write.option("compression", "zstd").parquet(path)
    atexit.register(_removed, spark, name, path)
    return spark.read.schema(rows.schema).parquet(path)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with their part, numbered 1, 2, … inside the order, in buckets by caption.

    Parts come first (broadcast if they are counted to be few; else lines that have met them are written, so that the exchange by part is gone
    before the next), then the lines of an order are brought together, once: an exchange of lines each. Columns that only order lines of the same number and part are carried by those lines alone; where such lines are many, by all."""
    line, buckets = table(spark, sf_dir, "lineitem"), buckets_of(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", "p_size")
    same = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")  # equal for equal lines; if others share it they carry more, no harm
    several = line.groupBy(same.alias("_same")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_same", F.lit(True).alias("_tied"))
    tie = F.struct("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    shared(spark)
    several = several.limit(DIMENSION_ROWS + 1).checkpoint()
    if several.count() <= DIMENSION_ROWS:
        line = line.withColumn("_same", same).join(F.broadcast(several), "_same", "left")
        tie = F.when(F.col("_tied"), tie)
    caption = F.col("l_orderkey").cast("string").alias("caption_id")
    rows = line.select(caption, "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").cast("int").alias("quantity"), "l_linestatus", tie.alias("_tie"))
    few, met = part.limit(DIMENSION_ROWS + 1).count() <= DIMENSION_ROWS, f"tessera_{uuid.uuid4().hex}"
    rows = rows.join(F.broadcast(part) if few else part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    if not few:
        rows = written(rows, met)
    order = Window.partitionBy("caption_id").orderBy("l_linenumber", "l_partkey", "_tie")
    rows = rows.repartition(buckets, "caption_id").withColumn("n", F.row_number().over(order))
    rows = rows.select("caption_id", "n", "l_returnflag", F.col("quantity").cast("string").alias("quantity"), "l_linestatus", "p_brand", "p_name", "p_type", "p_size")
    out = bucketed(rows, buckets, "n")
    if not few:
        _removed(spark, met, f"{shared(spark)}/{met}")
    return out


def kept(buckets: int):
    """For operators that cut their lineage: rows with captions become a table in buckets by caption, others a checkpoint."""

    def cut(df: DataFrame) -> DataFrame:
        shared(df.sparkSession)
        return bucketed(df, buckets) if "caption_id" in df.columns else df.checkpoint()

    return cut


def buckets_of(spark: SparkSession, sf_dir: str) -> int:
    """Buckets that lines and orders are dealt into."""
    return max(8, -(-table(spark, sf_dir, "lineitem").count() // BUCKET_ROWS))


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Canonical mentions and edges."""
    line = lines(spark, sf_dir)
    buckets = buckets_of(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("caption_id"), "o_orderpriority", "o_orderstatus")
    orders = bucketed(orders, buckets)
    mid = lambda k, n="n": F.concat(F.lit("m"), (F.col(n) * 3 + k).cast("string"))
    none = F.array().cast("array<string>")

    def mention(df, kind, id_, text, canonical, rule, parents=none, synsets=none):
        parent = F.when(F.size(parents) > 0, "R23")
        return _typed(df.select("caption_id", id_.alias("mention_id"), F.lit(kind).alias("mention_type"), text.alias("raw_text"), F.lower(text).alias("raw_lemma"), canonical.alias("canonical"), parents.alias("parent_concepts"), synsets.alias("parent_synset_ids"), F.lit(rule).alias("canonical_rule_id"), parent.alias("parent_rule_id"), F.lit("high").alias("confidence")), MENTION)

    parents = F.array("p_type", F.concat(F.lit("size_"), F.floor(F.col("p_size") / 10).cast("string")))
    mentions = reduce(
        DataFrame.unionByName,
        [
            mention(line, "object", mid(-3), F.col("p_name"), F.col("p_brand"), "R19", parents, F.array(F.concat(F.lit("s-"), "p_type"))),
            mention(line, "attribute", mid(-2), F.col("l_returnflag"), F.lower("l_returnflag"), "R20"),
            mention(line, "quantity", mid(-1), F.col("quantity"), F.col("quantity"), "R21"),
            mention(orders, "action", F.lit("a0"), F.col("o_orderpriority"), F.lower("o_orderpriority"), "R22"),
        ],
    )
    eid = lambda prefix: F.concat(F.lit(prefix), F.col("n").cast("string"))

    def edge(df, kind, id_, source, target, label, rule, **more):
        columns = {"caption_id": F.col("caption_id"), "edge_id": id_, "edge_type": F.lit(kind), "source_mention_id": source, "target_mention_id": target, "label": label, "canonical_label": label, "rule_id": rule if not isinstance(rule, str) else F.lit(rule), "confidence": F.lit("high"), **more}
        return _typed(df.select(*(v.alias(k) for k, v in columns.items())), EDGE)

    role = F.when(F.col("l_linestatus") == "F", "agent").otherwise("patient")
    follows = line.withColumn("last", F.max("n").over(Window.partitionBy("caption_id"))).where("n < last").join(orders.hint("merge"), "caption_id")
    preposition = F.when(F.col("o_orderstatus") == "F", "on").when(F.col("o_orderstatus") == "O", "next to").otherwise("in front of")
    sides = line.groupBy("caption_id").agg(F.collect_list(F.when(F.col("l_linestatus") == "F", F.col("n"))).alias("f"), F.collect_list(F.when(F.col("l_linestatus") == "O", F.col("n"))).alias("o"))
    pairs = sides.where((F.size("f") >= 2) & (F.size("o") >= 1)).select("caption_id", F.explode("f").alias("f"), "o").select("caption_id", "f", F.explode("o").alias("o"))
    edges = reduce(
        DataFrame.unionByName,
        [
            edge(line, "has_attribute", eid("ea"), mid(-3), mid(-2), F.lit("has_attribute"), "R13"),
            edge(line, "has_quantity", eid("eq"), mid(-3), mid(-1), F.lit("has_quantity"), "R14"),
            edge(line, "event_role", eid("er"), F.lit("a0"), mid(-3), role, F.when(role == "agent", "R16").otherwise("R17")),
            edge(follows, "relation", eid("el"), mid(-3), mid(0), preposition, F.when(preposition == "on", "R18").otherwise("R18.1"), canonical_rule_id=F.lit("R24")),
            edge(pairs, "ambiguous_relation_candidate", F.concat(F.lit("ex"), F.col("f").cast("string"), F.lit("_"), F.col("o").cast("string")), mid(-3, "f"), mid(-3, "o"), F.lit("between"), "R18.1", canonical_rule_id=F.lit("R24"), matched_token_indices=F.array(F.lit("0"))),
        ],
    )
    return mentions, edges


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source captions: key, caption, caption_type."""
    kind = F.when(F.col("doc_id") % 10 == 0, "tag").when(F.col("n_chars") <= 200, "short").when(F.col("n_chars") <= 2000, "medium").otherwise("long")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("caption"), kind.alias("caption_type"))


#: The graph adapter in SQL: tables line, mention, edge.
GRAPH_SQL = """
line AS (
  SELECT cast(l_orderkey AS VARCHAR) AS caption_id, n, l_returnflag, cast(cast(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS quantity, l_linestatus, p_brand, p_name, p_type, p_size
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS n FROM lineitem)
  JOIN part ON l_partkey = p_partkey),
ord AS (SELECT cast(o_orderkey AS VARCHAR) AS caption_id, o_orderpriority, o_orderstatus FROM orders),
mention AS (
  SELECT caption_id, 'm' || (3 * n - 3) AS mention_id, 'object' AS mention_type, p_name AS raw_text, p_brand AS canonical,
         [p_type, 'size_' || cast(floor(p_size / 10.0) AS INTEGER)] AS parent_concepts, ['s-' || p_type] AS parent_synset_ids, ['R12', 'R19', 'R23'] AS rules, lower(trim(p_name)) AS variant FROM line
  UNION ALL SELECT caption_id, 'm' || (3 * n - 2), 'attribute', l_returnflag, lower(l_returnflag), [], [], ['R13', 'R20'], lower(l_returnflag) FROM line
  UNION ALL SELECT caption_id, 'm' || (3 * n - 1), 'quantity', quantity, quantity, [], [], ['R14', 'R21'], quantity FROM line
  UNION ALL SELECT caption_id, 'a0', 'action', o_orderpriority, lower(o_orderpriority), [], [], ['R15', 'R22'], lower(trim(o_orderpriority)) FROM ord),
f AS (SELECT caption_id, n FROM line WHERE l_linestatus = 'F'),
o AS (SELECT caption_id, n FROM line WHERE l_linestatus = 'O'),
edge AS (
  SELECT caption_id, 'ea' || n AS edge_id, 'has_attribute' AS edge_type, 'm' || (3 * n - 3) AS src, 'm' || (3 * n - 2) AS dst, 'has_attribute' AS label, ['R13'] AS rules FROM line
  UNION ALL SELECT caption_id, 'eq' || n, 'has_quantity', 'm' || (3 * n - 3), 'm' || (3 * n - 1), 'has_quantity', ['R14'] FROM line
  UNION ALL SELECT caption_id, 'er' || n, 'event_role', 'a0', 'm' || (3 * n - 3), CASE l_linestatus WHEN 'F' THEN 'agent' ELSE 'patient' END, [CASE l_linestatus WHEN 'F' THEN 'R16' ELSE 'R17' END] FROM line
  UNION ALL SELECT caption_id, 'el' || n, 'relation', 'm' || (3 * n - 3), 'm' || (3 * n), CASE o_orderstatus WHEN 'F' THEN 'on' WHEN 'O' THEN 'next to' ELSE 'in front of' END,
                   [CASE o_orderstatus WHEN 'F' THEN 'R18' ELSE 'R18.1' END, 'R24']
            FROM (SELECT *, max(n) OVER (PARTITION BY caption_id) AS last FROM line) JOIN ord USING (caption_id) WHERE n < last
  UNION ALL SELECT f.caption_id, 'ex' || f.n || '_' || o.n, 'ambiguous_relation_candidate', 'm' || (3 * f.n - 3), 'm' || (3 * o.n - 3), 'between', ['R18.1', 'R24']
            FROM f JOIN o USING (caption_id) WHERE f.caption_id IN (SELECT caption_id FROM f GROUP BY 1 HAVING count(*) >= 2)),
joined AS (
  SELECT e.*, s.canonical AS s, t.canonical AS t, s.parent_concepts AS sp, s.parent_synset_ids AS ss, t.parent_concepts AS tp, t.parent_synset_ids AS ts, s.rules AS sr, t.rules AS tr
  FROM edge e JOIN mention s ON s.caption_id = e.caption_id AND s.mention_id = e.src JOIN mention t ON t.caption_id = e.caption_id AND t.mention_id = e.dst)"""

#: The facts of each kind in SQL: the keys, then the extras, as the count tables name them.
FACT_SQL = {
    "entity_exists": "SELECT caption_id, canonical AS object, parent_concepts, parent_synset_ids, [variant] AS raw_variants, rules AS rule_ids FROM mention WHERE mention_type = 'object'",
    "attribute_exists": "SELECT caption_id, canonical AS attribute, mention_type AS attribute_kind, [variant] AS raw_variants, rules AS rule_ids FROM mention WHERE mention_type IN ('attribute', 'quantity')",
    "object_parent": "SELECT caption_id, canonical AS object, unnest(parent_concepts) AS parent, [coalesce(parent_synset_ids[generate_subscripts(parent_concepts, 1)], '')] AS parent_synset_id, [variant] AS raw_variants, rules AS rule_ids FROM mention WHERE mention_type = 'object'",
    "action_event": "SELECT caption_id, canonical AS action, [variant] AS raw_variants, rules AS rule_ids FROM mention WHERE mention_type = 'action'",
    "has_attribute": "SELECT caption_id, s AS object, t AS attribute, CASE edge_type WHEN 'has_attribute' THEN 'attribute' ELSE 'quantity' END AS attribute_kind, sp AS object_parent_concepts, ss AS object_parent_synset_ids, [] AS raw_variants, list_concat(rules, sr, tr) AS rule_ids FROM joined WHERE edge_type IN ('has_attribute', 'has_quantity')",
    "event_role": "SELECT caption_id, s AS action, label AS role, t AS target, tp AS target_parent_concepts, ts AS target_parent_synset_ids, [label] AS raw_role, ['none'] AS voice_normalization, [] AS raw_variants, list_concat(rules, sr, tr) AS rule_ids FROM joined WHERE edge_type = 'event_role'",
    "relation": "SELECT caption_id, s AS source, label AS relation, t AS target, sp AS source_parent_concepts, ss AS source_parent_synset_ids, tp AS target_parent_concepts, ts AS target_parent_synset_ids, [] AS raw_variants, list_concat(rules, sr, tr) AS rule_ids FROM joined WHERE edge_type = 'relation'",
    "relation_component": "SELECT caption_id, label AS relation, cast(generate_subscripts(string_split(label, ' '), 1) - 1 AS VARCHAR) AS component_index, unnest(string_split(label, ' ')) AS component, [label] AS raw_variants, rules AS rule_ids FROM edge WHERE edge_type = 'relation'",
    "ambiguous_relation_candidate": """SELECT caption_id, CASE WHEN count(DISTINCT s) > 1 THEN 'source_ambiguous' ELSE 'source_resolved' END AS source_status, label AS relation, CASE WHEN count(DISTINCT t) > 1 THEN 'target_ambiguous' ELSE 'target_resolved' END AS target_status,
         list(DISTINCT s) AS candidate_sources, list(DISTINCT t) AS candidate_targets, [cast(count(*) AS VARCHAR)] AS candidate_pair_count, [label] AS raw_variants, flatten(list(list_concat(rules, sr, tr))) AS rule_ids
         FROM joined WHERE edge_type = 'ambiguous_relation_candidate' GROUP BY caption_id, label""",
    "object_pair_in_caption": """SELECT a.caption_id, a.canonical AS source_object, b.canonical AS target_object, a.p AS source_parent_concepts, a.i AS source_parent_synset_ids, b.p AS target_parent_concepts, b.i AS target_parent_synset_ids, [] AS raw_variants, list_concat(a.r, b.r) AS rule_ids
         FROM ob a JOIN ob b ON a.caption_id = b.caption_id AND a.canonical <> b.canonical""",
}
OBJECTS_SQL = "ob AS (SELECT caption_id, canonical, flatten(list(parent_concepts)) AS p, flatten(list(parent_synset_ids)) AS i, flatten(list(rules)) AS r FROM mention WHERE mention_type = 'object' GROUP BY 1, 2)"


def united(column: str) -> str:
    """Sorted distinct members of a list column over a group, pipe-joined."""
    return f"coalesce(array_to_string(list_sort(list_distinct(flatten(list({column})))), '|'), '')"


def count_sql(spec) -> str:
    """The SQL of a count table over the graph adapter."""
    keys = ", ".join(spec.keys)
    extras = "".join(f", {united(x)} AS {x}" for x in spec.extras)
    return f"""WITH {GRAPH_SQL}, {OBJECTS_SQL}, fact AS ({FACT_SQL[spec.fact_type]})
SELECT concat_ws(':', '{spec.prefix}', {keys}) AS count_key, {keys}{extras}, count(*) AS count, count(DISTINCT caption_id) AS caption_count,
       array_to_string(list_slice(list_sort(list(DISTINCT caption_id)), 1, 5), '|') AS example_caption_ids, {united('raw_variants')} AS raw_variants,
       array_to_string(list_sort(list_distinct(list_append(flatten(list(rule_ids)), 'R25'))), '|') AS rule_ids
FROM fact GROUP BY {keys}"""
