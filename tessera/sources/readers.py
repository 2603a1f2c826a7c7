"""Source files as DataFrames."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ANNOTATED, CAPTION_SOURCE
from . import archives


def jsonl(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """One object a line, gzip by extension; blank lines are skipped, anything else fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def captions(spark: SparkSession, paths: list[str], limit: int | None = None) -> DataFrame:
    """Caption rows of many files; ``limit`` counts over all of them, in order of file name and place."""
    rows = spark.read.schema(CAPTION_SOURCE).json(paths).withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
    return rows.orderBy("_file", "_at").limit(limit).drop("_file", "_at") if limit is not None else rows.drop("_file", "_at")


def annotated(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, ANNOTATED)


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    """JSON members of tar shards with where they came from; shards of any size, read in splits."""
    return archives.caption_shards(spark, path)


def shard_range(text: str) -> list[int]:
    """``0-3,7`` as sorted numbers, each once."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        m = re.fullmatch(r"(\d+)(?:-(\d+))?", part)
        if not m or (m[2] and int(m[2]) < int(m[1])):
            raise ValueError(f"no shard range: {part!r}")
        out.update(range(int(m[1]), int(m[2] or m[1]) + 1))
    return sorted(out)


def front(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Exactly the first n rows; fewer fail."""
    out = rows.orderBy(*order).limit(n)
    if (there := out.count()) < n:
        raise ValueError(f"{n} rows wanted, {there} found")
    return out


def xlsx_sheet(content: bytes, sheet: str = "xl/worksheets/sheet1.xml") -> list[list[str]]:
    """Cells of a sheet as text, row by row; absent cells are ''."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        rows = []
        for row in ElementTree.fromstring(book.read(sheet)).iter(f"{ns}row"):
            cells: dict[int, str] = {}
            for c in row.iter(f"{ns}c"):
                letters = re.match(r"[A-Z]+", c.get("r", "A"))[0]
                at = 0
                for x in letters:
                    at = at * 26 + ord(x) - 64
                value = c.find(f"{ns}v")
                text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if value is None else value.text or ""
                cells[at - 1] = shared[int(text)] if c.get("t") == "s" else text
            rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
    return rows


def xlsx(spark: SparkSession, path: str) -> DataFrame:
    """A workbook's first sheet, its first row the header. Workbooks are small and read on the driver."""
    content = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    head, *rows = xlsx_sheet(content)
    return spark.createDataFrame([r + [""] * (len(head) - len(r)) for r in rows], ", ".join(f"`{h}` string" for h in head))


def dictionary_prepositions(spark: SparkSession, path: str) -> DataFrame:
    """English prepositions of two words or more from a dictionary dump (one JSON entry a line)."""
    rows = spark.read.schema("word string, pos string, lang_code string").json(path)
    return rows.where("lang_code = 'en' and pos = 'prep'").select("word").where(F.size(F.split("word", " ")) >= 2).distinct()


def multiword_expressions(spark: SparkSession, path: str) -> DataFrame:
    """One row for each expression of annotated sentences: sent_id, kind, lexcat, lexlemma, supersense."""
    mwe = "map<string, struct<lexlemma string, lexcat string, ss string, toknums array<int>>>"
    rows = spark.read.schema(f"sent_id string, swes {mwe}, smwes {mwe}, wmwes {mwe}").option("multiLine", True).json(path)
    kinds = [rows.select("sent_id", F.lit(k).alias("kind"), F.explode(F.map_values(k)).alias("e")) for k in ("smwes", "wmwes")]
    return kinds[0].unionByName(kinds[1]).select("sent_id", "kind", "e.lexcat", "e.lexlemma", F.col("e.ss").alias("supersense"), F.size("e.toknums").alias("n_tokens"))


def preposition_lines(spark: SparkSession, path: str, pattern: str = r"^(\S.*?)\s{2,}(\d+)\s*$") -> DataFrame:
    """preposition, senses from lines of a text file that match the pattern."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_extract("value", pattern, 1).alias("preposition"), F.expr(f"try_cast(regexp_extract(value, '{pattern.replace(chr(92), chr(92) * 2)}', 2) as int)").alias("senses")).where("preposition <> ''")


def region_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label occurrences of an image region file: image_id, label (lower case)."""
    rows = spark.read.schema("image_id long, objects array<struct<names: array<string>>>").option("multiLine", True).json(path)
    return rows.select("image_id", F.explode("objects").alias("o")).select("image_id", F.explode("o.names").alias("label")).select("image_id", F.lower(F.trim("label")).alias("label")).where("label <> ''")


def hierarchy_edges(tree: dict, label: str = "LabelName", kids: str = "Subcategory") -> list[tuple[str, str]]:
    """(parent, child) pairs of a nested class hierarchy."""
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        for child in node.get(kids, ()):
            out.append((node[label], child[label]))
            stack.append(child)
    return sorted(set(out))


def category_labels(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """id, name of label sets: a JSON file with ``categories``, or a table with the two columns."""
    if fmt == "json":
        rows = spark.read.schema("categories array<struct<id: long, name: string, synonyms: array<string>>>").option("multiLine", True).json(path)
        return rows.select(F.explode("categories").alias("c")).select("c.id", F.lower(F.trim("c.name")).alias("name"))
    return spark.read.options(header=True, sep="\t" if fmt == "tsv" else ",").csv(path).select(F.expr("try_cast(id as long)").alias("id"), F.lower(F.trim("name")).alias("name"))


def scene_graphs(spark: SparkSession, path: str) -> DataFrame:
    """caption_id and the scene graph from whichever field a row has it in."""
    graph = "struct<entities: array<struct<head: string, attributes: array<string>>>>"
    rows = spark.read.schema(f"key string, scene_graph_v4 {graph}, scene_graph {graph}, sg {graph}").json(path)
    return rows.select(F.col("key").alias("caption_id"), F.coalesce("scene_graph_v4", "scene_graph", "sg").alias("graph"))


def facts_of_type(spark: SparkSession, path: str, fact_type: str) -> tuple[DataFrame, Column]:
    """Facts of one type; lines are tested for the word before they are parsed. The second value counts the lines that are no JSON
    (an aggregate over the first's ``bad``)."""
    lines = spark.read.text(path).where(F.col("value").contains(fact_type))
    schema = "caption_id string, fact_type string, count_key string, rule_ids array<string>, source_mention_ids array<string>, source_edge_ids array<string>, values map<string, string>, _bad string"
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("f")).select("f.*")
    rows = parsed.withColumn("bad", F.col("_bad").isNotNull()).where((F.col("fact_type") == fact_type) | F.col("bad")).drop("_bad")
    return rows, F.count_if("bad")


def shard_folders(root: str, stage: str) -> str:
    """A path pattern for one stage's outputs of all shards."""
    return f"{root.rstrip('/')}/shards/shard_*/{stage}"


def caption_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """caption_id of JSON lines without parsing the rest of them."""
    return lines.select(F.get_json_object(column, "$.caption_id").alias("caption_id"))


def count_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A count table file: a byte-order mark is dropped, null is ''."""
    from .lexicons import read_tsv

    rows = read_tsv(spark, path).drop("_pos")
    return rows.withColumns({c: F.col(c).cast("long") for c in ("count", "caption_count") if c in rows.columns})


def inventory_bundle(state: dict, folder: str) -> dict[str, str]:
    """Paths of an inventory bundle, resolved against its folder. A name given twice with different paths is an error."""
    out: dict[str, str] = {}
    for section in ("artifacts", "paths", "inventories", "inputs"):
        for name, path in (state.get(section) or {}).items():
            full = path if path.startswith("/") or "://" in path else f"{folder.rstrip('/')}/{path}"
            if out.setdefault(name, full) != full:
                raise ValueError(f"{name} has two paths: {out[name]} and {full}")
    return out
