import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import counts, report
from tessera.operators.facts import all_facts
from tessera.plans import adapters
from tessera.sources import lexicons, readers, sinks


def test_shard_ranges():
    assert readers.shard_range("0-3, 7,2") == [0, 1, 2, 3, 7]
    with pytest.raises(ValueError, match="no shard range"):
        readers.shard_range("3-1")


def test_jsonl_round_trip_and_bad_line(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", None), ("2", "é|\t", "tag")], "key string, caption string, caption_type string")
    sinks.write_jsonl(rows, f"{tmp_path}/a", compression="gzip")
    assert {tuple(r) for r in readers.jsonl(spark, f"{tmp_path}/a", rows.schema.simpleString()[7:-1].replace(":", " ")).collect()} == {tuple(r) for r in rows.collect()}
    (tmp_path / "bad.jsonl").write_text('{"key": "1"}\n\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        readers.jsonl(spark, f"{tmp_path}/bad.jsonl", "key string").collect()


def test_limit_and_front(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"s{n}.jsonl").write_text("".join(json.dumps({"key": f"{n}-{i}", "caption": "x", "caption_type": "short"}) + "\n" for i in range(3)))
    got = readers.captions(spark, [f"{tmp_path}/s1.jsonl", f"{tmp_path}/s2.jsonl"], limit=4)
    assert [r["key"] for r in got.collect()] == ["1-0", "1-1", "1-2", "2-0"]
    with pytest.raises(ValueError, match="wanted"):
        readers.front(got, 9, ["key"])


def test_tar(spark, tmp_path):
    (tmp_path / "train").mkdir()
    with tarfile.open(tmp_path / "train/shard_0.tar", "w") as tar:
        for i in range(2):
            raw = json.dumps({"key": f"k{i}", "caption": "c", "caption_type": "tag"}).encode()
            info = tarfile.TarInfo(f"{i}.json")
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    got = readers.tar_members(spark, f"{tmp_path}/train/*.tar").orderBy("record_index").collect()
    assert [(r["key"], r["split_dir"], r["shard"], r["shard_member"]) for r in got] == [("k0", "train", "shard_0.tar", "0.json"), ("k1", "train", "shard_0.tar", "1.json")]


def test_xlsx(spark, tmp_path):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>name</t></si><si><t>in front of</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>7</v></c></row><row><c r="A2" t="s"><v>1</v></c></row></sheetData></worksheet>')
    assert readers.xlsx_sheet((tmp_path / "a.xlsx").read_bytes()) == [["name", "", "7"], ["in front of"]]


def test_hierarchy():
    tree = {"LabelName": "a", "Subcategory": [{"LabelName": "b", "Subcategory": [{"LabelName": "c"}]}, {"LabelName": "d"}]}
    assert readers.hierarchy_edges(tree) == [("a", "b"), ("a", "d"), ("b", "c")]


def test_count_table_file(spark, sf, tmp_path):
    table = counts.count_table(all_facts(*adapters.graph(spark, sf))["action_event"], counts.BY_NAME["action_counts"])
    sinks.write_count_table(table, f"{tmp_path}/t")
    back = readers.count_tsv(spark, f"{tmp_path}/t")
    assert [(r["count_key"], r["count"]) for r in back.collect()] == [(r["count_key"], r["count"]) for r in counts.ordered(table).collect()]
    sinks.write_count_table(table.limit(0), f"{tmp_path}/e")
    text = "".join(p.read_text() for p in (tmp_path / "e").glob("part-*"))
    assert text.startswith("count_key\taction\tcount")


def test_facts_file_with_bad_lines(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"fact_type": "relation", "caption_id": "1"}\n{"fact_type": "entity_exists", "caption_id": "2"}\n{"fact_type": "relation", broken\n')
    rows, bad = readers.facts_of_type(spark, f"{tmp_path}/f.jsonl", "relation")
    assert rows.agg(bad.alias("bad"), F.count_if(F.col("caption_id").isNotNull()).alias("n")).first().asDict() == {"bad": 1, "n": 1}


def test_small_files_and_bundles(spark, tmp_path):
    sinks.write_text(spark, f"{tmp_path}/x.json", "{}")
    sinks.write_text(spark, f"{tmp_path}/x.json", "[1]")
    assert (tmp_path / "x.json").read_text() == "[1]"
    assert readers.inventory_bundle({"artifacts": {"a": "b.tsv"}, "inputs": {"a": "/r/b.tsv"}}, "/r") == {"a": "/r/b.tsv"}
    with pytest.raises(ValueError, match="two paths"):
        readers.inventory_bundle({"artifacts": {"a": "b.tsv"}, "inputs": {"a": "/c.tsv"}}, "/r")


def test_ngram_evidence_last_row_wins(spark, tmp_path):
    (tmp_path / "n.tsv").write_text("﻿selected_oewn_synset\tsurface_key\tmean_frequency\ns\tdog\t1\ns\tdog\tx\ns\tdog\t3\n")
    assert lexicons.ngram_evidence(lexicons.read_tsv(spark, f"{tmp_path}/n.tsv")).first()["mean_frequency"] == 3.0


def test_report_files(spark, sf, tmp_path):
    facts = all_facts(*adapters.graph(spark, sf))
    table = counts.count_table(facts["action_event"], counts.BY_NAME["action_counts"])
    view = report.numbered(table.select(F.col("action").alias("canonical_action"), F.col("raw_variants").alias("action_raw_surfaces"), "count", "caption_count", "example_caption_ids"), "actions")
    index = report.caption_index(facts, {"actions": view})
    sinks.write_report({"actions": view}, facts["action_event"].select("caption_id"), index, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/caption_index")
    assert report.index_mismatches(spark.read.parquet(f"{tmp_path}/views/actions"), back, "actions").count() == 0
