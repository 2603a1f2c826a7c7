"""Versioned folders: immutable data, numbered manifests, and a commit that only one of several writers can win.

A folder holds ``data/<name>`` folders that are never changed, and ``_versions/<number>.json``. The highest number is the current version.
A commit writes its manifest beside the others and renames it to the next number without replacing: if another writer has
taken that number in the meantime, it fails with Conflict and nothing that readers see has changed. A reader takes one manifest and
reads what that names, so it sees one version whole.

On file systems without an atomic rename that refuses to replace, writers must be kept apart by other means."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has committed first."""


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.jvm.org.apache.hadoop.fs.Path(self.folder).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def number(self) -> int:
        """The current version; 0 before the first."""
        at = self._path("_versions")
        if not self.fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(at)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, number: int | None = None) -> dict:
        number = self.number() if number is None else number
        if not number:
            return {}
        stream = self.fs.open(self._path(f"_versions/{number:08d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, expected: int, manifest: dict) -> int:
        """Makes ``manifest`` the version after ``expected``."""
        if self.number() != expected:
            raise Conflict(f"{self.folder} is at version {self.number()}, not {expected}")
        hidden, target = self._path(f"_versions/.{uuid.uuid4().hex}"), self._path(f"_versions/{expected + 1:08d}.json")
        out = self.fs.create(hidden, True)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs.Options, "Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(self.fs.makeQualified(hidden), self.fs.makeQualified(target), how)
        except Exception as error:  # noqa: BLE001 - whatever the file system calls it, the number is taken
            self.fs.delete(hidden, False)
            if self.fs.exists(target):
                raise Conflict(f"version {expected + 1} of {self.folder} was taken") from error
            raise
        return expected + 1

    def new_data(self) -> str:
        """The name of a data folder that nobody uses yet."""
        return f"data/{uuid.uuid4().hex}"

    def drop(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


# --- partitioned tables, patched by copying what changes


def create(spark: SparkSession, folder: str, rows: DataFrame, partition: str, keys: list[str]) -> int:
    """The first version of a table: one data folder for each value of ``partition`` (a string column)."""
    there = Versions(spark, folder)
    name = there.new_data()
    rows.write.partitionBy(partition).parquet(f"{there.folder}/{name}")
    values = [r[0] for r in rows.select(partition).distinct().collect()]  # the partitions, not the rows
    return there.commit(0, {"schema": rows.schema.json(), "partition": partition, "keys": keys, "partitions": {v: name for v in values}})


def read(spark: SparkSession, folder: str, number: int | None = None, only: list[str] | None = None) -> DataFrame:
    """A version of a table, or some partitions of it."""
    there = Versions(spark, folder)
    m = there.manifest(number)
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    by_folder: dict[str, list[str]] = {}
    for value, name in m["partitions"].items():
        if only is None or value in only:
            by_folder.setdefault(name, []).append(value)
    each = [spark.read.schema(schema).parquet(f"{there.folder}/{name}").where(F.col(m["partition"]).isin(values)) for name, values in by_folder.items()]
    return reduce(DataFrame.unionByName, [x.select(*schema.names) for x in each]) if each else spark.createDataFrame([], schema)


def export_patch(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """op (upsert or delete) with the columns of the tables: what makes ``new`` of ``old``. Rows that are equal are left out."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("_a"))
    b = new.select(*keys, F.struct(*values).alias("_b"))
    both = a.join(b, keys, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    op = F.when(F.col("_b").isNull(), "delete").otherwise("upsert")
    return both.select(op.alias("op"), *keys, F.coalesce("_b", "_a").alias("_v")).select("op", *keys, "_v.*").select("op", *old.columns)


def patch_effect(spark: SparkSession, folder: str, patch: DataFrame, number: int | None = None) -> DataFrame:
    """partition value, inserted, updated, deleted, same: what the patch would change now."""
    m = Versions(spark, folder).manifest(number)
    keys, part = m["keys"], m["partition"]
    touched = [r[0] for r in patch.select(part).distinct().collect()]
    joined = _beside(read(spark, folder, number, touched), patch, keys)
    is_new, is_gone = F.col("_a").isNull(), F.col("op") == "delete"
    kind = F.when(is_new & is_gone, "same").when(is_new, "inserted").when(is_gone, "deleted").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("updated")
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("inserted", "updated", "deleted", "same")]
    return joined.where("op is not null").withColumn("kind", kind).groupBy(part).agg(*counts)


def _beside(old: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("_a"))
    return a.join(patch.select("op", *keys, F.struct(*values).alias("_b")), keys, "full")


def apply_patch(spark: SparkSession, folder: str, patch: DataFrame) -> tuple[int, list]:
    """Applies a patch; the version afterwards, and for each partition that changed the rows of ``patch_effect``.

    Only partitions that change are written, into a new data folder. Before the commit the new rows are counted: each partition must
    have the rows it had, plus the inserted and less the deleted, under as many keys. A patch without effect leaves
    the version as it is; one with two rows for a key fails."""
    there = Versions(spark, folder)
    number = there.number()
    m = there.manifest(number)
    keys, part = m["keys"], m["partition"]
    if part not in keys:
        raise ValueError("the partition must be one of the keys")
    twice = patch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two rows of the patch have the key {twice[0].asDict()}")
    effect = [r for r in patch_effect(spark, folder, patch, number).collect() if r["inserted"] + r["updated"] + r["deleted"]]  # a row for each partition
    if not effect:
        return number, []
    values = [r[part] for r in effect]
    old = read(spark, folder, number, values)
    joined = _beside(old, patch.where(F.col(part).isin(values)), keys).where("op is null or op <> 'delete'")
    taken = F.when(F.col("op") == "upsert", F.col("_b")).otherwise(F.col("_a"))
    name = there.new_data()
    joined.withColumn("_v", taken).select(*keys, "_v.*").select(*old.columns).write.partitionBy(part).parquet(f"{there.folder}/{name}")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    fresh = spark.read.schema(schema).parquet(f"{there.folder}/{name}")
    after = {r[part]: (r["n"], r["k"]) for r in fresh.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*keys).alias("k")).collect()}
    before = {r[part]: r["n"] for r in old.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in effect:
        want = before.get(r[part], 0) + r["inserted"] - r["deleted"]
        if after.get(r[part], (0, 0)) != (want, want):
            there.drop(name)
            raise ValueError(f"partition {r[part]!r}: {want} rows wanted, {after.get(r[part])} (rows, keys) made")
    partitions = m["partitions"] | {v: name for v in values if v in after}
    partitions = {v: n for v, n in partitions.items() if v in after or v not in values}
    try:
        return there.commit(number, m | {"partitions": partitions}), effect
    except Conflict:
        there.drop(name)
        raise


# --- bundles of inventories


def digest(rows: DataFrame) -> dict:
    """Rows, and two sums over them that do not depend on their order."""
    cells = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    r = rows.select(F.xxhash64(cells).alias("a"), F.crc32(cells.cast("binary")).alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return {"rows": r["rows"], "digest": f"{r['a'] & (2**64 - 1):016x}-{r['b']:x}"}


def stage(spark: SparkSession, folder: str, components: dict[str, DataFrame], required: tuple[str, ...], blocking: dict[str, DataFrame] | None = None) -> dict:
    """Writes a bundle's components beside the published ones and returns its manifest; readers see nothing of it yet.

    A required component that is absent, and one with blocking rows (open decisions), refuses the bundle before anything is written."""
    missing = [n for n in required if n not in components]
    still = [n for n, rows in (blocking or {}).items() if rows.limit(1).count()]
    if missing or still:
        raise ValueError(f"the bundle is not ready; missing: {missing}; open decisions: {still}")
    there, out = Versions(spark, folder), {}
    for name, rows in components.items():
        place = there.new_data()
        rows.write.parquet(f"{there.folder}/{place}")
        out[name] = {"path": place, "schema": rows.schema.json(), **digest(spark.read.schema(rows.schema).parquet(f"{there.folder}/{place}"))}
    return {"components": out}


def publish(spark: SparkSession, folder: str, staged: dict, expected: int, label: str = "") -> int:
    """Makes a staged bundle the current one, if the folder is still at version ``expected``; else Conflict."""
    return Versions(spark, folder).commit(expected, staged | {"label": label})


def bundle(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, DataFrame]:
    """The components of one version of a bundle."""
    there = Versions(spark, folder)
    return {n: spark.read.schema(T.StructType.fromJson(json.loads(c["schema"]))).parquet(f"{there.folder}/{c['path']}") for n, c in there.manifest(number).get("components", {}).items()}


def verify(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, bool]:
    """For each component whether its rows are those that were published."""
    m = Versions(spark, folder).manifest(number)["components"]
    return {n: digest(rows) == {"rows": m[n]["rows"], "digest": m[n]["digest"]} for n, rows in bundle(spark, folder, number).items()}
