"""Tar and zip archives of any size as tables of their members, and back.

Reading takes two jobs. Planning: archives are listed by Spark, and a task for each walks its headers (of a zip: its directory), seeking from one
to the next, and gives back a split point for about every SPLIT bytes; no content is read, and no list of members leaves the task.
Reading: the splits are dealt out; a task seeks to its split and streams the members that begin there. A member above PART bytes comes in
parts, so neither an archive nor a member must fit into memory. Tasks may be lost and run again; writing renames whole files only.

Files are opened with Arrow's file systems by their address (a path, file, hdfs, s3 and others that Arrow knows), on executors.

Defined cases: directories, links and devices are no members; members that the pattern does not match are skipped unread; names may
repeat; an empty member has one empty part; an empty archive, or none, gives no rows; other files in the folder are ignored; a damaged
archive fails the job. Global pax headers hold for the split that they stand in only."""

from __future__ import annotations

import io
import re
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CAPTION_SOURCE

#: Bytes of an archive that one task reads, about, and bytes of a part of a member at most.
SPLIT, PART = 128 << 20, 32 << 20
#: Bytes of rows that go to Spark at a time, about.
BATCH = 8 << 20
_MEMBERS = "archive string, split int, place long, member string, size long, part int, content binary"


def _open(path: str):
    where, name = pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path)) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)
    return where, name


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, length of the archives in folders or by name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.where(F.lower("path").rlike("[.](tar|zip)$"))


def _tar_headers(f) -> Iterator[tuple[tarfile.TarInfo, int]]:
    """Members from where the file stands, each with the place where its headers begin."""
    with tarfile.open(fileobj=f, mode="r:") as tar:
        while True:
            begin = tar.offset
            info = tar.next()
            if info is None:
                return
            tar.members = []  # the library would keep them all
            yield info, min(begin, info.offset)


def plan(archives: DataFrame, pattern: str = "", split: int = SPLIT) -> DataFrame:
    """path, split, begin, end, first: parts of archives, and the number of matching members before each. begin and end are bytes of a tar, places
    in the directory of a zip."""
    wanted = re.compile(pattern)

    def walk(batches):
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                where, name = _open(path)
                begin, first, seen, bytes_ = 0, 0, 0, 0
                n = 0
                with where.open_input_file(name) as f:
                    if path.lower().endswith(".zip"):
                        with zipfile.ZipFile(f) as book:
                            for i, info in enumerate(book.infolist()):
                                if bytes_ >= split:
                                    rows.append((path, n, begin, i, first))
                                    n, begin, first, bytes_ = n + 1, i, seen, 0
                                bytes_ += info.compress_size
                                seen += not info.is_dir() and bool(wanted.search(info.filename))
                            end = len(book.infolist())
                    else:
                        end = f.size()
                        for info, at in _tar_headers(f):
                            if at - begin >= split:
                                rows.append((path, n, begin, at, first))
                                n, begin, first = n + 1, at, seen
                            seen += info.isfile() and bool(wanted.search(info.name))
                rows.append((path, n, begin, end, first))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["path", "split", "begin", "end", "first"])

    some = archives.select("path").repartition(max(1, min(archives.count(), 10_000)), "path")
    return some.mapInArrow(walk, "path string, split int, begin long, end long, first long")


def members(spark: SparkSession, path: str | list[str], pattern: str = "", split: int = SPLIT, part: int = PART, cut=lambda df: df.checkpoint()) -> DataFrame:
    """archive, split, place (among the archive's matching members, from 0), member, size, part, content of all files in archives whose names match."""
    splits = cut(plan(listed(spark, path), pattern, split))
    wanted = re.compile(pattern)

    def pieces(f, size: int) -> Iterator[tuple[int, bytes]]:
        number, left = 0, size
        while True:
            raw = f.read(min(part, left)) if left else b""
            if left and not raw:
                raise EOFError("the archive ends inside a member")
            left -= len(raw)
            yield number, raw
            number += 1
            if not left:
                return

    def found(row: dict) -> Iterator[tuple]:
        where, name = _open(row["path"])
        place = row["first"]
        with where.open_input_file(name) as f:
            if row["path"].lower().endswith(".zip"):
                with zipfile.ZipFile(f) as book:
                    for info in book.infolist()[row["begin"] : row["end"]]:
                        if not info.is_dir() and wanted.search(info.filename):
                            with book.open(info) as content:
                                for number, raw in pieces(content, info.file_size):
                                    yield row["path"], row["split"], place, info.filename, info.file_size, number, raw
                            place += 1
                return
            f.seek(row["begin"])
            with tarfile.open(fileobj=f, mode="r:") as tar:
                at = row["begin"]  # the library has read the first header by now
                while at < row["end"] and (info := tar.next()) is not None:
                    tar.members, at = [], tar.offset
                    if info.isfile() and wanted.search(info.name):
                        for number, raw in pieces(tar.extractfile(info), info.size):
                            yield row["path"], row["split"], place, info.name, info.size, number, raw
                        place += 1

    types = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary())
    names = [x.split()[0] for x in _MEMBERS.split(", ")]

    def read(batches):
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                for cells in found(row):
                    rows.append(cells)
                    held += len(cells[-1]) + 100
                    if held >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    dealt = splits.repartition(max(1, min(splits.count(), 100_000)), "path", "split")
    return dealt.mapInArrow(read, _MEMBERS)


def write(rows: DataFrame, folder: str, kind: str = "tar", cut=lambda df: df.checkpoint()) -> DataFrame:
    """Writes rows (member, content) into one archive for each task; path, members, bytes of what was written.

    An archive gets its name when it is whole; a task that runs again writes the same name again."""
    if kind not in ("tar", "zip"):
        raise ValueError(f"no such kind of archive: {kind}")

    def pack(batches):
        where, name = _open(folder)
        where.create_dir(name, recursive=True)
        final = f"{name}/part-{TaskContext.get().partitionId():06d}.{kind}"
        hidden = f"{name}/.{uuid.uuid4().hex}.tmp"
        n = total = 0
        with where.open_output_stream(hidden) as f:
            book = tarfile.open(fileobj=f, mode="w|", format=tarfile.GNU_FORMAT) if kind == "tar" else zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED)
            with book:
                for batch in batches:
                    for member, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                        raw = content.as_py() or b""
                        if kind == "tar":
                            info = tarfile.TarInfo(member)
                            info.size = len(raw)
                            book.addfile(info, io.BytesIO(raw))
                        else:
                            book.writestr(zipfile.ZipInfo(member), raw, zipfile.ZIP_DEFLATED)
                        n, total = n + 1, total + len(raw)
        if n:
            where.move(hidden, final)
        else:
            where.delete_file(hidden)
        yield pa.RecordBatch.from_arrays([pa.array([final], pa.string()), pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["path", "members", "bytes"])

    return cut(rows.select("member", F.col("content").cast("binary").alias("content")).mapInArrow(pack, "path string, members long, bytes long").where("members > 0"))


def caption_shards(spark: SparkSession, path: str | list[str], split: int = SPLIT, cut=lambda df: df.checkpoint()) -> DataFrame:
    """Caption rows from the JSON members of tar shards, with split_dir, shard, shard_member and record_index; a member that is no JSON fails the job."""
    found = members(spark, path, "[.]json$", split, part=1 << 30, cut=cut)
    row = F.from_json(F.decode("content", "utf-8"), CAPTION_SOURCE, {"mode": "FAILFAST"})
    parts = F.split("archive", "/")
    return found.select(row.alias("r"), F.element_at(parts, -2).alias("split_dir"), F.element_at(parts, -1).alias("shard"), F.col("member").alias("shard_member"), F.col("place").alias("record_index")).select("r.*", "split_dir", "shard", "shard_member", "record_index")
