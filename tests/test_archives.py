"""Archives of any size: splits, parts, damaged files."""

import hashlib
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.sources import archives


def files(rows):
    return {(os.path.basename(r["archive"]), r["member"]): (r["n"], r["size"], r["sha"]) for r in rows}


def together(df):
    parts = F.array_sort(F.collect_list(F.struct("part", F.hex("content").alias("h"))))
    whole = F.unhex(F.array_join(F.transform(parts, lambda x: x.h), ""))
    return df.groupBy("archive", "member", "size").agg(F.count(F.lit(1)).alias("n"), F.sha2(whole, 256).alias("sha"))


@pytest.mark.parametrize("split", [1, 5000, 1 << 30])
def test_members_of_every_kind(spark, tmp_path, split):
    """Long names, pax headers, empty files, folders and links; whatever the splits, each member comes once."""
    want = {}
    names = ["a.txt", "deep/" * 40 + "long.txt", "ñandú.txt", "empty.txt", "b.bin"]
    for archive, fmt in (("gnu.tar", tarfile.GNU_FORMAT), ("pax.tar", tarfile.PAX_FORMAT)):
        with tarfile.open(f"{tmp_path}/{archive}", "w", format=fmt) as tar:
            for i, name in enumerate(names):
                raw = b"" if "empty" in name else os.urandom(700 * i + 10)
                path = tmp_path / f"raw{i}"
                path.write_bytes(raw)
                tar.add(path, name)
                want[(archive, name)] = (1, len(raw), hashlib.sha256(raw).hexdigest())
            link = tarfile.TarInfo("link.txt")
            link.type, link.linkname = tarfile.SYMTYPE, "a.txt"
            tar.addfile(link)
            folder = tarfile.TarInfo("folder.txt")
            folder.type = tarfile.DIRTYPE
            tar.addfile(folder)
    with zipfile.ZipFile(f"{tmp_path}/z.zip", "w") as book:
        for i, name in enumerate(names):
            raw = b"" if "empty" in name else os.urandom(900 * i + 10)
            book.writestr(name, raw)
            want[("z.zip", name)] = (1, len(raw), hashlib.sha256(raw).hexdigest())
        book.writestr("folder.txt/", b"")
    got = archives.members(spark, str(tmp_path), split=split)
    assert files(together(got).collect()) == want
    assert sorted(r["place"] for r in got.where("archive like '%gnu.tar'").collect()) == list(range(5))
    some = archives.members(spark, str(tmp_path), "[.]bin$", split=split).select("member", "place").collect()
    assert {tuple(r) for r in some} == {("b.bin", 0)} and len(some) == 3


def test_a_member_above_64_mb_comes_in_parts(spark, tmp_path):
    raw = os.urandom(1 << 20) * 70
    (tmp_path / "big").write_bytes(raw)
    with tarfile.open(f"{tmp_path}/big.tar", "w") as tar:
        tar.add(tmp_path / "big", "big")
    with zipfile.ZipFile(f"{tmp_path}/big.zip", "w", zipfile.ZIP_STORED) as book:
        book.write(tmp_path / "big", "big")
    rows = archives.members(spark, [f"{tmp_path}/big.tar", f"{tmp_path}/big.zip"], part=16 << 20).select("archive", "part", F.length("content").alias("n"), F.sha2("content", 256).alias("sha")).collect()
    for kind in ("tar", "zip"):
        mine = sorted((r["part"], r["n"], r["sha"]) for r in rows if r["archive"].endswith(kind))
        assert mine == [(i, len(raw[i << 24 : (i + 1) << 24]), hashlib.sha256(raw[i << 24 : (i + 1) << 24]).hexdigest()) for i in range(5)]


def test_round_trip_of_hard_rows(spark, tmp_path):
    rows = [("a", bytearray(b"x")), ("a", bytearray(b"y")), ("empty", bytearray()), ("none", None)]
    df = spark.createDataFrame(rows, "member string, content binary").repartition(2)
    for kind in ("tar", "zip"):
        made = archives.write(df, f"{tmp_path}/{kind}", kind).collect()
        assert sum(r["members"] for r in made) == 4
        got = archives.members(spark, f"{tmp_path}/{kind}").collect()
        assert sorted((r["member"], bytes(r["content"])) for r in got) == [("a", b"x"), ("a", b"y"), ("empty", b""), ("none", b"")]
    assert archives.write(df.limit(0), f"{tmp_path}/nothing").count() == 0
    with pytest.raises(ValueError):
        archives.write(df, f"{tmp_path}/x", "rar")


def test_damaged_archives_fail(spark, tmp_path):
    raw = os.urandom(50_000)
    (tmp_path / "f").write_bytes(raw)
    with tarfile.open(f"{tmp_path}/x.tar", "w") as tar:
        tar.add(tmp_path / "f", "f")
    whole = (tmp_path / "x.tar").read_bytes()
    (tmp_path / "x.tar").write_bytes(whole[:20_000])
    with pytest.raises(Exception, match="ends inside|unexpected end|truncated"):
        archives.members(spark, f"{tmp_path}/x.tar").count()
