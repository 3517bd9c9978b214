"""Accounts of archives and repairs inside them, as the smoke test of the pipeline does it."""

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from millrace.plans import archives
from millrace.sources import tar

FIGURES = "figures array<struct<status:string,member:string>>"


def build(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def names(path):
    with tarfile.open(path) as t:
        return [(m.name, t.extractfile(m).read()) for m in t.getmembers()]


def test_accounts(spark, tmp_path):
    build(tmp_path / "data/s/a.tar", [("1/x", b"xx"), ("1/s", b"s"), ("1/f", b"old"), ("1/f", b"fffff")])
    rows = spark.createDataFrame([("1", "s/a.tar", "1/x", "1/s", [("ok", "1/f"), ("error", "1/g")]), ("2", "s/a.tar", "2/x", "1/s", None), ("3", "s/b.tar", "3/x", "3/s", [])], f"source_id string, tar_path string, xml_member string, source_member string, {FIGURES}")
    told = archives.account(spark, rows, str(tmp_path / "data"))
    per = {r["tar_path"]: r for r in told.archives.collect()}
    assert (per["s/a.tar"]["rows"], per["s/a.tar"]["members"], per["s/a.tar"]["payload_bytes"], per["s/a.tar"]["figure_bytes"], per["s/a.tar"]["tar_size_bytes"]) == (2, 5, 9, 5, (tmp_path / "data/s/a.tar").stat().st_size)
    assert (per["s/b.tar"]["rows"], per["s/b.tar"]["payload_bytes"], per["s/b.tar"]["tar_size_bytes"]) == (1, 0, 0)
    assert [(r["tar_path"], r["error"], r["member"]) for r in told.first_missing().collect()] == [("s/a.tar", "missing_member", "2/x"), ("s/b.tar", "missing_member", "3/s"), ("s/b.tar", "missing_member", "3/x"), ("s/b.tar", "missing_tar", None)]
    totals = told.totals().first()
    assert (totals["tar_files"], totals["rows"], totals["members"], totals["payload_bytes"]) == (2, 3, 7, 9)
    with pytest.raises(ValueError, match="missing_member s/a.tar 2/x"):
        archives.account(spark, rows, str(tmp_path / "data"), strict=True)
    archives.account(spark, rows.where("source_id = '1'"), str(tmp_path / "data"), strict=True)


ROWS = f"tar_path string, row int, source_member string, xml_member string, {FIGURES}, target boolean"
PAYLOADS = "tar_path string, row int, members array<struct<member:string,content:binary>>"


def test_repair_in_an_archive(spark, tmp_path):
    build(tmp_path / "d/s/0.tar", [("k/s", b"1"), ("k/x", b"22"), ("k/f", b"333"), ("stray", b"4")])
    build(tmp_path / "d/s/1.tar", [("m/s", b"1")])
    untouched = (tmp_path / "d/s/1.tar").stat().st_mtime_ns
    rows = spark.createDataFrame([("s/0.tar", 0, "k/s", "k/x", [("ok", "k/f"), ("error", None)], False), ("s/0.tar", 1, "r/s", "r/x", None, True), ("s/0.tar", 2, "k/s", None, [], False), ("s/1.tar", 0, "m/s", "", None, False)], ROWS)
    new = spark.createDataFrame([("s/0.tar", 1, [("r/s", b"{}"), ("r/x", b"<article/>")])], PAYLOADS)
    archives.repair_archives(spark, str(tmp_path / "d"), rows, new)
    assert names(tmp_path / "d/s/0.tar") == [("k/s", b"1"), ("k/x", b"22"), ("k/f", b"333"), ("r/s", b"{}"), ("r/x", b"<article/>")]
    assert (tmp_path / "d/s/1.tar").stat().st_mtime_ns == untouched
    before = names(tmp_path / "d/s/0.tar")
    lacks = rows.withColumn("xml_member", F.when(F.col("row") == 0, "k/lost").otherwise(F.col("xml_member")))
    for bad, payloads in ((lacks, new), (rows, new.where("false"))):
        with pytest.raises(Exception, match="missing rows"):
            archives.repair_archives(spark, str(tmp_path / "d"), bad, payloads)
        assert names(tmp_path / "d/s/0.tar") == before and sorted(p.name for p in (tmp_path / "d").rglob("*")) == ["0.tar", "1.tar", "s"]
    nothing = archives.repaired(spark, str(tmp_path / "d"), rows.withColumn("target", F.lit(False)), new)
    assert nothing.count() == 0
    assert {r["tar_path"] for r in tar.read_tar(spark, str(tmp_path / "d"), only=["s/1.tar"]).collect()} == {"s/1.tar"}


def test_an_account_reads_the_archives_once(spark, tmp_path):
    """What is asked of an account later comes from what it has kept."""
    build(tmp_path / "data/a.tar", [("1/x", b"xx"), ("1/s", b"s")])
    rows = spark.createDataFrame([("1", "a.tar", "1/x", "1/s", [("ok", "1/f")])], f"source_id string, tar_path string, xml_member string, source_member string, {FIGURES}")
    told = archives.account(spark, rows, str(tmp_path / "data"))
    build(tmp_path / "data/a.tar", [])
    assert sorted((r["member"], r["size_bytes"]) for r in told.members.collect()) == [("1/f", 0), ("1/s", 1), ("1/x", 2)]
    assert [r["member"] for r in told.first_missing().collect()] == ["1/f"]
