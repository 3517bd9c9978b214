"""Tar archives as a data source and a sink: listings without contents, dialects, commits and aborts."""

import io
import os
import resource
import tarfile
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.sources import tar

ROWS = "tar_path string, ordinal int, member string, content binary"


def build(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w", format=members.pop("format", tarfile.PAX_FORMAT)) as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))


@pytest.mark.parametrize("form", [tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
def test_listing_of_dialects(spark, tmp_path, form):
    long = "d/" + "n" * 90 if form == tarfile.USTAR_FORMAT else "ü/" * 40 + "n" * 150
    build(tmp_path / "data/shard-00/sub-000.tar", {"format": form, "a": None, "a/x": b"1" * 700, long: b"", "a/y": b"22"})
    build(tmp_path / "data/shard-01/sub-000.tar", {"format": form, "b/x": b"3"})
    build(tmp_path / "data/_temporary-1/sub-000.tar", {"c/x": b"3"})
    (tmp_path / "data/note.txt").write_text("no archive")
    (tmp_path / "data/empty.tar").write_bytes(b"\0" * 10240)
    members = tar.read_tar(spark, str(tmp_path / "data"))
    assert members.columns == ["tar_path", "ordinal", "member", "size", "is_file"]
    got = sorted((r["tar_path"], r["ordinal"], r["member"], r["size"], r["is_file"]) for r in members.collect())
    assert got == [("shard-00/sub-000.tar", 0, "a", 0, False), ("shard-00/sub-000.tar", 1, "a/x", 700, True), ("shard-00/sub-000.tar", 2, long, 0, True), ("shard-00/sub-000.tar", 3, "a/y", 2, True), ("shard-01/sub-000.tar", 0, "b/x", 1, True)]
    whole = tar.read_tar(spark, str(tmp_path / "data"), payload=True)
    assert {r["member"]: None if r["content"] is None else bytes(r["content"]) for r in whole.collect()} == {"a": None, "a/x": b"1" * 700, long: b"", "a/y": b"22", "b/x": b"3"}
    one = tar.read_tar(spark, str(tmp_path / "data/shard-01/sub-000.tar"))
    assert [(r["tar_path"], r["member"]) for r in one.collect()] == [("sub-000.tar", "b/x")]


def test_a_large_archive_is_listed_without_its_bytes(spark, tmp_path):
    """3 GB of members, of which the file system stores none; the listing reads headers only."""
    (tmp_path / "d").mkdir()
    with open(tmp_path / "d/big.tar", "wb") as f:
        for i in range(3):
            info = tarfile.TarInfo(f"m{i}")
            info.size = 1 << 30
            f.write(info.tobuf())
            f.seek(info.size, os.SEEK_CUR)
        f.write(b"\0" * 1024)
    at, before = time.time(), resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss
    got = {r["member"]: r["size"] for r in tar.member_sizes(tar.read_tar(spark, str(tmp_path / "d"))).collect()}
    assert got == {f"m{i}": 1 << 30 for i in range(3)} and time.time() - at < 20
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss - before < 500_000


def test_a_damaged_archive_fails(spark, tmp_path):
    build(tmp_path / "d/cut.tar", {"a": b"1" * 5000, "b": b"2" * 5000})
    whole = (tmp_path / "d/cut.tar").read_bytes()
    (tmp_path / "d/cut.tar").write_bytes(whole[:3000])
    with pytest.raises(Exception, match="unexpected end of data"):
        tar.read_tar(spark, str(tmp_path / "d")).collect()


def test_write_and_read_back(spark, tmp_path):
    rows = spark.range(500).select(F.format_string("s/t%d.tar", F.col("id") % 7).alias("tar_path"), (1000 - F.col("id")).cast("int").alias("ordinal"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("member"), F.repeat(F.lit("y"), (F.col("id") % 90).cast("int")).alias("content"))
    tar.write_tar(rows, str(tmp_path / "o"))
    assert sorted(p.name for p in (tmp_path / "o").rglob("*")) == ["s", *[f"t{i}.tar" for i in range(7)]]
    got = tar.read_tar(spark, str(tmp_path / "o"), payload=True).orderBy("tar_path", "ordinal").collect()
    assert [(r["tar_path"], r["member"], len(r["content"])) for r in got] == [(f"s/t{k}.tar", f"m{i}", i % 90) for k in range(7) for i in range(499, -1, -1) if i % 7 == k]
    with pytest.raises(Exception, match="exists"):
        tar.write_tar(rows.where("id = 3"), str(tmp_path / "o"))
    assert len(list((tmp_path / "o").rglob("*"))) == 8
    tar.write_tar(rows.where("id = 3"), str(tmp_path / "o"), mode="overwrite")
    assert tar.read_tar(spark, str(tmp_path / "o")).where("tar_path = 's/t3.tar'").count() == 1 and len(list((tmp_path / "o").rglob("*.tar"))) == 7


def test_a_missing_row_leaves_no_file(spark, tmp_path):
    """Rows without a result are refused by the write, whichever archive they belong to; rows with no members are none."""
    plan = spark.createDataFrame([(f"b{k % 2}.tar", k) for k in range(10)], "tar_path string, row int")
    results = [(k, [(f"{k}/source", b"{}"), (f"{k}/xml", b"<a/>")] if k != 4 else []) for k in range(10)]
    schema = "row int, members array<struct<member:string,content:binary>>"
    tar.write_tar(tar.assemble(plan, spark.createDataFrame(results, schema), ["row"]), str(tmp_path / "good"), order=("row", "at"))
    got = tar.read_tar(spark, str(tmp_path / "good")).orderBy("tar_path", "ordinal").collect()
    assert [r["member"] for r in got if r["tar_path"] == "b0.tar"] == [f"{k}/{m}" for k in (0, 2, 6, 8) for m in ("source", "xml")]
    holed = tar.assemble(plan, spark.createDataFrame([r for r in results if r[0] != 7], schema), ["row"])
    with pytest.raises(Exception, match="b1.tar: row 7"):
        tar.write_tar(holed, str(tmp_path / "bad"), order=("row", "at"))
    assert list((tmp_path / "bad").rglob("*")) == []


def test_one_archive_of_two_tasks_fails(spark, tmp_path):
    spark.dataSource.register(tar.TarSource)
    rows = spark.range(4, numPartitions=2).select(F.lit("t.tar").alias("tar_path"), F.col("id").cast("string").alias("row"), F.col("id").cast("string").alias("member"), F.lit(b"x").alias("content"))
    with pytest.raises(Exception, match="several tasks wrote t.tar"):
        rows.write.format("tar").mode("append").save(str(tmp_path / "o"))
    assert list((tmp_path / "o").rglob("*")) == []


NAMES = ["a", "d/" + "n" * 98, "n" * 101, "d/" * 80 + "x", "ü/x", "", "1/2"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("size", [0, 1, 511, 8**7, 8**11 - 1, 8**11])
def test_headers_are_those_of_tarfile(name, size):
    info = tarfile.TarInfo(name)
    info.size = size
    assert tar.plain_header(name, size) == info.tobuf()


def members_of(data, payload=True):
    return list(tar.members_in(io.BytesIO(data), payload))


@pytest.mark.parametrize("form", [tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
def test_members_are_those_of_tarfile(form):
    """Plain members between others: folders, links, long names, sizes beyond eight octal digits, and headers for all that follows."""
    for globals_ in [{}, {"path": "every"}] if form == tarfile.PAX_FORMAT else [{}]:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w", format=form, pax_headers=globals_) as t:
            for i in range(3000):
                info = tarfile.TarInfo(f"d{i % 3}/" * 12 + "n" * 40 + str(i) if i % 7 == 3 else f"m{i}")
                if i % 11 == 5:
                    info.type = (tarfile.DIRTYPE, tarfile.SYMTYPE, tarfile.AREGTYPE, tarfile.LNKTYPE)[i % 4]
                    info.linkname = "m0"
                if info.isfile():
                    info.size = (i * 37) % 1500 + (200_000 if i % 500 == 0 else 0)
                t.addfile(info, io.BytesIO(bytes([i % 256]) * info.size))
        with tarfile.open(fileobj=io.BytesIO(out.getvalue())) as t:
            want = [(m.name, m.size, m.isfile(), t.extractfile(m).read() if m.isfile() else None) for m in t.getmembers()]
        assert len(want) == 3000 and members_of(out.getvalue()) == want
        assert members_of(out.getvalue(), False) == [(*m[:3], None) for m in want]


def test_a_wrong_checksum_ends_an_archive_as_in_tarfile():
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for i in range(3):
            t.addfile(tarfile.TarInfo(f"m{i}"))
    data = bytearray(out.getvalue())
    data[512] ^= 1
    assert [m[0] for m in members_of(bytes(data))] == [m.name for m in tarfile.open(fileobj=io.BytesIO(bytes(data))).getmembers()] == ["m0"]


def test_small_members_are_written_and_listed_in_bulk(tmp_path):
    """Well under the time of an object of tarfile's for each member."""
    rows, at = 30_000, time.process_time()
    names, data = [f"{i}/1" for i in range(rows)], [b"x" * (i % 50) for i in range(rows)]
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w|") as t:
        for name, content in zip(names, data):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    listed = [(m.name, m.size) for m in tarfile.open(fileobj=io.BytesIO(out.getvalue())).getmembers()]
    plain, at = time.process_time() - at, time.process_time()
    done = tar.TarWriter(str(tmp_path), False).write(iter([pa.record_batch({"tar_path": ["t.tar"] * rows, "row": ["0"] * rows, "member": names, "content": data})]))
    with open(done.archives[0][0], "rb") as f:
        got = [r for b in tar.batches_of("t.tar", f, False) for r in zip(b["member"].to_pylist(), b["size"].to_pylist())]
    assert (time.process_time() - at) * 2 < plain and got == listed
    with open(done.archives[0][0], "rb") as f:
        assert f.read() == out.getvalue()
