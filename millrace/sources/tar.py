"""Tar archives as a data source and a sink.

`spark.read.format("tar")` lists the archives under a path and deals them to tasks. A task
steps from header to header by ranged reads, so a listing of names and sizes reads 512 bytes
for each member, whatever the members hold; contents are read, one member at a time, only
with option("content", True). `write.format("tar")` streams the rows of each archive, in
their order, into a file of the task's own; the files take their names when the job commits
and are deleted when it fails. A row without content is a missing one and fails the job.

Both open files through Arrow's file systems. Archives in a store that only Spark can open
are read through its binary files instead (members_of), each whole.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

_HEAD = [("tar_path", pa.string()), ("ordinal", pa.int64()), ("member", pa.string()), ("size", pa.int64()), ("is_file", pa.bool_())]
HEADERS = "tar_path string, ordinal long, member string, size long, is_file boolean"
#: Bytes of content, and members, that are handed on at once.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 10_000
#: Archives of one task, and their bytes: with content, and as headers alone.
TASK_ARCHIVES, TASK_BYTES, LISTED_BYTES = 64, 128 << 20, 1 << 30
#: Bytes read at once where headers stand close together, and bytes of members that are written at once.
AHEAD, WRITTEN_BYTES = 1 << 20, 4 << 20
#: A plain header between its name, size and checksum, and the sum of all that does not change.
_PLAIN = tarfile.TarInfo("x").tobuf()
_BEFORE, _AFTER, _REST = _PLAIN[100:124], _PLAIN[135:148], _PLAIN[156:]
_SUM = sum(_BEFORE) + sum(_AFTER) + sum(_REST) + 256
#: Missing rows that a failed write names.
NAMED = 10


def plain_header(name: str, size: int) -> bytes:
    """The header of a regular file, as tarfile writes it."""
    digits, data = b"%011o" % size, name.encode() if name.isascii() else b""
    if not 0 < len(data) <= tarfile.LENGTH_NAME or len(digits) > 11:  # needs more than one block
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf()
    return b"".join((data.ljust(100, b"\0"), _BEFORE, digits, _AFTER, b"%06o\0 " % (_SUM + sum(data) + sum(digits)), _REST))


def plain_member(block: bytes) -> tuple[str, int] | None:
    """Name and size of a regular file whose header is this one block; None for all else, which tarfile reads."""
    if block[156:157] != tarfile.REGTYPE or block[257:262] != b"ustar" or block[345] or not block[124:135].isdigit() or block[135] not in b"\0 ":
        return None
    # the bytes' sum is the low half of Adler-32, less 1; the checksum counts its own eight as blanks
    told = block[148:156]
    try:
        total = int(told.split(b"\0")[0], 8) + sum(told) - 256
        if (zlib.adler32(block) & 0xFFFF) != (total + 1) % 65521:
            return None
        return block[:100].split(b"\0", 1)[0].decode("ascii"), int(block[124:135], 8)
    except ValueError:
        return None


def members_in(source, payload: bool) -> Iterator[tuple[str, int, bool, bytes | None]]:
    """(name, size, whether it is a file, content) of each member of an open, seekable archive.

    Headers that stand close together are read many at once, those far apart one by one."""
    end = source.seek(0, io.SEEK_END)
    at, start, window, ahead = 0, 0, b"", 512
    while True:
        if at > end:
            raise tarfile.ReadError("unexpected end of data")
        if not start <= at <= start + len(window) - 512:
            ahead = min(2 * ahead, AHEAD) if at <= start + 2 * len(window) else 512
            source.seek(at)
            start, window = at, source.read(ahead)
        block = window[at - start : at - start + 512]
        plain = plain_member(block) if len(block) == 512 else None
        if plain is not None:
            name, size = plain
            data, content = at + 512, None
            if payload:
                content = window[data - start : data - start + size]
                if len(content) < size:
                    source.seek(data)
                    content = source.read(size)
                if len(content) < size:
                    raise tarfile.ReadError("unexpected end of data")
            yield name, size, True, content
            at = data + -(-size // 512) * 512
            continue
        source.seek(at)
        with tarfile.open(fileobj=source, mode="r:") as tar:
            while (m := tar.next()) is not None:
                tar.members = []
                yield m.name, m.size, m.isfile(), tar.extractfile(m).read() if payload and m.isfile() else None
                at = tar.offset
                if not tar.pax_headers:  # else they hold for all that follows
                    break
            if m is None:
                return


def batches_of(tar_path: str, source, payload: bool) -> Iterator[pa.RecordBatch]:
    """The members of an open, seekable archive as bounded batches."""
    schema = pa.schema(_HEAD + [("content", pa.binary())] * payload)
    first, size = 0, 0
    columns = [[], [], [], []]

    def batch() -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.repeat(pa.scalar(tar_path), n), pa.array(range(first, first + n), pa.int64()), *[pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.binary()))]]
        return pa.RecordBatch.from_arrays(arrays[: len(schema)], schema=schema)

    for m in members_in(source, payload):
        for column, value in zip(columns, m):
            column.append(value)
        if payload and m[3] is not None:
            size += m[1]
        if size > BATCH_BYTES or len(columns[0]) >= BATCH_ROWS:
            yield batch()
            first, size = first + len(columns[0]), 0
            columns = [[], [], [], []]
    if columns[0]:
        yield batch()


@dataclass
class Archives(InputPartition):
    """Archives of one task: (path, path below the one that is read)."""

    paths: list[tuple[str, str]]


class TarReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, only: list[str] | None = None):
        self.path, self.payload, self.only = path, payload, None if only is None else frozenset(only)

    def partitions(self) -> list[Archives]:
        store, root = files.FileSystem.from_uri(self.path)
        if store.get_file_info(root).type == files.FileType.File:
            found = [store.get_file_info(root)]
            root = root.rpartition("/")[0]
        else:
            found = store.get_file_info(files.FileSelector(root, recursive=True))
        shown = lambda p: not any(part.startswith(("_", ".")) for part in p.split("/"))
        below = sorted((f.path[len(root) :].lstrip("/"), f) for f in found if f.type == files.FileType.File and f.path.endswith(".tar"))
        out, held, most = [Archives([])], 0, TASK_BYTES if self.payload else LISTED_BYTES
        for name, f in below:
            if not shown(name) or (self.only is not None and name not in self.only):
                continue
            if len(out[-1].paths) >= TASK_ARCHIVES or (held and held + f.size > most):
                out.append(Archives([]))
                held = 0
            out[-1].paths.append((f.path, name))
            held += f.size
        return out

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = files.FileSystem.from_uri(self.path)
        for path, name in partition.paths:
            with store.open_input_file(path) as source:
                yield from batches_of(name, source, self.payload)


@dataclass
class Written(WriterCommitMessage):
    """(temporary path, path below the one that is written, members, bytes) of a task's archives."""

    archives: list[tuple[str, str, int, int]]


class TarWriter(DataSourceArrowWriter):
    """Rows (tar_path, row, member, content), those of an archive together and in the order they are to have."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, f"_temporary-{uuid.uuid4().hex}"

    def _store(self) -> tuple[files.FileSystem, str]:
        store, root = files.FileSystem.from_uri(self.path)
        return store, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._store()
        folder = f"{root}/{self.job}/{uuid.uuid4().hex}"  # an attempt's own
        store.create_dir(folder, recursive=True)
        done, missing, at, out, names = [], [], None, None, set()
        parts, held, written = [], 0, 0  # blocks that wait, their bytes, and bytes of the archive that are written

        def flush():
            nonlocal parts, held, written
            out.write(b"".join(parts))
            parts, held, written = [], 0, written + held

        def close():
            nonlocal held, written
            if out is not None:
                size = written + held + 2 * tarfile.BLOCKSIZE
                parts.append(bytes(2 * tarfile.BLOCKSIZE + -size % tarfile.RECORDSIZE))
                flush()
                out.close()
                written = 0

        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("tar_path", "row", "member", "content")]
            for name, row, member, content in zip(*(c.to_pylist() for c in columns[:3]), columns[3], strict=True):
                if member is None or not content.is_valid:
                    missing.append(f"{name}: row {row}")
                    if len(missing) >= NAMED:
                        break
                    continue
                if name != at:
                    close()
                    if name in names:
                        raise ValueError(f"the rows of {name} do not stand together")
                    names.add(name)
                    done.append([f"{folder}/{len(done)}.tar", name, 0, 0])
                    at, out, last = name, store.open_output_stream(done[-1][0]), done[-1]
                data = content.as_py()
                header, size = plain_header(member, len(data)), len(data)
                parts += header, data, bytes(-size % tarfile.BLOCKSIZE)
                held += len(header) + size + -size % tarfile.BLOCKSIZE
                last[2] += 1
                last[3] += size
                if held > WRITTEN_BYTES:
                    flush()
        close()
        if missing:
            raise ValueError(f"archives with missing rows are not written: {', '.join(missing)}")
        return Written([tuple(d) for d in done])

    def commit(self, messages: list[Written | None]) -> None:
        store, root = self._store()
        every = [a for m in messages if m is not None for a in m.archives]
        twice = [name for name, n in Counter(a[1] for a in every).items() if n > 1]
        if twice:
            raise ValueError(f"several tasks wrote {', '.join(twice[:NAMED])}")
        if not self.overwrite:
            for name in (a[1] for a in every):
                if store.get_file_info(f"{root}/{name}").type != files.FileType.NotFound:
                    raise ValueError(f"{name} exists")
        for temporary, name, _, _ in every:
            store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            store.move(temporary, f"{root}/{name}")
        store.delete_dir(f"{root}/{self.job}")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = self._store()
        if store.get_file_info(f"{root}/{self.job}").type != files.FileType.NotFound:
            store.delete_dir(f"{root}/{self.job}")


class TarSource(DataSource):
    """Format "tar". Options: path, content (whether members' bytes are read), only (a JSON list of the archives to open)."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def _content(self) -> bool:
        return str(self.options.get("content", "false")).lower() == "true"

    def schema(self) -> str:
        return HEADERS + ", content binary" * self._content()

    def reader(self, schema) -> TarReader:
        return TarReader(self.options["path"], self._content(), json.loads(self.options.get("only", "null")))

    def writer(self, schema, overwrite: bool) -> TarWriter:
        return TarWriter(self.options["path"], overwrite)


def opens(path: str) -> bool:
    """Whether tasks can open files under path themselves."""
    try:
        files.FileSystem.from_uri(path)
    except (OSError, pa.ArrowException):
        return False
    return True


def read_tar(spark: SparkSession, path: str, payload: bool = False, only: list[str] | None = None) -> DataFrame:
    """Members of all archives (*.tar) under path, or of only some, with content if payload. tar_path is the place below path."""
    if opens(path):
        spark.dataSource.register(TarSource)
        return spark.read.format("tar").option("content", payload).option("only", json.dumps(only)).load(path)
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True).load(path)
    below = whole.withColumn("path", F.substring_index("path", path.rstrip("/") + "/", -1))
    return members_of((below if only is None else below.where(F.col("path").isin(only))).select("path", "content"), payload)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """tar_path and size of the archives under path, without opening one."""
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True).load(path)
    return whole.select(F.substring_index("path", path.rstrip("/").rpartition(":")[2] + "/", -1).alias("tar_path"), F.col("length").alias("size"))


def members_of(archives: DataFrame, payload: bool = False) -> DataFrame:
    """Members of archives (path, content)."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from batches_of(path, io.BytesIO(content.as_buffer()), payload)

    return archives.mapInArrow(run, HEADERS + ", content binary" * payload)


def write_tar(rows: DataFrame, path: str, mode: str = "append", order: tuple[str, ...] = ("ordinal",)) -> None:
    """rows (tar_path, member, content and the columns of order) as archives under path, the
    members of each in that order; an archive that exists fails the job unless mode is
    "overwrite", and so does a row without member or content. An archive is one task's
    stream, never held whole."""
    rows.sparkSession.dataSource.register(TarSource)
    dealt = rows.repartition("tar_path").sortWithinPartitions("tar_path", *order)
    dealt.select("tar_path", F.col(order[0]).cast("string").alias("row"), "member", F.col("content").cast("binary").alias("content")).write.format("tar").mode(mode).save(path)


def assemble(plan: DataFrame, payloads: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to write of planned ones (keys, tar_path, row): the members that payloads (keys,
    members: array of member, content) has for each, by row and at. A planned row that payloads
    lacks stays as one without member, which the write refuses; one with no members gives none."""
    there = payloads.select(*keys, "members", F.lit(True).alias("_there"))
    rows = plan.join(there, keys, "left").withColumn("_none", F.lit(None).cast(payloads.schema["members"].dataType.elementType))
    each = F.when(F.col("_there"), F.coalesce("members", F.array().cast(payloads.schema["members"].dataType))).otherwise(F.array("_none"))
    return rows.select("tar_path", "row", F.posexplode(each).alias("at", "m")).select("tar_path", "row", "at", "m.member", "m.content")


def member_sizes(members: DataFrame) -> DataFrame:
    """Files only; of equal names in an archive the last counts."""
    return members.where("is_file").groupBy("tar_path", "member").agg(F.max_by("size", "ordinal").alias("size"))


def names(members: DataFrame) -> DataFrame:
    """tar_path and member of all members, folders and links too."""
    return members.select("tar_path", "member").distinct()


def tar_bytes(rows: DataFrame) -> DataFrame:
    """rows (tar_path, ordinal, member, content) as (tar_path, content): small archives as
    values, each built in the memory of one task; write_tar streams ones of any size to files."""

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for name, data in frame.sort_values("ordinal")[["member", "content"]].itertuples(index=False):
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame([(key[0], out.getvalue())], columns=["tar_path", "content"])

    return rows.groupBy("tar_path").applyInPandas(build, "tar_path string, content binary")
