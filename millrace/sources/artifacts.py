"""Artifacts as tables: JSON-lines and text parts written, joined, listed and chosen between."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.ladder import ACCEPTED


def counted(rows: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict[str, int | float | None]:
    """Writes rows, and returns how many were written ("rows") and the aggregates that are
    asked for, observed in the writing pass. write must run one job over what it is given."""
    told = Observation()
    write(rows.observe(told, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in metrics.items()]))
    return told.get


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists", **metrics: Column) -> dict[str, int | float | None]:
    """Compressed JSON lines; Spark's commit makes the write appear whole or not at all. Null
    fields are written. Returns the count of rows, and metrics of them, without another pass."""
    return counted(rows, lambda r: r.write.mode(mode).option("ignoreNullFields", False).option("compression", "gzip").json(path), **metrics)


def transfer_metrics(status: Column, n_bytes: Column, wait_seconds: Column) -> dict[str, Column]:
    """Metrics of the rows of a fetch to observe while they are written: bytes, seconds waited, and how they ended."""
    code = F.regexp_extract(F.coalesce(status, F.lit("")), "^xml_http_([0-9]+)$", 1)
    return {
        "bytes": F.coalesce(F.sum(n_bytes), F.lit(0)), "wait_seconds": F.coalesce(F.sum(wait_seconds), F.lit(0.0)), "longest_wait": F.max(wait_seconds),
        "http_errors": F.count_if(code != ""), "server_errors": F.count_if(code.startswith("5")), "succeeded": F.count_if(F.coalesce(status.isin(*ACCEPTED), F.lit(False))),
    }


def _text_files(path: str):
    def run(batches):
        store, root = files.FileSystem.from_uri(path)
        made, at, out, draft, n = set(), None, None, f"{root}/.{uuid.uuid4().hex}", 0

        def close():
            if out is not None:
                out.close()
                folder = f"{root}/{at}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                store.move(draft, f"{root}/{at}")

        store.create_dir(root, recursive=True)
        for batch in batches:
            names = batch.column(0)
            starts = [0, *(np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(names)] if len(names) else []
            for a, b in zip(starts, starts[1:]):
                name = names[a].as_py()
                if name != at:
                    close()
                    at, out, n = name, store.open_output_stream(draft), n + 1
                out.write(("\n".join(batch.column(1)[a:b].to_pylist()) + "\n").encode())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    return run


def write_text_files(rows: DataFrame, path: str, order: tuple[str, ...]) -> int:
    """rows (file, value and the columns of order) as text files under path, each named file and
    its lines in that order. Returns how many. A task streams its files one after the other; a
    file takes its name when it is whole. Folders hold many files each, which are far cheaper to
    write and to list than a folder for each."""
    dealt = rows.repartition("file").sortWithinPartitions("file", *order).select("file", F.coalesce("value", F.lit("")).alias("value"))
    return dealt.mapInArrow(_text_files(path), "files long").agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files")).first()["files"]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, at (number of a line in its file, from 0), ordinal (over all files in order of
    path) and value of all lines under path that are not blank.

    The lines of each part of a file that a task reads are counted, and the parts' counts
    added up: as many rows as the scan has parts. A line's number is then that of its part
    and its place in it. A task reads a part in one piece, so places are differences of
    Spark's ids, which a second scan must confirm.
    """
    text = spark.read.option("recursiveFileLookup", True).text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), "value").where(F.btrim("value", F.lit(" \t\r")) != "")
    lines = lines.withColumn("id", F.monotonically_increasing_id())
    parts = lines.groupBy("file", "part").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    starts = parts.select("file", "part", "n", "first", before(Window.partitionBy("file").orderBy("part")).alias("in_file"), before(Window.orderBy("file", "part")).alias("in_all"))
    place = F.col("id") - F.col("first")
    sure = F.when((place >= 0) & (place < F.col("n")), place).otherwise(F.raise_error(F.lit("a second scan read the files in other parts")).cast("long"))
    return lines.join(starts, ["file", "part"]).withColumn("place", sure).select("file", (F.col("in_file") + F.col("place")).alias("at"), (F.col("in_all") + F.col("place")).alias("ordinal"), "value")


def numbered_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines under path as rows with file, at and ordinal; a bad line fails the job."""
    row = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_row")
    return numbered_lines(spark, path).select("file", "at", "ordinal", row).select("file", "at", "ordinal", "_row.*")


def join_manifests(spark: SparkSession, path: str, to: str) -> int:
    """One table of lines in order of file and place. Returns how many, counted as they are written."""
    lines = numbered_lines(spark, path).orderBy("ordinal").select("value")
    return counted(lines, lambda rows: rows.write.text(to))["rows"]


def json_text(document: dict) -> str:
    """A document as compact JSON with sorted keys, one line."""
    return json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of every file under path, in order of path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256")).orderBy("path")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def choose_input(spark: SparkSession, single: str, parts: str) -> str:
    """The single table where it exists, else the folder of parts."""
    return single if exists(spark, single) else parts


def filtered(seed: DataFrame, statuses: tuple[str, ...] = ("planned_xml",)) -> DataFrame:
    """The rows of a seed that a plan asks for, by a set of statuses."""
    return seed.where(F.col("status").isin(*statuses))


def public_columns(rows: DataFrame) -> DataFrame:
    """rows without the columns that begin with an underscore."""
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def probe(seed: DataFrame, order: str, most: int, status: str = "planned_xml") -> DataFrame:
    """The first planned rows of a seed, for a trial run."""
    return filtered(seed, (status,)).orderBy(order).limit(most)
