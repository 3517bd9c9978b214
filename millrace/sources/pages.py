"""Identifier pages as a stream whose offset is the cursor of the harvest.

A harvest writes page after page, page_000000.json.gz and on, each with the total that the
server told. The offset of the stream is how many pages it has read; a batch is the pages
from one offset to another, a task for a few of them, and the checkpoint keeps the cursor, so
a restart reads every page once. Pages count up to the first that is not there yet; a page
without objects, or one with which as many as the total have come, is the last.
"""

from __future__ import annotations

import gzip
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_PAGE = re.compile(r"page_([0-9]+)\.json(\.gz)?")
PAGES = "page bigint, at int, collection string, code string, total bigint, records int"
_SCHEMA = pa.schema([("page", pa.int64()), ("at", pa.int32()), ("collection", pa.string()), ("code", pa.string()), ("total", pa.int64()), ("records", pa.int32())])
#: Pages of one task.
TASK_PAGES = 16


@dataclass
class Pages(InputPartition):
    paths: list[tuple[int, str]]


class PageReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def _known(self) -> dict[int, str]:
        store, root = files.FileSystem.from_uri(self.path)
        found = store.get_file_info(files.FileSelector(root, allow_not_found=True))
        return {int(m[1]): f.path for f in found if (m := _PAGE.fullmatch(f.base_name))}

    def initialOffset(self) -> dict:
        return {"next_page": 0}

    def latestOffset(self) -> dict:
        known = self._known()
        return {"next_page": next(page for page in range(len(known) + 1) if page not in known)}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        known = self._known()
        pages = [(k, known[k]) for k in range(start["next_page"], end["next_page"])]
        return [Pages(pages[i : i + TASK_PAGES]) for i in range(0, len(pages), TASK_PAGES)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        store, _ = files.FileSystem.from_uri(self.path)
        for page, path in partition.paths:
            with store.open_input_file(path) as f:
                data = f.read()
            told = json.loads(gzip.decompress(data) if path.endswith(".gz") else data)
            objects, total = told.get("objects") or [], int((told.get("meta") or {}).get("total") or 0)
            head = {"page": page, "total": total, "records": len(objects)}
            # a page without objects is a row without code, so that the end of the harvest is seen
            rows = [head | {"at": i, "collection": o.get("collection"), "code": o.get("code")} for i, o in enumerate(objects)] or [head | {"at": -1, "collection": None, "code": None}]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


class PageSource(DataSource):
    """Format "identifier_pages", for streams. Option: path."""

    @classmethod
    def name(cls) -> str:
        return "identifier_pages"

    def schema(self) -> str:
        return PAGES

    def streamReader(self, schema) -> PageReader:
        return PageReader(self.options["path"])


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """The rows of pages as a stream: page, at, collection, code, total, records."""
    spark.dataSource.register(PageSource)
    return spark.readStream.format("identifier_pages").load(path)


def cursor(rows: DataFrame) -> DataFrame:
    """One row of where a harvest stands, from the rows of its pages: next_page, next_offset
    (objects so far), reported_total (of the last page), and whether it is complete."""
    pages = rows.groupBy("page").agg(F.max("total").alias("total"), F.max("records").alias("records"))
    out = pages.agg(F.coalesce(F.max("page") + 1, F.lit(0)).alias("next_page"), F.coalesce(F.sum("records"), F.lit(0)).alias("next_offset"), F.max_by("total", "page").alias("reported_total"), F.max_by("records", "page").alias("_last"))
    done = (F.col("_last") == 0) | ((F.col("reported_total") > 0) & (F.col("next_offset") >= F.col("reported_total")))
    return out.select("next_page", "next_offset", "reported_total", F.coalesce(done, F.lit(False)).alias("complete"))
