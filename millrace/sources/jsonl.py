"""JSON lines: strict, multi-part and tolerant scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.dedup import first_wins

BAD = "_corrupt_record"
#: Tasks that a scan of very many small files is drawn together to.
SCAN_TASKS = 1000
#: Bytes of a file that is read whole, as a row; larger files, and those that Spark unpacks, are read in parts.
WHOLE_BYTES, PACKED = 1 << 20, r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, parts: bool = False) -> DataFrame:
    """Finished tables only (.jsonl, .jsonl.gz; with parts, Spark's .json and .json.gz ones of such a table too); a bad line fails the job."""
    ends = "jsonl,jsonl.gz,json,json.gz" if parts else "jsonl,jsonl.gz"
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", f"*.{{{ends}}}").json(path)


def read_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """Identifier pages as rows, the first of each (collection, code) in file order; blank codes go."""
    schema = "objects ARRAY<STRUCT<code: STRING, collection: STRING>>"
    pages = spark.read.schema(schema).option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("page"), "objects")
    rows = pages.select("page", F.posexplode("objects").alias("at", "o")).select("page", "at", F.coalesce("o.collection", F.lit("")).alias("collection"), F.col("o.code").alias("code")).where("coalesce(code, '') <> ''")
    return first_wins(rows, ["collection", "code"], ["page", "at"])


def read_prefixes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Of each file the lines before the first bad one; a compressed file that is cut short ends there.

    Small files are rows, each cut at its own first bad line. Lines of others are ordered by
    where their part of the file begins, then as its task reads them. Only this read skips
    what is corrupt; the session's setting stays as it is. Folders below path are read too.
    """
    full = StructType([*schema.fields, StructField(BAD, StringType())])
    parsed = lambda value: F.from_json(value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    whole = (F.col("_metadata.file_size") <= WHOLE_BYTES) & ~F.col("_metadata.file_path").rlike(PACKED)
    read = lambda form: spark.read.format(form).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).load(path)
    columns = ["file", "line", *[F.col(f"r.{f.name}") for f in schema.fields]]

    small = read("binaryFile").where(whole).select(F.col("_metadata.file_path").alias("file"), F.col("content").cast("string").alias("text")).coalesce(SCAN_TASKS)
    small = small.select("file", F.transform(F.split("text", r"\r\n|\r|\n"), lambda v: F.when(F.trim(v) != "", parsed(v))).alias("rows"))
    first = F.array_position(F.transform("rows", lambda r: F.coalesce(r[BAD].isNotNull(), F.lit(False))), True)
    small = small.select("file", F.posexplode(F.when(first > 0, F.slice("rows", F.lit(1), (first - 1).cast("int"))).otherwise(F.col("rows"))).alias("at", "r")).where(F.col("r").isNotNull())
    small = small.select("file", F.struct(F.lit(0).cast("long").alias("part"), F.col("at").cast("long").alias("row")).alias("line"), "r").select(*columns)

    at = F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))  # parts keep their ids where tasks take several
    lines = read("text").where(~whole).select(F.col("_metadata.file_path").alias("file"), at.alias("line"), "value").coalesce(SCAN_TASKS).where("trim(value) <> ''")
    rows = lines.withColumn("r", parsed("value"))
    bad = rows.where(F.col(f"r.{BAD}").isNotNull()).groupBy("file").agg(F.min("line").alias("_bad"))
    large = rows.join(bad, "file", "left").where(F.col("_bad").isNull() | (F.col("line") < F.col("_bad"))).select(*columns)
    return small.unionByName(large)


def newest(files: DataFrame) -> DataFrame:
    """The path of the newest, then longest, of files (path, modificationTime, length) that is not empty."""
    return files.where("length > 0").agg(F.max_by("path", F.struct("modificationTime", "length", "path")).alias("path"))
