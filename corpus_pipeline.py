"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

run() applies STAGES to documents; each stage's rows are written as Parquet to the shared
folder and read again as the next one's docs. No SQL can express it: the thresholds,
links and packing are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import keep
from millrace.llm.mixing import mixed_rows
from millrace.llm.neardup import dedup_stage
from millrace.llm.packing import packing_stage
from millrace.llm.pii import pii_stage
from millrace.llm.quality import quality_stage


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs mixed by weights 1, 2, 3 over the sources; a row for each time one is taken."""
    return mixed_rows(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", dedup_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
