"""From metadata rows to the seed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.ids import source_id
from ..functions.ladder import seed_status
from ..functions.urls import choose_fulltext
from ..operators.dedup import first_wins, last_wins
from ..sources import artifacts

#: What a seed row adds to a manifest row.
SEED_FIELDS = ("document_type", "publication_year", "publication_date", "processing_date", "preferred_lang", "fulltext_html_url", "fulltexts")


def build_seed(meta: DataFrame, order: str = "row_index", prefix: str = "corpus") -> DataFrame:
    """meta (collection, code, doi, status, html map, row_index) as the seed: the first row of
    each (collection, code), blank codes included, with its full-text choice and status."""
    rows = first_wins(meta, ["collection", "code"], [order])
    chosen = choose_fulltext(F.col("html"))
    return rows.withColumn("_c", chosen).select(
        source_id(F.col("collection"), F.col("code"), F.col("doi"), prefix).alias("source_id"), "collection", F.col("code").alias("pid"), "doi",
        F.col("_c.lang").alias("preferred_lang"), F.col("_c.url").alias("fulltext_html_url"), seed_status(F.col("status") == "ok", F.col("_c.url")).alias("status"),
    )


def load_seed(spark: SparkSession, path: str) -> DataFrame:
    """source_id and SEED_FIELDS of a seed of JSON lines, the last line of each id, whole. Lines
    whose id is no text, or empty, do not count; without a file there are no rows."""
    kinds = ", ".join(f"{c} {'variant' if c == 'fulltexts' else 'string'}" for c in SEED_FIELDS)
    if not artifacts.exists(spark, path):
        return spark.createDataFrame([], f"source_id string, {kinds}")
    rows = artifacts.numbered_rows(spark, path, f"source_id variant, {kinds}").where(F.schema_of_variant("source_id") == "STRING")
    return last_wins(rows.withColumn("source_id", F.variant_get("source_id", "$", "string")).where("source_id <> ''"), ["source_id"], list(SEED_FIELDS), "ordinal")


def enrich(rows: DataFrame, seed: DataFrame) -> DataFrame:
    """rows with the SEED_FIELDS that they lack, or have null or as an empty text, from the seed's row of their id."""
    own = {f.name: f.dataType for f in rows.schema}
    given = seed.select("source_id", *[F.col(c).alias(f"_s_{c}") for c in SEED_FIELDS])
    has = lambda c: F.nullif(c, F.lit("")) if isinstance(own[c], StringType) else F.col(c)
    # a text that stays empty is empty still
    filled = {c: F.coalesce(has(c), f"_s_{c}", c) if c in own else F.col(f"_s_{c}") for c in SEED_FIELDS}
    return rows.join(given, "source_id", "left").withColumns(filled).select(*rows.columns, *[c for c in SEED_FIELDS if c not in own])
