"""The work plan: deterministic buckets of the seed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import padded, stable_shard, stable_sub_shard


def with_buckets(seed: DataFrame, shards: int, subs: int, key: str = "source_id") -> DataFrame:
    """seed with planned_shard and planned_subtar, by two independent hashes of the key."""
    return seed.withColumns({
        "planned_shard": padded(stable_shard(F.col(key), shards), max(2, len(str(shards - 1)))),
        "planned_subtar": padded(stable_shard(F.concat(F.col(key), F.lit("|sub")), subs), max(3, len(str(subs - 1)))),
    })


def sub_count(rows: int, shards: int, per_subtar: int) -> int:
    return max(1, -(-rows // (shards * per_subtar)))


def sub_counts(seed: DataFrame, shards: int, per_subtar: int) -> DataFrame:
    """One row: subs, the sub-shards that a seed's rows need."""
    return seed.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(shards * per_subtar))).cast("long").alias("subs"))


def bucket_counts(plan: DataFrame, shards: int, subs: int) -> DataFrame:
    """Rows of every bucket, empty ones too; there are shards * subs of them."""
    spark = plan.sparkSession
    every = spark.range(shards * subs).select(
        padded(F.floor(F.col("id") / subs), max(2, len(str(shards - 1)))).alias("planned_shard"),
        padded(F.pmod("id", F.lit(subs)), max(3, len(str(subs - 1)))).alias("planned_subtar"),
    )
    counts = plan.groupBy("planned_shard", "planned_subtar").agg(F.count("*").alias("n"))
    return every.join(counts, ["planned_shard", "planned_subtar"], "left").select("planned_shard", "planned_subtar", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def plan_meta(plan: DataFrame, shards: int, subs: int, per_subtar: int) -> DataFrame:
    """One row that describes a written plan: its shape, rows of every shard, and plans, empty ones too."""
    counts = bucket_counts(plan, shards, subs).groupBy("planned_shard").agg(F.sum("n").alias("n"))
    every = F.transform(F.array_sort(F.collect_list(F.struct("planned_shard", "n"))), lambda s: s["n"])  # as many as shards
    return counts.agg(
        F.lit(shards).alias("n_shards"), F.lit(subs).alias("sub_count_per_shard"), F.lit(per_subtar).alias("articles_per_subtar_target"), F.lit(max(2, len(str(shards - 1)))).alias("pad_shard"),
        F.lit(max(3, len(str(subs - 1)))).alias("pad_sub"), F.sum("n").alias("total_articles"), F.lit(shards * subs).alias("plans_written"), every.alias("shard_article_counts"),
    )


def write_plan(plan: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder for each bucket, rows in order of the key."""
    plan.repartition("planned_shard", "planned_subtar").sortWithinPartitions("planned_shard", "planned_subtar", "source_id").write.mode(mode).partitionBy("planned_shard", "planned_subtar").json(path, compression="gzip")


def write_by_shard(rows: DataFrame, path: str, key: Column, shards: int, subs: int = 1, mode: str = "errorifexists") -> None:
    """rows as Parquet with a folder for each shard and sub-shard of key, so that a shard's run
    opens its own files only. Files are as many as Spark's partitions times the shards in them."""
    dealt = rows.withColumns({"shard": stable_shard(key, shards), "sub": stable_sub_shard(key, subs)})
    dealt.repartition("shard", "sub").write.mode(mode).partitionBy("shard", "sub").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int, sub: int | None = None) -> DataFrame:
    """What write_by_shard() has dealt to a shard, or to one sub-shard of it; a filter of folders, not of rows."""
    rows = spark.read.parquet(path).where(F.col("shard") == shard)
    return (rows if sub is None else rows.where(F.col("sub") == sub)).drop("shard", "sub")
