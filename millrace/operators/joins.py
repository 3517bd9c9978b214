"""Enrichment, existence, resume and overlay joins. Spark picks the strategy by size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import last_wins

#: Buckets that an error names.
NAMED = 10


def fill_from_seed(rows: DataFrame, seed: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """Fills columns that are null or empty from the seed's last row of the key."""
    usable = seed.where((F.col(key).isNotNull()) & (F.col(key).cast("string") != ""))
    last = last_wins(usable.select(key, order, *[F.col(c).alias(f"_s_{c}") for c in columns]), [key], [f"_s_{c}" for c in columns], order)
    out = rows.join(last, key, "left")
    return out.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_s_{c}")) for c in columns}).select(*rows.columns)


def member_sizes(members: DataFrame, listing: DataFrame, keys: list[str], size: str) -> DataFrame:
    """members with size (0 where the listing lacks them) and missing."""
    known = listing.groupBy(*keys).agg(F.max(size).alias("_size"))
    return members.join(known, keys, "left").withColumn("missing", F.col("_size").isNull()).withColumn("size_bytes", F.coalesce("_size", F.lit(0))).drop("_size")


def without(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not done yet."""
    return rows.join(done.select(*keys), keys, "left_anti")


def overlay(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows that new has replaced, whole; keys that only new has are added."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def by_position(plan: DataFrame, manifest: DataFrame, bucket: list[str], at: str = "at") -> DataFrame:
    """plan and manifest joined by their place in the bucket: row k of one stands for row k of
    the other, whatever keys they hold and however often. Both need as many rows in every bucket;
    an error names buckets that differ. Columns that both have are the manifest's; the plan's get "planned_" before them."""
    count = lambda df, name: df.groupBy(*bucket).agg(F.count("*").alias(name))
    differ = count(plan, "planned").join(count(manifest, "written"), bucket, "full").where(~F.col("planned").eqNullSafe(F.col("written"))).limit(NAMED).collect()
    if differ:
        raise ValueError("plan and manifest differ in length: " + ", ".join(f"{[r[b] for b in bucket]} {r['planned']} != {r['written']}" for r in differ))
    keys = [*bucket, at]
    own = plan.select(*keys, *[F.col(c).alias(f"planned_{c}" if c in manifest.columns else c) for c in plan.columns if c not in keys])
    return manifest.join(own, keys)


def inventory(members: DataFrame, by: str, kind: Column, kinds: list[str], size: str = "size_bytes") -> DataFrame:
    """Counts and bytes of members by archive, in all and of each kind, in one aggregation."""
    sums = [F.count("*").alias("members"), F.sum(size).alias("payload_bytes")]
    for k in kinds:
        sums += [F.count_if(kind == k).alias(f"{k}_members"), F.coalesce(F.sum(F.when(kind == k, F.col(size))), F.lit(0)).alias(f"{k}_bytes")]
    return members.groupBy(by).agg(*sums)
