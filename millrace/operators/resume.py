"""Resuming and repairing: caches of finished rows, retry states, and commits of whole buckets.

State is tables: a cache of row results, the payloads that exist, retry states, plans and
manifests, all keyed by bucket and row. What a run does next is a join over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import article_key, stable_shard, stable_sub_shard
from ..functions.ladder import retry_target, retryable
from .dedup import first_wins


def valid_cache(cache: DataFrame, payloads: DataFrame, keys: list[str], has_payload: str = "has_payload") -> DataFrame:
    """Cached rows that can be used: those that need a payload must have it among payloads."""
    there = payloads.select(*keys).distinct().withColumn("_there", F.lit(True))
    return cache.join(there, keys, "left").where(~F.coalesce(F.col(has_payload), F.lit(False)) | F.col("_there")).select(*cache.columns)


def retry_states(cache: DataFrame, keys: list[str], max_retries: int, retry_cached: bool = True, status: str = "status", history: str = "retry_history") -> tuple[DataFrame, DataFrame]:
    """(rows to keep, states of rows to run again) of a cache.

    Rows whose status may be retried leave the cache where that is asked for and retries
    are allowed at all. The retries they have used are the entries of their history, one
    for a row without any, and never more than max_retries.
    """
    if not retry_cached or max_retries <= 0:
        return cache, cache.where("false").select(*keys, F.lit(0).cast("long").alias("retries_used"))
    again = retryable(F.col(status))
    entries = F.greatest(F.coalesce(F.size(history), F.lit(0)), F.lit(1))
    return cache.where(~again), cache.where(again).select(*keys, F.least(entries, F.lit(max_retries)).cast("long").alias("retries_used"))


def to_run(plan: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the plan that no cached row stands for."""
    return plan.join(cache.select(*keys), keys, "left_anti")


def overlay_cache(plan: DataFrame, cache: DataFrame, computed: DataFrame, keys: list[str]) -> DataFrame:
    """keys and status of every planned row: the cached one wins over the computed one; null where there is neither."""
    old, new = cache.select(*keys, F.col("status").alias("_old")), computed.select(*keys, F.col("status").alias("_new"))
    return plan.join(old, keys, "left").join(new, keys, "left").select(*keys, F.coalesce("_old", "_new").alias("status"))


def commit_states(results: DataFrame, done: DataFrame, bucket: list[str], force: bool = False) -> DataFrame:
    """bucket, n_rows, n_missing, state of each bucket: "done" if it was committed before
    (unless force), "commit" if all its rows are there, else "incomplete"."""
    before = done.select(*bucket).distinct().withColumn("_done", F.lit(not force))
    counts = results.groupBy(*bucket).agg(F.count("*").alias("n_rows"), F.count_if(F.col("status").isNull()).alias("n_missing"))
    state = F.when(F.col("_done"), "done").when(F.col("n_missing") == 0, "commit").otherwise("incomplete")
    return counts.join(before, bucket, "left").select(*bucket, "n_rows", "n_missing", state.alias("state"))


def repair_plan(manifest: DataFrame, bucket: list[str], status: str = "status") -> DataFrame:
    """bucket, n_targets and repair_noop of each: its rows, where none is to be repaired."""
    counts = manifest.groupBy(*bucket).agg(F.count("*").alias("n_rows"), F.count_if(retry_target(F.col(status))).alias("n_targets"))
    return counts.select(*bucket, "n_targets", F.when(F.col("n_targets") == 0, F.col("n_rows")).otherwise(F.lit(0)).alias("repair_noop"))


def repair_targets(manifest: DataFrame, order: str, most: int | None = None, status: str = "status") -> DataFrame:
    """Rows to be repaired, only the first of them where a bound is given."""
    rows = manifest.where(retry_target(F.col(status)))
    return rows.orderBy(order).limit(most) if most else rows


def mismatched(plan: DataFrame, manifest: DataFrame, bucket: list[str]) -> DataFrame:
    """Buckets whose plan and manifest differ in length, which no repair may touch."""
    count = lambda df, name: df.groupBy(*bucket).agg(F.count("*").alias(name))
    both = count(plan, "planned").join(count(manifest, "written"), bucket, "full")
    return both.where(~F.col("planned").eqNullSafe(F.col("written")))


def of_shard(rows: DataFrame, key: Column, shards: int = 1, shard: int = 0, subs: int = 1, sub: int = 0) -> DataFrame:
    """Rows whose key falls into one shard, and one sub-shard of it."""
    if shards > 1:
        rows = rows.where(stable_shard(key, shards) == shard)
    return rows.where(stable_sub_shard(key, subs) == sub) if subs > 1 else rows


def resumed(rows: DataFrame, order: list[str], **shard) -> DataFrame:
    """What an earlier run has left of a shard: the first row of each (collection, code), without blank keys and those of other shards."""
    mine = of_shard(rows, article_key(F.col("collection"), F.col("code")), **shard)
    named = mine.withColumns({c: F.coalesce(c, F.lit("")) for c in ("collection", "code")}).where("concat(collection, code) <> ''")
    return first_wins(named, ["collection", "code"], order)


def fetch_summary(selected: DataFrame, restored: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row of counts: selected, restored, fetched and written rows of a run."""
    n = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("_k", F.lit(1))
    out = n(selected, "selected").join(n(restored, "restored"), "_k").join(n(fetched, "fetched"), "_k")
    return out.select("selected", "restored", "fetched", (F.col("restored") + F.col("fetched")).alias("written"))


def barrier(done: DataFrame, shards: int, key: str = "shard") -> DataFrame:
    """One row: how many shards are done, and whether all are."""
    return done.agg(F.count_distinct(key).alias("n_done")).select("n_done", (F.col("n_done") >= shards).alias("open"))


def backoff(attempt: Column, base: float, cap: float, retry_after: Column | None = None) -> Column:
    """Seconds before the next attempt, without jitter: what the server asks for, else doubling, never above cap."""
    grown = F.lit(base) * F.pow(F.lit(2.0), attempt)
    return F.least(F.lit(cap), F.coalesce(retry_after, grown) if retry_after is not None else grown)
