"""Mixing sources to target weights.

Every source is cut into blocks of documents, about sqrt(n) of them where it is large. What the mix takes of a
source is a run of block draws: whole passes over its blocks, each in an order of its
own, and a last partial pass. A splitting tree deals these quotas to output shards: a
node splits its quota vector between its halves by one multivariate hypergeometric
draw whose generator depends only on the seed and the node, so each leaf walks its own
path from the root and learns which draws are its own, disjoint from all others,
without any table of all shards. Rows are then ordered at random inside each shard.

Defined results: null texts have size 0; a null source is a source of its own, last in
order; sources without words get target 0; repeated rows count as rows; documents of
size 0 are placed but take no words; an empty table gives an empty mix. Extra columns
pass through; mix() replaces those named as its own, mixed_rows() keeps them all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, n_words_of, texts

#: Weights and targets are held per source; more sources than this are an error.
MAX_SOURCES = 100_000
MAX_REPEATS = 3
SHARD_WORDS = 1_000_000
#: Rows of blocks that may be sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Documents of a block in small sources; large ones have about sqrt(n) in each.
BLOCK_DOCS = 64


#: Names that mix() uses and drops from docs beforehand.
OWN = ("_size", "_src", "_row", "_block", "_draws", "_in", "_source_size", "_target")


def fill_targets(sizes: Sequence[int], weights: Sequence[float], cap: float = MAX_REPEATS, share: float = 1.0) -> list[float]:
    """Shares of sum(sizes) by weight, none above cap times its size.

    The excess goes to the others by weight, again and again, until none is above.
    """
    left, open_, out = share * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if total <= 0 or left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
        left = max(left, 0.0)
    return out


def split_range(quota: np.ndarray, shards: int, begin: int, end: int, seed: int):
    """(shard, first draw, number of draws of each source) of the leaves begin to end of the
    splitting tree. Only nodes above them are visited, each once."""
    open_ = [(0, shards, np.zeros_like(quota), quota)]
    while open_:
        lo, hi, first, rest = open_.pop()
        if hi - lo == 1:
            yield lo, first, rest
            continue
        mid = (lo + hi) // 2
        n = int(rest.sum())
        to_left = n * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(rest, to_left, method="marginals") if n else np.zeros_like(rest)
        if end > mid:
            open_.append((mid, hi, first + left, rest - left))
        if begin < mid:
            open_.append((lo, mid, first, left))


def split_quota(quota: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first draw, number of draws) of each source for one leaf of the splitting tree."""
    return next(split_range(quota, shards, shard, shard + 1, seed))[1:]


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), *, source: str = "source", text: str = "text", key: str = "doc_id", seed: int = 17, cap: int = MAX_REPEATS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """docs with _size, _source_size, _target and _draws: array<struct<pass, shard>>,
    one for each time the mix takes the row. weights repeat over the sources in code
    point order, null last.
    """
    spark, docs = docs.sparkSession, docs.drop(*OWN)
    rows = docs.withColumns(
        {
            "_size": n_words_of(texts(text)),
            "_src": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")),
            "_row": F.xxhash64(F.lit(seed), F.col(key), F.col(text)),
        }
    )
    counts = rows.groupBy("_src").agg(F.count("*").alias("_n"))
    n_blocks = F.ceil(F.least(F.sqrt("_n"), F.col("_n") / BLOCK_DOCS)).cast("long")
    if counts.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: weigh groups of sources instead")
    blocks_of = {r["_src"]: r["k"] for r in counts.select("_src", n_blocks.alias("k")).toLocalIterator()}
    order = [*sorted(x for x in blocks_of if x != "n"), *(["n"] if "n" in blocks_of else [])]
    table = F.broadcast(spark.createDataFrame([(x, blocks_of[x]) for x in order], "_src string, _k long"))  # MAX_SOURCES rows at most
    rows = rows.join(table, "_src").withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.col("_k"))).drop("_k")

    blocks = keep(rows.groupBy("_src", "_block").agg(F.sum("_size").alias("_words")), "mix-blocks")
    sizes = {r["_src"]: r["w"] for r in blocks.groupBy("_src").agg(F.sum("_words").alias("w")).toLocalIterator()}
    targets = fill_targets([sizes[x] for x in order], [weights[i % len(weights)] for i in range(len(order))], cap)
    plan = []
    for i, x in enumerate(order):
        whole = min(cap, int(targets[i] // sizes[x])) if sizes[x] else 0
        plan.append((x, i, sizes[x], targets[i], whole, targets[i] - whole * sizes[x] if whole < cap and sizes[x] else 0.0))
    plan_df = F.broadcast(spark.createDataFrame(plan, "_src string, _ix int, _source_size long, _target double, _whole int, _rest double"))  # MAX_SOURCES rows at most

    per_pass = Window.partitionBy("_src", "_pass").orderBy(F.xxhash64(F.lit(seed), "_pass", "_block"), "_block")
    draws = (
        blocks.join(plan_df, "_src")
        .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.col("_whole"))))
        .withColumn("_pos", F.row_number().over(per_pass) - 1)
        .withColumn("_before", F.sum("_words").over(per_pass.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_words"))
        .where((F.col("_pass") < F.col("_whole")) | (F.col("_before") < F.col("_rest")))
        .withColumn("_limit", F.when((F.col("_pass") == F.col("_whole")) & (F.col("_before") + F.col("_words") > F.col("_rest")), F.col("_rest") - F.col("_before")))
    )
    in_order = Window.partitionBy("_src").orderBy("_pass", "_pos")
    draws = keep(draws.withColumn("_draw", F.row_number().over(in_order) - 1).select("_src", "_ix", "_block", "_pass", "_limit", "_draw"), "mix-draws")
    quota = np.zeros(len(order), np.int64)
    for r in draws.groupBy("_ix").count().toLocalIterator():
        quota[r["_ix"]] = r["count"]
    shards = max(1, math.ceil(sum(targets) / shard_words))

    def leaves(batches):
        for ids in batches:
            if not len(ids):
                continue
            # a task's shards follow one another
            for k, first, n in split_range(quota, shards, int(ids["id"].min()), int(ids["id"].max()) + 1, seed):
                has = np.flatnonzero(n)
                yield pd.DataFrame({"_ix": has.astype("int32"), "_first": first[has], "_last": first[has] + n[has] - 1, "_shard": np.full(len(has), k, "int64")})

    dealt = (
        spark.range(shards).mapInPandas(leaves, "_ix int, _first long, _last long, _shard long")
        .withColumn("_draw", F.explode(F.sequence("_first", "_last")))
        .select("_ix", "_draw", "_shard")
    )
    taken = (
        draws.join(dealt, ["_ix", "_draw"])
        .groupBy("_src", "_block")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("_pass").alias("pass"), F.col("_shard").alias("shard"), F.col("_limit").alias("limit")))).alias("_draws"))
    )
    taken = keep(taken, "mix-taken")
    # of the block that a source's last pass ends in: documents in order while they fit, then twice the largest that
    # still does. One block of each source ends so, and only the sizes of its rows are sorted; equal rows go together
    limited = taken.select("_src", "_block", F.array_max(F.transform("_draws", lambda d: d["limit"])).alias("_limit")).where("_limit is not null")
    small = rows.select("_src", "_block", "_row", "_size").join(F.broadcast(limited), ["_src", "_block"])  # MAX_SOURCES rows at most
    small = small.groupBy("_src", "_block", "_row").agg(F.sum("_size").alias("_size"), F.first("_limit").alias("_limit"))
    block = Window.partitionBy("_src", "_block")
    in_order = block.orderBy(F.xxhash64(F.lit(seed + 1), "_row"), "_row").rowsBetween(Window.unboundedPreceding, 0)
    small = small.withColumn("_in", F.sum("_size").over(in_order) <= F.col("_limit"))
    for _ in range(2):
        small = small.withColumn("_gap", F.col("_limit") - F.coalesce(F.sum(F.when(F.col("_in"), F.col("_size"))).over(block), F.lit(0)))
        small = small.withColumn("_fits", ~F.col("_in") & (F.col("_size") > 0) & (F.col("_size") <= F.col("_gap")))
        largest = F.row_number().over(block.orderBy(F.desc("_fits"), F.desc("_size"), "_row"))
        small = small.withColumn("_in", F.col("_in") | (F.col("_fits") & (largest == 1)))
    last = keep(small.where("_in").select("_src", "_block", "_row", F.lit(True).alias("_in")), "mix-last")

    # blocks and last rows are small beside the documents: those stay where they are while the others' number allows
    sent = lambda df, n: F.broadcast(df) if n <= BROADCAST_ROWS else df
    placed = rows.join(sent(taken, sum(blocks_of.values())), ["_src", "_block"], "left")
    placed = placed.join(sent(last, last.limit(BROADCAST_ROWS + 1).count()), ["_src", "_block", "_row"], "left")
    own = F.filter("_draws", lambda d: d["limit"].isNull() | F.coalesce(F.col("_in"), F.lit(False)))
    return (
        placed.withColumn("_draws", F.transform(F.coalesce(own, F.array()), lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"))))
        .join(plan_df.select("_src", "_source_size", "_target"), "_src")
        .select(*docs.columns, "_size", "_source_size", "_target", "_draws", "_row")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each time a document is taken, dealt to output shards
    and in random order inside each. Columns: those of docs, whatever their names."""
    seed, names = options.get("seed", 17), docs.columns
    plain = {c: f"c{i}" for i, c in enumerate(names)}
    options |= {k: plain[options.get(k, v)] for k, v in (("source", "source"), ("text", "text"), ("key", "doc_id"))}
    rows = mix(docs.toDF(*plain.values()), **options).withColumn("_d", F.explode("_draws"))
    return (
        rows.repartition("_d.shard").sortWithinPartitions("_d.shard", F.xxhash64(F.lit(seed + 2), "_d.pass", "_row"), "_row")
        .select(*plain.values()).toDF(*names)
    )


def op1_mix(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.size("_draws")).alias("taken"), F.transform("_draws", lambda d: d["shard"]).alias("shards"),
    )
