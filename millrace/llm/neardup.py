"""Near-duplicates by fast similarity sketching, banding and exact verification.

A text's set is its distinct 5-word shingles, as 64-bit hashes. Its sketch has
BANDS * ROWS coordinates: in round i every shingle is placed into the bin its i-th hash
names, for as many rounds as there are coordinates, then in round T + j all go to bin j;
a bin keeps the smallest value of the first round that reached it. So every coordinate
fills, and matches of two sketches concentrate about the Jaccard similarity. Texts that
agree on all rows of a band meet in a bucket.

From buckets to components, without ever listing the pairs of a bucket:

1. Equal sets are one node, their smallest doc_id.
2. Each bucket's most central member (that of the largest buckets in all) is its pivot.
   Every other member is held against it: by size, by sketch (5.5 standard deviations
   below the threshold), then exactly on full sets. Links give components.
3. What may still be missing are links between components that share a bucket of three
   or more. For the members of such buckets, shingles that occur in two components are
   counted; a text of which too few are such shingles cannot have a link, and the rest
   meet on the rarest of their shared shingles, by size (prefix filter), and are
   verified exactly. This is complete for all buckets, whatever their size.

Chance of missing a pair at exactly 0.85: (1 - 0.85^5)^24 < 1e-6 for banding.

Defined results: null texts, and texts without words, have an empty set and no links;
null ids are never linked and their component is null; texts that share a doc_id count
as one node where they hold its set; repeated rows give repeated result rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import free_name, keep, release, slices

WORDS = 5
ROWS, BANDS = 5, 24
T = ROWS * BANDS
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Coordinates, of T, that must agree before sets are compared: 5.5 standard deviations less than 0.85 T.
LEAST_AGREEING = int(T * 0.85 - 5.5 * (T * 0.85 * 0.15) ** 0.5)
#: Ids that may be sent to every executor; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: A bucket of more members than this, and than this share of all memberships, is hot:
#: there are at most 1 / HOT_SHARE hot ones, so their pivots can go to every executor.
HOT_SIZE, HOT_SHARE = 200, 1e-5
#: Size classes of the prefix filter: so many to a factor of e.
SIZE_CLASSES = 50

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_SEEDS = np.random.default_rng(2_021).integers(0, 2**63, 2 * T + 2, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _STEPS[0]
    x = (x ^ (x >> _U(27))) * _STEPS[1]
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


#: Bytes of a text that are hashed at once, whole words; only a longer word takes more.
CHUNK = 1 << 16
_UP, _DOWN = _power_tables(CHUNK + 1)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word in order: the word as a polynomial of its lower-cased bytes."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _IS_SPACE[raw], [True])).astype(np.int8)))
    begins, ends = edge[0::2], edge[1::2]
    out, at = np.zeros(len(begins), np.uint64), 0
    while at < len(begins):
        start = begins[at]
        to = max(at + 1, int(np.searchsorted(ends, start + CHUNK, "right")))
        piece = _LOWER[raw[start : ends[to - 1]]].astype(np.uint64) + _U(1)
        up, down = (_UP, _DOWN) if len(piece) <= CHUNK else _power_tables(len(piece) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(piece * up[: len(piece)], dtype=np.uint64)))
        a, b = begins[at:to] - start, ends[at:to] - start
        out[at:to] = _mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = to
    return out


def shingle_hashes(text: bytes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = word_hashes(text)
    m = len(words)
    if not m:
        return np.zeros(0, np.uint64)
    if m < WORDS:
        return _mix((words * _STEPS[:m]).sum(dtype=np.uint64, keepdims=True) + _U(m))
    total = words[: m - 4] * _STEPS[0]
    for k in range(1, WORDS):
        total = total + words[k : m - 4 + k] * _STEPS[k]
    return np.unique(_mix(total))


def sketch(items: np.ndarray, t: int = T) -> np.ndarray:
    """The t coordinates of a set of 64-bit hashes (not empty)."""
    out, filled = np.zeros(t, np.uint64), np.zeros(t, bool)
    low, at = _U((1 << 40) - 1), 0
    while at < t and not filled.all():
        rounds = min(t - at, max(1, -(-int(t * (np.log(t) + 3)) // len(items))))
        h = _mix(items[None, :] ^ _SEEDS[at : at + rounds, None])
        bins = (h >> _U(40)) % _U(t)
        value = (np.arange(at, at + rounds, dtype=np.uint64)[:, None] << _U(40)) | (h & low)
        order = np.argsort(value, axis=None, kind="stable")
        first_bins, where = np.unique(bins.ravel()[order], return_index=True)
        new = ~filled[first_bins.astype(np.int64)]
        b = first_bins[new].astype(np.int64)
        out[b] = value.ravel()[order][where[new]]
        filled[b] = True
        at += rounds
    for j in np.flatnonzero(~filled):
        out[j] = (_U(t + j) << _U(40)) | (_mix(items ^ _SEEDS[t + j]) & low).min()
    return _mix(out)


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    return _mix((rows * _STEPS[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


SKETCHES = "doc_id long, n int, set_key binary, bands array<long>, marks binary"
_SKETCH_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("marks", pa.binary())])
SETS = "doc_id long, items array<long>"
_SET_SCHEMA = pa.schema([("doc_id", pa.int64()), ("items", pa.list_(pa.int64()))])


def _texts_of(batch):
    for i in range(batch.num_rows):
        text = batch.column(1)[i]
        yield batch.column(0)[i].as_py(), (text.as_buffer().to_pybytes() if text.is_valid else b"")


def _sketch_rows(batches):
    with np.errstate(over="ignore"):
        for batch in slices(batches):
            ids, ns, keys, bands, marks = [], [], [], [], []
            for doc_id, text in _texts_of(batch):
                items = shingle_hashes(text)
                ids.append(doc_id)
                ns.append(len(items))
                if not len(items):
                    keys.append(None), bands.append(None), marks.append(None)
                    continue
                keys.append(np.array([_mix(items ^ _SEEDS[-1]).sum(dtype=np.uint64), _mix(items ^ _SEEDS[-2]).sum(dtype=np.uint64), len(items)], np.uint64).tobytes())
                c = sketch(items)
                bands.append(band_keys(c).view(np.int64))
                marks.append(c.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())], schema=_SKETCH_SCHEMA)


def _set_rows(batches):
    with np.errstate(over="ignore"):
        for batch in slices(batches):
            ids, sets, size = [], [], 0
            for doc_id, text in _texts_of(batch):
                ids.append(doc_id)
                sets.append(shingle_hashes(text).view(np.int64))
                size += len(sets[-1])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], schema=_SET_SCHEMA)
                    ids, sets, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], schema=_SET_SCHEMA)


@F.pandas_udf(IntegerType())
def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    """Coordinates on which two sketches agree, by one byte of each."""
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, T) for s in (a, b))
    return pd.Series((x == y).sum(axis=1).astype("int32"))


def _sizes_allow(a, b):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def salted_join(pairs: DataFrame, rows: DataFrame, key: str, counted: DataFrame, hot: int) -> DataFrame:
    """pairs (a, b, ..) joined to rows by key. What more than hot pairs of counted, a written
    table, ask for is sent in as many copies as parts of hot pairs, so that no task gets all."""
    heavy = counted.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select(key, F.ceil(F.col("_n") / hot).alias("_parts"))
    heavy = F.broadcast(heavy)  # HOT_SHARE bounds them
    left = pairs.join(heavy, key, "left").withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("a", "b"), F.col("_parts"))).otherwise(F.lit(0))).drop("_parts")
    right = rows.join(heavy, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1))).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")


def links_of(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (a, b), a written table, whose full sets reach the threshold."""
    hot = max(HOT_SIZE, int(HOT_SHARE * pairs.count()))
    mark = lambda x: sketches.select(F.col("doc_id").alias(x), F.col("marks").alias(f"_m{x}"))
    near = salted_join(salted_join(pairs, mark("b"), "b", pairs, hot), mark("a"), "a", pairs, hot)
    near = keep(near.where(_agreeing("_ma", "_mb") >= LEAST_AGREEING).select("a", "b"), "near-pairs")
    full = lambda x: sets.select(F.col("doc_id").alias(x), F.col("items").alias(f"_s{x}"))
    both = salted_join(salted_join(near, full("a"), "a", near, hot), full("b"), "b", near, hot).withColumn("_i", F.size(F.array_intersect("_sa", "_sb")))
    return both.where(100 * F.col("_i") >= PERCENT * (F.size("_sa") + F.size("_sb") - F.col("_i"))).select("a", "b").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, component) of the nodes of edges (a, b): large-star and small-star by turns,
    each round a written table, until nothing changes. Groups are only ever reduced to
    their smallest member, so no node's neighbours are gathered."""
    now, last = keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None
    for _ in range(most):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        new = keep(small, "edges")
        release(now)
        now = new
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == last:
            return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
        last = sign
    raise RuntimeError("components did not settle")


def near_components(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as doc_id, n_shingles, component_id, kept, and the row's set_key."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = keep(rows.mapInArrow(_sketch_rows, SKETCHES), "sketches")
    own = every.where("n > 0 and doc_id is not null")
    classes = keep(own.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = own.join(classes, "set_key").where("doc_id = node").select("doc_id", "n", "bands", "marks").dropDuplicates(["doc_id", "n", "marks"])
    nodes = keep(nodes, "nodes")

    met = nodes.select("doc_id", "n", F.explode("bands").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = keep(met.join(shared, "key"), "buckets")
    central = met.groupBy("doc_id").agg(F.sum("size").alias("c"))
    pivots = met.join(central, "doc_id").groupBy("key").agg(F.max(F.struct("c", -F.col("doc_id"), "n")).alias("p"), F.max("size").alias("size")).select("key", "size", (-F.col("p.col2")).alias("b"), F.col("p.n").alias("_n"))
    pivots = keep(pivots, "pivots")
    hot = max(HOT_SIZE, int(HOT_SHARE * (pivots.agg(F.sum("size")).first()[0] or 0)))
    held = with_buckets(met, pivots, hot).where((F.col("doc_id") != F.col("b")) & _sizes_allow(F.col("n"), F.col("_n")))
    pairs = keep(held.select(F.col("doc_id").alias("a"), "b").distinct(), "pairs")

    wanted = keep(met.select("doc_id").distinct(), "wanted")
    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    sets = keep(rows.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi").mapInArrow(_set_rows, SETS), "sets")
    links = keep(links_of(pairs, nodes, sets), "links")
    found = keep(components(links), "components")
    more = keep(links_between(met, found, nodes, sets, hot), "links")
    if not more.isEmpty():
        found = components(links.union(more))

    of_rows = every.join(classes, "set_key", "left").join(found.withColumnRenamed("id", "node"), "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return of_rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "set_key")


def with_buckets(met: DataFrame, buckets: DataFrame, hot: int) -> DataFrame:
    """met (key, size, ..) joined to buckets (key, size, ..) by key. Members of buckets of more than
    hot stay where they are and are sent those buckets' rows; the others are dealt by key."""
    is_hot = F.col("size") > hot
    return met.where(~is_hot).join(buckets.where(~is_hot).drop("size"), "key").unionByName(met.where(is_hot).join(F.broadcast(buckets.where(is_hot).drop("size")), "key"))  # HOT_SHARE bounds them


def links_between(met: DataFrame, found: DataFrame, nodes: DataFrame, sets: DataFrame, hot: int) -> DataFrame:
    """All links between the components that meet in a bucket of three or more."""
    label = met.where("size > 2").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).select("key", "size", "doc_id", "n", "label")
    mixed = label.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("size").alias("size")).where("x != y").select("key", "size")
    open_ = keep(with_buckets(label, mixed, hot).select("doc_id", "n", "label").distinct(), "open")
    items = sets.join(open_, "doc_id").select("doc_id", "n", "label", F.explode("items").alias("h"))
    across = items.groupBy("h").agg(F.count("*").alias("df"), F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("h", "df")
    # what a text shares with other components, rarest first
    mine = items.join(across, "h").groupBy("doc_id", "n", "label").agg(F.count("*").alias("c"), F.collect_list(F.struct("df", "h")).alias("hs"))
    mine = mine.withColumn("hs", F.array_sort("hs"))
    # a link of sizes m <= n needs PERCENT / (100 + PERCENT) * (n + m) common shingles. As the smaller text of a
    # link, one stands in the class of its own size, as the larger one in those of all sizes down to PERCENT of its own
    need = lambda m: F.ceil((F.col("n") + m) * PERCENT / (100 + PERCENT))
    head = lambda least: F.slice("hs", 1, F.greatest(F.col("c") - least + 1, F.lit(0)).cast("int"))["h"]
    size_class = lambda m: F.floor(F.log(m.cast("double")) * SIZE_CLASSES).cast("int")
    smaller = mine.where(F.col("c") >= need(F.col("n"))).select("doc_id", "n", "label", size_class(F.col("n")).alias("s"), F.explode(head(need(F.col("n")))).alias("h"))
    larger = mine.where(100 * F.col("c") >= PERCENT * F.col("n")).withColumn("s", F.explode(F.sequence(size_class(F.col("n") * PERCENT / 100), size_class(F.col("n")))))
    floor = F.greatest(F.exp(F.col("s") / SIZE_CLASSES) - 1e-6 * F.col("n"), F.col("n") * PERCENT / 100)
    larger = larger.where(F.col("c") >= need(floor)).select(F.col("doc_id").alias("b"), F.col("n").alias("_n"), F.col("label").alias("_l"), "s", F.explode(head(need(floor))).alias("h"))
    smaller = keep(smaller, "prefixes")
    pairs = smaller.join(larger, ["h", "s"]).where((F.col("label") != F.col("_l")) & (F.col("n") <= F.col("_n")) & _sizes_allow(F.col("n"), F.col("_n"))).select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct()
    return links_of(keep(pairs, "pairs"), nodes, sets)


def op6_neardup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_components(docs).drop("set_key")


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that another of their component stands for.

    Texts that share a doc_id are judged apart: one of them has the id as its node, the
    others have numbers behind all ids, made from id and text. Of rows that repeat id and
    text one stays.
    """
    node, first, text = free_name("_node", docs), free_name("_first", docs), F.xxhash64(F.coalesce("text", F.lit("")))
    many = keep(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n"), F.min(text).alias(first)).where("_n > 1").select("doc_id", first), "repeated-ids")
    if many.isEmpty():
        rows = docs.withColumn(node, F.col("doc_id").cast("long")).withColumn(first, F.lit(None).cast("long"))
    else:
        behind = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        rows = docs.join(many, "doc_id", "left").withColumn(node, F.when(F.col(first) != text, behind).otherwise(F.col("doc_id").cast("long")))
    gone = near_components(rows.select(F.col(node).alias("doc_id"), "text")).where(~F.col("kept")).select(F.col("doc_id").alias(node)).distinct()
    gone = keep(gone, "gone")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rest = rows.join(F.broadcast(gone) if few else gone, node, "left_anti")
    if not many.isEmpty():
        rest = rest.where(F.col(first).isNull()).unionByName(rest.where(F.col(first).isNotNull()).dropDuplicates([node]))
    return rest.select(*docs.columns)


#: Links by a join on shingles, components by walking them.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END)) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, u.b FROM r JOIN u ON r.node = u.a),
c AS (SELECT id, min(node) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.id = d.doc_id"""
