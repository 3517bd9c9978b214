"""Document fingerprints: a quartile bucket digest.

The bytes of a text in UTF-8 are read as overlapping triplets; each triplet's hash adds
one to one of 128 buckets. The digest encodes each bucket by the quartile its count lies
in (2 bits), the text's length on a log scale, and how far the quartiles lie apart. The
difference of two digests is the sum of bucket distances and of bounded penalties for
length and quartile ratios; likeness is 1 less the difference over its largest value.

Defined results: null is the empty text; texts under 3 bytes have empty buckets; equal
texts have equal digests. Documents follow one another in descending doc_id, null ids
last, equal ids by the hash of their text; a lone document follows itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

BUCKETS = 128
#: Distance of two bucket codes; opposite quartiles count double.
CODE_STEP = 1
CODE_FAR = 6
LENGTH_MAX, RATIO_MAX = 24, 24
DIFF_MAX = BUCKETS * CODE_FAR + LENGTH_MAX + RATIO_MAX
#: Rows that a block of following documents holds.
BLOCK_ROWS = 200
#: More blocks are never made: their cuts and heads pass through the driver.
MAX_BLOCKS = 20_000
#: Stands for a null id, last in descending order.
LAST_ID = -(2**63)

_CODES = np.array([[CODE_FAR if abs(a - b) == 3 else CODE_STEP * abs(a - b) for b in range(4)] for a in range(4)], np.int64)
_MIX = np.uint32(2654435761)
_CHUNK = 1 << 22


def buckets(data: bytes) -> np.ndarray:
    """Counts of hashed byte triplets, read in pieces of bounded size."""
    out = np.zeros(BUCKETS, np.int64)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, max(len(whole) - 2, 0), _CHUNK):
        b = whole[at : at + _CHUNK + 2].astype(np.uint32)
        h = (b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))) * _MIX
        out += np.bincount(h >> np.uint32(25), minlength=BUCKETS)
    return out


def digest(text: str) -> str:
    """Hex: length code, quartile ratios, then 2 bits a bucket."""
    data = text.encode("utf-8", "surrogatepass")
    counts = buckets(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = (code.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(np.log(len(data)) / np.log(1.1))) if data else 0
    r1, r2 = (int(16 * q1 // q3) & 15, int(16 * q2 // q3) & 15) if q3 else (0, 0)
    return bytes([length, r1 << 4 | r2]).hex() + packed.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for digests as unlike as they can be."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    shifts = np.array([6, 4, 2, 0], np.uint8)
    p, q = (x[2:, None] >> shifts) & 3, (y[2:, None] >> shifts) & 3
    diff = int(_CODES[p, q].sum())
    diff += min(LENGTH_MAX, 2 * abs(int(x[0]) - int(y[0])))
    diff += min(RATIO_MAX, sum(min(d, 16 - d) for d in (abs((int(x[1]) >> s & 15) - (int(y[1]) >> s & 15)) for s in (0, 4))))
    return 1.0 - diff / DIFF_MAX


def edited(text: str, following: str) -> str:
    """text with its last third replaced by the start of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches):
    """Rows come by block and order; the last row of each block is the guest that heads the next."""
    last = None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            block, doc_id, guest, text = (batch.column(c)[i].as_py() for c in range(4))
            if last and last[0] == block and last[2]:
                continue
            now = (block, doc_id, guest, text, digest(text))
            if last and last[0] == block:
                new = edited(last[3], text)
                mark = digest(new)
                out.append((last[1], len(last[3]), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), last[4], mark, likeness(last[4], mark), likeness(last[4], now[4])))
            last = now
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in out], schema=_SCHEMA)


def following_blocks(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """docs as (_block, doc_id, _guest, text) in runs by descending doc_id.

    Each run ends with a guest, the document that heads the next run (after the last:
    the first). The cuts, MAX_BLOCKS at most, come from the ids alone, so texts are
    moved once and no global order is built.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"))
    wanted = min(MAX_BLOCKS, ids.count() // block_rows)
    cuts = np.array(sorted({*ids.agg(F.percentile_approx("_id", [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0]}), np.int64) if wanted > 1 else np.array([], np.int64)

    @F.pandas_udf("int")
    def block_of(x: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, x.to_numpy(np.int64)), dtype="int32")

    heads = sorted((r["b"], r["h"]) for r in ids.groupBy(block_of("_id").alias("b")).agg(F.max("_id").alias("h")).toLocalIterator())  # MAX_BLOCKS rows at most
    head_ids = np.array([h for _, h in heads][::-1], np.int64)  # ascending
    before = np.array([heads[i - 1][0] for i in range(len(heads))][::-1], np.int32)

    @F.pandas_udf("int")
    def guest_in(x: pd.Series) -> pd.Series:
        v = x.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(head_ids, v), len(head_ids) - 1)
        return pd.Series(np.where(head_ids[at] == v, before[at], -1), dtype="int32")

    places = F.array(F.struct(block_of("_id").alias("block"), F.lit(0).alias("guest")), F.struct(guest_in("_id").alias("block"), F.lit(1).alias("guest")))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), texts("text").alias("text"))
        .withColumn("_at", F.explode(F.filter(places, lambda p: p["block"] >= 0)))
        .select(F.col("_at.block").alias("_block"), "doc_id", F.col("_at.guest").alias("_guest"), "text", "_id")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each of docs (doc_id, text): its digest and those it is held against."""
    runs = following_blocks(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = runs.repartition("_block").sortWithinPartitions("_block", "_guest", F.desc("_id"), "_tie")
    return ordered.select("_block", "doc_id", "_guest", "text").mapInArrow(_compare, OUT)


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
