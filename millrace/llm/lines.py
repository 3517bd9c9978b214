"""Lines that stand in several documents, dropped by probes of a sharded minimal perfect hash.

A line's key is the line without spaces at both ends and with A-Z in lower case. Keys of
LEAST_CHARS code points or more that at least two documents hold lose all their lines but
those in the document of the smallest doc_id.

Documents are dealt to blocks of about BLOCK_CHARS characters by a hash of id and text. A
block sends its distinct keys, once each, as 128-bit hashes with the smallest and greatest
id that holds them; a shard of the key space merges what all blocks send and builds an index
of it: a minimal perfect hash in levels of bit arrays (a key's place is the rank of the bit
that it alone hits at its level), and by place a fingerprint of 32 bits, a count of documents
that stops at 2, and the smallest id. Then it answers the blocks' probes of the same keys: for
each one found in two documents or more, its owner. Blocks apply the answers to their own
documents. No lines are joined, and a line that a third of all documents hold costs one probe
for each block. There are as many shards as keep an index at SHARD_KEYS keys or fewer, by the
number of lines counted first; a shard's task merges and answers in a stream and holds one
index. All keys are indexed, so a probe's place is always its own; fingerprints are held
against it all the same, and one that differs fails the task.

Defined results: null and empty texts are one empty line; a null doc_id counts as one
document behind all others; rows of equal ids are one document, so a line that only they hold
stays in all of them; repeated rows each give a row. A block is one task's memory; only
rows that are alike in id and text share one whatever their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, free_name, texts

LEAST_CHARS = 10
BLOCK_CHARS, SHARD_KEYS = 2 << 20, 1 << 19
#: Entries that a shard's task gathers before it merges them.
MERGE_ENTRIES = 1 << 19
#: Room of a level: bits for each key that it is to place.
ROOM, LEVELS = 2, 64

_STRIP = SPACES.encode()
_NO_ID = np.iinfo(np.int64).max
ENTRY = np.dtype([("a", "<u8"), ("b", "<u8"), ("low", "<i8"), ("high", "<i8")])
PROBE = np.dtype([("a", "<u8"), ("b", "<u8")])
ANSWER = np.dtype([("a", "<u8"), ("b", "<u8"), ("owner", "<i8")])


def line_key(line: bytes) -> bytes | None:
    """The key of a line of UTF-8, None if it is too short to count. bytes.lower() changes A-Z alone."""
    key = line.strip(_STRIP)
    if len(key) < LEAST_CHARS or (len(key) < 4 * LEAST_CHARS and len(key.decode()) < LEAST_CHARS):
        return None
    return key.lower()


def line_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _stirred(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """One hash of 64 bits for each key and level."""
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    with np.errstate(over="ignore"):
        return _stirred(_stirred(a + salt) + b)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys (a, b): places 0 to n - 1."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels, words, left_a, left_b = [], [], a, b
        for level in range(LEVELS):
            if not len(left_a):
                break
            room = 64 * (1 + ROOM * len(left_a) // 64)
            at = _mixed(left_a, left_b, level) % np.uint64(room)
            alone = np.bincount(at.astype(np.int64), minlength=room) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            self.levels.append(room)
            left = ~alone[at]
            left_a, left_b = left_a[left], left_b[left]
        if len(left_a):
            raise ValueError("keys repeat")
        self.words = np.concatenate(words) if words else np.zeros(0, "<u8")
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each key; keys that were not given have any place, or -1."""
        out, left, first = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, room in enumerate(self.levels):
            if not len(left):
                break
            at = (_mixed(a[left], b[left], level) % np.uint64(room)).astype(np.int64) + first
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.ranks[at >> 6] + below)[hit]
            left, first = left[~hit], first + room
        return out


class LineIndex:
    """Fingerprints, counts of documents (1, or 2 for more) and smallest ids, by the place of the line."""

    def __init__(self, entries: np.ndarray):
        self.hash = PerfectHash(entries["a"], entries["b"])
        at = self.hash.places(entries["a"], entries["b"])
        self.prints, self.counts, self.owners = np.empty(len(at), "<u4"), np.empty(len(at), "u1"), np.empty(len(at), "<i8")
        self.prints[at] = fingerprints(entries["a"], entries["b"])
        self.counts[at] = 1 + (entries["low"] != entries["high"])
        self.owners[at] = entries["low"]

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, smallest id) of each key."""
        at = self.hash.places(keys["a"], keys["b"])
        if len(at) and ((at < 0).any() or (self.prints[at] != fingerprints(keys["a"], keys["b"])).any()):
            raise ValueError("a line is probed that was not indexed")
        return self.counts[at], self.owners[at]


def fingerprints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a ^ (b << np.uint64(7))) >> np.uint64(32)).astype("<u4")


def merged(entries: np.ndarray) -> np.ndarray:
    """Entries with each key once, its smallest and greatest ids over all."""
    if not len(entries):
        return entries
    entries = entries[np.lexsort((entries["b"], entries["a"]))]
    first = np.flatnonzero(np.concatenate([[True], (entries["a"][1:] != entries["a"][:-1]) | (entries["b"][1:] != entries["b"][:-1])]))
    out = entries[first]
    out["low"], out["high"] = np.minimum.reduceat(entries["low"], first), np.maximum.reduceat(entries["high"], first)
    return out


def _hashes(text: bytes) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and for each its key's hash or None."""
    lines = text.split(b"\n")
    return lines, [None if (k := line_key(x)) is None else line_hash(k) for x in lines]


_SENT = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("packed", pa.binary())])
SENT = "shard bigint, kind int, block bigint, packed binary"


def _send(shards: int, most: int):
    """(block, id, text), by block, as entries (kind 0) and probes (kind 1) of each block for each shard."""

    def packed(block: int, digests: list[bytes], ids: list[int]):
        entries = np.empty(len(ids), ENTRY)
        both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        entries["a"], entries["b"], entries["low"], entries["high"] = both[:, 0], both[:, 1], ids, ids
        entries = merged(entries)
        shard = (entries["a"] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        entries, shard = entries[order], shard[order]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        rows = [(int(s[0]), e) for s, e in zip(np.split(shard, cuts), np.split(entries, cuts), strict=True)]
        probes = [np.ascontiguousarray(e[["a", "b"]]).astype(PROBE).tobytes() for _, e in rows]
        return pa.RecordBatch.from_arrays([
            pa.array([s for s, _ in rows] * 2, pa.int64()), pa.array([0] * len(rows) + [1] * len(rows), pa.int32()),
            pa.array([block] * 2 * len(rows), pa.int64()), pa.array([e.tobytes() for _, e in rows] + probes, pa.binary()),
        ], schema=_SENT)

    def run(batches):
        block, digests, ids = None, [], []
        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())]
            for at, doc, text in zip(*columns, strict=True):
                if digests and (at != block or len(digests) >= most):
                    yield packed(block, digests, ids)
                    digests, ids = [], []
                found = {h for h in _hashes(text.as_py())[1] if h is not None}
                block = at
                digests.extend(found)
                ids.extend([_NO_ID if doc is None else doc] * len(found))
        if digests:
            yield packed(block, digests, ids)

    return run


_ANSWERED = pa.schema([("block", pa.int64()), ("packed", pa.binary())])


def _answer(most: int):
    """What blocks sent, by shard and entries first, as the answers to each block: its keys that several documents hold."""
    return lambda batches: _answers(batches, most)


def _answers(batches, most: int):
    shard, index, parts, held = None, None, [], 0
    for batch in batches:
        out = []
        for at, kind, block, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if at != shard:
                shard, index, parts, held = at, None, [], 0
            if kind == 0:
                parts.append(np.frombuffer(packed, ENTRY))
                held += len(parts[-1])
                if held >= most and len(parts) > 1:
                    parts = [merged(np.concatenate(parts))]
                    held = 0  # counted anew, so that merging stays in proportion to what comes in
                continue
            if index is None:
                index, parts = LineIndex(merged(np.concatenate(parts))), []
            keys = np.frombuffer(packed, PROBE)
            counts, owners = index.probe(keys)
            shared = counts > 1
            if shared.any():
                told = np.empty(int(shared.sum()), ANSWER)
                told["a"], told["b"], told["owner"] = keys["a"][shared], keys["b"][shared], owners[shared]
                out.append((block, told.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([p for _, p in out], pa.binary())], schema=_ANSWERED)


def _apply(columns: list[str], text: str, doc_id: str):
    """A block's documents and its answers as documents with their own lines only."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        owner = {}
        for packed in answers.column("packed").to_pylist():
            told = np.frombuffer(packed, ANSWER)
            keys = np.ascontiguousarray(told[["a", "b"]]).astype(PROBE).tobytes()
            owner.update(zip((keys[i : i + 16] for i in range(0, len(keys), 16)), told["owner"].tolist(), strict=True))
        kept, n_lines, n_dropped = [], [], []
        for doc, value in zip(docs.column(doc_id).to_pylist(), docs.column(text).to_pylist(), strict=True):
            doc = _NO_ID if doc is None else doc
            lines, hashes = _hashes((value or "").encode())
            stay = [x for x, h in zip(lines, hashes, strict=True) if h is None or owner.get(h, doc) == doc]
            kept.append(b"\n".join(stay).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        out = {c: pa.array(kept, pa.string()) if c == text else docs.column(c) for c in columns}
        return pa.table([*out.values(), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*columns, "n_lines", "n_dropped"])

    return run


def sizes(docs: DataFrame, text: str) -> tuple[int, int]:
    """(blocks, shards) by one count of characters and lines, without Python."""
    value = texts(F.col(f"`{text}`"))
    lines = F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit(""))) + 1
    row = docs.agg(F.sum(F.length(value).cast("long") + 64).alias("chars"), F.sum(lines.cast("long")).alias("lines")).first()
    return 1 + (row["chars"] or 0) // BLOCK_CHARS, 1 + (row["lines"] or 0) // SHARD_KEYS


def drop_shared_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with the lines of text that a document of a smaller id holds too left out, and
    with n_lines (before) and n_dropped. Columns of docs of these names give way."""
    docs = docs.drop("n_lines", "n_dropped")
    columns, block = docs.columns, free_name("_block", docs)
    blocks, shards = sizes(docs, text)
    place = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(blocks))
    # one shuffle of the texts: what is sent and what is applied both read it
    dealt = docs.withColumn(block, place).repartition(block)
    sent = dealt.sortWithinPartitions(block).select(block, F.col(f"`{doc_id}`").cast("long").alias("doc_id"), texts(F.col(f"`{text}`")).alias("text")).mapInArrow(_send(shards, MERGE_ENTRIES), SENT)
    answers = sent.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_answer(MERGE_ENTRIES), f"`{block}` bigint, packed binary")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], "n_lines bigint, n_dropped bigint"])
    return dealt.groupBy(block).cogroup(answers.groupBy(block)).applyInArrow(_apply(columns, text, doc_id), schema)


def op12_lines(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = """
WITH l AS (
  SELECT doc_id, row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS owner, count(DISTINCT coalesce(doc_id, 9223372036854775807)) AS docs FROM k WHERE length(key) >= 10 GROUP BY key),
f AS (SELECT k.*, coalesce(docs > 1 AND k.doc_id IS DISTINCT FROM owner, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY row"""
