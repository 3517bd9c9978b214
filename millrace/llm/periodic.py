"""Periodic runs of words, found by bit-parallel lags, and texts with their repeats collapsed.

Words become numbers, and the numbers of a group of documents bit planes: big integers
whose bit i is one bit of word i. A lag q shifts every plane by q, XORs it with itself and
ORs the differences, so that bit i of the result tells whether words i and i + q differ, for
all words of the group at once. ANDing the agreements with themselves at doubling shifts
leaves the places where as many of them as a run needs stand in a row. Words of different
documents have different numbers, so no stretch leaves its document.

A run is a stretch of consecutive words with smallest period q, at least LEAST words and
REPEATS * q long, that no neighbour extends. At a multiple of its period a run shows up
once more with the same bounds, and is dropped there, since lags are tried in rising order.

Documents of more than LONG words are taken alone, and only at lags at which a run can be:
a run of period q holds some window of W words, the least power of two not under q, that
recurs first exactly q words on, so lags that are no such distance have no run of three
periods or more. That changes the work and not the result.

Defined results: null and empty texts have no words and no runs; a null id changes no
result; repeated rows each give a row; documents with equal texts have equal runs. A text
of any length is read whole, in memory of some multiple of its size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, slices, texts, words_of

#: Least words of a run, and least periods in it.
LEAST, REPEATS = 24, 3
#: Words in a group of documents, and words from which a document is taken alone.
GROUP_WORDS, LONG = 1 << 16, 1 << 13

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def planes_of(numbers: np.ndarray) -> list[int]:
    """One big integer for each bit of the numbers; its bit i belongs to number i."""
    top = int(numbers.max()).bit_length() if len(numbers) else 0
    return [int.from_bytes(np.packbits((numbers >> b) & 1, bitorder="little").tobytes(), "little") for b in range(top)]


def standing(agree: int, need: int) -> int:
    """The bits from which need bits of agree in a row are set."""
    have = 1
    while agree and have < need:
        step = min(have, need - have)
        agree &= agree >> step
        have += step
    return agree


def stretches(agree: int, need: int, n: int) -> list[tuple[int, int]]:
    """(start, end) of all maximal stretches of at least need set bits among the first n."""
    found = standing(agree, need)
    if not found:
        return []
    bits = np.unpackbits(np.frombuffer(found.to_bytes((n + 7) // 8, "little"), dtype=np.uint8), bitorder="little").astype(np.int8)
    edges = np.diff(bits, prepend=0, append=0)
    return list(zip(np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) - 1 + need).tolist(), strict=True))


def runs_at(numbers: np.ndarray, lags, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with one of the lags, which rise, by start and period."""
    n, planes, seen, out = len(numbers), planes_of(numbers), set(), []
    for q in lags:
        need = max(least, repeats * q) - q
        if n - q < need:
            continue
        differ = 0
        for p in planes:
            differ |= p ^ (p >> q)
        agree = ~differ & ((1 << (n - q)) - 1)
        for start, end in stretches(agree, need, n):
            if (start, end + q) not in seen:  # else the run of a shorter period
                seen.add((start, end + q))
                out.append((start, end + q - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def likely_lags(numbers: np.ndarray, repeats: int = REPEATS) -> list[int]:
    """Lags at which a run can be, rising: distances q at which a window of the least power
    of two not under q words recurs first. Windows are numbered by doubling."""
    n, lags, window, ids = len(numbers), set(), 1, numbers.astype(np.int64)
    while window < 2 * (n // repeats) and len(ids) > 1:
        order = np.argsort(ids, kind="stable")
        same = ids[order[1:]] == ids[order[:-1]]
        gaps = (order[1:] - order[:-1])[same]
        lags.update(np.unique(gaps[(gaps <= min(window, n // repeats)) & (2 * gaps > window)]).tolist())
        if not same.any():
            break
        pairs = ids[:-window] * (int(ids.max()) + 1) + ids[window:] if len(ids) > window else ids[:0]
        ids = np.unique(pairs, return_inverse=True)[1]
        window *= 2
    return sorted(lags)


def numbered(words: list[bytes], first: int = 0) -> np.ndarray:
    """A number for each word, equal for equal ones, from first on."""
    place = {w: i for i, w in enumerate(dict.fromkeys(words), first)}
    return np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def runs_of(documents: list[list[bytes]], least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some documents, given as lists of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    group, held = [], 0

    def flush():
        starts = np.cumsum([0] + [len(documents[k]) for k in group])
        numbers, first = [], 0
        for k in group:
            numbers.append(numbered(documents[k], first))
            first = int(numbers[-1].max()) + 1
        for start, length, period in runs_at(np.concatenate(numbers), range(1, len(documents[group[-1]]) // repeats + 1), least, repeats):
            at = int(np.searchsorted(starts, start, "right")) - 1
            out[group[at]].append((start - int(starts[at]), length, period))

    for k in sorted((k for k, d in enumerate(documents) if len(d) >= least), key=lambda k: len(documents[k])):
        if len(documents[k]) > LONG:
            numbers = numbered(documents[k])
            lags = likely_lags(numbers, repeats) if repeats >= 3 else range(1, len(numbers) // repeats + 1)
            out[k] = runs_at(numbers, lags, least, repeats)
            continue
        if group and held + len(documents[k]) > GROUP_WORDS:
            flush()
            group, held = [], 0
        group.append(k)
        held += len(documents[k])
    if group:
        flush()
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        mark[start + period] += 1
        mark[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0)])


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first, then the one of the least period."""
    best = None
    for r in runs:  # by start and period, so that only a greater one replaces
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _find(least: int, repeats: int, digests: bool):
    def run(batches):
        for batch in slices(batches):
            # bytes.split() parts at [\x20\x09-\x0D] and at nothing else
            words = [t.split() for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            runs = runs_of(words, least, repeats)
            whole = [collapsed(w, r) for w, r in zip(words, runs, strict=True)]
            best = [best_run(r) for r in runs]
            told = pa.array([hashlib.sha256(c).hexdigest() for c in whole]) if digests else pa.array([c.decode() for c in whole], pa.string())
            columns = [
                pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs], pa.list_(_RUN)),
                pa.array([None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in best], _RUN), told,
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "runs", "best", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS, digests: bool = False) -> DataFrame:
    """docs without text, with runs (array of start, length, period in words), best (the run
    with the greatest length / period, null for none) and collapsed (the text without
    repeated periods, or its SHA-256 if digests). Columns of docs of these names give way."""
    rest = [c for c in docs.columns if c not in (text, "runs", "best", "collapsed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], texts(F.col(f"`{text}`")).alias(free_name("_text", docs)))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    run = RUNS[len("array<") : -1]
    return rows.mapInArrow(_find(least, repeats, digests), f"{kept}{', ' if kept else ''}runs {RUNS}, best {run}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document, by the CRC-32 of its decimal id, with a periodic tail: from word
    a on, word i is word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda bounds: F.array_join(F.concat(F.slice(words, 1, bounds["a"].cast("int")), F.transform(F.sequence(F.lit(0).cast("long"), n - 1 - bounds["a"]), lambda i: F.get(words, (bounds["a"] + F.pmod(i, bounds["p"])).cast("int")))), " ")
        return F.when(n > 0, let(F.struct(a.alias("a"), p.alias("p")), place)).otherwise("")

    return F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text)


def op13_periodic(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", planted(F.col("doc_id"), texts("text")).alias("text"))
    found = periodic_runs(docs, digests=True)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )
