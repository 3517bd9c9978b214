"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids; those longer than a sequence are cut into full pieces and a
rest. Pieces are dealt by hash into blocks of about BLOCK pieces, and several islands
work on each block. An individual is a list of bins. Crossover injects some of a mate's
best-filled bins whole, removes the bins that hold the same pieces, and best-fits the
pieces this displaces, largest first: into gaps, then into new bins that one or two pieces
at a time fill best. Selection keeps fewer bins, then the fuller ones.
After each epoch every island sends its elite to the next one, by a shuffle. The best
individual of a block over its islands gives the sequences; a block ends its search when
it needs no more sequences than its tokens fill. Full pieces stand alone.

The tokenizer splits a text into words, digits and runs of signs and encodes each apart.
Here the bytes of a chunk of text are split as arrays; the distinct units of a chunk are
looked up once, and the new ones encoded once and their ids remembered, a bounded number in
each Python worker.

Defined results: null texts are empty, and an empty document is the end id alone;
repeated rows are packed as often as they occur; an empty table gives no sequences.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, slices, worker_store

SEQUENCE = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Pieces of a block; islands on it, individuals on each, epochs and generations of each.
BLOCK, ISLANDS, INDIVIDUALS, EPOCHS, GENERATIONS = 4096, 3, 3, 2, 3
#: Units whose ids a Python worker remembers from one chunk of text to the next (some 200
#: bytes each), and the bytes of a chunk.
UNITS_KEPT, CHUNK = 500_000, 1 << 20
#: The tokenizer's rule for lower-cased texts up to Latin Extended-A, which is these
#: contractions, else a run of letters, a number, or a run of signs; how tokens that end a word end.
_LETTER, _NUMBER, _SPACE = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", " \\t\\n\\x0b\\f\\r\u0085\u00a0"
SHORT, LONG, WORD_END = b"stmd", (b"re", b"ve", b"ll"), "</w>"
#: What the rule is not for: all beyond Latin Extended-A, and the letter whose lower case is two.
FOREIGN = re.compile("[^\x00-\u012f\u0131-\u017f]")
#: The kind of each character that the rule is for, and its lower case.
SPACE, LETTER, NUMBER, SIGN, WHOLE = range(5)
_LOWER = [chr(c) if FOREIGN.match(chr(c)) else chr(c).lower() for c in range(0x180)]
LOWER = np.array([*map(ord, _LOWER)], np.uint16)
KIND = np.array([next((k for k, x in ((SPACE, _SPACE), (LETTER, _LETTER), (NUMBER, _NUMBER)) if re.match(f"[{x}]", c)), SIGN) for c in _LOWER], np.uint8)
#: The same of bytes; those of characters beyond ASCII get theirs in pairs.
BYTE_LOWER, BYTE_KIND = np.arange(256, dtype=np.uint8), np.full(256, SIGN, np.uint8)
BYTE_LOWER[:128], BYTE_KIND[:128] = LOWER[:128], KIND[:128]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of texts that lie one after another in data, as UTF-8, and how many there are up to each end.

    Units are what the tokenizer's own rule splits a text into, and are encoded apart. The
    rule is applied here to words of Basic Latin to Latin Extended-A, which the tokenizer's
    normal form (NFC) leaves alone; other words, and those with special tokens, are units as
    they stand.
    """
    n = len(data)
    if not n:
        return pa.array([], pa.binary()), np.zeros(len(ends), np.int64)
    first = np.zeros(n + 1, bool)
    first[0] = first[ends] = True
    low, kind = BYTE_LOWER[data], BYTE_KIND[data]
    lead = np.flatnonzero(data >= 0xC0)
    code = (data[lead] & 31).astype(np.uint16) << 6 | data[lead + 1] & 63
    foreign = (data[lead] > 0xC5) | (code == 0x130)
    pair, code = lead[~foreign], code[~foreign]
    low[pair], low[pair + 1] = 0xC0 | LOWER[code] >> 6, 0x80 | LOWER[code] & 63
    kind[pair] = kind[pair + 1] = KIND[code]
    special = np.flatnonzero(data[:-1] == ord("<"))  # special tokens begin with <|
    if len(odd := np.concatenate([lead[foreign], special[data[special + 1] == ord("|")]])):
        white = (data == 32) | (data - np.uint8(9) < 5)  # other white space stays inside words
        word = np.cumsum(white | first[:n])
        is_odd = np.zeros(word[-1] + 1, bool)
        is_odd[word[odd]] = True
        whole = is_odd[word] & ~white
        low[whole], kind[whole] = data[whole], WHOLE
    start = first.copy()
    start[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    start[pair + 1] = False
    # contractions: where one follows a quote that begins a unit, the unit ends behind it
    quote = np.flatnonzero(data[:-1] == ord("'"))
    quote = quote[start[quote] & (kind[quote] == SIGN) & ~first[quote + 1]]
    ends_at = np.where(np.isin(low[quote + 1], list(SHORT)), quote + 2, 0)
    far = quote + 2 < n
    two = quote[far]
    for a, b in LONG:
        ends_at[far] = np.where((low[two + 1] == a) & (low[two + 2] == b) & ~first[two + 2], two + 3, ends_at[far])
    start[quote[ends_at > 0] + 1] = False
    start[ends_at[ends_at > 0]] = True
    kept = kind != SPACE
    start = start[:n] & kept
    offsets = np.append(np.flatnonzero(start[kept]), np.count_nonzero(kept)).astype(np.int32)
    units = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(low[kept])])
    return units, np.searchsorted(np.flatnonzero(start), ends)


def cuts(data: np.ndarray, most: int) -> list[int]:
    """Where to cut data into parts of about most bytes or a word: behind a space or line end."""
    out, at = [0], most
    while at < len(data):
        ends = np.flatnonzero(np.isin(data[at : at + most], (10, 32)))
        at += int(ends[0]) + 1 if len(ends) else most
        if len(ends) and at < len(data):
            out.append(at)
            at += most
    return [*out, len(data)]


class WordIds:
    """unit -> its ids as little-endian unsigned 32-bit numbers, as the tokenizer encodes it.

    Each distinct unit of a chunk of text is looked up once. New ones are learned together: a
    unit of letters ends with the one id that ends words, so many are encoded in one call and
    told apart. Units met in one chunk wait in once, those met in more are in again.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.once: dict[bytes, bytes] = {}
        self.again: dict[bytes, bytes] = {}
        # for units of lower-case letters, which no normal form changes and no rule splits, with their bytes spelled as the model's
        self.lean = Tokenizer(self.tokenizer.model)
        self.lean.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: "".join(x for x, _ in spelled.pre_tokenize_str(chr(c))) for c in range(0x80, 0x180)}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def encoded(self, unit: bytes) -> bytes:
        return array("I", self.tokenizer.encode(unit.decode(), add_special_tokens=False).ids).tobytes()

    def learn(self, units: list[bytes]) -> None:
        ascii_ = [u for u in units if u.isalpha()]
        latin = [u for u in units if not u.isascii() and (t := u.decode()).isalpha() and t.islower() and not FOREIGN.search(t)]
        if plain := ascii_ + latin:
            text = b" ".join(ascii_).decode() + " " + b" ".join(latin).decode().translate(self.spelled)
            ids = np.array(self.lean.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = [0, *((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()]
            if len(at) == len(plain) + 1:
                data = ids.tobytes()
                self.once.update((u, data[at[k] : at[k + 1]]) for k, u in enumerate(plain))
        for u in units:
            if u not in self.once:
                self.once[u] = self.encoded(u)

    def known(self, units: list[bytes]) -> list[bytes]:
        """The ids of distinct units."""
        out, new = list(map(self.again.get, units)), []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            if (ids := self.once.pop(units[k], None)) is None:
                new.append(k)
            else:
                out[k] = self.again[units[k]] = ids
        if new:
            self.learn([units[k] for k in new])
            for k in new:
                out[k] = self.once[units[k]]
        if len(self.once) + len(self.again) > UNITS_KEPT:  # those stay that were met again since the last time
            self.once, self.again = ({}, self.again) if len(self.again) <= UNITS_KEPT * 3 // 4 else (self.again, {})
        return out

    def of(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie one after another in data, and how many there are up to each end."""
        parts, counts = [np.zeros(0, "<u4")], np.zeros(len(ends), np.int64)
        at = cuts(data, CHUNK)
        for a, b in zip(at, at[1:]):
            units, upto = split(data[a:b], np.clip(ends - a, 0, b - a))
            distinct = units.dictionary_encode()
            ids = pa.array(self.known(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(distinct.indices)
            places = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 0) if len(ids) else np.zeros(1, np.int32)
            if len(ids):
                parts.append(np.frombuffer(ids.buffers()[2], "<u4", places[-1] // 4))
            counts += places[upto] // 4
        return np.concatenate(parts), counts

    def ids(self, text: bytes) -> bytes:
        return self.of(np.frombuffer(text, np.uint8), np.array([len(text)]))[0].tobytes()


def word_ids(path: str) -> WordIds:
    """The words that this Python worker knows already."""
    store = worker_store()
    if path not in store:
        store[path] = WordIds(path)
    return store[path]


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_END = np.array([END_ID], "<u4").tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts (null: empty), one text after another, and where each ends."""
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[at[0] : at[-1]], at[1:] - at[0]


def _pieces(path: str, sequence: int):
    def run(batches):
        words = word_ids(path)
        for batch in slices(batches, CHUNK):
            every, ends = words.of(*text_bytes(batch.column(1)))
            out, at = [[] for _ in _PIECES], 0
            for doc_id, row, end in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ends.tolist(), strict=True):
                ids, at = every[at:end].tobytes() + _END, end
                for k, start in enumerate(range(0, len(ids), 4 * sequence)):
                    part = ids[start : start + 4 * sequence]
                    for column, value in zip(out, (doc_id, row, k, start // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _PIECES, strict=True)], schema=_PIECES)

    return run


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """docs (doc_id, text) as pieces of at most a sequence: PIECES. row tells equal ids apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(_pieces(path, sequence), PIECES)


class Bins:
    """Bins of one individual with the room left in each, and best fit by a bit set of rooms."""

    def __init__(self, sizes: list[int], sequence: int):
        self.sizes, self.sequence = sizes, sequence
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(sequence + 1)]
        self.mask = 0

    def add_bin(self, items: list[int]) -> None:
        room = self.sequence - sum(self.sizes[i] for i in items)
        self.bins.append(items)
        self.room.append(room)
        self.by_room[room].append(len(self.bins) - 1)
        self.mask |= 1 << room

    def fit(self, item: int) -> None:
        size = self.sizes[item]
        rest = self.mask >> size
        if not rest:
            self.add_bin([item])
            return
        room = size + (rest & -rest).bit_length() - 1
        k = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        self.bins[k].append(item)
        self.room[k] = room - size
        self.by_room[room - size].append(k)
        self.mask |= 1 << (room - size)


def best_fit(sizes: list[int], sequence: int, order=None, whole: list[list[int]] = ()) -> list[list[int]]:
    """Bins that begin as whole and take the items of order (all, largest first) by best fit."""
    out = Bins(sizes, sequence)
    for items in whole:
        out.add_bin(list(items))
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]) if order is None else order:
        out.fit(i)
    return out.bins


def best_filled(sizes: list[int], sequence: int, items: list[int], whole: list[list[int]] = ()) -> list[list[int]]:
    """Bins that begin as whole and take items, largest first: what fits into whole bins goes
    there by best fit, and each new bin is filled by the one or two items that leave least room."""
    out, rest = Bins(sizes, sequence), []
    for b in whole:
        out.add_bin(list(b))
    for i in sorted(items, key=lambda i: -sizes[i]):
        if out.mask >> sizes[i]:
            out.fit(i)
        else:
            rest.append(i)
    by_size: dict[int, list[int]] = {}
    for i in rest:
        by_size.setdefault(sizes[i], []).append(i)
    mask = sum(1 << s for s in by_size)
    largest = lambda most: (mask & ((2 << most) - 1)).bit_length() - 1  # noqa: E731  size of the largest item of at most most, -1 if none

    def take(size: int) -> int:
        nonlocal mask
        item = by_size[size].pop()
        if not by_size[size]:
            del by_size[size]
            mask ^= 1 << size
        return item

    while by_size:
        size = mask.bit_length() - 1
        new, room = [take(size)], sequence - size
        while (one := largest(room)) > 0:
            best, pair = one, (one,)
            # a pair in which the larger item falls from what fits; it ends where no pair can do better
            a = one
            while a > 0 and 2 * a > best and best < room:
                b = largest(min(a, room - a))
                if b == a and len(by_size[a]) < 2:
                    b = largest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                a = largest(a - 1)
            new += [take(s) for s in pair]
            room -= best
        out.add_bin(new)
    return out.bins


def fitness(bins: list[list[int]], sizes: list[int], sequence: int) -> float:
    """Higher for fewer bins, then for bins that are fuller or emptier than the mean."""
    return -len(bins) + sum((sum(sizes[i] for i in b) / sequence) ** 2 for b in bins) / (len(bins) + 1)


def crossover(own: list[list[int]], mate: list[list[int]], sizes: list[int], sequence: int, rng) -> list[list[int]]:
    """own with some of mate's well-filled bins injected whole."""
    fill = np.array([sum(sizes[i] for i in b) for b in mate])
    best = np.argsort(-fill, kind="stable")[: max(1, len(mate) // 2)]
    injected = [mate[k] for k in rng.choice(best, max(1, len(best) // 4), replace=False)]
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in own:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    # the emptiest bins are opened too: their pieces may fill gaps elsewhere
    kept.sort(key=lambda b: -sum(sizes[i] for i in b))
    while kept and len(displaced) < len(sizes) and sum(sizes[i] for i in kept[-1]) < 0.9 * sequence:
        displaced += kept.pop()
    return best_filled(sizes, sequence, displaced, [*injected, *kept])


def encode(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def decode(code) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(code, default=-1) + 1)]
    for i, k in enumerate(code):
        out[k].append(i)
    return [b for b in out if b]


STATE = "block long, island int, sizes array<int>, codes array<array<int>>"


def _seeded(sequence: int, islands: int, individuals: int):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame.sort_values(["row", "piece"])["length"].astype(int).tolist()
        out, least = [], -(-sum(sizes) // sequence)
        every = list(range(len(sizes)))
        first = best_fit(sizes, sequence)
        if len(first) > least:
            first = min(first, best_filled(sizes, sequence, every), key=len)
        if len(first) <= least:  # no search can do better
            return pd.DataFrame([(key[0], 0, sizes, [encode(first, len(sizes))])], columns=["block", "island", "sizes", "codes"])
        for island in range(islands):
            rng, herd = np.random.default_rng([int(key[0]), island]), [first]
            for _ in range(individuals - 1):  # a random part is packed before the rest
                part = rng.random(len(sizes)) < rng.uniform(0.3, 0.7)
                early = best_filled(sizes, sequence, [i for i in every if part[i]])
                herd.append(best_filled(sizes, sequence, [i for i in every if not part[i]], early))
            out.append((key[0], island, sizes, [encode(b, len(sizes)) for b in herd]))
        return pd.DataFrame(out, columns=["block", "island", "sizes", "codes"])

    return run


def _evolved(sequence: int, islands: int, individuals: int, generations: int, epoch: int):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        sizes = [int(x) for x in frame["sizes"].iloc[0]]
        rng = np.random.default_rng([block, island, epoch])
        codes = sorted([tuple(int(x) for x in c) for codes in frame["codes"] for c in codes])
        least = -(-sum(sizes) // sequence)
        herd = sorted(((fitness(b, sizes, sequence), i, b) for i, b in enumerate(map(decode, codes))), key=lambda x: (-x[0], x[1]))
        for g in range(generations):
            if len(herd[0][2]) <= least:
                break
            for k in range(individuals):
                a, b = rng.choice(len(herd), 2, replace=len(herd) < 2)
                child = crossover(herd[min(a, k)][2], herd[b][2], sizes, sequence, rng)
                herd.append((fitness(child, sizes, sequence), len(codes) + g * individuals + k, child))
            herd = sorted(herd, key=lambda x: (-x[0], x[1]))[:individuals]
        best = [encode(b, len(sizes)) for _, _, b in herd[:individuals]]
        if len(herd[0][2]) <= least:
            return pd.DataFrame([(block, island, sizes, best[:1])], columns=["block", "island", "sizes", "codes"])
        # the elite moves to the next island
        return pd.DataFrame([(block, island, sizes, best), (block, (island + 1) % islands, sizes, best[:1])], columns=["block", "island", "sizes", "codes"])

    return run


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _placed(sequence: int):
    def run(key, parts: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        if parts.empty:
            return pd.DataFrame({c.split()[0]: [] for c in PLACED.split(", ")})
        parts = parts.sort_values(["row", "piece"]).reset_index(drop=True)
        sizes = parts["length"].astype(int).tolist()
        best = max((decode(c) for codes in states["codes"] for c in codes), key=lambda b: fitness(b, sizes, sequence))
        where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for k, b in enumerate(best):
            at = 0
            for i in b:
                where[i], offset[i] = k, at
                at += sizes[i]
        parts["sequence_id"], parts["offset"] = int(key[0]) << 24 | where, offset
        return parts[[c.split()[0] for c in PLACED.split(", ")]]

    return run


def pack(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, block: int = BLOCK) -> DataFrame:
    """docs (doc_id, text) as PLACED: where each piece lies in which sequence."""
    return pack_pieces(keep(pieces(docs, path or tokenizer_path(), sequence), "pieces"), sequence, block)


def pack_pieces(parts: DataFrame, sequence: int = SEQUENCE, block: int = BLOCK, islands: int = ISLANDS, individuals: int = INDIVIDUALS, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """PIECES, a written table, as PLACED. More islands, individuals, epochs and generations search longer."""
    full = F.col("length") == sequence
    blocks = max(1, round(parts.where(~full).count() / block))
    rest = parts.where(~full).withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
    state = rest.select("block", "row", "piece", "length").groupBy("block").applyInPandas(_seeded(sequence, islands, individuals), STATE)
    for epoch in range(epochs):
        state = state.groupBy("block", "island").applyInPandas(_evolved(sequence, islands, individuals, generations, epoch), STATE)
    state = keep(state.select("block", "codes"), "packing-islands")
    packed = rest.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(_placed(sequence), PLACED)
    # a full piece is a sequence; negative numbers keep apart from the blocks'
    alone = parts.where(full).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs.select("doc_id", "text"))
