"""Exact order statistics of whole numbers, without sorting or gathering a column anywhere.

The place of a wanted rank is narrowed by counting: one pass counts the rows of each of
RANGES value ranges between the bounds known so far, with the least and greatest value in
each; the range that holds the rank gives the next bounds. A range of one value is the
answer. All columns and ranks are narrowed in the same pass, by partial aggregation: a task
sends at most RANGES rows for each of them, and the driver sees as many. Byte counts up to
2**40 take four passes after the first, as each divides the bounds by RANGES.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Value ranges into which a pass divides what is left.
RANGES = 1 << 10


@dataclass
class Sought:
    """A rank (from 0) of a column among its rows, between bounds (inclusive), below which some rows lie."""

    column: str
    rank: int
    low: int
    high: int
    below: int = 0

    def width(self) -> int:
        return -(-(self.high - self.low + 1) // RANGES)


def _range_of(value: Column, s: Sought) -> Column:
    """The number of the range that a value between the bounds lies in."""
    if s.high - s.low < 1 << 52:  # a double tells such differences apart
        return F.floor((value - F.lit(s.low)) / F.lit(s.width())).cast("int")
    wide = lambda x: x.cast("decimal(38,0)")
    return F.floor((wide(value) - wide(F.lit(str(s.low)))) / wide(F.lit(str(s.width())))).cast("int")


def ranked(rows: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], int]:
    """(column, rank) -> value, for ranks from 0 of whole-number columns; nulls have no rank."""
    columns = [c for c, ranks in wanted.items() if ranks]
    if not columns:
        return {}
    ends = rows.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in (("low", F.min), ("high", F.max))]).first()
    open_ = [Sought(c, r, ends[f"low_{i}"], ends[f"high_{i}"]) for i, c in enumerate(columns) for r in sorted(set(wanted[c]))]
    out = {}
    while open_:
        out |= {(s.column, s.rank): s.low for s in open_ if s.low == s.high}
        open_ = [s for s in open_ if s.low < s.high]
        if not open_:
            break
        value = lambda s: F.col(s.column).cast("long")
        # a row falls into one range of each rank that is sought between bounds around it
        falls = [F.when((value(s) >= s.low) & (value(s) <= s.high), F.struct(F.lit(k).alias("k"), _range_of(value(s), s).alias("r"), value(s).alias("v"))) for k, s in enumerate(open_)]
        each = rows.select(F.explode(F.array_compact(F.array(*falls))).alias("f")).groupBy("f.k", "f.r").agg(F.count("*").alias("n"), F.min("f.v").alias("low"), F.max("f.v").alias("high"))
        counted: dict[int, list] = {}
        for r in each.collect():  # at most RANGES rows for each rank
            counted.setdefault(r["k"], []).append(r)
        for k, s in enumerate(open_):
            for r in sorted(counted[k], key=lambda r: r["r"]):
                if s.below + r["n"] > s.rank:
                    s.low, s.high = r["low"], r["high"]
                    break
                s.below += r["n"]
            else:
                raise ValueError(f"{s.column} has no rank {s.rank}: its rows changed between passes, or there are fewer")
    return out


def medians(rows: DataFrame, counts: dict[str, int]) -> dict[str, float | None]:
    """The median of each column, given how many values it has: the middle one, or the mean of the middle two; None without values."""
    ranks = {c: sorted({(n - 1) // 2, n // 2}) if n else [] for c, n in counts.items()}
    found = ranked(rows, ranks)
    return {c: None if not n else sum(found[c, r] for r in ((n - 1) // 2, n // 2)) / 2 for c, n in counts.items()}
