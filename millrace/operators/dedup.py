"""Keyed deduplication by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key, whole. Null keys are a key.

    An aggregate with a map side: of a key that many rows share each task sends one row.
    By one column of order, and with one of numbers or times besides, it is an aggregate by
    hash, which does not sort the rows.
    """
    if (lean := _first_by_hash(df, keys, order)) is not None:
        return lean
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.struct(F.col(o).isNotNull() if isinstance(o, str) else o.isNotNull(), F.col(o) if isinstance(o, str) else o) for o in order])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(F.lit(1), *rest), by).alias("_v"))
    return first.select(*[F.col(c) if c in keys else F.col("_v")[c].alias(c) for c in df.columns])


#: Types that an aggregate by hash can hold.
FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")


def _first_by_hash(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame | None:
    """first_wins by columns of fixed width, null where it does not apply. A null order comes first."""
    if len(order) != 1 or not isinstance(order[0], str) or order[0] not in df.columns or order[0] in keys:
        return None
    by, values = order[0], [c for c in df.columns if c not in keys and c != order[0]]
    types = dict(df.dtypes)
    if len(values) > 1 or any(types[c] not in FIXED for c in [by, *values]):
        return None
    unknown = F.col(by).isNull()
    sums = [F.count_if(unknown).alias("_unknown"), F.min(by).alias("_by")]
    for c in values:  # min_by passes over rows whose order is null
        sums += [F.min_by(c, by).alias("_first"), F.min(F.when(unknown, F.col(c))).alias("_null")]
    first = df.groupBy(*keys).agg(*sums)
    at = F.when(F.col("_unknown") == 0, F.col("_by")).alias(by)
    value = lambda c: F.when(F.col("_unknown") == 0, F.col("_first")).otherwise(F.col("_null")).alias(c)
    return first.select(*[F.col(c) if c in keys else at if c == by else value(c) for c in df.columns])


def last_wins(df: DataFrame, keys: list[str], values: list[str], order: Column | str) -> DataFrame:
    """The values of each key's last row, aggregated before the shuffle."""
    best = F.max_by(F.struct(*values), order).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, "_v.*")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, keys, duplicates) of a table."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), (F.sum("n") - F.count("*")).alias("n_duplicates"))
