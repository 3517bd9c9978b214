"""Histograms and volume projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladder import ACCEPTED, INCOMPLETE
from .selection import medians

#: Sizes and counts of complete rows that an estimate tells mean and median of.
MEASURES = ("xml_bytes", "figure_bytes", "original_bytes", "figures", "rendered")


def histogram(df: DataFrame, value: Column, name: str, missing: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(value, F.lit("")), F.lit(missing)).alias(name)).agg(F.count("*").alias("n"))


def measures(rows: DataFrame) -> DataFrame:
    """Of each row whether it is complete or packaged incomplete, and the MEASURES of complete ones, else null: bad and absent
    numbers are 0, XML bytes of 0 do not count, original bytes of 0 fall back to the figures'. Columns that rows lack count as 0."""
    complete = F.coalesce(F.col("status").isin(*ACCEPTED), F.lit(False))
    number = lambda c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0).cast("bigint")) if c in rows.columns else F.lit(0).cast("bigint")
    original = F.coalesce(F.nullif(number("original_figure_bytes"), F.lit(0)), number("figure_bytes"))
    of = {"xml_bytes": F.nullif(F.greatest(number("xml_bytes"), F.lit(0)), F.lit(0)), "figure_bytes": number("figure_bytes"), "original_bytes": original, "figures": number("expected_figure_files"), "rendered": number("rendered_figure_files")}
    return rows.select(complete.alias("complete"), F.coalesce(F.col("status").isin(*INCOMPLETE), F.lit(False)).alias("incomplete"), *[F.when(complete, of[c]).alias(c) for c in MEASURES])


def estimate(rows: DataFrame, total: int) -> DataFrame:
    """One row of means, exact medians and projections to total identifiers.

    rows: status, xml_bytes, figure_bytes, original_figure_bytes, and if there are
    expected_figure_files and rendered_figure_files. Only complete rows count for sizes.
    The medians are found by counting, in a few passes over the rows.
    """
    own = measures(rows)
    out = own.agg(F.count("*").alias("sample_rows"), F.count_if("complete").alias("complete_rows"), F.count_if("incomplete").alias("incomplete_rows"), *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}_mean") for c in MEASURES])
    middle = medians(own, {c: (n or 0) for c, n in own.agg(*[F.count(c).alias(c) for c in MEASURES]).first().asDict().items()})
    out = out.withColumns({f"{c}_median": F.lit(float(middle[c] or 0)) for c in MEASURES})
    part = lambda n: F.when(F.col("sample_rows") > 0, F.col(n) / F.col("sample_rows")).otherwise(0.0)
    out = out.withColumns({"complete_fraction": part("complete_rows"), "incomplete_fraction": part("incomplete_rows")})
    out = out.withColumns({"projected_complete": F.bround(total * F.col("complete_fraction")).cast("long"), "projected_incomplete": F.bround(total * F.col("incomplete_fraction")).cast("long")})
    gb = lambda mean: F.round(total * F.col("complete_fraction") * mean / 1e9, 2)
    return out.withColumns({"projected_xml_gb": gb(F.col("xml_bytes_mean")), "projected_figure_gb": gb(F.col("figure_bytes_mean")), "projected_original_gb": gb(F.col("original_bytes_mean")), "projected_total_gb": gb(F.col("xml_bytes_mean") + F.col("figure_bytes_mean"))})
