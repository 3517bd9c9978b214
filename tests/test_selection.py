"""Exact ranks and medians against sorted lists: ties, extremes, nulls, hot values, bounded collects."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import selection, stats


def lists():
    rng = random.Random(4)
    return {
        "ties": [rng.randrange(5) for _ in range(999)],
        "even": [10, 20, 30, 41],
        "one": [7],
        "hot": [3] * 700 + [rng.randrange(10**9) for _ in range(300)],
        "heavy": [int(10 ** (rng.random() * 18)) for _ in range(1000)],
        "extremes": [-(2**63), 2**63 - 1, 0, 1, -1, 2**62, -(2**62)],
        "close": [2**60 + k for k in range(501)] + [-(2**61)],
        "nulls": [None, 5, None, 9, 1],
        "none": [None, None],
    }


@pytest.mark.parametrize("ranges", [16, 1 << 10])
def test_every_rank(spark, monkeypatch, ranges):
    monkeypatch.setattr(selection, "RANGES", ranges)
    every = lists()
    for names in (["ties", "even", "one"], ["hot", "heavy"], ["extremes", "close", "nulls", "none"]):
        size = max(len(every[n]) for n in names)
        rows = spark.createDataFrame([tuple(every[n][k] if k < len(every[n]) else None for n in names) for k in range(size)], ", ".join(f"{n} long" for n in names))
        given = {n: sorted(v for v in every[n] if v is not None) for n in names}
        wanted = {n: sorted({0, len(v) // 3, len(v) // 2, len(v) - 1}) if v else [] for n, v in given.items()}
        got = selection.ranked(rows, wanted)
        assert got == {(n, r): given[n][r] for n in names for r in wanted[n]}
        exact = {n: None if not v else (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 for n, v in given.items()}
        assert selection.medians(rows, {n: len(v) for n, v in given.items()}) == exact


def test_passes_are_few_and_small(spark, monkeypatch):
    rows, seen = spark.range(100_000).select((F.col("id") * 7919 % 100_003 * 1_000_003).alias("v")), []
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: seen.append(len(out := collect(self))) or out)
    assert selection.medians(rows, {"v": 100_000})["v"] == statistics.median(sorted(k * 7919 % 100_003 * 1_000_003 for k in range(100_000)))
    passes = [n for n in seen if n > 1]
    assert len(passes) <= 4 and max(passes) <= 2 * selection.RANGES


def test_a_rank_that_is_not_there(spark):
    with pytest.raises(ValueError, match="no rank"):
        selection.ranked(spark.createDataFrame([(1,), (2,)], "v long"), {"v": [2]})


def test_estimate(spark):
    schema = "status string, xml_bytes string, figure_bytes long, original_figure_bytes long, expected_figure_files int, rendered_figure_files int"
    rows = [("ok", "100", 10, 0, 2, 1), ("ok", "0", None, 50, None, None), ("no_figures", "x", 30, None, 0, 0), ("partial_figures", "9", 9, 9, 9, 9), (None, "5", 5, 5, 5, 5)]
    got = stats.estimate(spark.createDataFrame(rows, schema), 1_000_000_000).first().asDict()
    assert (got["sample_rows"], got["complete_rows"], got["incomplete_rows"], got["projected_complete"], got["projected_incomplete"]) == (5, 3, 1, 600_000_000, 200_000_000)
    assert (got["xml_bytes_mean"], got["xml_bytes_median"], got["figure_bytes_median"], got["original_bytes_median"], got["figures_median"], got["rendered_median"]) == (100, 100, 10, 30, 0, 0)
    assert (got["projected_xml_gb"], got["projected_figure_gb"], got["projected_original_gb"], got["projected_total_gb"]) == (60.0, 8.0, 18.0, 68.0)
    none = stats.estimate(spark.createDataFrame([], "status string, xml_bytes long, figure_bytes long"), 10).first().asDict()
    assert none["sample_rows"] == 0 and none["xml_bytes_median"] == 0.0 and none["projected_total_gb"] == 0.0
