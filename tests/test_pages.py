"""The stream of identifier pages: each page once over restarts, gaps, the end of a harvest; tables dealt to shards."""

import gzip
import json

from pyspark.sql import functions as F

from millrace.functions.ids import stable_shard, stable_sub_shard
from millrace.plans import shards
from millrace.sources import pages


def page(path, k, codes, total, packed=True):
    path.mkdir(exist_ok=True)
    data = json.dumps({"meta": {"total": total}, "objects": [{"code": c, "collection": "x"} for c in codes]}).encode()
    (path / (f"page_{k:06d}.json" + ".gz" * packed)).write_bytes(gzip.compress(data) if packed else data)


def run(spark, tmp_path):
    q = pages.stream_pages(spark, str(tmp_path / "raw")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(60)
    rows = spark.read.schema(pages.PAGES).parquet(str(tmp_path / "out"))
    return sorted((r["page"], r["at"], r["code"]) for r in rows.collect()), pages.cursor(rows).first().asDict()


def test_every_page_once(spark, tmp_path):
    raw = tmp_path / "raw"
    for k in range(5):
        page(raw, k, [f"c{k}{i}" for i in range(3)], 24, packed=k % 2 == 0)
    page(raw, 6, ["later"], 24)
    (raw / "page_000005.json.gz.tmp.17").write_text("not a page")
    got, at = run(spark, tmp_path)
    assert got == [(k, i, f"c{k}{i}") for k in range(5) for i in range(3)]  # up to the gap
    assert at == {"next_page": 5, "next_offset": 15, "reported_total": 24, "complete": False}
    assert run(spark, tmp_path)[0] == got  # nothing new, nothing again
    page(raw, 5, ["a", "b"], 24)
    page(raw, 7, [], 24)
    more, at = run(spark, tmp_path)
    assert more == sorted(got + [(5, 0, "a"), (5, 1, "b"), (6, 0, "later"), (7, -1, None)])
    assert at == {"next_page": 8, "next_offset": 18, "reported_total": 24, "complete": True}  # an empty page ends it


def test_the_total_ends_a_harvest(spark, tmp_path):
    page(tmp_path / "raw", 0, ["a", "b"], 3)
    page(tmp_path / "raw", 1, ["c"], 3)
    assert run(spark, tmp_path)[1] == {"next_page": 2, "next_offset": 3, "reported_total": 3, "complete": True}
    none = pages.cursor(spark.createDataFrame([], pages.PAGES)).first().asDict()
    assert none == {"next_page": 0, "next_offset": 0, "reported_total": None, "complete": False}


def test_shards_are_folders(spark, tmp_path):
    rows, key = spark.range(500).select(F.col("id"), F.col("id").cast("string").alias("key")), F.col("key")
    shards.write_by_shard(rows, str(tmp_path / "t"), key, 8, 3)
    for sub in (None, 2):
        wanted = rows.where(stable_shard(key, 8) == 3)
        wanted = wanted if sub is None else wanted.where(stable_sub_shard(key, 3) == sub)
        got = shards.read_shard(spark, str(tmp_path / "t"), 3, sub)
        assert sorted(got.collect()) == sorted(wanted.collect()) and got.columns == rows.columns
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(shard" in plan and "= 3)" in plan
