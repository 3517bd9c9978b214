"""Line numbers over files read in many parts, joins by position, and counts observed while writing."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.sources import artifacts


def test_numbers_over_parts(spark, tmp_path):
    """Files cut into many parts, with blank lines, repeated lines and an empty file between."""
    rng, want = random.Random(2), []
    for name, n in (("a/sub-0.jsonl", 3000), ("a/sub-1.jsonl", 0), ("b/sub-0.jsonl", 1), ("b/sub-1.jsonl", 5000)):
        (tmp_path / "m" / name).parent.mkdir(parents=True, exist_ok=True)
        lines = [rng.choice(["", "  ", "same", f"line {k} " + "x" * rng.randrange(60)]) for k in range(n)]
        (tmp_path / "m" / name).write_text("".join(x + "\n" for x in lines))
        want += [(name, k, x) for k, x in enumerate(x for x in lines if x.strip())]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = artifacts.numbered_lines(spark, str(tmp_path / "m"))
        got = [(r["file"].split("/m/")[1], r["at"], r["ordinal"], r["value"]) for r in rows.orderBy("ordinal").collect()]
        assert artifacts.join_manifests(spark, str(tmp_path / "m"), str(tmp_path / "whole")) == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == [(f, k, o, x) for o, (f, k, x) in enumerate(want)]
    whole = [x for p in sorted((tmp_path / "whole").glob("part-*")) for x in p.read_text().splitlines()]
    assert whole == [x for _, _, x in want]


def test_positions(spark):
    plan = spark.createDataFrame([("b", k, "same", k) for k in range(5)] + [("c", 0, "same", 9)], "bucket string, at long, source_id string, planned int")
    rows = spark.createDataFrame([("b", k, "same", f"s{k}") for k in range(5)] + [("c", 0, "x", "s9")], "bucket string, at long, source_id string, status string")
    got = joins.by_position(plan, rows, ["bucket"]).orderBy("bucket", "at").collect()
    assert [(r["bucket"], r["at"], r["source_id"], r["status"], r["planned_source_id"], r["planned"]) for r in got] == [("b", k, "same", f"s{k}", "same", k) for k in range(5)] + [("c", 0, "x", "s9", "same", 9)]
    with pytest.raises(ValueError, match=r"\['b'\] 5 != 4"):
        joins.by_position(plan, rows.where("at < 4"), ["bucket"])
    with pytest.raises(ValueError, match=r"\['c'\] 1 != None"):
        joins.by_position(plan, rows.where("bucket = 'b'"), ["bucket"])


def test_counts_of_a_write(spark, tmp_path):
    """The count comes from the pass that writes: the rows are computed once."""
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(1000, numPartitions=3).select("id", F.when(F.col("id") % 2 == 0, "ok").otherwise("xml_http_502").alias("status"), F.lit(0.5).alias("wait")).mapInArrow(note, "id long, status string, wait double")
    told = artifacts.write_jsonl(rows, str(tmp_path / "o"), **artifacts.transfer_metrics(F.col("status"), F.col("id"), F.col("wait")))
    assert told == {"rows": 1000, "bytes": 499500, "wait_seconds": 500.0, "longest_wait": 0.5, "http_errors": 500, "server_errors": 500, "succeeded": 500} and seen.value == 1000
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        artifacts.write_jsonl(rows, str(tmp_path / "o"))
    assert artifacts.write_jsonl(rows.where("false"), str(tmp_path / "none"))["rows"] == 0


def test_statuses_of_a_plan(spark):
    seed = spark.createDataFrame([("a", "planned_xml"), ("b", "no_fulltext_url"), ("c", None), ("d", "articlemeta_error")], "source_id string, status string")
    assert [r["source_id"] for r in artifacts.filtered(seed).collect()] == ["a"]
    assert sorted(r["source_id"] for r in artifacts.filtered(seed, ("planned_xml", "articlemeta_error")).collect()) == ["a", "d"]
