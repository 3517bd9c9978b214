import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.plans.handoff import accounts, figure_sums, split
from millrace.plans.seed import build_seed
from millrace.sources import artifacts, jsonl, tar
from millrace.streaming.liveness import last_beats


def test_tolerant_prefix(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2}\nbad\n{"x": 4}\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"x": 7}\n{"x": 8}\n')
    got = jsonl.read_prefixes(spark, str(tmp_path), StructType([StructField("x", LongType())]))
    assert sorted(r["x"] for r in got.collect()) == [1, 2, 7, 8]
    assert jsonl.read_jsonl(spark, str(tmp_path / "b.jsonl.gz"), "x long").count() == 2


def test_many_small_files(spark, tmp_path, monkeypatch):
    """Few folders for many files, lines in order, and a scan of few tasks, which gives the same prefixes."""
    monkeypatch.setattr(jsonl, "SCAN_TASKS", 3)
    k = F.col("id")
    rows = spark.range(3000, numPartitions=3).select(F.concat((k % 4).cast("string"), F.lit("/f"), (k % 300).cast("string")).alias("file"), (-k).alias("at"), F.when(k % 700 == 13, "{bad").otherwise(F.to_json(F.struct(k.alias("x")))).alias("value"))
    assert artifacts.write_text_files(rows, f"file:{tmp_path}/logs", ("at",)) == 300
    assert sorted(p.name for p in (tmp_path / "logs").iterdir()) == ["0", "1", "2", "3"] and len(list((tmp_path / "logs").rglob("*"))) == 304
    assert (tmp_path / "logs/1/f13").read_text().splitlines()[:3] == ['{"x":2713}', '{"x":2413}', "{bad"]
    got = jsonl.read_prefixes(spark, f"file:{tmp_path}/logs", StructType([StructField("x", LongType())]))
    last = {k: max([i for i in range(k, 3000, 300) if i % 700 == 13], default=-1) for k in range(300)}
    assert sorted(r["x"] for r in got.select("x").collect()) == [i for i in range(3000) if i > last[i % 300]]
    assert spark.read.option("recursiveFileLookup", True).text(f"file:{tmp_path}/logs").rdd.getNumPartitions() > 3
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Repartition 3, false") == 3
    monkeypatch.setattr(jsonl, "WHOLE_BYTES", 90)  # some are read in parts then
    parts = jsonl.read_prefixes(spark, f"file:{tmp_path}/logs", StructType([StructField("x", LongType())]))
    both = lambda df: sorted((r["file"], r["x"]) for r in df.select("file", "x").collect())
    assert both(parts) == both(got) and parts.where("line.row > 1000000").count() > 0 and parts.where("line.row < 1000000").count() > 0


def test_lines_of_small_files_are_those_of_the_text_source(spark, tmp_path, monkeypatch):
    """Ends of lines, blanks, bytes that are no UTF-8, a bad first line, empty files."""
    data = {"a": b'{"x": 1}\r\n \r{"x": 2}\n\n{"x": 3}', "b": b'\xff\n{"x": 4}\n', "c": b"", "d": b'{"x": 5, "y": "\xff"}\n{"x": 6}\nbad\n{"x": 7}\n', "e": b'{"x": "t"}\n{"x": 8}\n'}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    read = lambda: sorted((r["file"], r["x"]) for r in jsonl.read_prefixes(spark, str(tmp_path), StructType([StructField("x", LongType())])).select("file", "x").collect())
    small = read()
    monkeypatch.setattr(jsonl, "WHOLE_BYTES", -1)
    assert small == read() and [x for _, x in small] == [1, 2, 3, 5, 6]


def test_identifier_pages(spark, tmp_path):
    for i, codes in enumerate((["a", "", "b"], ["b", "c"])):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"meta": {"total": 4}, "objects": [{"code": c, "collection": "x"} for c in codes]}))
    assert [r["code"] for r in jsonl.read_identifiers(spark, str(tmp_path)).orderBy("page", "at").collect()] == ["a", "b", "c"]


def test_tar_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("t.tar", 1, "a/x", bytearray(b"10")), ("t.tar", 2, "a/y", bytearray(b"333")), ("t.tar", 3, "a/x", bytearray(b"4444"))], "tar_path string, ordinal int, member string, content binary")
    (tmp_path / "t.tar").write_bytes(tar.tar_bytes(rows).first()["content"])
    members = tar.read_tar(spark, str(tmp_path), payload=True)
    assert {r["member"]: r["size"] for r in tar.member_sizes(members).collect()} == {"a/x": 4, "a/y": 3}
    assert [bytes(r["content"]) for r in members.orderBy("ordinal").collect()] == [b"10", b"333", b"4444"]


def test_seed_and_handoff(spark):
    meta = spark.createDataFrame([("c", "p", "", "ok", {"en": "u"}, 1), ("c", "p", "", "bad", {}, 2), ("c", "q", "", "ok", {}, 3)], "collection string, code string, doi string, status string, html map<string,string>, row_index int")
    assert sorted(r["status"] for r in build_seed(meta).collect()) == ["no_fulltext_url", "planned_xml"]
    schema = "source_id string, tar_path string, xml_member string, source_member string, status string, license_policy string, license_code string, figures array<struct<url:string,member:string,status:string,bytes:long,original_bytes:long>>"
    figure = [("u", "a/f", "ok", 3, 0), ("v", None, "error", 0, 0)]
    rows = spark.createDataFrame([("a", "t", "a/x", "a/s", "ok", "keep", "CC BY", figure), ("b", "t", "", "b/s", "ok", "keep", "CC BY", []), ("c", "t", "", "", "retry_blocked_row_error", None, None, [])], schema)
    good, blocked, rejected = split(rows)
    assert [x.count() for x in (good, blocked, rejected)] == [1, 1, 1]
    listing = spark.createDataFrame([("t", "a/x", 10), ("t", "a/s", 2)], "tar_path string, member string, size long")
    inventory, missing = accounts(good, listing)
    assert inventory.first()["payload_bytes"] == 12 and missing.first()["member"] == "a/f"
    sums = good.select(*[c.alias(n) for n, c in figure_sums(F.col("figures")).items()]).first()
    assert (sums["figure_bytes"], sums["original_figure_bytes"], sums["missing_figure_urls"]) == (3, 3, ["v"])


def test_stream_equals_batch(spark, tmp_path):
    beats = spark.range(200).select((F.col("id") % 7).alias("shard"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    beats.write.parquet(str(tmp_path / "beats"))
    stream = spark.readStream.schema(beats.schema).parquet(str(tmp_path / "beats"))
    q = last_beats(stream).writeStream.outputMode("complete").format("memory").queryName("beats").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(spark.table("beats").collect()) == sorted(last_beats(beats).collect())
