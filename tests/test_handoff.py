import json

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

import __spark_entry__ as e
from millrace.functions import ids, ladder, urls
from millrace.functions.xml import parse_xml, rewrite_media, rewritten
from millrace.operators import dedup, resume
from millrace.plans import handoff
from millrace.sources import artifacts, jsonl, tar

ROWS = "source_id string, pid string, doi string, xml_doi string, tar_path string, xml_member string, source_member string, status string, license_policy string, license_code string, publication_year string, shard long, xml_bytes string, figure_bytes long, original_figure_bytes long, third_party_caption_flag boolean, license_urls array<string>, figures array<struct<url:string,member:string,status:string,bytes:long>>"


def rows(spark):
    figures = [("u1", "a/f1", "ok", 2), ("u2", None, "error", 0), ("u3", "", "ok", 1)]
    return spark.createDataFrame([
        ("a", "p", "", "10.1/é", "t", "a/x", "a/s", "ok", "keep", "CC BY", "2026", 3, "1.5", 10, 0, None, ["l"], figures),
        ("b", None, "10.2/y", None, "t", "b/x", "b/s", "no_figures", "keep", "PD", None, None, " 12 ", None, 7, True, None, None),
        ("c", "q", None, None, "t", "", "c/s", "ok", "keep", "CC0", None, None, None, None, None, None, None, []),
        ("d", "q", None, None, "t", "d/x", "d/s", "retry_blocked_row_error", None, None, None, None, None, None, None, None, None, None),
    ], ROWS)


def test_flat_table(spark):
    good, blocked, rejected = handoff.split(rows(spark))
    assert [r["source_id"] for r in blocked.collect()] == ["d"] and [r["source_id"] for r in handoff.rejected_examples(rejected, "source_id").collect()] == ["c"]
    flat = handoff.flatten(good, "corpus")
    assert len(flat.columns) == 45 and len(set(flat.columns)) == 45
    a, b = sorted(flat.collect(), key=lambda r: r["source_id"])
    assert (a["doi"], a["publication_year"], a["shard"], a["xml_bytes"], a["figure_bytes"], a["original_figure_bytes"], a["third_party_caption_flag"]) == ("10.1/é", "2026", "3", 0, 10, 10, False)
    assert (a["figure_members_json"], a["figure_urls_json"], a["license_urls_json"], a["fulltexts_json"]) == ('["a/f1"]', '["u1"]', '["l"]', "[]")
    assert json.loads(a["figures_json"])[0] == {"bytes": 2, "member": "a/f1", "status": "ok", "url": "u1"}
    assert (b["source"], b["pid"], b["doi"], b["xml_bytes"], b["original_figure_bytes"], b["figures_json"], b["figure_members_json"], b["third_party_caption_flag"]) == ("corpus", "", "10.2/y", 12, 7, "[]", "[]", True)
    assert handoff.flatten(good.where("false"), "x").schema == flat.schema
    members = spark.createDataFrame([("t", "a/x", 10), ("t", "a/s", 2), ("t", "a/f1", 3)], "tar_path string, member string, size long")
    inventory, missing = handoff.accounts(good, members)
    assert inventory.first()["payload_bytes"] == 15 and sorted(r["member"] for r in missing.collect()) == ["b/s", "b/x"]
    totals = handoff.byte_totals(good.withColumns({"xml_bytes": F.lit(10**9), **{c: F.lit(1) for c in ("expected_figure_files", "downloaded_figure_files", "rendered_figure_files")}}))
    assert totals.first()["original_figure_bytes_manifest"] == 17 and handoff.volumes(totals).first()["xml_manifest"] == 2.0
    own = rows(spark).select("source_id", handoff.payload_members(F.col("source_member"), F.col("xml_member"), F.col("figures")).alias("m"))
    assert {r["source_id"]: r["m"] for r in own.collect()} == {"a": ["a/s", "a/x", "a/f1"], "b": ["b/s", "b/x"], "c": ["c/s"], "d": ["d/s", "d/x"]}
    text = good.select("source_id", handoff.provenance(good).alias("d")).orderBy("source_id").first()["d"]
    assert text.endswith("}\n") and json.loads(text)["license_urls"] == ["l"] and text.startswith('{"license_code":"CC BY"')


def test_resuming(spark):
    cache = spark.createDataFrame([(1, 0, "ok", True, None), (1, 1, "xml_http_502", False, ["x"] * 5), (1, 2, "row_error", False, None), (2, 0, "retry_blocked_row_error", False, None)], "b int, i int, status string, has_payload boolean, retry_history array<string>")
    assert sorted((r["b"], r["i"]) for r in resume.valid_cache(cache, cache.where("false"), ["b", "i"]).collect()) == [(1, 1), (1, 2), (2, 0)]
    kept, again = resume.retry_states(cache, ["b", "i"], 2)
    assert kept.count() == 2 and {(r["b"], r["i"]): r["retries_used"] for r in again.collect()} == {(1, 1): 2, (1, 2): 1}
    assert [x.count() for x in resume.retry_states(cache, ["b", "i"], 0)] == [4, 0]
    plan = cache.select("b", "i").union(spark.createDataFrame([(3, 0)], "b int, i int"))
    new = plan.select("b", "i", F.lit("new").alias("status"))
    got = {(r["b"], r["i"]): r["status"] for r in resume.overlay_cache(plan, kept, new.where("b < 3"), ["b", "i"]).collect()}
    assert got == {(1, 0): "ok", (1, 1): "new", (1, 2): "new", (2, 0): "retry_blocked_row_error", (3, 0): None}
    over = resume.overlay_cache(plan, kept, new.where("b < 3"), ["b", "i"])
    assert {r["b"]: r["state"] for r in resume.commit_states(over, kept.where("b = 2"), ["b"]).collect()} == {1: "commit", 2: "done", 3: "incomplete"}
    assert {r["b"]: r["state"] for r in resume.commit_states(over, kept.where("b = 2"), ["b"], force=True).collect()} == {1: "commit", 2: "commit", 3: "incomplete"}
    assert {r["b"]: (r["n_targets"], r["repair_noop"]) for r in resume.repair_plan(cache, ["b"]).collect()} == {1: (2, 0), 2: (1, 0)}
    assert resume.repair_plan(cache.where("status = 'ok'"), ["b"]).first()["repair_noop"] == 1
    assert [r["i"] for r in resume.repair_targets(cache, "i", 1).collect()] == [0] and resume.repair_targets(cache, "i").count() == 3
    assert [(r["b"], r["planned"], r["written"]) for r in resume.mismatched(plan, kept, ["b"]).orderBy("b").collect()] == [(1, 3, 1), (3, 1, None)]
    rows = spark.createDataFrame([("c", "1", 1), ("c", "1", 2), ("", "", 3), (None, "2", 4), (None, None, 5)], "collection string, code string, at int")
    assert sorted(r["at"] for r in resume.resumed(rows, ["at"]).collect()) == [1, 4]
    assert resume.fetch_summary(plan, kept, again).first().asDict() == {"selected": 5, "restored": 2, "fetched": 2, "written": 4}
    assert resume.barrier(spark.range(3).withColumnRenamed("id", "shard"), 4).first()["open"] is False


def test_first_wins_with_nulls_and_a_hot_key(spark):
    rows = spark.createDataFrame([(None, 2, "x"), (None, 1, None), ("k", 5, "y"), ("k", None, "z")] + [("hot", i, str(i)) for i in range(500, 0, -1)], "k string, at int, v string")
    got = {r["k"]: (r["at"], r["v"]) for r in dedup.first_wins(rows, ["k"], ["at"]).collect()}
    assert got == {None: (1, None), "k": (None, "z"), "hot": (1, "1")}


def test_first_wins_by_hash_equals_the_sort(spark):
    """Numbers by one order need no sort; nulls come first, as by any other way."""
    rows = spark.range(4000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 9 > 0, (F.col("id") * 31) % 4001).alias("v"), F.when((F.col("id") % 7 != 3) | (F.col("id") != 3), (F.col("id") * 17) % 4001).alias("at"))
    lean, whole = dedup.first_wins(rows, ["k"], ["at"]), dedup.first_wins(rows, ["k"], [F.col("at")])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan(lean) and "SortAggregate" in plan(whole)
    assert sorted(lean.collect()) == sorted(whole.collect()) and lean.columns == rows.columns
    assert lean.where("k = 3 and at is null").count() == 1



def test_tolerant_read_leaves_the_session_alone(spark, tmp_path):
    import gzip

    schema = StructType([StructField("x", LongType())])
    body = "\n".join(f'{{"x": {i}}}' for i in range(60_000)).encode()
    (tmp_path / "cut.jsonl.gz").write_bytes(gzip.compress(body)[:60_000])
    (tmp_path / "split.jsonl").write_bytes(body.replace(b'{"x": 30000}', b'{"x": 30'))
    before = spark.conf.get("spark.sql.files.ignoreCorruptFiles")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")  # the file is read in several parts
    try:
        per = {r["file"].rpartition("/")[2]: (r["n"], r["m"]) for r in jsonl.read_prefixes(spark, str(tmp_path), schema).groupBy("file").agg(F.count("*").alias("n"), F.max("x").alias("m")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert per["split.jsonl"] == (30_000, 29_999) and 0 < per["cut.jsonl.gz"][0] == per["cut.jsonl.gz"][1] + 1 < 60_000
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == before


def test_artifacts(spark, tmp_path):
    for i, text in enumerate(("a\n\n b\n", "  \nc\n")):
        (tmp_path / "m" / f"shard-{i}").mkdir(parents=True)
        (tmp_path / "m" / f"shard-{i}" / "sub-0.txt").write_text(text)
    artifacts.join_manifests(spark, str(tmp_path / "m"), str(tmp_path / "whole"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "whole")).collect()] == ["a", " b", "c"]
    assert [r["length"] for r in artifacts.listing(spark, str(tmp_path / "m")).collect()] == [6, 5]
    assert artifacts.choose_input(spark, str(tmp_path / "whole"), "parts") == str(tmp_path / "whole") and artifacts.choose_input(spark, str(tmp_path / "none"), "parts") == "parts"
    rows = spark.createDataFrame([(1, None)], "a int, b string")
    artifacts.write_jsonl(rows, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()["value"] == '{"a":1,"b":null}'
    members = spark.createDataFrame([(f"t{i % 2}", i, f"m{i}", bytearray(b"x" * i)) for i in range(6)], "path string, ordinal int, member string, content binary")
    built = tar.tar_bytes(members.withColumnRenamed("path", "tar_path")).withColumnRenamed("tar_path", "path")
    assert sorted((r["tar_path"], r["member"], len(r["content"])) for r in tar.members_of(built, payload=True).collect()) == [(f"t{k}", f"m{i}", i) for k in range(2) for i in range(k, 6, 2)]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_sniffs_and_legacy_urls(spark):
    assert one(spark, urls.is_xml(F.lit("text/plain"), F.lit("\n \t<?xml version='1.0'?>"))) and not one(spark, urls.is_xml(F.lit(None).cast("string"), F.lit("\n<html>")))
    given = ("/scripts/page.php", "view_article", "/tools/xml.php")
    assert one(spark, urls.xml_url(F.lit("https://x.test/scripts/page.php?script=view_article&pid=S1&tlng=es"), F.lit(""), given)) == "https://x.test/tools/xml.php?pid=S1&lang=es"
    assert one(spark, urls.xml_url(F.lit("https://x.test/scripts/page.php?pid=S1"), F.lit("pt"), given)) == "https://x.test/scripts/page.php?format=xml&lang=pt"
    assert one(spark, ladder.render_reason(F.lit(False), F.lit((2 << 20) + 1))) == "large_raster_to_jpeg"
    assert one(spark, ids.first_text(F.lit(""), F.lit(None).cast("string"), F.lit("v"))) == "v"
    assert one(spark, resume.backoff(F.lit(3.0), 0.5, 60.0)) == 4.0


def test_rewritten_attributes(spark):
    head = '<article xmlns:xlink="http://www.w3.org/1999/xlink"><body>'
    names = {"https://x.test/f.tif": "m/1.jpg"}
    both = rewritten(head + '<graphic href="f.tif" xlink:href="f.tif"/></body></article>', names, "https://x.test/").decode()
    assert 'xlink:href="m/1.jpg"' in both and 'href="f.tif"' in both
    assert ' href="m/1.jpg"' in rewritten("<article><graphic href='f.tif'/></article>", names, "https://x.test/").decode()
    rows = spark.createDataFrame([(head + '<media xlink:href="f.tif"/></body></article>',), (None,)], "t string")
    out = rows.select(rewrite_media(F.col("t"), F.create_map(F.lit("https://x.test/f.tif"), F.lit("m/1.jpg")), F.lit("https://x.test/")).alias("t"))
    assert out.where("t is null").count() == 1 and out.where("t is not null").select(parse_xml("t")["hrefs"].alias("h")).first()["h"] == ["m/1.jpg"]


def test_every_reference_query_has_sql():
    assert {k for k in e.queries() if not k.startswith("op") and k != "pipeline"} <= set(e.oracle_sql())
