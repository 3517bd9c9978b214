"""Queries over documents and files: XML articles, URLs, JSON lines, archives and listings.

Files are written to the shared folder first and then read by the code that is tested.
"""

from __future__ import annotations

import gzip
from functools import partial

from pyarrow import fs as files
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import ladder, urls
from ..functions.xml import parse_xml, rewrite_media
from ..operators import joins
from ..operators.dedup import first_wins
from ..sources import artifacts, jsonl, tar
from ..sources.pages import PAGES, cursor, stream_pages
from ..sources.shared import new_path
from . import shards
from .queries import MD5, query, table

HEAD = '<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-id pub-id-type="DOI">10.1/'
CLEAN_SQL = "regexp_replace(coalesce(text, ''), '[^A-Za-z0-9 .]', ' ', 'g')"
FLAT = "trim(regexp_replace({}, ' +', ' ', 'g'))"
BODY_SQL = f"concat({CLEAN_SQL}, 'Courtesy of X', repeat('A', CAST(doc_id % 3 AS INTEGER)))"


def article(prefix: str = "xlink:"):
    """Article XML of each document; every tenth is another kind of document."""
    n = lambda m: (F.col("doc_id") % m).cast("string")
    times = lambda text, m: F.repeat(F.lit(text), (F.col("doc_id") % m).cast("int"))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z0-9 .]", " ")
    whole = F.concat(
        F.lit(HEAD), F.col("doc_id").cast("string"), F.lit("</article-id><article-title>T <i>u</i>  v</article-title><license xlink:href=\"https://l/"), n(3), F.lit("\"><ext-link href=\"https://e/"), n(2),
        F.lit("\">t</ext-link>L</license></front><body><p>"), text, F.lit(f"</p><fig><caption>Courtesy of X</caption><graphic {prefix}href=\"f"), n(4), F.lit(".tif\"/><media href=\"../m\"/></fig>"),
        times("<table-wrap><caption>A</caption></table-wrap>", 3), times("<disp-formula/>", 2), F.lit("</body></article>"),
    )
    return F.when(F.col("doc_id") % 10 == 9, "<html/>").otherwise(whole)


@query(f"""SELECT doc_id, bad IS NULL AS ok, bad AS error, CASE WHEN bad IS NULL THEN concat('10.1/', doc_id) END AS doi, CASE WHEN bad IS NULL THEN 'T u v' END AS title, CASE WHEN bad IS NULL THEN 'tL' END AS license_text,
 CASE WHEN bad IS NULL THEN concat('https://l/', doc_id % 3, ',https://e/', doc_id % 2) ELSE '' END AS license_urls, CASE WHEN bad IS NULL THEN 'courtesy' ELSE '' END AS terms, CASE WHEN bad IS NULL THEN CAST(1 AS BIGINT) END AS figures, CASE WHEN bad IS NULL THEN CAST(doc_id % 3 AS BIGINT) END AS tables, CASE WHEN bad IS NULL THEN CAST(doc_id % 2 AS BIGINT) END AS formulas,
 CASE WHEN bad IS NULL THEN CAST(length({FLAT.format(f"concat('10.1/', doc_id, 'T u  vtL', {BODY_SQL})")}) AS BIGINT) END AS text_chars, CASE WHEN bad IS NULL THEN CAST(length({FLAT.format(BODY_SQL)}) AS BIGINT) END AS body_chars
 FROM (SELECT *, CASE WHEN doc_id % 10 = 9 THEN 'not_article:html' END AS bad FROM documents)""")
def xml1_articles(spark, d):
    rows = table(spark, d, "documents").select("doc_id", parse_xml(article()).alias("a"))
    return rows.select(
        "doc_id", "a.ok", "a.error", "a.doi", "a.title", "a.license_text", F.concat_ws(",", "a.license_urls").alias("license_urls"), F.concat_ws(",", ladder.caption_terms(F.col("a.captions"))).alias("terms"),
        "a.figures", "a.tables", "a.formulas", "a.text_chars", "a.body_chars",
    )


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN '' ELSE concat('https://x/a/f', doc_id % 4, '.tif,https://x/m') END AS media FROM documents")
def xml9_media_urls(spark, d):
    rows = table(spark, d, "documents").select("doc_id", parse_xml(article()).alias("a"))
    return rows.select("doc_id", F.concat_ws(",", urls.joined_urls(F.lit("https://x/a/b"), F.col("a.hrefs"))).alias("media"))


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN '' ELSE concat(CASE WHEN doc_id % 4 < 2 THEN concat('p/', doc_id % 4, '.jpg') ELSE concat('f', doc_id % 4, '.tif') END, ',../m') END AS media FROM documents")
def xml10_rewritten_media(spark, d):
    """The references of the rewritten documents, as a new parse finds them."""
    names = F.create_map(*[F.lit(x) for i in range(2) for x in (f"https://x/a/f{i}.tif", f"p/{i}.jpg")])
    rows = table(spark, d, "documents").select("doc_id", rewrite_media(article(), names, F.lit("https://x/a/b")).alias("t"))
    return rows.select("doc_id", F.concat_ws(",", parse_xml("t")["hrefs"]).alias("media"))


@query(r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat(regexp_extract(url, '^([a-z]+:)', 1), '//cdn.test/f') WHEN 1 THEN concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1), '/img/', page_id) WHEN 2 THEN concat(regexp_replace(url, '#.*$', ''), '#frag') ELSE concat('https://o.test/', page_id) END AS joined FROM pages""")
def url5_joined(spark, d):
    k, n = F.col("page_id") % 4, F.col("page_id").cast("string")
    href = F.when(k == 0, "//cdn.test/f").when(k == 1, F.concat(F.lit("/img/"), n)).when(k == 2, "#frag").otherwise(F.concat(F.lit("https://o.test/"), n))
    return table(spark, d, "pages").select("page_id", urls.joined_url(F.col("url"), href).alias("joined"))


@query(r"""SELECT page_id, page_id % 5 = 0 OR page_id % 3 < 2 AS xml, page_id % 7 = 0 OR page_id % 4 = 1 OR page_id % 11 = 0 AS tiff FROM pages""")
def url6_url7_sniffs(spark, d):
    k = F.col("page_id")
    kind = F.when(k % 5 == 0, "application/XHTML+xml").when(k % 7 == 0, "image/tiff").otherwise("text/html")
    kind = F.when((k % 5 == 0) & (k % 7 == 0), "image/tiff; x=xml").otherwise(kind)
    body = F.when(k % 3 == 0, "\n\t <?XML version").when(k % 3 == 1, "<!DOCTYPE article PUBLIC").otherwise("<html>")
    url = F.when(k % 4 == 1, F.concat("url", F.lit("/a.TIF?x=1"))).otherwise("https://x/a.png")
    url = F.when(k % 4 == 1, "https://x/a.TIF?x=1").otherwise(url)
    start = F.when(k % 11 == 0, F.unhex(F.lit("4D4D002A00"))).otherwise(F.unhex(F.lit("FFD8")))
    return table(spark, d, "pages").select("page_id", urls.is_xml(kind, body).alias("xml"), urls.is_tiff(url, kind, start).alias("tiff"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'tiff_to_jpeg' WHEN p_retailprice * 2000 > 2097152 THEN 'large_raster_to_jpeg' END AS reason FROM part")
def img3_render_reason(spark, d):
    return table(spark, d, "part").select("p_partkey", ladder.render_reason(F.col("p_partkey") % 4 == 0, F.col("p_retailprice") * 2000).alias("reason"))


@query("SELECT doc_id, source, lang FROM documents")
def src1_jsonl_round_trip(spark, d):
    path, rows = new_path(spark, "rows"), table(spark, d, "documents").select("doc_id", "source", "lang")
    artifacts.write_jsonl(rows, f"{path}/part.jsonl.gz")
    return jsonl.read_jsonl(spark, f"{path}/part.jsonl.gz", rows.schema, parts=True)


STATUS_SQL = "CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_figures' WHEN 2 THEN 'xml_http_503' WHEN 3 THEN 'xml_http_404' END"


def fetched_status():
    k = F.col("doc_id") % 5
    return F.when(k == 0, "ok").when(k == 1, "no_figures").when(k == 2, "xml_http_503").when(k == 3, "xml_http_404")


@query(f"""SELECT count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS bytes, CAST(sum(doc_id % 8 / 4.0) AS DOUBLE) AS wait_seconds, CAST(max(doc_id % 8 / 4.0) AS DOUBLE) AS longest_wait, count(*) FILTER (status LIKE 'xml_http_%') AS http_errors,
 count(*) FILTER (status LIKE 'xml_http_5%') AS server_errors, count(*) FILTER (status IN ('ok', 'no_figures')) AS succeeded FROM (SELECT *, {STATUS_SQL} AS status FROM documents)""")
def agg15_counts_of_a_write(spark, d):
    """What a write of fetched rows reports of them, observed as they were written."""
    rows = table(spark, d, "documents").select("doc_id", fetched_status().alias("status"), F.col("n_chars").alias("n_bytes"), (F.col("doc_id") % 8 / 4).alias("wait"))
    told = artifacts.write_jsonl(rows, new_path(spark, "fetched"), **artifacts.transfer_metrics(F.col("status"), F.col("n_bytes"), F.col("wait")))
    return spark.createDataFrame([told], "rows long, bytes long, wait_seconds double, longest_wait double, http_errors long, server_errors long, succeeded long")


@query("SELECT DISTINCT collection, code FROM (SELECT coalesce(source, '') AS collection, CASE WHEN doc_id % 9 > 0 THEN concat('c', doc_id % 400) ELSE '' END AS code FROM documents) WHERE code <> ''")
def src3_identifier_pages(spark, d):
    k = F.col("doc_id")
    item = F.struct(F.when(k % 9 > 0, F.concat(F.lit("c"), (k % 400).cast("string"))).otherwise("").alias("code"), F.col("source").alias("collection"))
    pages = table(spark, d, "documents").groupBy(F.floor(k / 100).alias("page")).agg(F.collect_list(item).alias("objects"))  # a hundred ids a page
    path = new_path(spark, "pages")
    pages.repartition("page").write.partitionBy("page").json(path)
    return jsonl.read_identifiers(spark, path).select("collection", "code")


PAGES_SQL = "SELECT doc_id // 100 AS page, doc_id % 100 AS place, CASE WHEN doc_id % 9 > 0 THEN concat('c', doc_id % 400) ELSE '' END AS code, coalesce(source, '') AS collection FROM documents"


def harvest(spark, d):
    """Pages of a hundred documents, numbered without a gap, read as a stream and kept."""
    k, path, out = F.col("doc_id"), new_path(spark, "harvest"), new_path(spark, "identifiers")
    code = F.when(k % 9 > 0, F.concat(F.lit("c"), (k % 400).cast("string"))).otherwise("")
    docs = table(spark, d, "documents").select(F.floor(k / 100).alias("page"), F.struct(k.alias("k"), code.alias("code"), F.coalesce("source", F.lit("")).alias("collection")).alias("o"))
    total = docs.agg(F.count("*").alias("total")).first()["total"]
    objects = F.transform(F.array_sort(F.collect_list("o")), lambda o: F.struct(o["code"].alias("code"), o["collection"].alias("collection")))
    pages = docs.groupBy("page").agg(objects.alias("objects"))  # a hundred rows each
    text = F.to_json(F.struct(F.struct(F.lit(total).alias("total")).alias("meta"), "objects"))
    pages.select("page", text.alias("text")).foreachPartition(partial(write_pages, path))
    stream = stream_pages(spark, path)
    q = stream.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "cursor")).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(PAGES).parquet(out)


def write_pages(path: str, rows) -> None:
    """Page files under the names that a harvest gives them."""
    store, root = files.FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)
    for r in rows:
        with store.open_output_stream(f"{root}/page_{r['page']:06d}.json.gz", compression=None) as f:
            f.write(gzip.compress(r["text"].encode()))


@query(f"SELECT collection, code, min(page * 100 + place) AS first FROM ({PAGES_SQL}) WHERE code <> '' GROUP BY ALL")
def src3_harvest_stream(spark, d):
    """The first of each identifier, from a stream of page files."""
    rows = harvest(spark, d).where("coalesce(code, '') <> ''")
    return first_wins(rows, ["collection", "code"], ["page", "at"]).select("collection", "code", (F.col("page") * 100 + F.col("at")).alias("first"))


@query(f"SELECT CAST(max(page) + 1 AS BIGINT) AS next_page, count(*) AS next_offset, count(*) AS reported_total, true AS complete FROM ({PAGES_SQL})")
def cur1_cursor(spark, d):
    """Where the harvest stands once all its pages are read."""
    return cursor(harvest(spark, d))


@query(f"SELECT doc_id FROM documents WHERE {MD5.format('CAST(doc_id AS VARCHAR)', 8)} = 5 AND {MD5.format("concat('articlemeta-sub|', CAST(doc_id AS VARCHAR))", 2)} = 1")
def prt2_shard_files(spark, d):
    """What one sub-shard's run reads of a table that is written by shard: the files of its folder."""
    path = new_path(spark, "by-shard")
    shards.write_by_shard(table(spark, d, "documents").select("doc_id"), path, F.col("doc_id").cast("string"), 8, 2)
    return shards.read_shard(spark, path, 5, 1)


@query("SELECT event_id FROM events e WHERE event_id < coalesce((SELECT min(event_id) FROM events b WHERE b.event_id % 101 = 0 AND b.user_id IS NOT DISTINCT FROM e.user_id), 9223372036854775807)")
def src5_tolerant_prefixes(spark, d):
    """A file for each user, of which some have a bad line: what stands before it."""
    line = F.when(F.col("event_id") % 101 == 0, "{bad").otherwise(F.to_json(F.struct("event_id")))
    user = F.coalesce(F.col("user_id").cast("string"), F.lit("none"))
    file = F.concat(F.pmod(F.xxhash64("user_id"), F.lit(64)).cast("string"), F.lit("/user-"), user, F.lit(".jsonl"))
    path = new_path(spark, "logs")
    artifacts.write_text_files(table(spark, d, "events").select(file.alias("file"), "event_id", line.alias("value")), path, ("event_id",))
    return jsonl.read_prefixes(spark, path, StructType([StructField("event_id", LongType())])).select("event_id")


@query("SELECT arg_max(CAST(event_id AS VARCHAR), (ts, CAST(value * 100 AS BIGINT), CAST(event_id AS VARCHAR))) AS path FROM events WHERE CAST(value * 100 AS BIGINT) > 0")
def src6_newest_part(spark, d):
    files = table(spark, d, "events").select(F.col("event_id").cast("string").alias("path"), F.col("ts").alias("modificationTime"), F.round(F.col("value") * 100).cast("long").alias("length"))
    return jsonl.newest(files)


def archives(spark, d):
    """A thousand archives of the lines of orders, written and listed; lines repeat the names of earlier ones."""
    content = F.encode(F.repeat(F.lit("x"), F.col("l_quantity").cast("int")), "UTF-8")
    member = F.concat((F.col("l_orderkey") % 4000).cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    path = new_path(spark, "archives")
    tar.write_tar(lines.select(F.format_string("t%d.tar", F.col("l_orderkey") % 1000).alias("tar_path"), "l_orderkey", "l_linenumber", member.alias("member"), content.alias("content")), path, order=("l_orderkey", "l_linenumber"))
    return tar.read_tar(spark, path).withColumn("tar_path", F.regexp_replace("tar_path", r"\.tar$", ""))


LINES_SQL = "SELECT concat('t', l_orderkey % 1000) AS tar_path, concat(l_orderkey % 4000, '/', l_linenumber) AS member, CAST(l_quantity AS BIGINT) AS size, l_orderkey * 10 + l_linenumber AS pos FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)"


@query(f"SELECT tar_path, member, arg_max(size, pos) AS size FROM ({LINES_SQL}) GROUP BY ALL")
def src8_tar_sizes(spark, d):
    return tar.member_sizes(archives(spark, d))


@query(f"SELECT tar_path, member, arg_min(size, pos) AS size FROM ({LINES_SQL}) GROUP BY ALL")
def dd7_member_once(spark, d):
    return first_wins(archives(spark, d).select("tar_path", "member", "size", "ordinal"), ["tar_path", "member"], ["ordinal"]).drop("ordinal")


@query("""SELECT concat('shard-', doc_id % 8, '/sub-', doc_id % 3, '.tar') AS tar_path, row_number() OVER (PARTITION BY doc_id % 8, doc_id % 3 ORDER BY doc_id, m) - 1 AS ordinal, concat(doc_id, '/', m) AS member,
 CASE m WHEN 0 THEN sha256(concat('{', doc_id, '}')) ELSE sha256(coalesce(text, '')) END AS sha256 FROM documents, range(2) x(m) WHERE doc_id % 11 > 0""")
def snk4_assembled_archives(spark, d):
    """Archives assembled from the members of planned rows, in row order, and read back with their contents; every eleventh row has none."""
    k, n = F.col("doc_id"), F.col("doc_id").cast("string")
    docs = table(spark, d, "documents")
    plan = docs.select("doc_id", F.format_string("shard-%d/sub-%d.tar", k % 8, k % 3).alias("tar_path"), k.alias("row"))
    member = lambda i, data: F.struct(F.concat(n, F.lit(f"/{i}")).alias("member"), F.encode(data, "UTF-8").alias("content"))
    both = F.array(member(0, F.concat(F.lit("{"), n, F.lit("}"))), member(1, F.coalesce("text", F.lit(""))))
    payloads = docs.select("doc_id", F.when(k % 11 > 0, both).otherwise(F.slice(both, 1, 0)).alias("members"))
    path = new_path(spark, "assembled")
    tar.write_tar(tar.assemble(plan, payloads, ["doc_id"]), path, order=("row", "at"))
    return tar.read_tar(spark, path, payload=True).select("tar_path", "ordinal", "member", F.sha2("content", 256).alias("sha256"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS source_id, lpad(CAST({MD5.format('CAST(doc_id AS VARCHAR)', 8)} AS VARCHAR), 2, '0') AS planned_shard, lpad(CAST({MD5.format("concat(CAST(doc_id AS VARCHAR), '|sub')", 2)} AS VARCHAR), 3, '0') AS planned_subtar FROM documents")
def snk3_written_plan(spark, d):
    path = new_path(spark, "plan")
    shards.write_plan(shards.with_buckets(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_id")), 8, 2), path)
    return spark.read.schema("source_id string, planned_shard string, planned_subtar string").json(path)


@query("SELECT count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars FROM (SELECT concat('{\"a\":', doc_id, '}') AS line FROM documents WHERE doc_id % 5 > 0)")
def snk6_joined_manifests(spark, d):
    """Manifests by shard with blank lines between, joined to one table of lines."""
    line = F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit('{"a":'), F.col("doc_id").cast("string"), F.lit("}"))).otherwise(" ")
    parts, whole = new_path(spark, "manifests"), new_path(spark, "manifest")
    table(spark, d, "documents").select(line.alias("value"), (F.col("doc_id") % 8).alias("shard")).repartition("shard").write.partitionBy("shard").text(parts)
    artifacts.join_manifests(spark, parts, whole)
    return spark.read.text(whole).agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("chars"))


def in_buckets(rows, folder: str, order: str) -> None:
    """JSON lines, a file for each bucket, in order."""
    rows.repartition("bucket").sortWithinPartitions("bucket", order).write.partitionBy("bucket").option("ignoreNullFields", False).json(folder)


@query("""SELECT row_number() OVER (ORDER BY doc_id % 8, doc_id) - 1 AS ordinal, row_number() OVER (PARTITION BY doc_id % 8 ORDER BY doc_id) - 1 AS at, doc_id % 8 AS bucket, doc_id % 50 AS code FROM documents""")
def src4_numbered_lines(spark, d):
    """Lines of several manifests, numbered in each and over all, as they stand in the files; codes repeat."""
    k, path = F.col("doc_id"), new_path(spark, "numbered")
    in_buckets(table(spark, d, "documents").select(k, (k % 50).alias("code"), (k % 8).alias("bucket")), path, "doc_id")
    rows = artifacts.numbered_rows(spark, path, "doc_id long, code long")
    return rows.select("ordinal", "at", F.regexp_extract("file", r"bucket=([0-9]+)", 1).cast("long").alias("bucket"), "code")


@query("""WITH m AS (SELECT doc_id % 6 AS bucket, row_number() OVER (PARTITION BY doc_id % 6 ORDER BY doc_id) - 1 AS at, concat('a-', doc_id % 50) AS source_id, CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'xml_http_503' WHEN 2 THEN 'retry_blocked_row_error' ELSE 'no_figures' END AS status, concat('a-', doc_id % 50, '?') AS planned_source_id FROM documents)
SELECT bucket, "at", source_id, planned_source_id, CASE WHEN status IN ('xml_http_503', 'retry_blocked_row_error') AND "at" % 2 = 0 THEN 'repaired' ELSE status END AS status FROM m""")
def jn7_positional_repair(spark, d):
    """Plan and manifest files joined by the place of their lines, as keys repeat; every second target gets a new row."""
    k, bucket = F.col("doc_id"), F.regexp_extract("file", r"bucket=([0-9]+)", 1).cast("long").alias("bucket")
    status = F.when(k % 5 == 0, "ok").when(k % 5 == 1, "xml_http_503").when(k % 5 == 2, "retry_blocked_row_error").otherwise("no_figures")
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("a-"), (k % 50).cast("string")).alias("source_id"), status.alias("status"), (k % 6).alias("bucket"))
    plans, manifests = new_path(spark, "plans"), new_path(spark, "manifests")
    in_buckets(docs.select("doc_id", F.concat("source_id", F.lit("?")).alias("source_id"), "bucket"), plans, "doc_id")
    in_buckets(docs, manifests, "doc_id")
    read = lambda path, schema: artifacts.numbered_rows(spark, path, schema).select(bucket, "at", *[c.split(" ")[0] for c in schema.split(", ")])
    rows = joins.by_position(read(plans, "source_id string"), read(manifests, "source_id string, status string"), ["bucket"])
    new = rows.where(ladder.retry_target(F.col("status")) & (F.col("at") % 2 == 0)).withColumn("status", F.lit("repaired"))
    return joins.overlay(rows, new, ["bucket", "at"])


@query("SELECT n_nationkey, CAST(length(n_name) + 1 AS BIGINT) AS length, sha256(concat(n_name, chr(10))) AS sha256 FROM nation")
def snk8_listing(spark, d):
    path = new_path(spark, "artifacts")
    table(spark, d, "nation").select("n_name", F.col("n_nationkey").alias("k")).repartition("k").write.partitionBy("k").text(path)
    return artifacts.listing(spark, path).where("path like '%/k=%'").select(F.regexp_extract("path", r"/k=([0-9]+)/", 1).cast("int").alias("n_nationkey"), "length", "sha256")


@query(f"""WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS source_id, {MD5.format('CAST(doc_id AS VARCHAR)', 8)} AS a, {MD5.format("concat(CAST(doc_id AS VARCHAR), '|sub')", 2)} AS b FROM documents)
SELECT lpad(CAST(a AS VARCHAR), 2, '0') AS planned_shard, lpad(CAST(b AS VARCHAR), 3, '0') AS planned_subtar, row_number() OVER (PARTITION BY a, b ORDER BY source_id) - 1 AS place, source_id FROM p""")
def srt1_plan_order(spark, d):
    """The rows of each plan file in the order of its lines, which is that of their ids."""
    path, part = new_path(spark, "plan"), lambda name: F.regexp_extract("file", name + "=([0-9]+)", 1).alias(name)
    shards.write_plan(shards.with_buckets(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_id")), 8, 2), path)
    return artifacts.numbered_rows(spark, path, "source_id string").select(part("planned_shard"), part("planned_subtar"), F.col("at").alias("place"), "source_id")


@query(f"""WITH p AS (SELECT {MD5.format('CAST(doc_id AS VARCHAR)', 300)} AS a, {MD5.format("concat(CAST(doc_id AS VARCHAR), '|sub')", 4)} AS b FROM documents), c AS (SELECT i, (SELECT count(*) FROM p WHERE a = i) AS n FROM range(300) x(i))
SELECT 300 AS n_shards, 4 AS sub_count_per_shard, 50 AS articles_per_subtar_target, 3 AS pad_shard, 3 AS pad_sub, CAST(sum(n) AS BIGINT) AS total_articles, 1200 AS plans_written, string_agg(CAST(n AS VARCHAR), ',' ORDER BY i) AS shard_article_counts FROM c""")
def agg4_plan_meta(spark, d):
    """What describes a plan of 300 shards, of which some are empty."""
    plan = shards.with_buckets(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_id")), 300, 4)
    return shards.plan_meta(plan, 300, 4, 50).withColumn("shard_article_counts", F.array_join(F.transform("shard_article_counts", lambda n: n.cast("string")), ","))


@query("SELECT count(*) AS records, min(doc_id) AS first, max(doc_id) AS last, (SELECT count(*) FROM documents) AS total, true AS single FROM documents WHERE doc_id // 100 = 3")
def src2_document(spark, d):
    """One JSON document of many lines, chosen as it exists beside a folder of parts."""
    k, path, parts = F.col("doc_id"), new_path(spark, "state"), new_path(spark, "parts")
    docs = table(spark, d, "documents")
    whole = docs.groupBy(F.floor(k / 100).alias("page")).agg(F.array_sort(F.collect_list(k)).alias("codes")).where("page = 3")
    text = F.regexp_replace(F.to_json(F.struct(F.lit(docs.count()).alias("total"), "codes")), ",", ",\n ")
    whole.select(text.alias("value")).coalesce(1).write.text(path)
    chosen = artifacts.choose_input(spark, path, parts)
    rows = jsonl.read_document(spark, chosen, "total long, codes array<long>")
    return rows.select(F.size("codes").cast("long").alias("records"), F.array_min("codes").alias("first"), F.array_max("codes").alias("last"), "total", F.lit(chosen == path).alias("single"))


@query("SELECT CAST(greatest(1, ceil(count(*) / (40 * 7.0))) AS BIGINT) AS subs FROM documents")
def agg5_sub_count(spark, d):
    return shards.sub_counts(table(spark, d, "documents"), 40, 7)
