"""Queries over the driver's tables and the SQL that gives the same rows.

Column roles: documents are articles, pages full-text URLs, events heartbeats and
attempts, orders and lineitem articles and their members, conversations attempt logs.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ids, ladder, urls
from ..functions.licenses import BLOCKED, license_of
from ..operators import dedup, joins, monitor, retry, selection, stats
from ..sources.shared import new_path
from ..streaming import liveness
from . import shards

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MD5 = "CAST(concat('0x', substr(md5({}), 1, 16)) AS UBIGINT) % {}"
LIC_SQL = f"""CASE WHEN trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'missing'
 WHEN regexp_matches(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), '{"|".join(BLOCKED)}') THEN 'skip'
 WHEN regexp_matches(lower(text), 'creativecommons\\.org/publicdomain/zero|cc0|creativecommons\\.org/publicdomain/mark|public domain|creativecommons\\.org/licenses/by/|creative commons attribution') THEN 'keep'
 ELSE 'unknown' END"""


@query(f"SELECT CAST({MD5.format('CAST(doc_id AS VARCHAR)', 40)} AS INTEGER) AS shard, count(*) AS n FROM documents GROUP BY 1")
def fn1_stable_shard_counts(spark, d):
    return table(spark, d, "documents").groupBy(ids.stable_shard(F.col("doc_id").cast("string"), 40).alias("shard")).agg(F.count("*").alias("n"))


@query(f"SELECT concat(source, '|', CAST(doc_id AS VARCHAR)) AS article_key, CAST({MD5.format('''concat('articlemeta-sub|', source, '|', CAST(doc_id AS VARCHAR))''', 8)} AS INTEGER) AS sub FROM documents")
def fn3_article_keys(spark, d):
    key = ids.article_key(F.col("source"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select(key.alias("article_key"), ids.stable_sub_shard(key, 8).alias("sub"))


@query(r"""SELECT p_partkey, substr(concat('corpus-', coalesce(nullif(trim(regexp_replace(p_brand, '[^A-Za-z0-9._-]+', '-', 'g'), '-'), ''), 'col'), '-', trim(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '-', 'g'), '-'),
 CASE WHEN trim(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '-', 'g'), '-') = '' THEN substr(sha256(p_name), 1, 16) ELSE '' END), 1, 180) AS source_id FROM part""")
def fn5_source_id(spark, d):
    return table(spark, d, "part").select("p_partkey", ids.source_id(F.col("p_brand"), F.col("p_name")).alias("source_id"))


@query("SELECT event_id, json_object('k', CAST(json_extract(props, '$.k') AS BIGINT)) :: VARCHAR AS canonical FROM events")
def fn6_canonical_json(spark, d):
    return table(spark, d, "events").select("event_id", ids.canonical_json(F.col("props")).alias("canonical"))


@query(r"SELECT l_orderkey, l_linenumber, lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS padded, coalesce(CASE WHEN regexp_full_match(l_returnflag, '[0-9]+') THEN CAST(l_returnflag AS BIGINT) END, 0) AS as_int FROM lineitem")
def fn7_fn9_ints_and_pads(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ids.padded(F.col("l_linenumber"), 3).alias("padded"), ids.int_value(F.col("l_returnflag")).alias("as_int"))


@query(f"SELECT policy, count(*) AS n FROM (SELECT {LIC_SQL} AS policy FROM documents) GROUP BY 1")
def lic_policy_counts(spark, d):
    # the table's texts hold no HTML entities, and SQL could not decode them
    return table(spark, d, "documents").groupBy(license_of(F.col("text"), unescape=False)["policy"].alias("policy")).agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(lower(line), 'licensed under|released under')""")
def lic_family_lines(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(F.regexp_like(F.lower("line"), F.lit("licensed under|released under")))


LADDER_SQL = f"""
WITH l AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
t AS (SELECT d.doc_id, d.source, n_chars, CASE WHEN doc_id % 3 = 0 THEN d.text ELSE concat(d.text, ' https://creativecommons.org/licenses/by/4.0/') END AS text,
 CASE WHEN l.toxic = 1 THEN 'xml_http_403' END AS fetch_error, coalesce(l.quality, 1) = 1 AS parsed,
 regexp_matches(lower(d.text), 'adapted from|courtesy|source:') AS captions, d.doc_id % 4 AS expected, d.doc_id % 3 AS downloaded FROM documents d LEFT JOIN l USING (doc_id)),
s AS (SELECT *, {LIC_SQL} AS policy FROM t)
SELECT CAST({MD5.format('CAST(doc_id AS VARCHAR)', 4)} AS INTEGER) AS shard, CASE WHEN fetch_error IS NOT NULL THEN fetch_error WHEN NOT parsed THEN 'xml_parse_error' WHEN policy <> 'keep' THEN 'license_' || policy
 WHEN captions THEN 'license_figure_ambiguous' WHEN n_chars < 200 THEN 'xml_no_body' WHEN expected = 0 THEN 'no_figures' WHEN downloaded >= expected THEN 'ok' WHEN downloaded > 0 THEN 'partial_figures' ELSE 'figures_failed' END AS status,
 count(*) AS n FROM s GROUP BY 1, 2"""


@query(LADDER_SQL)
def st2_ladder_by_shard(spark, d):
    """The whole ladder over documents and labels, counted by shard."""
    label = table(spark, d, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    docs = table(spark, d, "documents").join(label, "doc_id", "left")
    text = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat("text", F.lit(" https://creativecommons.org/licenses/by/4.0/")))
    captions = reduce(or_, (F.contains(F.lower("text"), F.lit(w)) for w in ("adapted from", "courtesy", "source:")))
    # the policy is a column first, as the ladder names it twice
    docs = docs.withColumns({"policy": license_of(text, unescape=False)["policy"], "captions": captions})
    status = ladder.row_status(
        F.lit("planned_xml"), F.when(F.col("toxic") == 1, F.lit("xml_http_403")), F.coalesce(F.col("quality") == 1, F.lit(True)), F.col("policy"),
        F.col("captions"), F.col("n_chars"), F.col("doc_id") % 4, F.col("doc_id") % 3,
    )
    return docs.groupBy(ids.stable_shard(F.col("doc_id").cast("string"), 4).alias("shard"), status.alias("status")).agg(F.count("*").alias("n"))


EVENT_STATUS_SQL = "CASE event_type WHEN 'error' THEN 'xml_http_' || CAST(500 + event_id % 3 AS VARCHAR) WHEN 'view' THEN 'retry_blocked_partial_figures' WHEN 'signup' THEN 'xml_http_404' ELSE 'ok' END"


def event_status():
    t = F.col("event_type")
    return F.when(t == "error", F.concat(F.lit("xml_http_"), (500 + F.col("event_id") % 3).cast("string"))).when(t == "view", "retry_blocked_partial_figures").when(t == "signup", "xml_http_404").otherwise("ok")


@query(f"""SELECT status, regexp_matches(status, '^(xml_fetch_error|xml_html_response|xml_parse_error|row_error|partial_figures|figures_failed|xml_http_(403|408|429|5[0-9][0-9]))$') AS retryable,
 regexp_matches(regexp_replace(status, '^retry_blocked_', ''), '^(xml_fetch_error|xml_html_response|xml_parse_error|row_error|partial_figures|figures_failed|xml_http_(403|408|429|5[0-9][0-9]))$') AS target, count(*) AS n
 FROM (SELECT {EVENT_STATUS_SQL} AS status FROM events) GROUP BY ALL""")
def st4_retryable(spark, d):
    rows = table(spark, d, "events").select(event_status().alias("status"))
    return rows.groupBy("status", ladder.retryable(F.col("status")).alias("retryable"), ladder.retry_target(F.col("status")).alias("target")).agg(F.count("*").alias("n"))


@query(r"SELECT page_id, regexp_extract(url, '//[^/]+/([a-z][a-z])/', 1) AS lang, url FROM pages")
def url1_choose_fulltext(spark, d):
    pages = table(spark, d, "pages")
    chosen = urls.choose_fulltext(F.create_map(F.regexp_extract("url", r"//[^/]+/([a-z][a-z])/", 1), F.col("url")))
    return pages.select("page_id", chosen["lang"].alias("lang"), chosen["url"].alias("url"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat(regexp_extract(url, '^([^?#]*?//[^/?#]*)', 1), '/getitem.php?pid=S', page_id, '&lang=pt')
 ELSE concat(regexp_extract(url, '^([^?#]*?//[^/?#]*[^?#]*)', 1), '?format=xml&lang=', regexp_extract(url, '//[^/]+/([a-z][a-z])/', 1)) END AS xml_url FROM pages""")
def url2_xml_url(spark, d):
    """Every third page is taken to be a legacy one, which names its item in the query."""
    root, old = F.regexp_extract("url", r"^([^?#]*?//[^/?#]*)", 1), F.col("page_id") % 3 == 0
    url = F.when(old, F.concat(root, F.lit("/old/item.php?script=view&pid=S"), F.col("page_id").cast("string"), F.lit("&tlng=pt#top"))).otherwise(F.col("url"))
    lang = F.when(~old, F.regexp_extract("url", r"//[^/]+/([a-z][a-z])/", 1))
    return table(spark, d, "pages").select("page_id", urls.xml_url(url, lang, ("/item.php", "view", "/getitem.php")).alias("xml_url"))


BASE_SQL = r"trim(regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1), '[^A-Za-z0-9._+ -]+', '_', 'g'))"


@query(f"SELECT page_id, CASE WHEN {BASE_SQL} = '' THEN substr(sha256(url), 1, 16) ELSE {BASE_SQL} END AS base FROM pages")
def url3_basename(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_basename(F.col("url")).alias("base"))


@query(f"SELECT page_id, printf('p/figures/%03d-%s-%s', page_id, substr(sha256(url), 1, 12), CASE WHEN {BASE_SQL} = '' THEN substr(sha256(url), 1, 16) ELSE {BASE_SQL} END) AS member FROM pages")
def url4_media_member(spark, d):
    return table(spark, d, "pages").select("page_id", urls.media_member(F.lit("p"), F.col("page_id"), F.col("url")).alias("member"))


@query("""SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS hrefs FROM pages""")
def xml9_distinct_hrefs(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))).alias("hrefs"))


@query(r"SELECT doc_id, CAST(length(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'))) AS BIGINT) AS text_chars FROM documents")
def xml11_text_chars(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(F.trim(F.regexp_replace("text", r"[ \t\n\r\f\x0B]+", " "))).cast("long").alias("text_chars"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS text_sha256 FROM documents GROUP BY text")
def dd1_first_wins(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return dedup.first_wins(docs, ["text_sha256"], ["doc_id"])


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT text) AS BIGINT) AS n_keys, CAST(count(*) - count(DISTINCT text) AS BIGINT) AS n_duplicates FROM documents")
def dd1_duplicates(spark, d):
    return dedup.duplicates(table(spark, d, "documents"), ["text"])


@query("SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def dd4_last_wins(spark, d):
    return dedup.last_wins(table(spark, d, "orders"), ["o_custkey"], ["o_orderstatus", "o_totalprice"], "o_orderkey")


@query("SELECT d.doc_id, coalesce(nullif(CASE WHEN d.doc_id % 2 = 0 THEN d.lang ELSE '' END, ''), 'q' || CAST(l.quality AS VARCHAR)) AS lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def jn1_enrich(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("lang"))
    seed = table(spark, d, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("lang"), F.col("toxic").alias("at"))
    return joins.fill_from_seed(rows, seed, "doc_id", ["lang"], "at")


MEMBERS_SQL = "SELECT o_orderkey AS tar_path, l_linenumber AS member, CASE WHEN l_linenumber = 1 THEN 'xml' WHEN l_linenumber = 2 THEN 'source' ELSE 'figure' END AS kind, CAST(coalesce(l_quantity, 0) AS BIGINT) AS size_bytes, l_quantity IS NULL AS missing FROM (SELECT o_orderkey, unnest(range(1, 4)) AS l_linenumber FROM orders) LEFT JOIN (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) l ON l_orderkey = o_orderkey AND l.l_linenumber = l_linenumber"
MEMBERS_SQL = MEMBERS_SQL.replace("FROM (SELECT o_orderkey, unnest(range(1, 4)) AS l_linenumber FROM orders) LEFT", "FROM (SELECT o_orderkey, unnest(range(1, 4)) AS m FROM orders) LEFT").replace("l_linenumber AS member", "m AS member").replace("WHEN l_linenumber = 1", "WHEN m = 1").replace("WHEN l_linenumber = 2", "WHEN m = 2").replace("l.l_linenumber = l_linenumber", "l.l_linenumber = m")


def order_members(spark, d):
    """Three expected members of each order, held against the lines that exist."""
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("tar_path"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))).alias("member"))
    listing = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tar_path"), F.col("l_linenumber").cast("long").alias("member"), F.col("l_quantity").cast("long").alias("size"))
    sized = joins.member_sizes(wanted, listing, ["tar_path", "member"], "size")
    return sized.withColumn("kind", F.when(F.col("member") == 1, "xml").when(F.col("member") == 2, "source").otherwise("figure"))


@query(MEMBERS_SQL)
def jn2_member_sizes(spark, d):
    return order_members(spark, d).select("tar_path", "member", "kind", "size_bytes", "missing")


INVENTORY = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS {k}_members, CAST(coalesce(sum(size_bytes) FILTER (kind = '{k}'), 0) AS BIGINT) AS {k}_bytes" for k in ("xml", "source", "figure"))


@query(f"SELECT tar_path, count(*) AS members, CAST(sum(size_bytes) AS BIGINT) AS payload_bytes, {INVENTORY} FROM ({MEMBERS_SQL}) GROUP BY tar_path")
def agg7_tar_inventory(spark, d):
    return joins.inventory(order_members(spark, d), "tar_path", F.col("kind"), ["xml", "source", "figure"])


@query(f"SELECT CAST(sum(members) AS BIGINT) AS members, CAST(sum(payload_bytes) AS BIGINT) AS payload_bytes FROM (SELECT tar_path, count(*) AS members, sum(size_bytes) AS payload_bytes FROM ({MEMBERS_SQL}) GROUP BY tar_path)")
def agg8_totals(spark, d):
    return agg7_tar_inventory(spark, d).agg(F.sum("members").alias("members"), F.sum("payload_bytes").alias("payload_bytes"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jn3_verify_anti(spark, d):
    return joins.without(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 20")
def agg6_error_sample(spark, d):
    """The first 20 errors, as a report shows them."""
    return jn3_verify_anti(spark, d).orderBy("doc_id").limit(20)


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 500) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jn5_resume(spark, d):
    """A limited run: the limit counts what is done already, so it comes before the join."""
    return joins.without(table(spark, d, "documents").select("doc_id").orderBy("doc_id").limit(500), table(spark, d, "labels"), ["doc_id"])


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'repaired' ELSE event_type END AS status FROM events")
def jn7_repair_overlay(spark, d):
    old = table(spark, d, "events").select("event_id", F.col("event_type").alias("status"))
    return joins.overlay(old, old.where("status = 'error'").select("event_id", F.lit("repaired").alias("status")), ["event_id"])


@query(f"""WITH p AS (SELECT lpad(CAST({MD5.format('CAST(doc_id AS VARCHAR)', 40)} AS VARCHAR), 2, '0') AS a, lpad(CAST({MD5.format("concat(CAST(doc_id AS VARCHAR), '|sub')", 3)} AS VARCHAR), 3, '0') AS b FROM documents)
SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS planned_shard, lpad(CAST(j AS VARCHAR), 3, '0') AS planned_subtar, (SELECT count(*) FROM p WHERE a = lpad(CAST(i AS VARCHAR), 2, '0') AND b = lpad(CAST(j AS VARCHAR), 3, '0')) AS n FROM range(40) x(i), range(3) y(j)""")
def prt1_plan_buckets(spark, d):
    seed = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_id"))
    return shards.bucket_counts(shards.with_buckets(seed, 40, 3), 40, 3)


@query(f"SELECT status, count(*) AS n FROM (SELECT {EVENT_STATUS_SQL} AS status FROM events) GROUP BY 1")
def agg1_status(spark, d):
    return stats.histogram(table(spark, d, "events"), event_status(), "status", "unknown")


@query("SELECT CASE WHEN regexp_matches(text, 'GNU General Public') THEN 'GPL' WHEN regexp_matches(text, 'MIT License') THEN 'MIT' ELSE 'NONE' END AS license, count(*) AS n FROM documents GROUP BY 1")
def agg2_license(spark, d):
    code = F.when(F.contains("text", F.lit("GNU General Public")), "GPL").when(F.contains("text", F.lit("MIT License")), "MIT")
    return stats.histogram(table(spark, d, "documents"), code, "license", "NONE")


@query(f"SELECT substr(status, 15) AS status, count(*) AS n FROM (SELECT {EVENT_STATUS_SQL} AS status FROM events) WHERE status LIKE 'retry_blocked_%' GROUP BY 1")
def agg3_blocked(spark, d):
    rows = table(spark, d, "events").select(event_status().alias("status")).where(F.col("status").startswith(ladder.BLOCKED))
    return rows.groupBy(F.substring("status", len(ladder.BLOCKED) + 1, 100).alias("status")).agg(F.count("*").alias("n"))


ESTIMATE_SQL = """
WITH r AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_figures' WHEN 2 THEN 'partial_figures' ELSE 'license_skip' END AS status, n_chars AS x, CAST(doc_id % 100 AS BIGINT) AS f, CAST(doc_id % 2 * 50 AS BIGINT) AS o FROM documents),
c AS (SELECT * FROM r WHERE status IN ('ok', 'no_figures')),
s AS (SELECT (SELECT count(*) FROM r) AS sample_rows, (SELECT count(*) FROM c) AS complete_rows, (SELECT count(*) FROM r WHERE status = 'partial_figures') AS incomplete_rows,
 CAST(avg(x) FILTER (x > 0) AS DOUBLE) AS xml_bytes_mean, CAST(median(x) FILTER (x > 0) AS DOUBLE) AS xml_bytes_median, CAST(avg(f) AS DOUBLE) AS figure_bytes_mean, CAST(median(f) AS DOUBLE) AS figure_bytes_median,
 CAST(avg(CASE WHEN o = 0 THEN f ELSE o END) AS DOUBLE) AS original_bytes_mean, CAST(median(CASE WHEN o = 0 THEN f ELSE o END) AS DOUBLE) AS original_bytes_median FROM c)"""


def estimates(spark, d):
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        F.when(k % 5 == 0, "ok").when(k % 5 == 1, "no_figures").when(k % 5 == 2, "partial_figures").otherwise("license_skip").alias("status"),
        F.col("n_chars").alias("xml_bytes"), (k % 100).alias("figure_bytes"), (k % 2 * 50).alias("original_figure_bytes"),
    )
    return stats.estimate(rows, 1_409_144)


@query(ESTIMATE_SQL + " SELECT * FROM s")
def agg10_estimate(spark, d):
    return estimates(spark, d).select("sample_rows", "complete_rows", "incomplete_rows", "xml_bytes_mean", "xml_bytes_median", "figure_bytes_mean", "figure_bytes_median", "original_bytes_mean", "original_bytes_median")


@query(ESTIMATE_SQL + " SELECT complete_rows / sample_rows AS complete_fraction, CAST(round_even(1409144 * (complete_rows / sample_rows), 0) AS BIGINT) AS projected_complete FROM s")
def agg11_projection(spark, d):
    return estimates(spark, d).select("complete_fraction", "projected_complete")


@query("""WITH r AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_figures' WHEN 2 THEN 'partial_figures' ELSE 'license_skip' END AS status, n_chars * 1000 AS x, doc_id % 100 * 2000 AS f, doc_id % 2 * 500000 AS o, doc_id % 7 AS e, doc_id % 3 AS g FROM documents),
c AS (SELECT x, f, CASE WHEN o = 0 THEN f ELSE o END AS o, e, g FROM r WHERE status IN ('ok', 'no_figures')), p AS (SELECT 1409144 * ((SELECT count(*) FROM c) / (SELECT count(*) FROM r)) AS n)
SELECT CAST(avg(e) AS DOUBLE) AS figures_mean, CAST(median(e) AS DOUBLE) AS figures_median, CAST(avg(g) AS DOUBLE) AS rendered_mean, CAST(median(g) AS DOUBLE) AS rendered_median, (SELECT count(*) FROM r WHERE status = 'partial_figures') / (SELECT count(*) FROM r) AS incomplete_fraction,
 round(any_value(n) * avg(x) FILTER (x > 0) / 1e9, 2) AS projected_xml_gb, round(any_value(n) * avg(f) / 1e9, 2) AS projected_figure_gb, round(any_value(n) * avg(o) / 1e9, 2) AS projected_original_gb, round(any_value(n) * (avg(x) FILTER (x > 0) + avg(f)) / 1e9, 2) AS projected_total_gb FROM c, p""")
def agg11_volumes(spark, d):
    """Figures for each article, and the volumes that all identifiers are projected to, in GB."""
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        F.when(k % 5 == 0, "ok").when(k % 5 == 1, "no_figures").when(k % 5 == 2, "partial_figures").otherwise("license_skip").alias("status"), (F.col("n_chars") * 1000).alias("xml_bytes"),
        (k % 100 * 2000).alias("figure_bytes"), (k % 2 * 500_000).alias("original_figure_bytes"), (k % 7).alias("expected_figure_files"), (k % 3).alias("rendered_figure_files"),
    )
    return stats.estimate(rows, 1_409_144).select("figures_mean", "figures_median", "rendered_mean", "rendered_median", "incomplete_fraction", "projected_xml_gb", "projected_figure_gb", "projected_original_gb", "projected_total_gb")


@query("""SELECT 'cents' AS measure, CAST(median(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS median, CAST(count(o_totalprice) AS BIGINT) AS n FROM orders UNION ALL SELECT 'orders', CAST(median(o_custkey) AS DOUBLE), count(o_custkey) FROM orders UNION ALL SELECT 'status', CAST(median(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE), count(CASE WHEN o_orderstatus = 'F' THEN 1 END) FROM orders""")
def agg10_exact_medians(spark, d):
    """Medians of three columns in the same passes: many values, fewer, and one value with nulls."""
    rows = table(spark, d, "orders").select(F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.col("o_custkey").cast("long").alias("orders"), F.when(F.col("o_orderstatus") == "F", F.lit(1).cast("long")).alias("status"))
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first().asDict()
    found = selection.medians(rows, counts)
    return spark.createDataFrame([(c, found[c], counts[c]) for c in rows.columns], "measure string, median double, n long")


@query("""SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_linestatus = 'F') AS BIGINT) AS figure_bytes, count(*) FILTER (l_linestatus = 'F') AS downloaded, count(*) FILTER (l_linestatus <> 'F') AS failed
 FROM lineitem GROUP BY 1""")
def agg13_figure_rollup(spark, d):
    good = F.col("l_linestatus") == "F"
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.when(good, F.col("l_quantity").cast("long"))).alias("figure_bytes"), F.count_if(good).alias("downloaded"), F.count_if(~good).alias("failed"))


ATTEMPT_SQL = "SELECT conv_id, turn, CASE role WHEN 'user' THEN 'xml_http_50' || CAST(conv_id % 5 AS VARCHAR) WHEN 'system' THEN 'row_error' ELSE CASE WHEN conv_id % 2 = 0 THEN 'no_figures' ELSE 'partial_figures' END END AS status FROM conversations"


def attempts(spark, d):
    c = F.col("conv_id")
    status = F.when(F.col("role") == "user", F.concat(F.lit("xml_http_50"), (c % 5).cast("string"))).when(F.col("role") == "system", "row_error").otherwise(F.when(c % 2 == 0, "no_figures").otherwise("partial_figures"))
    return table(spark, d, "conversations").select("conv_id", "turn", status.alias("status"))


@query(f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM ({ATTEMPT_SQL})), b AS (SELECT *, status IN ('row_error', 'partial_figures') OR regexp_matches(status, '^xml_http_5[0-9][0-9]$') AS again FROM a WHERE k <= 3),
f AS (SELECT conv_id, min(k) FILTER (NOT again) AS done, max(k) AS last, arg_min(status, k) FILTER (NOT again) AS fine, arg_max(status, k) AS ended FROM b GROUP BY conv_id)
SELECT conv_id, CAST(coalesce(done, last) AS BIGINT) AS attempts, CAST(coalesce(done, last) - 1 AS BIGINT) AS retries, CASE WHEN done IS NOT NULL THEN fine WHEN last > 2 THEN 'retry_blocked_' || ended ELSE ended END AS final_status FROM f""")
def rt1_retry_fold(spark, d):
    return retry.fold_attempts(attempts(spark, d), ["conv_id"], "turn", "status", 2)


@query(f"SELECT conv_id, string_agg(CAST(turn AS VARCHAR) || ':' || status || ':first', ',' ORDER BY turn, status) AS history FROM ({ATTEMPT_SQL}) GROUP BY conv_id")
def rt7_history(spark, d):
    rows = retry.history(attempts(spark, d), ["conv_id"], "turn", ["status"], "first")
    return rows.select("conv_id", F.concat_ws(",", F.transform("retry_history", lambda h: F.concat_ws(":", h["turn"].cast("string"), h["status"], h["repair_pass"]))).alias("history"))


@query("SELECT shard, CASE WHEN shard % 10 = 0 THEN 'DONE' WHEN ts IS NULL THEN CASE WHEN shard % 3 = 0 THEN 'PARTIAL' ELSE 'MISSING' END WHEN (epoch_us(now_) - epoch_us(ts)) / 1e6 > 900 THEN 'STALE' ELSE 'ACTIVE' END AS state FROM (SELECT i AS shard FROM range(200) x(i) UNION SELECT user_id FROM events WHERE user_id IS NOT NULL) LEFT JOIN (SELECT user_id AS shard, max(ts) AS ts FROM events GROUP BY 1) USING (shard), (SELECT max(ts) AS now_ FROM events)")
def hb2_shard_state(spark, d):
    events = table(spark, d, "events").select(F.col("user_id").alias("shard"), F.col("ts").cast("timestamp").alias("ts"))
    now = events.agg(F.max("ts").alias("now"))  # one row
    # planned shards, of which some have no heartbeat, and all that have one
    ids = spark.range(200).union(events.where("shard is not null").select(F.col("shard").cast("long"))).distinct()
    every = ids.select(F.col("id").alias("shard"), (F.col("id") % 10 == 0).alias("done"), (F.col("id") % 3 == 0).cast("int").alias("parts"))
    return monitor.shard_states(every.join(F.broadcast(now)), events, F.col("now")).select("shard", "state")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN event_type = 'purchase' AND event_id % 50 = 0 THEN 'done' WHEN event_type = 'signup' THEN 'part' ELSE 'beat' END AS kind FROM events WHERE user_id IS NOT NULL)
SELECT user_id AS shard, CASE WHEN bool_or(kind = 'done') THEN 'DONE' WHEN max(ts) FILTER (kind = 'beat') IS NULL THEN 'PARTIAL' WHEN (SELECT max(epoch_ms(ts)) FROM e) - max(epoch_ms(ts)) FILTER (kind = 'beat') > 86400000 THEN 'STALE' ELSE 'ACTIVE' END AS state FROM e GROUP BY user_id""")
def hb1_liveness_stream(spark, d):
    """The states that a stream of all events ends with; a shard is stale after a day. Timers in its
    keyed state go off as the watermark passes, so silent shards need no event of their own."""
    k = F.col("event_id")
    kind = F.when((F.col("event_type") == "purchase") & (k % 50 == 0), liveness.DONE).when(F.col("event_type") == "signup", liveness.PART).otherwise(liveness.BEAT)
    rows = table(spark, d, "events").where("user_id is not null").select(F.col("user_id").alias("shard"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"))
    log, out = new_path(spark, "events"), new_path(spark, "changes")
    rows.write.parquet(log)  # the log that the stream reads
    events = spark.readStream.schema(rows.schema).parquet(log)
    writer = liveness.liveness(events, late_seconds=43_200, stale_seconds=86_400).writeStream.outputMode("append").option("checkpointLocation", new_path(spark, "check"))
    told = writer.trigger(availableNow=True).format("parquet").start(out)
    told.awaitTermination()
    return liveness.latest(spark.read.schema(liveness.CHANGES).parquet(out))


@query("""WITH e AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 - 1704067200 AS t_in FROM events), k AS (SELECT *, row_number() OVER w - 1 AS i FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t_in, event_id)),
s AS (SELECT *, max(t_in - i * 7200.0) OVER (PARTITION BY user_id ORDER BY t_in, event_id) + i * 7200.0 AS t_start FROM k) SELECT event_id, CAST(round((t_start - t_in) * 1000) AS BIGINT) AS wait_ms FROM s""")
def rl1_limiter_waits(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1704067200).alias("at"))
    return monitor.limiter_waits(events, ["user_id"], "at", 60 / 7200, "event_id").select("event_id", F.round(F.col("wait") * 1000).cast("long").alias("wait_ms"))


@query("SELECT arg_max(event_id, (ts, value, event_id)) AS event_id FROM events WHERE value > 0")
def srt6_newest(spark, d):
    return table(spark, d, "events").where("value > 0").agg(F.max_by("event_id", F.struct("ts", "value", "event_id")).alias("event_id"))


@query("""SELECT p_partkey, CAST(greatest(1, round_even(w * s, 0)) AS INTEGER) AS width, CAST(greatest(1, round_even(h * s, 0)) AS INTEGER) AS height
FROM (SELECT p_partkey, CAST(p_size * 200 AS DOUBLE) AS w, CAST(p_retailprice AS DOUBLE) * 2 AS h0, CAST(CAST(p_retailprice * 2 AS INTEGER) AS DOUBLE) AS h, least(1.0, 2048 / greatest(p_size * 200, CAST(p_retailprice * 2 AS INTEGER)), sqrt(4194304 / (CAST(p_size * 200 AS DOUBLE) * CAST(p_retailprice * 2 AS INTEGER)))) AS s FROM part)""")
def img1_capped_size(spark, d):
    size = ladder.capped_size(F.col("p_size") * 200, F.round(F.col("p_retailprice") * 2).cast("int"))
    return table(spark, d, "part").select("p_partkey", size["width"].alias("width"), size["height"].alias("height"))


@query("SELECT user_id, first, beats FROM (SELECT user_id, min(ts) AS first, count(*) AS beats FROM (SELECT user_id, ts, sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 86400000000 THEN 0 ELSE 1 END AS g FROM events)) GROUP BY user_id, run)")
def hb2_runs(spark, d):
    """Runs of heartbeats that a silence of a day ends: the batch form of the stream of stale shards."""
    events = table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    runs = events.withColumn("g", F.when(F.col("us") - F.lag("us").over(w) < 86_400_000_000, 0).otherwise(1)).withColumn("run", F.sum("g").over(w))
    return runs.groupBy("user_id", "run").agg(F.min("ts").alias("first"), F.count("*").alias("beats")).drop("run")
