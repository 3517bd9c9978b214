"""Queries of the hand-off, of resuming and of repairing, with the SQL that gives the same rows.

The manifest is made of documents: statuses, licenses, members and figures follow from
doc_id, so SQL can say the same.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, ladder
from ..operators import joins, resume, stats
from ..operators.commit import Buckets
from ..operators.retry import ENTRY
from ..operators.verify import verify
from ..sources import artifacts, tar
from ..sources.shared import new_path
from . import archives, convert, handoff
from . import seed as seeds
from .queries import MD5, query, table
from .seed import build_seed

MANIFEST_SQL = """SELECT doc_id, concat('a-', doc_id) AS source_id, CAST(doc_id AS VARCHAR) AS pid, source AS collection, CASE WHEN doc_id % 3 = 0 THEN concat('10.1/', doc_id) END AS doi,
 CASE WHEN doc_id % 2 = 0 THEN concat('10.2/', doc_id) ELSE '' END AS xml_doi,
 CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_figures' WHEN 2 THEN 'retry_blocked_row_error' WHEN 3 THEN 'partial_figures' ELSE 'license_skip' END AS status,
 CASE WHEN doc_id % 7 > 0 THEN 'CC BY' END AS license_code, CASE WHEN doc_id % 7 > 0 THEN 'keep' ELSE 'unknown' END AS license_policy,
 concat('t-', doc_id % 10) AS tar_path, CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat(doc_id, '/x') END AS xml_member, concat(doc_id, '/s') AS source_member,
 n_chars AS xml_bytes, doc_id % 100 * 10 AS figure_bytes, doc_id % 2 * 50 AS original_figure_bytes, doc_id % 4 AS expected_figure_files, doc_id % 3 AS downloaded_figure_files,
 doc_id % 8 AS shard, doc_id % 3 AS subtar, CASE WHEN doc_id % 2 = 0 THEN [concat('u', doc_id)] END AS license_urls,
 list_transform(range(doc_id % 3), lambda i: {'bytes': i * 10 + 1, 'member': concat(doc_id, '/f', i), 'original_bytes': i * 20, 'status': CASE WHEN (doc_id + i) % 2 = 0 THEN 'ok' ELSE 'error' END, 'url': concat('https://x/', doc_id, '/', i)}) AS figures FROM documents"""
ACCEPTED_SQL = f"SELECT * FROM ({MANIFEST_SQL}) WHERE status IN ('ok', 'no_figures') AND license_policy = 'keep' AND license_code = 'CC BY' AND xml_member <> ''"


def manifest(spark, d):
    k, n = F.col("doc_id"), F.col("doc_id").cast("string")
    figure = lambda i: F.struct((i * 10 + 1).alias("bytes"), F.concat(n, F.lit("/f"), i.cast("string")).alias("member"), (i * 20).alias("original_bytes"), F.when((k + i) % 2 == 0, "ok").otherwise("error").alias("status"), F.concat(F.lit("https://x/"), n, F.lit("/"), i.cast("string")).alias("url"))
    several = F.when(k % 3 > 0, F.transform(F.sequence(F.lit(0).cast("long"), k % 3 - 1), figure)).otherwise(F.transform(F.array().cast("array<bigint>"), figure))
    return table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("a-"), n).alias("source_id"), n.alias("pid"), F.col("source").alias("collection"), F.when(k % 3 == 0, F.concat(F.lit("10.1/"), n)).alias("doi"),
        F.when(k % 2 == 0, F.concat(F.lit("10.2/"), n)).otherwise("").alias("xml_doi"),
        F.when(k % 5 == 0, "ok").when(k % 5 == 1, "no_figures").when(k % 5 == 2, "retry_blocked_row_error").when(k % 5 == 3, "partial_figures").otherwise("license_skip").alias("status"),
        F.when(k % 7 > 0, "CC BY").alias("license_code"), F.when(k % 7 > 0, "keep").otherwise("unknown").alias("license_policy"),
        F.concat(F.lit("t-"), (k % 10).cast("string")).alias("tar_path"), F.when(k % 11 == 0, "").otherwise(F.concat(n, F.lit("/x"))).alias("xml_member"), F.concat(n, F.lit("/s")).alias("source_member"),
        F.col("n_chars").alias("xml_bytes"), (k % 100 * 10).alias("figure_bytes"), (k % 2 * 50).alias("original_figure_bytes"), (k % 4).alias("expected_figure_files"), (k % 3).alias("downloaded_figure_files"),
        (k % 8).alias("shard"), (k % 3).alias("subtar"), F.when(k % 2 == 0, F.array(F.concat(F.lit("u"), n))).alias("license_urls"), several.alias("figures"),
    )


def accepted_rows(spark, d):
    return handoff.split(manifest(spark, d))[0]


GIVEN = ("source_id", "pid", "collection", "xml_doi", "status", "license_code", "license_policy", "tar_path", "xml_member", "source_member")
GIVEN_NUMBERS = ("xml_bytes", "expected_figure_files", "downloaded_figure_files", "figure_bytes")
GOOD_SQL = "list_filter(figures, lambda f: f.status = 'ok')"
FLAT_SQL = ", ".join([
    "'corpus' AS source", "coalesce(nullif(doi, ''), xml_doi) AS doi", *[f"coalesce({c}, '') AS {c}" if c in GIVEN else f"CAST({c} AS VARCHAR) AS {c}" if c in ("shard", "subtar") else f"'' AS {c}" for c in handoff.FLAT_TEXTS],
    *[f"CAST({c} AS BIGINT) AS {c}" if c in GIVEN_NUMBERS else f"CAST(0 AS BIGINT) AS {c}" for c in handoff.FLAT_NUMBERS],
    "CAST(CASE WHEN original_figure_bytes <> 0 THEN original_figure_bytes ELSE figure_bytes END AS BIGINT) AS original_figure_bytes", "false AS third_party_caption_flag",
    f"CAST(to_json(list_transform({GOOD_SQL}, lambda f: f.member)) AS VARCHAR) AS figure_members_json", f"CAST(to_json(list_transform({GOOD_SQL}, lambda f: f.url)) AS VARCHAR) AS figure_urls_json",
    "CAST(to_json(figures) AS VARCHAR) AS figures_json", "'[]' AS fulltexts_json", "coalesce(CAST(to_json(license_urls) AS VARCHAR), '[]') AS license_urls_json", "'[]' AS missing_figure_urls_json", "'[]' AS third_party_caption_terms_json",
])


@query(f"SELECT {FLAT_SQL} FROM ({ACCEPTED_SQL})")
def ns3_flatten(spark, d):
    return handoff.flatten(accepted_rows(spark, d), "corpus")


@query(f"SELECT {FLAT_SQL} FROM ({ACCEPTED_SQL})")
def snk7_zstd_parquet(spark, d):
    """The flat table as it is read back from its Parquet files."""
    from ..sources.shared import new_path

    path = new_path(spark, "flat")
    handoff.write_flat(ns3_flatten(spark, d), path)
    return spark.read.parquet(path)


@query(f"""SELECT source_id, tar_path, unnest(list_concat([{{'kind': 'xml', 'member': xml_member}}, {{'kind': 'source', 'member': source_member}}], list_transform({GOOD_SQL}, lambda f: {{'kind': 'figure', 'member': f.member}})), recursive := true) FROM ({ACCEPTED_SQL})""")
def ns2_members(spark, d):
    return handoff.members(accepted_rows(spark, d))


@query(f"SELECT source_id, array_to_string(list_concat(list_filter([source_member, xml_member], lambda m: m <> ''), list_transform({GOOD_SQL}, lambda f: f.member)), ',') AS members FROM ({MANIFEST_SQL})")
def ns5_payload_members(spark, d):
    return manifest(spark, d).select("source_id", F.concat_ws(",", handoff.payload_members(F.col("source_member"), F.col("xml_member"), F.col("figures"))).alias("members"))


@query(f"""SELECT source_id, concat('{{"collection":', to_json(coalesce(collection, '')), ',"license_code":', to_json(coalesce(license_code, '')), ',"license_policy":', to_json(license_policy), ',"license_urls":', to_json(coalesce(license_urls, [])),
 ',"pid":"', pid, '","source_id":"', source_id, '","xml_http_status":', CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '200' END, '}}', chr(10)) AS document FROM ({MANIFEST_SQL})""")
def ns4_provenance(spark, d):
    rows = manifest(spark, d).withColumn("xml_http_status", F.when(F.col("doc_id") % 4 > 0, 200))
    return rows.select("source_id", handoff.provenance(rows).alias("document"))


TOTALS_SQL = "CAST(coalesce(sum(xml_bytes), 0) AS BIGINT) AS xml_bytes_manifest, CAST(coalesce(sum(figure_bytes), 0) AS BIGINT) AS figure_bytes_manifest, CAST(coalesce(sum(CASE WHEN original_figure_bytes <> 0 THEN original_figure_bytes ELSE figure_bytes END), 0) AS BIGINT) AS original_figure_bytes_manifest"


def accepted_totals(spark, d):
    return handoff.byte_totals(accepted_rows(spark, d).withColumn("rendered_figure_files", F.lit(None).cast("long")))


@query(f"SELECT {TOTALS_SQL}, CAST(sum(expected_figure_files) AS BIGINT) AS expected_figure_files, CAST(sum(downloaded_figure_files) AS BIGINT) AS downloaded_figure_files, CAST(0 AS BIGINT) AS rendered_figure_files FROM ({ACCEPTED_SQL})")
def agg9_byte_totals(spark, d):
    return accepted_totals(spark, d)


@query(f"SELECT round(xml_bytes_manifest / 1e9, 3) AS xml_manifest, round(figure_bytes_manifest / 1e9, 3) AS figures_manifest, round(original_figure_bytes_manifest / 1e9, 3) AS original_figures_manifest FROM (SELECT {TOTALS_SQL} FROM ({ACCEPTED_SQL}))")
def agg12_volumes(spark, d):
    return handoff.volumes(accepted_totals(spark, d))


@query(f"SELECT status, count(*) AS n FROM ({ACCEPTED_SQL}) GROUP BY 1")
def agg18_accepted_status(spark, d):
    return accepted_rows(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(f"SELECT source_id, status, license_code, license_policy, tar_path, xml_member, source_member FROM ({MANIFEST_SQL}) WHERE status IN ('ok', 'no_figures') AND (doc_id % 7 = 0 OR doc_id % 11 = 0) ORDER BY source_id LIMIT 20")
def st8_rejected_examples(spark, d):
    """The first 20 rejected rows, as a report shows them."""
    return handoff.rejected_examples(handoff.split(manifest(spark, d))[2], "source_id")


@query(f"""SELECT source_id, CAST(coalesce(list_sum(list_transform({GOOD_SQL}, lambda f: f.bytes)), 0) AS BIGINT) AS figure_bytes, CAST(coalesce(list_sum(list_transform({GOOD_SQL}, lambda f: CASE WHEN f.original_bytes = 0 THEN f.bytes ELSE f.original_bytes END)), 0) AS BIGINT) AS original_figure_bytes,
 CAST(len({GOOD_SQL}) AS BIGINT) AS downloaded_figure_files, array_to_string(list_transform(list_filter(figures, lambda f: f.status <> 'ok'), lambda f: f.url), ',') AS missing FROM ({MANIFEST_SQL})""")
def agg13_figure_sums(spark, d):
    sums = handoff.figure_sums(F.col("figures"))
    return manifest(spark, d).select("source_id", *[F.concat_ws(",", c).alias("missing") if n == "missing_figure_urls" else c.alias(n) for n, c in sums.items()])


@query(f"SELECT DISTINCT tar_path FROM ({MANIFEST_SQL}) WHERE CAST(substr(tar_path, 3) AS INTEGER) % 4 > 0")
def jn4_missing_tars(spark, d):
    """Archives that the manifest names and a listing of every fourth one lacks."""
    rows = manifest(spark, d)
    there = rows.where(F.col("doc_id") % 10 % 4 == 0).select("tar_path").distinct()
    return joins.without(rows.select("tar_path").distinct(), there, ["tar_path"])


@query(f"SELECT tar_path, count(*) AS members, CAST(sum(CASE WHEN kind = 'xml' THEN 0 ELSE 7 END) AS BIGINT) AS payload_bytes, count(*) FILTER (kind = 'xml') AS missing FROM (SELECT tar_path, unnest(list_concat(['xml', 'source'], list_transform({GOOD_SQL}, lambda f: 'figure'))) AS kind FROM ({ACCEPTED_SQL})) GROUP BY 1")
def jn2_handoff_accounts(spark, d):
    """The members that accepted rows name against a listing that lacks their XML."""
    rows = accepted_rows(spark, d)
    found = handoff.members(rows).where("kind <> 'xml'").select("tar_path", "member", F.lit(7).alias("size"))
    inventory, missing = handoff.accounts(rows, found)
    lacks = missing.groupBy("tar_path").agg(F.count("*").alias("missing"))
    return inventory.join(lacks, "tar_path", "left").select("tar_path", "members", "payload_bytes", F.coalesce("missing", F.lit(0)).alias("missing"))


@query(f"SELECT shard, status, CAST(sum(n) AS BIGINT) AS n FROM (SELECT shard, subtar, status, count(*) AS n FROM ({MANIFEST_SQL}) GROUP BY ALL) GROUP BY ALL")
def agg14_counter_merge(spark, d):
    """Counts of buckets added up to those of shards."""
    per = manifest(spark, d).groupBy("shard", "subtar", "status").agg(F.count("*").alias("n"))
    return per.groupBy("shard", "status").agg(F.sum("n").alias("n"))


@query(f"""SELECT shard, count(*) AS n_rows, count(*) FILTER (status IN ('ok', 'partial_figures', 'no_figures') AND xml_member = '') AS n_errors FROM ({MANIFEST_SQL}) WHERE shard <> 3 GROUP BY 1""")
def hb4_verify_all(spark, d):
    """Every shard verified at once, but one that was before: rows and XML members that are not there."""
    rows = manifest(spark, d)
    open_ = joins.without(rows, spark.createDataFrame([(3,)], "shard long"), ["shard"])
    there = rows.where("xml_member <> ''").select("tar_path", "xml_member")
    lost = joins.without(open_.where(F.col("status").isin(*ladder.ACCEPTED, *ladder.INCOMPLETE)), there, ["tar_path", "xml_member"]).groupBy("shard").agg(F.count("*").alias("n_errors"))
    return open_.groupBy("shard").agg(F.count("*").alias("n_rows")).join(lost, "shard", "left").select("shard", "n_rows", F.coalesce("n_errors", F.lit(0)).alias("n_errors"))


ARCHIVED_SQL = f"""WITH r AS (SELECT * REPLACE (concat('t-', doc_id % 10, '.tar') AS tar_path) FROM ({ACCEPTED_SQL})),
m AS (SELECT doc_id, source_id, tar_path, unnest(list_concat([{{'kind': 'xml', 'member': xml_member}}, {{'kind': 'source', 'member': source_member}}], list_transform({GOOD_SQL}, lambda f: {{'kind': 'figure', 'member': f.member}})), recursive := true) FROM r),
s AS (SELECT m.*, doc_id % 10 <> 3 AND NOT (kind = 'figure' AND doc_id % 4 = 0) AS there, CASE WHEN doc_id % 10 <> 3 AND NOT (kind = 'figure' AND doc_id % 4 = 0) THEN doc_id % 90 + length(kind) ELSE 0 END AS size_bytes FROM m)"""


def archived(spark, d):
    """Accepted rows and the archives of their members: one of ten archives is not written, nor are figures of every fourth row."""
    k = F.col("doc_id")
    rows = accepted_rows(spark, d).withColumn("tar_path", F.concat(F.lit("t-"), (k % 10).cast("string"), F.lit(".tar")))
    every = handoff.members(rows).join(rows.select("source_id", "doc_id"), "source_id").where((k % 10 != 3) & ~((F.col("kind") == "figure") & (k % 4 == 0)))
    path = new_path(spark, "archives")
    content = F.repeat(F.lit("x"), (k % 90 + F.length("kind")).cast("int"))
    tar.write_tar(every.select("tar_path", "doc_id", "kind", "member", content.alias("content")), path, order=("doc_id", "kind", "member"))
    return rows, path


@query(f"{ARCHIVED_SQL} SELECT source_id, kind, tar_path, member, size_bytes FROM s")
def jn2_archive_members(spark, d):
    """Every member that accepted rows name with the size that its archive's header tells, 0 where there is none."""
    return archives.account(spark, *archived(spark, d)).members


@query(f"""{ARCHIVED_SQL} SELECT tar_path, (SELECT count(*) FROM r WHERE r.tar_path = s.tar_path) AS rows, count(*) AS members, CAST(sum(size_bytes) AS BIGINT) AS payload_bytes, count(*) FILTER (kind = 'figure') AS figure_members,
 CAST(coalesce(sum(size_bytes) FILTER (kind = 'figure'), 0) AS BIGINT) AS figure_bytes, count(*) FILTER (NOT there) + CASE WHEN bool_or(doc_id % 10 = 3) THEN 1 ELSE 0 END AS missing, bool_and(doc_id % 10 <> 3) AS exists FROM s GROUP BY tar_path""")
def agg7_archive_accounts(spark, d):
    """Rows, members and bytes of each archive, what is missing of it, and whether it exists at all."""
    told = archives.account(spark, *archived(spark, d))
    lacks = told.missing.groupBy("tar_path").agg(F.count("*").alias("missing"))
    rows = told.archives.join(lacks, "tar_path", "left")
    return rows.select("tar_path", "rows", "members", "payload_bytes", "figure_members", "figure_bytes", F.coalesce("missing", F.lit(0)).alias("missing"), (F.col("tar_size_bytes") > 0).alias("exists"))


@query(f"""{ARCHIVED_SQL} SELECT (SELECT count(*) FROM documents) AS manifest_rows, (SELECT count(*) FROM r) AS accepted_rows, (SELECT count(*) FROM ({MANIFEST_SQL}) WHERE status LIKE 'retry_blocked_%') AS retry_blocked_rows,
 (SELECT count(*) FROM ({MANIFEST_SQL}) WHERE status IN ('ok', 'no_figures') AND (doc_id % 7 = 0 OR doc_id % 11 = 0)) AS rejected, (SELECT CAST(sum(xml_bytes) AS BIGINT) FROM r) AS xml_bytes, CAST(sum(size_bytes) AS BIGINT) AS payload_bytes, count(*) AS members,
 count(DISTINCT tar_path) AS tar_files, count(*) FILTER (NOT there) + (SELECT count(DISTINCT tar_path) FROM r WHERE doc_id % 10 = 3) AS missing, (SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM (SELECT status, count(*) AS n FROM r GROUP BY 1)) AS accepted_status,
 (SELECT count(*) FROM r) AS flat_rows, count(*) AS listed_members FROM s""")
def cnv1_hand_off(spark, d):
    """The whole hand-off written to a folder: what its summary tells, and how many rows of its artifacts are read back."""
    rows, path = archived(spark, d)
    every = manifest(spark, d).withColumn("tar_path", F.concat("tar_path", F.lit(".tar"))).withColumn("rendered_figure_files", F.lit(0).cast("long"))
    out = new_path(spark, "handoff")
    told = convert.convert(spark, every, seeds.load_seed(spark, f"{out}/no-seed"), path, out, strict=False)
    flat, listed = spark.read.parquet(f"{out}/{convert.FLAT}").count(), spark.read.json(f"{out}/{convert.MEMBERS}").count()
    kinds = ",".join(f"{k}={n}" for k, n in sorted(told["accepted_status_counts"].items()))
    row = (told["manifest_rows"], told["accepted_rows"], told["retry_blocked_rows"], told["rejected_accepted_like_count"], told["byte_totals"]["xml_bytes_manifest"], told["member_totals"]["payload_bytes"], told["member_totals"]["members"], told["member_totals"]["tar_files"], told["missing_member_count"], kinds, flat, listed)
    return spark.createDataFrame([row], "manifest_rows long, accepted_rows long, retry_blocked_rows long, rejected long, xml_bytes long, payload_bytes long, members long, tar_files long, missing long, accepted_status string, flat_rows long, listed_members long")


@query("""WITH r AS (SELECT doc_id, concat('b-', doc_id % 12, '.tar') AS tar_path, doc_id % 12 < 8 AND doc_id % 5 = 2 AS target FROM documents), t AS (SELECT *, bool_or(target) OVER (PARTITION BY tar_path) AS touched FROM r),
m AS (SELECT doc_id, tar_path, target AND touched AS again, touched, unnest(CASE WHEN target THEN ['new', 'x'] ELSE ['s', 'x'] END) AS kind, unnest([0, 1]) AS at_ FROM t)
SELECT tar_path, row_number() OVER (PARTITION BY tar_path ORDER BY doc_id, at_) - 1 AS ordinal, concat(doc_id, '/', kind) AS member, sha256(CASE WHEN again THEN concat('repaired ', doc_id) ELSE concat(kind, doc_id) END) AS sha256 FROM m""")
def rt4_repaired_archives(spark, d):
    """Archives with repaired rows written anew: targets bring their members, other rows keep theirs, other archives are not touched."""
    k, n, path = F.col("doc_id"), F.col("doc_id").cast("string"), new_path(spark, "repaired")
    name = lambda kind: F.concat(n, F.lit(f"/{kind}"))
    docs = table(spark, d, "documents").select(k, F.concat(F.lit("b-"), (k % 12).cast("string"), F.lit(".tar")).alias("tar_path"))
    old = docs.select("tar_path", "doc_id", F.explode(F.array(F.lit("s"), F.lit("x"))).alias("kind"))
    tar.write_tar(old.select("tar_path", "doc_id", "kind", F.concat(n, F.lit("/"), "kind").alias("member"), F.concat("kind", n).alias("content")), path, order=("doc_id", "kind"))
    figures = F.array().cast("array<struct<status:string,member:string>>")
    rows = docs.select("tar_path", k.alias("row"), name("s").alias("source_member"), name("x").alias("xml_member"), figures.alias("figures"), ((k % 12 < 8) & (k % 5 == 2)).alias("target"))
    data = F.encode(F.concat(F.lit("repaired "), n), "UTF-8")
    made = F.array(*[F.struct(name(m).alias("member"), data.alias("content")) for m in ("new", "x")])
    archives.repair_archives(spark, path, rows, docs.where((k % 12 < 8) & (k % 5 == 2)).select("tar_path", k.alias("row"), made.alias("members")))
    return tar.read_tar(spark, path, payload=True).select("tar_path", "ordinal", "member", F.sha2("content", 256).alias("sha256"))


PAIRED_SQL = f"""WITH r AS (SELECT doc_id, shard, subtar, CASE WHEN doc_id % 17 > 0 THEN concat(shard, '/', subtar, '-', doc_id % 2, '.tar') END AS tar_path, CASE WHEN doc_id % 19 > 0 THEN status END AS status, xml_member, figures FROM ({MANIFEST_SQL})),
tars AS (SELECT DISTINCT shard, subtar, tar_path FROM r WHERE tar_path IS NOT NULL), there AS (SELECT * FROM tars WHERE NOT (shard = 5 AND subtar = 1 AND tar_path LIKE '%-1.tar')),
held AS (SELECT r.doc_id, r.shard, r.subtar, r.status, r.xml_member, r.figures, r.tar_path AS own, t.tar_path FROM r JOIN there t USING (shard, subtar)),
wanted AS (SELECT doc_id, shard, subtar, own, tar_path, 'xml' AS kind, 0 AS place, xml_member AS member FROM held WHERE status IN ('ok', 'no_figures', 'partial_figures', 'figures_failed')
 UNION ALL SELECT doc_id, shard, subtar, own, tar_path, 'figure', i, member FROM (SELECT *, unnest(list_transform(figures, lambda f: f.status)) AS s, unnest(list_transform(figures, lambda f: f.member)) AS member, unnest(range(1, len(figures) + 1)) AS i FROM held WHERE status IN ('ok', 'no_figures', 'partial_figures', 'figures_failed')) WHERE s = 'ok'),
errors AS (SELECT shard, subtar, tar_path, CAST(NULL AS BIGINT) AS at_, 0 AS place, 'tar' AS kind, concat('missing tar ', tar_path) AS text FROM (SELECT * FROM tars EXCEPT SELECT * FROM there)
 UNION ALL SELECT shard, subtar, tar_path, doc_id, place, kind, concat('missing ', kind, ' member ', member, ' in ', tar_path) FROM wanted WHERE member = '' OR own IS DISTINCT FROM tar_path OR doc_id % 23 = 0)"""


def verified(spark, d, **options):
    """Manifests of two archives each, of which one does not exist; members of every 23rd row are in none."""
    k, rows = F.col("doc_id"), manifest(spark, d)
    tar = F.when(k % 17 > 0, F.concat(F.col("shard").cast("string"), F.lit("/"), F.col("subtar").cast("string"), F.lit("-"), (k % 2).cast("string"), F.lit(".tar")))
    rows = rows.withColumns({"tar_path": tar, "status": F.when(k % 19 > 0, F.col("status"))})
    archives = rows.select("tar_path").where("tar_path is not null and tar_path <> '5/1-1.tar'").distinct()
    names = F.concat(F.array("xml_member"), F.transform("figures", lambda f: f["member"]))
    members = rows.where((k % 23 > 0) & F.col("tar_path").isNotNull()).select("tar_path", F.explode(names).alias("member"))
    return verify(rows, archives, members, ["shard", "subtar"], "doc_id", **options)


@query(f"{PAIRED_SQL} SELECT shard, coalesce(status, 'unknown') AS status, count(*) AS n FROM held GROUP BY ALL")
def agg6_verify_statuses(spark, d):
    return verified(spark, d).statuses


@query(f"""{PAIRED_SQL} SELECT shard, n_rows, coalesce(n_errors, 0) AS n_errors, coalesce(n_tar, 0) AS n_tar, coalesce(n_xml, 0) AS n_xml, coalesce(n_figure, 0) AS n_figure, coalesce(errors, '') AS errors FROM (SELECT shard, count(*) AS n_rows FROM held GROUP BY shard)
 LEFT JOIN (SELECT shard, count(*) AS n_errors, count(*) FILTER (kind = 'tar') AS n_tar, count(*) FILTER (kind = 'xml') AS n_xml, count(*) FILTER (kind = 'figure') AS n_figure FROM errors GROUP BY shard) USING (shard)
 LEFT JOIN (SELECT shard, string_agg(text, ';' ORDER BY k) AS errors FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY subtar, tar_path, at_, place) AS k FROM errors) WHERE k <= 20 GROUP BY shard) USING (shard)""")
def agg6_verify_report(spark, d):
    """Rows, errors by kind and the first 20 errors of each shard."""
    return verified(spark, d).report().withColumn("errors", F.array_join("errors", ";"))


@query(f"{PAIRED_SQL} SELECT shard, subtar, tar_path, kind, count(*) AS n FROM errors WHERE shard NOT IN (3, 4) GROUP BY ALL")
def hb4_verified_shards(spark, d):
    """Every shard verified but those that were before: what is missing of each archive."""
    done = spark.createDataFrame([(3,), (4,)], "shard long")
    return verified(spark, d, done=done).errors.groupBy("shard", "subtar", "tar_path", "kind").agg(F.count("*").alias("n"))


@query(f"SELECT which, license, count(*) AS n FROM (SELECT 'all' AS which, coalesce(license_code, 'NONE') AS license FROM ({MANIFEST_SQL}) UNION ALL SELECT 'accepted', coalesce(license_code, 'NONE') FROM ({ACCEPTED_SQL})) GROUP BY ALL")
def agg2_license_codes(spark, d):
    """License codes of all rows and of the accepted ones."""
    rows = manifest(spark, d)
    of = lambda which, r: stats.histogram(r, F.col("license_code"), "license", "NONE").select(F.lit(which).alias("which"), "license", "n")
    return of("all", rows).unionByName(of("accepted", handoff.split(rows)[0]))


@query(f"SELECT source_id, status FROM ({MANIFEST_SQL}) WHERE status IN ('ok', 'partial_figures', 'license_skip')")
def st10_plan_of_statuses(spark, d):
    return artifacts.filtered(manifest(spark, d), ("ok", "partial_figures", "license_skip")).select("source_id", "status")


@query("""SELECT concat('a-', doc_id) AS source_id, CASE WHEN doc_id % 2 = 0 THEN 'own' WHEN doc_id % 4 = 1 THEN concat('late', doc_id) ELSE '' END AS document_type, CASE WHEN doc_id % 4 = 1 THEN CAST(2000 + doc_id % 20 AS VARCHAR) END AS publication_year, CASE WHEN doc_id % 4 = 1 THEN '{"html":{"en":"u"}}' END AS fulltexts FROM documents""")
def src10_enriched(spark, d):
    """Manifest rows filled from a seed of JSON lines: the last line of an id counts whole, ids that are no texts do not."""
    k, n, path = F.col("doc_id"), F.col("doc_id").cast("string"), new_path(spark, "seed")
    docs = table(spark, d, "documents").where(k % 4 < 2)
    line = lambda id_, kind, rest: F.concat(F.lit('{"source_id":'), id_, F.lit(',"document_type":"'), kind, F.lit('"'), rest, F.lit("}"))
    name = F.concat(F.lit('"a-'), n, F.lit('"'))
    late = line(name, F.concat(F.lit("late"), n), F.concat(F.lit(',"publication_year":'), (2000 + k % 20).cast("string"), F.lit(',"fulltexts":{"html":{"en":"u"}}')))
    lines = F.when(k % 4 == 1, F.array(line(name, F.lit("early"), F.lit(',"publication_date":"2001"')), late, line(n, F.lit("number"), F.lit("")), line(F.lit('""'), F.lit("empty"), F.lit("")))).otherwise(F.array(line(n, F.lit("number"), F.lit(""))))
    docs.select(F.explode(lines).alias("value")).write.text(path)
    rows = table(spark, d, "documents").select(F.concat(F.lit("a-"), n).alias("source_id"), F.when(k % 2 == 0, "own").otherwise("").alias("document_type"))
    return seeds.enrich(rows, seeds.load_seed(spark, path)).select("source_id", "document_type", "publication_year", F.to_json("fulltexts").alias("fulltexts"))


CACHE_SQL = "SELECT event_id, user_id AS bucket, CASE event_type WHEN 'error' THEN 'xml_http_' || CAST(500 + event_id % 3 AS VARCHAR) WHEN 'view' THEN 'retry_blocked_partial_figures' WHEN 'signup' THEN 'xml_http_404' ELSE 'ok' END AS status, event_id % 2 = 0 AS has_payload FROM events"


def cache(spark, d):
    from .queries import event_status

    k = F.col("event_id")
    past = F.when(k % 4 == 0, F.array_repeat(F.lit("x"), (k % 6).cast("int")))
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("bucket"), event_status().alias("status"), (k % 2 == 0).alias("has_payload"), past.alias("retry_history"))


@query(f"SELECT event_id, status FROM ({CACHE_SQL}) WHERE NOT has_payload OR event_id % 3 = 0")
def rt3_valid_cache(spark, d):
    rows = cache(spark, d)
    return resume.valid_cache(rows, rows.where(F.col("event_id") % 3 == 0), ["event_id"]).select("event_id", "status")


@query(f"SELECT event_id, CAST(least(greatest(CASE WHEN event_id % 4 = 0 THEN event_id % 6 ELSE 1 END, 1), 2) AS BIGINT) AS retries_used FROM ({CACHE_SQL}) WHERE regexp_matches(status, '^xml_http_50')")
def rt2_retry_states(spark, d):
    return resume.retry_states(cache(spark, d), ["event_id"], 2)[1]


@query(f"SELECT event_id, CASE WHEN event_id % 5 > 0 THEN status WHEN event_id % 2 = 0 THEN 'again' END AS status FROM ({CACHE_SQL})")
def jn6_cache_overlay(spark, d):
    rows = cache(spark, d)
    new = rows.where("event_id % 2 = 0").select("event_id", F.lit("again").alias("status"))
    return resume.overlay_cache(rows.select("event_id"), rows.where("event_id % 5 > 0"), new, ["event_id"])


@query(f"SELECT bucket, count(*) AS n_rows, count(*) FILTER (event_id % 97 = 0) AS n_missing, CASE WHEN bucket % 4 = 0 THEN 'done' WHEN count(*) FILTER (event_id % 97 = 0) = 0 THEN 'commit' ELSE 'incomplete' END AS state FROM ({CACHE_SQL}) GROUP BY 1")
def rt4_commit_states(spark, d):
    rows = cache(spark, d).select("bucket", F.when(F.col("event_id") % 97 > 0, F.col("status")).alias("status"))
    return resume.commit_states(rows, rows.where("bucket % 4 = 0"), ["bucket"])


TARGET_SQL = "(regexp_matches(status, '^xml_http_50') OR status LIKE 'retry_blocked_%')"


@query(f"SELECT bucket, count(*) FILTER {TARGET_SQL.replace('(regexp', '(WHERE (regexp', 1)}) AS n_targets, CASE WHEN count(*) FILTER {TARGET_SQL.replace('(regexp', '(WHERE (regexp', 1)}) = 0 THEN count(*) ELSE 0 END AS repair_noop FROM ({CACHE_SQL}) GROUP BY 1")
def rt8_repair_plan(spark, d):
    return resume.repair_plan(cache(spark, d), ["bucket"])


@query(f"SELECT event_id, status FROM ({CACHE_SQL}) WHERE {TARGET_SQL} ORDER BY event_id LIMIT 100")
def srt8_repair_targets(spark, d):
    """A repair pass that was asked for its first 100 targets."""
    return resume.repair_targets(cache(spark, d), "event_id", 100).select("event_id", "status")


@query(f"SELECT bucket, planned, nullif(written, 0) AS written FROM (SELECT bucket, count(*) AS planned, count(*) FILTER (event_id % 50 > 0) AS written FROM ({CACHE_SQL}) GROUP BY 1) WHERE planned <> written")
def jn7_length_mismatch(spark, d):
    rows = cache(spark, d)
    return resume.mismatched(rows, rows.where("event_id % 50 > 0"), ["bucket"])


REPAIR_SQL = f"""WITH r AS (SELECT event_id, user_id % 40 AS b, status, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS p, event_id % 3 AS m, {TARGET_SQL} AS target FROM (SELECT event_id, user_id, {{status}} AS status FROM events)),
t AS (SELECT *, b % 3 > 0 AND count(*) FILTER (target) OVER (PARTITION BY b) > 0 AS done FROM r), u AS (SELECT *, target AND done AS again FROM t)
SELECT lpad(CAST(b AS VARCHAR), 2, '0') AS bucket, event_id, CASE WHEN NOT again THEN status WHEN m = 2 THEN 'no_figures' WHEN m = 0 OR event_id % 2 = 0 THEN 'ok' ELSE 'retry_blocked_row_error' END AS status,
 CAST(CASE WHEN again AND m = 1 THEN p + 2 WHEN again AND p > 0 THEN p + 1 END AS INTEGER) AS row_attempts, CAST(CASE WHEN again AND m = 1 THEN p + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END WHEN again AND p > 0 THEN p END AS INTEGER) AS row_retries,
 CAST(p + CASE WHEN again AND m = 1 THEN CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END ELSE 0 END AS INTEGER) AS entries, CASE WHEN again AND m = 1 THEN 'second' WHEN p > 0 THEN 'first' END AS last_pass, CASE WHEN done THEN 2 ELSE 1 END AS run FROM u"""
EVENT_SQL = "CASE event_type WHEN 'error' THEN 'xml_http_' || CAST(500 + event_id % 3 AS VARCHAR) WHEN 'view' THEN 'retry_blocked_partial_figures' WHEN 'signup' THEN 'xml_http_404' ELSE 'ok' END"


def repaired(spark, d):
    """Buckets of events that are committed, overwritten by a run that is killed, and repaired by a pass
    that has attempts for two buckets of three. Returns the table and what the pass did with each bucket."""
    from .queries import event_status

    k = F.col("event_id")
    past = F.when(k % 4 == 0, F.array(F.struct(F.lit(1).alias("attempt"), F.lit("row_error").alias("status"), F.lit(None).cast("string").alias("error"), F.lit("first").alias("repair_pass"))))
    rows = table(spark, d, "events").select(F.lpad((F.col("user_id") % 40).cast("string"), 2, "0").alias("bucket"), k, event_status().alias("status"), F.lit(None).cast("int").alias("row_attempts"), F.lit(None).cast("int").alias("row_retries"), past.cast(ENTRY).alias("retry_history"))
    held = Buckets(spark, new_path(spark, "buckets"), rows.schema, ["bucket"], "event_id")
    held.commit(rows)
    held.stage(rows.withColumn("status", F.lit("ok")), held.next_run())  # killed before its commits
    tries = rows.where(F.col("bucket").cast("int") % 3 > 0).select("bucket", "event_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("try"))
    first = F.when(k % 3 == 0, "ok").when(k % 3 == 1, "xml_http_503").otherwise("no_figures")
    told = F.when(F.col("try") == 1, first).when(k % 3 == 1, F.when(k % 2 == 0, "ok").otherwise("row_error"))
    states = held.repair(tries.withColumn("status", told).where("status is not null"), "second", 1)
    return held, states


@query(REPAIR_SQL.replace("{status}", EVENT_SQL))
def rt7_repaired_buckets(spark, d):
    """All rows after the repair: histories carried on, and the run that each bucket was last committed by."""
    rows = repaired(spark, d)[0].rows()
    return rows.select("bucket", "event_id", "status", "row_attempts", "row_retries", F.coalesce(F.size("retry_history"), F.lit(0)).alias("entries"), F.element_at("retry_history", -1)["repair_pass"].alias("last_pass"), F.col("run").cast("int").alias("run"))


@query(f"""SELECT lpad(CAST(b AS VARCHAR), 2, '0') AS bucket, count(*) FILTER (target) AS n_targets, CASE WHEN b % 3 = 0 THEN count(*) FILTER (target) ELSE 0 END AS n_missing, CASE WHEN count(*) FILTER (target) = 0 THEN 'noop' WHEN b % 3 = 0 THEN 'incomplete' ELSE 'commit' END AS state
 FROM (SELECT user_id % 40 AS b, {TARGET_SQL} AS target FROM (SELECT user_id, {EVENT_SQL} AS status FROM events)) GROUP BY b""")
def rt4_repair_states(spark, d):
    """What the pass did with each bucket; targets without attempts leave theirs incomplete."""
    return repaired(spark, d)[1]


KEY_SQL = "concat(coalesce(source, ''), '|', doc_id % 300)"


def fetched(spark, d):
    return table(spark, d, "documents").select(F.col("source").alias("collection"), (F.col("doc_id") % 300).cast("string").alias("code"), "doc_id")


@query(f"SELECT collection, code, min(doc_id) AS doc_id FROM (SELECT coalesce(source, '') AS collection, CAST(doc_id % 300 AS VARCHAR) AS code, doc_id FROM documents WHERE {MD5.format(KEY_SQL, 4)} = 1 AND {MD5.format(f'''concat('articlemeta-sub|', {KEY_SQL})''', 2)} = 0) GROUP BY 1, 2")
def dd3_resumed(spark, d):
    return resume.resumed(fetched(spark, d), ["doc_id"], shards=4, shard=1, subs=2, sub=0)


@query(f"SELECT doc_id FROM documents WHERE {MD5.format('CAST(doc_id AS VARCHAR)', 4)} = 2")
def prt2_of_shard(spark, d):
    """The identifiers of one shard of four, which is what a shard's run reads."""
    return resume.of_shard(table(spark, d, "documents").select("doc_id"), F.col("doc_id").cast("string"), 4, 2)


@query("SELECT (SELECT count(*) FROM documents) AS selected, (SELECT count(*) FROM labels) AS restored, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS fetched, (SELECT count(*) FROM labels) + (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS written")
def agg16_fetch_summary(spark, d):
    docs, done = table(spark, d, "documents"), table(spark, d, "labels")
    return resume.fetch_summary(docs, done, resume.to_run(docs, done, ["doc_id"]))


@query("SELECT count(DISTINCT user_id) AS n_done, count(DISTINCT user_id) >= 120 AS open FROM events WHERE event_type = 'purchase'")
def hb3_barrier(spark, d):
    return resume.barrier(table(spark, d, "events").where("event_type = 'purchase'"), 120, "user_id")


@query("SELECT event_id, least(60.0, coalesce(CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 90 AS DOUBLE) END, 0.5 * pow(2.0, event_id % 9))) AS wait FROM events")
def rl3_backoff(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", resume.backoff((k % 9).cast("double"), 0.5, 60.0, F.when(k % 5 == 0, (k % 90).cast("double"))).alias("wait"))


@query("""SELECT concat('corpus-', CASE WHEN source IS NULL OR source = '' THEN 'col' ELSE source END, '-', doc_id % 500) AS source_id, source AS collection, CAST(doc_id % 500 AS VARCHAR) AS pid, CASE WHEN doc_id % 3 > 0 THEN 'en' ELSE '' END AS preferred_lang,
 CASE WHEN doc_id % 3 > 0 THEN concat('https://x/', doc_id) ELSE '' END AS fulltext_html_url, CASE WHEN doc_id % 4 = 0 THEN 'articlemeta_error' WHEN doc_id % 3 = 0 THEN 'no_fulltext_url' ELSE 'planned_xml' END AS status
 FROM (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, doc_id % 500)""")
def st1_seed_table(spark, d):
    k = F.col("doc_id")
    meta = table(spark, d, "documents").select(
        F.col("source").alias("collection"), (k % 500).cast("string").alias("code"), F.lit("").alias("doi"), F.when(k % 4 == 0, "http_error").otherwise("ok").alias("status"),
        F.when(k % 3 > 0, F.create_map(F.lit("en"), F.concat(F.lit("https://x/"), k.cast("string")))).alias("html"), k.alias("row_index"),
    )
    return build_seed(meta).drop("doi")


@query("SELECT doc_id, n_chars, CASE WHEN doc_id % 3 > 0 THEN 'planned_xml' ELSE 'no_fulltext_url' END AS status FROM documents WHERE doc_id % 3 > 0 ORDER BY doc_id LIMIT 50")
def snk11_probe(spark, d):
    """The first 50 planned rows, for a trial run; internal columns stay behind."""
    rows = table(spark, d, "documents").select("doc_id", "n_chars", F.when(F.col("doc_id") % 3 > 0, "planned_xml").otherwise("no_fulltext_url").alias("status"), F.lit(1).alias("_work"))
    return artifacts.public_columns(artifacts.probe(rows, "doc_id", 50))


@query(f"SELECT status, status IN ('ok', 'no_figures') AS complete, status IN ('partial_figures', 'figures_failed') AS incomplete, count(*) AS n FROM ({MANIFEST_SQL}) WHERE status <> 'license_skip' GROUP BY ALL")
def st9_completeness_classes(spark, d):
    """Statuses by class, of the statuses that a plan asks for."""
    rows = manifest(spark, d).where(F.col("status").isin(*ladder.ACCEPTED, *ladder.INCOMPLETE, "retry_blocked_row_error"))
    return rows.groupBy("status", F.col("status").isin(*ladder.ACCEPTED).alias("complete"), F.col("status").isin(*ladder.INCOMPLETE).alias("incomplete")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(400 + event_id % 130 AS BIGINT) AS code, (400 + event_id % 130) IN (403, 408, 409, 425, 429, 500, 502, 503, 504, 520, 521, 522, 523, 524) AS again FROM events")
def st6_request_retryable(spark, d):
    code = 400 + F.col("event_id") % 130
    return table(spark, d, "events").select("event_id", code.alias("code"), ladder.request_retryable(code).alias("again"))


@query(r"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN coalesce(nullif(CASE WHEN page_id % 3 > 0 THEN CAST(page_id AS VARCHAR) ELSE '' END, ''), url) ELSE url END AS first_value, CASE WHEN page_id % 2 = 0 THEN concat('a.b/', page_id, '.jpg') ELSE concat('a.b/', page_id, '.jpg') END AS member, substr(html, 1, 300) AS error, sha256(html) AS digest FROM pages""")
def fn8_fn13_values(spark, d):
    k = F.col("page_id")
    member = F.concat(F.lit("a.b/"), k.cast("string"), F.when(k % 2 == 0, ".tif").otherwise(""))
    first = ids.first_text(F.when((k % 2 == 0) & (k % 3 > 0), k.cast("string")).otherwise(""), F.col("url"))
    return table(spark, d, "pages").select("page_id", first.alias("first_value"), ids.with_extension(member, ".jpg").alias("member"), ids.short_error(F.col("html")).alias("error"), F.sha2("html", 256).alias("digest"))
