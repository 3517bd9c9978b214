import hashlib

from pyspark.sql import functions as F

from millrace.functions import ids, ladder, urls
from millrace.functions.licenses import license_of
from millrace.functions.xml import parse_xml, rewritten
from millrace.operators import dedup, joins, monitor, retry


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_stable_shard(spark):
    for value, n, want in (("a", 40, 0), ("é", 40, 2), ("", 7, int(hashlib.md5(b"").hexdigest()[:16], 16) % 7)):
        assert one(spark, ids.stable_shard(F.lit(value), n)) == want


def test_source_id(spark):
    assert one(spark, ids.source_id(F.lit("a b/c"), F.lit("(S1)"), None, "x")) == "x-a-b-c-S1"
    assert one(spark, ids.source_id(F.lit(""), F.lit(""), F.lit("10.1/x"), "x")) == "x-col-4d718a0a89634e64"
    assert len(one(spark, ids.source_id(F.lit("c"), F.lit("p" * 300)))) == 180


def test_ints_and_names(spark):
    for text, want in ((" 12 ", 12), ("+3", 3), ("1.5", 0), ("abc", 0), (None, 0)):
        assert one(spark, ids.int_value(F.lit(text).cast("string"))) == want
    assert one(spark, ids.with_extension(F.lit("a/b.tif"), ".jpg")) == "a/b.jpg"
    assert one(spark, ids.with_extension(F.lit("a.x/b"), ".jpg")) == "a.x/b.jpg"


def test_license_vectors(spark):
    cases = {"": (None, "missing"), "https://creativecommons.org/licenses/by/4.0/": ("CC BY", "keep"), "x/by-nc/4.0/": (None, "skip"), "CC BY 4.0": (None, "unknown"), "https://creativecommons.org/publicdomain/zero/1.0/": ("CC0", "keep"), "Public Domain Mark": ("PD", "keep"), "published by SAGE under Creative Commons Attribution": (None, "skip"), "Creative Commons Attribution &amp; more": ("CC BY", "keep")}
    for text, want in cases.items():
        assert tuple(one(spark, license_of(F.lit(text), unescape=True))) == want


def test_ladder_and_retryable(spark):
    yes = ["xml_http_403", "xml_http_599", "xml_fetch_error", "row_error", "partial_figures"]
    no = ["xml_http_404", "xml_http_409", "license_skip", "ok", "retry_blocked_xml_http_502", None]
    for s in yes + no:
        assert one(spark, ladder.retryable(F.lit(s).cast("string"))) == (s in yes)
    assert one(spark, ladder.retry_target(F.lit("retry_blocked_xml_http_502")))
    sizes = {(4000, 3000): (2048, 1536), (2048, 2048): (2048, 2048), (100, 100): (100, 100), (10000, 1): (2048, 1), (0, 5): (0, 5)}
    for (w, h), want in sizes.items():
        assert tuple(one(spark, ladder.capped_size(F.lit(w), F.lit(h)))) == want
    for expected, got, want in ((0, 0, "no_figures"), (3, 3, "ok"), (3, 1, "partial_figures"), (3, 0, "figures_failed")):
        assert one(spark, ladder.figure_status(F.lit(expected), F.lit(got))) == want
    assert one(spark, ladder.caption_terms(F.array(F.lit("Source: IBGE. Courtesy of X")))) == ["courtesy", "source:"]


def test_urls(spark):
    choose = lambda m: tuple(one(spark, urls.choose_fulltext(F.from_json(F.lit(m), "map<string,string>"))))
    assert choose('{"pt": "p", "en": "e"}') == ("en", "e")
    assert choose('{"fr": "", "de": "u"}') == ("de", "u")
    assert choose("[]") == ("", "")
    legacy = "https://x.test/article.php?script=sci_arttext&pid=S10&tlng=es"
    assert one(spark, urls.xml_url(F.lit(legacy), None, ("/article.php", "sci_arttext", "/articleXML.php"))) == "https://x.test/articleXML.php?pid=S10&lang=es"
    assert one(spark, urls.xml_url(F.lit("https://x.test/j/abc/?lang=en#f"), None, ("/article.php", "sci_arttext", "/articleXML.php"))) == "https://x.test/j/abc/?format=xml&lang=en"
    assert one(spark, urls.url_basename(F.lit("https://x.test/img/a%20b.tif?x=1"))) == "a b.tif"
    assert one(spark, urls.joined_url(F.lit("https://x.test/j/abc/?f=1"), F.lit("../img/f1.jpg"))) == "https://x.test/j/img/f1.jpg"


XML = '<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-id pub-id-type="DOI">10.1/x</article-id><article-title>T <i>u</i> v</article-title><license xlink:href="https://creativecommons.org/licenses/by/4.0/">ok</license></front><body>ab  c<fig><caption>Adapted from X</caption><graphic xlink:href="f.tif"/></fig></body></article>'


def test_xml(spark):
    rows = spark.createDataFrame([(XML,), ("<html/>",), ("<a",), ("",), (None,), ("<!DOCTYPE a [<!ENTITY x 'y'>]><article/>",)], "t string").select(parse_xml("t").alias("r")).collect()
    first = rows[0]["r"]
    assert (first["ok"], first["doi"], first["title"], first["figures"], list(first["hrefs"])) == (True, "10.1/x", "T u v", 1, ["f.tif"])
    assert list(first["license_urls"]) == ["https://creativecommons.org/licenses/by/4.0/"] and list(first["captions"]) == ["Adapted from X"]
    assert [r["r"]["ok"] for r in rows[1:]] == [False] * 4 + [True] and rows[1]["r"]["error"] == "not_article:html"
    assert b'="m/1.jpg"' in rewritten(XML, {"https://x.test/f.tif": "m/1.jpg"}, "https://x.test/")


def test_retry_fold(spark):
    logs = {1: ["xml_http_502", "xml_http_502", "no_figures"], 2: ["xml_http_502", "row_error", "xml_http_503", "ok"], 3: ["xml_http_404", "ok"]}
    rows = spark.createDataFrame([(k, i, s) for k, v in logs.items() for i, s in enumerate(v)], "k int, i int, s string")
    got = {r["k"]: (r["attempts"], r["final_status"]) for r in retry.fold_attempts(rows, ["k"], "i", "s", 2).collect()}
    assert got == {1: (3, "no_figures"), 2: (3, "retry_blocked_xml_http_503"), 3: (1, "xml_http_404")}


def test_states_and_waits(spark):
    for done, age, parts, want in ((True, 5000, 0, "DONE"), (False, 900, 0, "ACTIVE"), (False, 901, 0, "STALE"), (False, None, 1, "PARTIAL"), (False, None, 0, "MISSING")):
        assert one(spark, monitor.state_of(F.lit(done), F.lit(age).cast("double"), F.lit(parts))) == want
    rows = spark.createDataFrame([("e", float(t), i) for i, t in enumerate((0, 1, 1, 10))], "e string, t double, i int")
    assert [r["start"] for r in monitor.limiter_waits(rows, ["e"], "t", 30, "i").orderBy("i").collect()] == [0, 2, 4, 10]


def test_fill_and_overlay(spark):
    rows = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "k string, v string")
    seed = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("c", "no", 1), ("", "z", 1)], "k string, v string, at int")
    assert {r["k"]: r["v"] for r in joins.fill_from_seed(rows, seed, "k", ["v"], "at").collect()} == {"a": "new", "b": None, "c": "x"}
    assert {r["k"]: r["v"] for r in joins.overlay(rows, seed.where("at = 2").select("k", "v"), ["k"]).collect()}["a"] == "new"
    assert dedup.duplicates(seed, ["k"]).first()["n_duplicates"] == 1
