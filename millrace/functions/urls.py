"""URL functions over columns."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Languages asked for first, in order.
PREFERRED = ("en", "pt", "es")


def choose_fulltext(html: Column) -> Column:
    """struct<lang, url> of a map lang -> url: preferred languages, then the first in map order."""
    entries = F.filter(F.map_entries(html), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    by_lang = lambda lang: F.filter(entries, lambda e: e["key"] == F.lit(lang))
    wanted = [by_lang(lang) for lang in PREFERRED]
    best = F.get(F.concat(*wanted, entries), F.lit(0))
    return F.struct(F.coalesce(best["key"], F.lit("")).alias("lang"), F.coalesce(best["value"], F.lit("")).alias("url"))


def query_value(url: Column, name: str) -> Column:
    """The decoded value of a query parameter, null where it is absent or empty."""
    return F.nullif(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name))), F.lit(""))


def form_encoded(text: Column) -> Column:
    """As HTML forms encode: hyphen, dot, underscore and tilde stay, the asterisk does not."""
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def xml_url(url: Column, lang: Column | None, legacy: tuple[str, str, str]) -> Column:
    """Where an article's XML lies, from its final URL.

    Legacy pages name the article by script and pid and have a page of their own for XML;
    all others take format=xml. Other parameters and the fragment are dropped. legacy: how
    the path of a site's legacy pages ends, their script, and the path of their XML.
    """
    legacy_page, legacy_script, legacy_xml = legacy
    known = [query_value(url, n) for n in ("lang", "tlng", "lng")]
    lang = F.coalesce(*([F.nullif(lang, F.lit(""))] if lang is not None else []), *known, F.lit("en"))
    root = F.regexp_extract(url, r"^([^?#]*?//[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[^?#]*?//[^/?#]*([^?#]*)", 1)
    pid = query_value(url, "pid")
    old = path.endswith(legacy_page) & (query_value(url, "script") == legacy_script) & pid.isNotNull()
    return F.when(F.coalesce(old, F.lit(False)), F.concat(root, F.lit(legacy_xml + "?pid="), form_encoded(pid), F.lit("&lang="), form_encoded(lang))).otherwise(
        F.concat(root, path, F.lit("?format=xml&lang="), form_encoded(lang))
    )


def url_basename(url: Column) -> Column:
    """The last segment of the decoded path with unsafe runs as "_"; a hash of the url where it is empty."""
    path = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    last = F.trim(F.regexp_replace(F.substring_index(decoded, "/", -1), r"[^A-Za-z0-9._+ -]+", "_"))
    return F.when(last == "", F.substring(F.sha2(F.coalesce(url, F.lit("")), 256), 1, 16)).otherwise(last)


def media_member(prefix: Column, index: Column, url: Column) -> Column:
    """prefix/figures/NNN-hash-name, with long names cut and their extension kept."""
    base = url_basename(url)
    stem, ext = F.regexp_extract(base, r"^(.*)\.[^.]*$", 1), F.substring_index(base, ".", -1)
    short = F.when(F.length(base) <= 100, base).when(stem != "", F.concat(F.substring(stem, 1, 80), F.lit("."), F.substring(ext, 1, 16))).otherwise(F.substring(base, 1, 96))
    return F.concat(prefix, F.lit("/figures/"), F.format_string("%03d", index), F.lit("-"), F.substring(F.sha2(url, 256), 1, 12), F.lit("-"), short)


@F.pandas_udf(ArrayType(StringType()))
def joined_urls(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    """Every one of hrefs resolved against base, the first of equal ones."""
    return pd.Series([h if h is None or b is None else list(dict.fromkeys(urljoin(b, x) for x in h)) for b, h in zip(base, hrefs, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def joined_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """href resolved against base."""
    return pd.Series([urljoin(b, h) if b is not None and h is not None else h for b, h in zip(base, href, strict=True)], dtype=object)


def is_xml(content_type: Column, body: Column) -> Column:
    """By content type, or by how the body begins."""
    head = F.lower(F.substring(F.ltrim(F.coalesce(body, F.lit("")), F.lit(" \t\n\r\x0b\f")), 1, 64))
    return F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("xml")) | head.startswith("<?xml") | head.startswith("<!doctype article") | head.startswith("<article")


def is_tiff(url: Column, content_type: Column, body: Column) -> Column:
    """By extension, content type or first bytes."""
    return F.regexp_like(F.lower(url), F.lit(r"\.tiff?($|[?#])")) | F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("image/tif")) | F.hex(F.substring(body, 1, 4)).isin("49492A00", "4D4D002A")
