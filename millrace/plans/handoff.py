"""The hand-off: accepted rows split off, flattened, and accounted for with their members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import canonical_json, first_text, int_value
from ..functions.ladder import ACCEPTED, BLOCKED, accepted
from ..functions.licenses import KEPT_CODES
from ..operators.joins import inventory, member_sizes

#: The columns of the flat table by kind, then of provenance documents.
FLAT_TEXTS = (
    "source_id", "pid", "collection", "xml_doi", "status", "license_code", "license_policy", "license_text", "tar_path",
    "xml_member", "source_member", "xml_url", "article_title", "journal_title", "document_type", "publication_year",
    "publication_date", "processing_date", "preferred_lang", "fulltext_html_url", "shard", "subtar", "fetched_at", "xml_sha256",
)
FLAT_NUMBERS = (
    "xml_bytes", "text_chars", "body_text_chars", "figure_count", "table_count", "formula_count", "expected_figure_files",
    "downloaded_figure_files", "figure_bytes", "rendered_figure_files",
)
FLAT_LISTS = ("figures", "fulltexts", "license_urls", "missing_figure_urls", "third_party_caption_terms")
PROVENANCE = (
    "source_id", "pid", "collection", "fulltext_html_url", "xml_url", "xml_http_status", "xml_content_type", "license_code",
    "license_policy", "license_urls", "downloaded_at",
)
KINDS = ("xml", "source", "figure")
#: Rows that a report shows of those rejected though their status is an accepted one.
EXAMPLES = 20


def ok_figures(figures: Column) -> Column:
    return F.filter(figures, lambda f: (f["status"] == "ok") & (F.coalesce(f["member"], F.lit("")) != ""))


def figure_sums(figures: Column) -> dict[str, Column]:
    """Bytes of good figures (original bytes fall back to bytes), rendered ones, and URLs that failed."""
    good, zero = F.filter(figures, lambda f: f["status"] == "ok"), F.lit(0).cast("long")
    return {
        "figure_bytes": F.aggregate(good, zero, lambda a, f: a + F.coalesce(f["bytes"], zero)),
        "original_figure_bytes": F.aggregate(good, zero, lambda a, f: a + F.coalesce(F.nullif(f["original_bytes"], zero), f["bytes"], zero)),
        "downloaded_figure_files": F.size(good).cast("long"),
        "missing_figure_urls": F.transform(F.filter(figures, lambda f: F.coalesce(f["status"] != "ok", F.lit(True))), lambda f: f["url"]),
    }


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, blocked, rejected though their status is an accepted one)."""
    good = accepted(F.col("status"), F.col("license_policy"), F.col("license_code"), F.col("tar_path"), F.col("xml_member"), F.col("source_member"))
    return rows.where(good), rows.where(F.col("status").startswith(BLOCKED)), rows.where(F.col("status").isin(*ACCEPTED) & ~good)


def rejected_examples(rejected: DataFrame, order: str, most: int = EXAMPLES) -> DataFrame:
    """The first of the rejected rows, as a report shows them."""
    return rejected.orderBy(order).limit(most).select("source_id", "status", "license_code", "license_policy", "tar_path", "xml_member", "source_member")


def json_list(value: Column) -> Column:
    """A list, map or struct as canonical JSON; null is the empty list."""
    return F.coalesce(canonical_json(F.to_json(value)), F.lit("[]"))


def flatten(rows: DataFrame, source: str) -> DataFrame:
    """rows as the flat table: texts empty where absent, numbers 0, lists as JSON texts.

    The DOI falls back to the XML's, original figure bytes of 0 to the figures' bytes;
    source names rows without one. Columns that rows lack count as null.
    """
    has = {f.name for f in rows.schema}
    text = lambda c: first_text(F.col(c).cast("string")) if c in has else F.lit("")
    number = lambda c: int_value(F.col(c).cast("string")) if c in has else F.lit(0).cast("long")
    figures = ok_figures(F.col("figures")) if "figures" in has else F.lit(None).cast("array<struct<member:string,url:string>>")
    original = F.when(number("original_figure_bytes") != 0, number("original_figure_bytes")).otherwise(number("figure_bytes"))
    doi = F.when(text("doi") != "", text("doi")).otherwise(text("xml_doi"))
    flag = F.coalesce(F.col("third_party_caption_flag").cast("boolean"), F.lit(False)) if "third_party_caption_flag" in has else F.lit(False)
    return rows.select(
        F.when(text("source") != "", text("source")).otherwise(F.lit(source)).alias("source"), doi.alias("doi"),
        *[text(c).alias(c) for c in FLAT_TEXTS], *[number(c).alias(c) for c in FLAT_NUMBERS], original.alias("original_figure_bytes"), flag.alias("third_party_caption_flag"),
        json_list(F.transform(figures, lambda f: f["member"])).alias("figure_members_json"), json_list(F.transform(figures, lambda f: f["url"])).alias("figure_urls_json"),
        *[(json_list(F.col(c)) if c in has else F.lit("[]")).alias(f"{c}_json") for c in FLAT_LISTS],
    )


def write_flat(flat: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The flat table as Parquet, compressed with Zstandard."""
    flat.write.mode(mode).option("compression", "zstd").parquet(path)


def provenance(rows: DataFrame) -> Column:
    """The provenance document of each row: canonical JSON, one line. Absent texts are empty, an absent list is []."""
    has = {f.name for f in rows.schema}
    value = lambda c: F.coalesce(F.col(c), F.array()) if c == "license_urls" else F.col(c) if c == "xml_http_status" else F.coalesce(F.col(c), F.lit(""))
    return F.concat(canonical_json(F.to_json(F.struct(*[value(c).alias(c) for c in PROVENANCE if c in has]), {"ignoreNullFields": "false"})), F.lit("\n"))


def byte_totals(rows: DataFrame) -> DataFrame:
    """One row of bytes and files summed over accepted rows; original bytes of 0 fall back to the figures'."""
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    original = F.when(number("original_figure_bytes") != 0, number("original_figure_bytes")).otherwise(number("figure_bytes"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.agg(
        total(number("xml_bytes")).alias("xml_bytes_manifest"), total(number("figure_bytes")).alias("figure_bytes_manifest"), total(original).alias("original_figure_bytes_manifest"),
        *[total(number(c)).alias(c) for c in ("expected_figure_files", "downloaded_figure_files", "rendered_figure_files")],
    )


def volumes(totals: DataFrame) -> DataFrame:
    """Byte totals in GB, to three places."""
    gb = lambda c: F.round(F.col(c) / 1e9, 3)
    return totals.select(gb("xml_bytes_manifest").alias("xml_manifest"), gb("figure_bytes_manifest").alias("figures_manifest"), gb("original_figure_bytes_manifest").alias("original_figures_manifest"))


def members(rows: DataFrame) -> DataFrame:
    """source_id, tar_path, kind, member: XML, provenance, then good figures."""
    one = lambda kind, member: F.struct(F.lit(kind).alias("kind"), member.alias("member"))
    figures = F.transform(ok_figures(F.col("figures")), lambda f: one("figure", f["member"]))
    every = F.concat(F.array(one("xml", F.col("xml_member")), one("source", F.col("source_member"))), F.coalesce(figures, F.filter(F.array(one("", F.lit(""))), lambda _: F.lit(False))))
    return rows.select("source_id", "tar_path", F.inline(every))


def payload_members(source: Column, xml: Column, figures: Column) -> Column:
    """The members that a row owns in its archive, in order: provenance, XML, good figures."""
    return F.concat(F.filter(F.array(source, xml), lambda m: F.coalesce(m, F.lit("")) != ""), F.transform(F.coalesce(ok_figures(figures), F.array()), lambda f: f["member"]))


def accounts(rows: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inventory of each archive, members the archives lack)."""
    sized = member_sizes(members(rows), listing, ["tar_path", "member"], "size")
    return inventory(sized, "tar_path", F.col("kind"), list(KINDS)), sized.where("missing")


__all__ = ["KEPT_CODES", "accounts", "byte_totals", "figure_sums", "flatten", "members", "ok_figures", "payload_members", "provenance", "rejected_examples", "split", "volumes", "write_flat"]
