"""Statuses: the decision ladder, retries, and what is accepted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .licenses import KEPT_CODES

#: Fixed values.
RETRYABLE = ("xml_fetch_error", "xml_html_response", "xml_parse_error", "row_error", "partial_figures", "figures_failed")
RETRYABLE_CODES = (403, 408, 429, 500, 502, 503, 504)
TRANSIENT_CODES = (408, 409, 425, 429, 500, 502, 503, 504, 520, 521, 522, 523, 524)
CAPTION_TERMS = ("adapted from", "modified from", "reprinted from", "reproduced from", "permission", "copyright", "courtesy", "source:")
ACCEPTED = ("ok", "no_figures")
INCOMPLETE = ("partial_figures", "figures_failed")
LEAST_BODY = 200
MAX_SIDE, MAX_PIXELS, PASS_BYTES = 2_048, 4_194_304, 2 << 20
BLOCKED = "retry_blocked_"


def seed_status(meta_ok: Column, url: Column) -> Column:
    return F.when(~F.coalesce(meta_ok, F.lit(False)), "articlemeta_error").when(F.coalesce(url, F.lit("")) == "", "no_fulltext_url").otherwise("planned_xml")


def figure_status(expected: Column, downloaded: Column) -> Column:
    return F.when(expected == 0, "no_figures").when(downloaded >= expected, "ok").when(downloaded > 0, "partial_figures").otherwise("figures_failed")


def row_status(planned: Column, fetch_error: Column, parsed: Column, policy: Column, captions: Column, body_chars: Column, expected: Column, downloaded: Column) -> Column:
    """The ladder in its order; the first step that applies decides."""
    return (
        F.when(planned != "planned_xml", planned)
        .when(fetch_error.isNotNull(), fetch_error)
        .when(~parsed, "xml_parse_error")
        .when(policy != "keep", F.concat(F.lit("license_"), policy))
        .when(captions, "license_figure_ambiguous")
        .when(body_chars < LEAST_BODY, "xml_no_body")
        .otherwise(figure_status(expected, downloaded))
    )


def caption_terms(captions: Column) -> Column:
    """The third-party terms that an array of captions has, sorted."""
    low = F.transform(captions, F.lower)
    return F.array_sort(F.filter(F.array(*[F.lit(t) for t in CAPTION_TERMS]), lambda t: F.exists(low, lambda c: F.contains(c, t))))


def retryable(status: Column) -> Column:
    """Named statuses, and HTTP ones of transient codes or any 5xx; never null."""
    pattern = rf"^({'|'.join(RETRYABLE)}|xml_http_({'|'.join(map(str, RETRYABLE_CODES))}|5[0-9][0-9]))$"
    return F.coalesce(F.regexp_like(status, F.lit(pattern)), F.lit(False))


def retry_target(status: Column) -> Column:
    """Whether a repair pass runs the row again: retryable, blocked or not."""
    return retryable(F.regexp_replace(status, "^" + BLOCKED, ""))


def request_retryable(code: Column) -> Column:
    return code.isin(*TRANSIENT_CODES, 403)


def accepted(status: Column, policy: Column, code: Column, *members: Column) -> Column:
    whole = status.isin(*ACCEPTED) & (policy == "keep") & code.isin(*KEPT_CODES)
    for m in members:
        whole = whole & (F.coalesce(m, F.lit("")) != "")
    return F.coalesce(whole, F.lit(False))


def capped_size(width: Column, height: Column, max_pixels: int = MAX_PIXELS, max_side: int = MAX_SIDE) -> Column:
    """struct<width, height> scaled down evenly to the bounds, rounded half to even, 1 at least."""
    w, h = width.cast("double"), height.cast("double")
    scale = F.least(F.lit(1.0), max_side / F.greatest(w, h), F.sqrt(max_pixels / (w * h)))
    side = lambda x, plain: F.when((width <= 0) | (height <= 0), plain).otherwise(F.greatest(F.lit(1), F.bround(x * scale).cast("int")))
    return F.struct(side(w, width.cast("int")).alias("width"), side(h, height.cast("int")).alias("height"))


def render_reason(tiff: Column, n_bytes: Column) -> Column:
    """Why a figure is rendered anew; null where it passes through."""
    return F.when(tiff, "tiff_to_jpeg").when(n_bytes > PASS_BYTES, "large_raster_to_jpeg")
