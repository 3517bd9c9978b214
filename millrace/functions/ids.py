"""Identity, hashing and string functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longest base of a source id.
SOURCE_ID_CHARS = 180


def stable_shard(value: Column, n: int | Column) -> Column:
    """First 8 bytes of MD5 as a big-endian unsigned number, modulo n."""
    head = F.conv(F.substring(F.md5(F.encode(value, "UTF-8")), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, (F.lit(n) if isinstance(n, int) else n).cast("decimal(20,0)")).cast("int")


def stable_sub_shard(value: Column, n: int) -> Column:
    return stable_shard(F.concat(F.lit("articlemeta-sub|"), value), n)


def article_key(collection: Column, code: Column) -> Column:
    return F.concat_ws("|", F.coalesce(collection, F.lit("")), F.coalesce(code, F.lit("")))


def safe_part(value: Column, fallback: str = "x") -> Column:
    """Runs of other characters than letters, digits, dot, underscore and hyphen become one hyphen."""
    clean = F.regexp_replace(F.coalesce(value, F.lit("")), r"[^A-Za-z0-9._-]+", "-")
    clean = F.regexp_replace(clean, r"^-+|-+$", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit(fallback))


def source_id(collection: Column, pid: Column, doi: Column | None = None, prefix: str = "corpus") -> Column:
    """prefix-collection-pid; without a usable pid, a hash of the doi (or raw pid) stands for it."""
    doi = F.coalesce(doi if doi is not None else F.lit(""), F.lit(""))
    base = F.concat(F.lit(prefix + "-"), safe_part(collection, "col"), F.lit("-"), safe_part(pid, ""))
    named = F.when(F.nullif(doi, F.lit("")).isNotNull(), doi).otherwise(F.coalesce(pid, F.lit("")))
    full = F.when(base.endswith("-"), F.concat(base, F.substring(F.sha2(named, 256), 1, 16))).otherwise(base)
    return F.substring(full, 1, SOURCE_ID_CHARS)


def canonical_json(text: Column) -> Column:
    """A JSON text with sorted keys and no spaces."""
    return F.to_json(F.parse_json(text))


def int_value(text: Column) -> Column:
    """A whole number, or 0 for anything else."""
    return F.coalesce(F.expr("try_cast(__x AS BIGINT)") if isinstance(text, str) else text.try_cast("bigint"), F.lit(0).cast("bigint"))


def first_text(*values: Column) -> Column:
    """The first value that is not empty, else empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def padded(number: Column, width: int) -> Column:
    """Zero-padded to width at least; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def with_extension(member: Column, ext: str) -> Column:
    """A member name with its last segment's extension replaced, or added."""
    return F.when(F.regexp_like(member, F.lit(r"[^/]\.[^./]*$")), F.regexp_replace(member, r"\.[^./]*$", ext)).otherwise(F.concat(member, F.lit(ext)))


def short_error(text: Column, chars: int = 300) -> Column:
    return F.substring(text, 1, chars)
