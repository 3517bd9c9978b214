"""WARC: a writer that names repeated payloads, and a salvage reader.

Writing. A first pass over the pages keeps the digests that occur more than once; of
pages with equal payloads of at least 100 bytes the one with the smallest page_id is
written as a response, the others as revisits of it. Records are WARC/1.1, and Spark's
own text writer puts them into archives, so any file system and task retries are safe.

Reading. Each archive is read by one task, record by record; a record counts only if its
header parses, its length fits, its end is right and its digest holds. After a failed
check the reader searches for the next version line, or in compressed archives the next
gzip member, that passes all checks, recovers from there on, and logs the bytes between
as a quarantined gap. Gaps are a table of their own; the log says how many there are, and
how many records are missing.

Archives are bounded by ARCHIVE_BYTES, or one record where that is longer: pages are
written by classes of size, each with as many records to a file as its longest allow.

Defined results: null html is empty; null page ids are written as such and come back
null, and are responses unless another page has the payload; rows that repeat a page_id
and payload are all responses or revisits alike; an empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import logging
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, new_path, texts

LEAST_REVISIT = 100
#: Bytes of an archive; upper bounds of the classes of payloads, the last open; what a record has besides its payload.
ARCHIVE_BYTES, CLASSES, RECORD_BYTES = 64 << 20, (16 << 10, 256 << 10, 4 << 20), 4 << 10
CRLF = "\r\n"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
#: A header is not longer, so broken ones are not searched to the archive's end.
HEADER_BYTES = 32 << 10
#: Fields that a record must have.
REQUIRED = ("warc-type", "warc-record-id")


def size_class(n_bytes):
    """The class of a payload, as a column."""
    return sum((F.when(n_bytes > most, 1).otherwise(0) for most in CLASSES), F.lit(0))


def revisits(pages: DataFrame) -> tuple[DataFrame, list[int]]:
    """(_page, _digest, _first) of the pages whose payload an earlier page has, and the classes of size that occur."""
    html = F.encode(texts("html"), "UTF-8")
    seen = pages.select(F.col("page_id").alias("_page"), F.sha2(html, 256).alias("_digest"), F.octet_length(html).alias("_bytes")).where(F.col("_bytes") >= LEAST_REVISIT).select("_page", "_digest", size_class(F.col("_bytes")).alias("_class"))
    seen = keep(seen, "warc-digests")
    many = seen.groupBy("_digest").agg(F.min("_page").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    classes = sorted({0, *(r["_class"] for r in seen.select("_class").distinct().collect())})  # as many rows as classes
    return keep(seen.join(many, "_digest").where(~F.col("_page").eqNullSafe(F.col("_first"))).select("_page", "_digest", "_first").distinct(), "warc-revisits"), classes


def record_text(page_id, url, html, digest, first):
    """A record without the blank line that ends it, as a column."""
    header = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    urn = lambda x: F.concat(F.lit("<urn:millrace:page:"), F.coalesce(x.cast("string"), F.lit("null")), F.lit(">"))
    again = first.isNotNull()
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    block = F.when(again, http).otherwise(F.concat(http, html))
    safe = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", urn(page_id)),
        header("WARC-Target-URI", safe),
        F.when(again, header("WARC-Refers-To", urn(first))).otherwise(F.lit("")),
        F.when(again, header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.encode(block, "UTF-8"), 256))),
        header("Millrace-Payload-Length", F.octet_length(html).cast("string")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block,
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes pages (page_id, url, html) as WARC files under path.

    The list of revisits is a written table, so Spark knows its size: it is broadcast
    below the session's threshold and joined by a shuffle beyond it.
    """
    again, classes = revisits(pages)
    rows = pages.select(F.col("page_id"), F.col("url"), texts("html").alias("html"))
    rows = rows.withColumn("_sha", F.sha2(F.encode("html", "UTF-8"), 256))
    rows = rows.join(again, rows["page_id"].eqNullSafe(again["_page"]) & (rows["_sha"] == again["_digest"]), "left")
    text = record_text(F.col("page_id"), F.col("url"), F.col("html"), F.col("_sha"), F.col("_first"))
    # the separator is the two line ends that close every record
    for c in classes:
        own = rows if len(classes) == 1 else rows.where(size_class(F.octet_length("html")) == c)
        records = max(1, ARCHIVE_BYTES // (CLASSES[c] + RECORD_BYTES)) if c < len(CLASSES) else 1
        own.select(text.alias("value")).write.mode("append").option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records).text(path)


def parse_record(data, at: int):
    """(end, headers, start of block) of a record that passes all checks, else the reason it does not."""
    if not VERSION.match(data, at):
        return "no version line"
    head = data.find(b"\r\n\r\n", at, at + HEADER_BYTES)
    if head < 0:
        return "header without end"
    headers = {}
    for line in bytes(data[at:head]).decode("utf-8", "replace").split(CRLF)[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return "header line without colon"
        if "\r" in value or "\n" in value:
            return "bare line end in a header"
        headers[name.strip().lower()] = value.strip()
    if lacks := [k for k in REQUIRED if k not in headers]:
        return f"no {lacks[0]}"
    size = headers.get("content-length", "")
    if not size.isdigit():
        return "no length"
    start, end = head + 4, head + 4 + int(size)
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        return "length does not meet the record's end"
    kind, _, want = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(data[start:end]).hexdigest() != want:
        return "block digest differs"
    return end + 4, headers, start


def inflate(data, at: int, step: int = 1 << 16):
    """(what the gzip member at a place decompresses to, its length, why it ends early or None)."""
    out, parts, n = zlib.decompressobj(31), [], len(data)
    for k in range(at, n, step):
        before = out.copy()
        try:
            parts.append(out.decompress(data[k : k + step]))
        except zlib.error as e:
            # a failed call returns nothing, so its bytes are given one by one up to the bad one
            try:
                for j in range(k, min(k + step, n)):
                    parts.append(before.decompress(data[j : j + 1]))
            except zlib.error:
                pass
            return b"".join(parts), 0, str(e)
        if out.eof:
            return b"".join(parts), min(k + step, n) - len(out.unused_data) - at, None
    return b"".join(parts) + out.flush(), 0, "member cut short"


def records_in(body) -> tuple[list, str]:
    """(headers and block of all good records of a member, why others are not)."""
    found, inner, why = [], 0, ""
    while inner < len(body):
        got = parse_record(body, inner)
        if isinstance(got, str):
            why = why or got
            line = VERSION.search(body, inner + 1)
            inner = line.start() if line else len(body)
        else:
            found.append((got[1], body[got[2] : got[0] - 4]))
            inner = got[0]
    return found, why


def salvage(data):
    """("record", offset, length, headers, payload) and ("gap", offset, length, reason, b"") in order.

    Offsets in compressed archives are those of the members.
    """
    at, bad, why, member = 0, -1, "", 0
    n = len(data)
    while at < n:
        found = []
        end = at
        if data[at : at + 3] == GZIP:
            body, size, got = inflate(data, at)
            found, inside = records_in(body)
            if got is None:
                end, got = at + size, None if found else inside or "empty member"
            if found and (got or inside):
                # what the member holds besides is a gap of its own
                if bad >= 0 and bad < at:
                    yield "gap", bad, at - bad, why, b""
                nxt = end if got is None else data.find(GZIP, at + 1)
                nxt = n if nxt < 0 else nxt
                for headers, block in found:
                    yield "record", at, nxt - at, headers, bytes(block)
                bad, why = (at, got) if got else (-1, "")
                if got is None:
                    yield "gap", at, nxt - at, inside, b""
                at = nxt
                continue
        else:
            got = parse_record(data, at)
            if not isinstance(got, str):
                found, end = [(got[1], data[got[2] : got[0] - 4])], got[0]
        if isinstance(got, str):
            if bad < 0:
                bad, why = at, got
            line = VERSION.search(data, at + 1)
            if member <= at:  # else it is the next one still
                member = data.find(GZIP, at + 1) % (n + 1)  # n where there is none
            at = min(line.start() if line else n, member)
            continue
        if bad >= 0:
            yield "gap", bad, at - bad, why, b""
            bad = -1
        for headers, block in found:
            yield "record", at, end - at, headers, bytes(block)
        at = end
    if bad >= 0:
        yield "gap", bad, n - bad, why, b""


_log = logging.getLogger(__name__)
OUT = "path string, kind string, offset long, length long, reason string, page_id long, record_type string, refers_to long, url string, payload_digest string, payload_bytes long, payload binary"
_SCHEMA = pa.schema([("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
_URN = re.compile(r"<urn:millrace:page:(-?\d+)>")


def _page(urn: str | None) -> int | None:
    m = _URN.match(urn or "")
    return int(m[1]) if m else None


def _read(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            path, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            rows, size = [], 0
            for kind, offset, length, info, block in salvage(data):
                row = {"path": path, "kind": kind, "offset": offset, "length": length}
                if kind == "gap":
                    row["reason"] = info
                else:
                    payload = block.partition(b"\r\n\r\n")[2]
                    again = info.get("warc-type") == "revisit"
                    row |= {
                        "page_id": _page(info.get("warc-record-id")), "record_type": info.get("warc-type"), "refers_to": _page(info.get("warc-refers-to")), "url": info.get("warc-target-uri"),
                        "payload_digest": info.get("warc-payload-digest", "").partition(":")[2] if again else hashlib.sha256(payload).hexdigest(),
                        "payload_bytes": int(info.get("millrace-payload-length", 0)) if again else len(payload),
                        "payload": payload,
                    }
                    size += len(payload)
                rows.append(row)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def read_archives(spark, path: str) -> DataFrame:
    """Records and gaps of all archives under path. Gaps: kind "gap", with a reason."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(_read, OUT)


def recover(spark, path: str, expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(records without payloads, gaps) of the archives under path, both written tables.

    expected: how many records there should be; what is missing, and gaps, are logged as warnings.
    """
    rows = keep(read_archives(spark, path).drop("payload"), "warc-read")
    records, gaps = rows.where("kind = 'record'"), rows.where("kind = 'gap'").select("path", "offset", "length", "reason")
    found = rows.agg(F.count_if(F.col("kind") == "record").alias("records"), F.count_if(F.col("kind") == "gap").alias("gaps"), F.sum(F.when(F.col("kind") == "gap", F.col("length"))).alias("bytes")).first()
    if found["gaps"]:
        gaps = keep(gaps, "warc-quarantine")
        _log.warning("%d gaps of %d bytes are quarantined in %s", found["gaps"], found["bytes"], gaps._millrace_path)
    if expected is not None and found["records"] < expected:
        _log.warning("%d of %d records are missing", expected - found["records"], expected)
    return records, gaps


def op5_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = new_path(spark, "archives")
    write_archives(pages, path)
    records, _ = recover(spark, path, pages.count())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""
