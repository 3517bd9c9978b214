"""PII: fixed patterns, and information-theoretic sanitisation of what surrounds them.

Patterns find e-mail addresses, IP addresses, card and phone numbers: the protected
entities. Over the whole corpus the words near an entity are counted with it. A term
discloses an entity by I = log2(P(entity | term) / P(entity)); terms seen with it in at
least SUPPORT different contexts, whose P(entity | term) reaches GENERALISE_AT and whose I
reaches LEAST_DISCLOSED of the entity's own -log2(P(entity)), so that neither its frequency
nor the size of the corpus decides, are sensitive wherever they stand. Copies of a passage
are one context, so a text that is merely repeated discloses nothing.

What becomes of a sensitive term is decided by the level above it, its class: names,
acronyms or plain words, by how the corpus mostly writes it. Below REMOVE_AT it is
generalised to its class, [NAME], [ACRONYM] or [WORD], if the class in its turn does not
disclose the entity: P(entity | class), over all words of the class, is below GENERALISE_AT.
Otherwise nothing above it is general enough and it is removed.

Defined results: null texts are empty; spans are code points, end exclusive; terms never
overlap a fixed span; overlapping fixed spans of two kinds are both reported, and
replaced together under the first one's name; repeated rows count as rows; a column of
docs named as one of find()'s own (_spans) is replaced in its result, and kept by sanitise().
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, keep, slices, texts

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of an entity that count as near it.
NEAR = 5
SUPPORT = 3
GENERALISE_AT, REMOVE_AT, LEAST_DISCLOSED = 0.5, 0.8, 0.5
#: Sensitive terms that every task may hold; more are dealt to the documents by a join on their words.
TERMS_HELD = 200_000
#: Candidate terms that may be sent to every executor; more meet their counts in a shuffle.
BROADCAST_TERMS = 200_000
CLASSES = ("NAME", "ACRONYM", "WORD")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
#: A match always begins where its run of digits does, which the look-behind tells the engine.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Terms: two letters, or numerals that are no digits, and more; what parts them, as Spark's expressions say it.
_TERM = re.compile(r"[^\W\d_]{2,}")
NO_TERM = r"[^\p{L}\p{Nl}\p{No}]+"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(text: str, span: tuple[int, int, int]) -> str:
    """What a span names, however it is written."""
    value = text[span[0] : span[2]]
    return f"{KINDS[span[1]]}:{value.lower() if span[1] < 2 else ''.join(_DIGIT.findall(value))}"


def contexts(text: str, spans: list[tuple[int, int, int]]):
    """(entity, terms near it, hash of the context) of each span; spans by start."""
    found = list(_TERM.finditer(text))
    starts, ends = [m.start() for m in found], [m.end() for m in found]
    begins, reach = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max))
    inside = lambda at: (k := bisect_right(begins, at)) and reach[k - 1] > at
    for s in spans:
        before = bisect_right(ends, s[0])
        after = bisect_left(starts, s[2])
        words = [(m.start(), m[0].lower()) for m in (*found[max(0, before - NEAR) : before], *found[after : after + NEAR])]
        near = [w for at, w in words if not inside(at)]
        context = hashlib.blake2b(" ".join(w for _, w in words).encode("utf-8", "surrogatepass"), digest_size=8).digest()
        yield entity(text, s), near, int.from_bytes(context, "little", signed=True)


def _near_rows(batches):
    schema = pa.schema([("entity", pa.string()), ("term", pa.string()), ("context", pa.int64())])
    for batch in slices(batches):
        rows = []
        for x in batch.column(0):
            text = x.as_py()
            if spans := base_spans(text):
                rows += [{"entity": e, "term": w, "context": c} for e, near, c in contexts(text, spans) for w in {None, *near}]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def word_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, class, n): how often each of terms occurs in docs (text) by the class it is
    written as; all other words are counted together under a null term."""
    words = docs.select(F.explode(F.split(texts("text"), NO_TERM)).alias("w")).where("length(w) > 1")
    upper = F.upper("w") == F.col("w")
    kind = F.when(upper & (F.length("w") > 1), CLASSES[1]).when(F.upper(F.substring("w", 1, 1)) == F.substring("w", 1, 1), CLASSES[0]).otherwise(CLASSES[2])
    words = words.select(F.lower("w").alias("term"), kind.alias("class"))
    known = terms.select("term", F.lit(True).alias("known"))
    if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        words = words.join(F.broadcast(known), "term", "left")  # counted: at most BROADCAST_TERMS rows
        return words.groupBy(F.when(F.col("known"), F.col("term")).alias("term"), "class").agg(F.count("*").alias("n"))
    counts = words.groupBy("term", "class").agg(F.count("*").alias("n")).join(known, "term", "left")
    return counts.groupBy(F.when(F.col("known"), F.col("term")).alias("term"), "class").agg(F.sum("n").alias("n"))


def scored_terms(docs: DataFrame) -> DataFrame:
    """What is weighed: (entity, term, together, contexts, occurs, class, seen, share, own, bits, of_class) of
    the terms near an entity in at least SUPPORT contexts, from all of docs (text)."""
    near = keep(docs.select(texts("text").alias("text")).mapInArrow(_near_rows, "entity string, term string, context long"), "pii-near")
    pairs = near.where("term is not null").groupBy("entity", "term", "context").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count("*").alias("contexts")).where(F.col("contexts") >= SUPPORT)
    pairs = keep(pairs, "pii-pairs")
    if pairs.isEmpty():
        none = lambda c, kind: F.lit(None).cast(kind).alias(c)
        return pairs.select("*", none("occurs", "long"), none("class", "string"), none("seen", "long"), *[none(c, "double") for c in ("share", "own", "bits")], none("of_class", "long"))
    counts = keep(word_counts(docs, pairs.select("term").distinct()), "pii-counts")
    of_class = counts.groupBy("class").agg(F.sum("n").alias("of_class"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    occurs = counts.where("term is not null").groupBy("term").agg(F.sum("n").alias("occurs"), F.max_by("class", F.struct("n", "class")).alias("class"))
    entities = near.where("term is null").groupBy("entity").agg(F.count("*").alias("seen"))
    share = F.least(F.lit(1.0), F.col("together") / F.col("occurs"))
    chance = F.least(F.lit(1.0), F.col("seen") / F.lit(float(total)))
    scored = pairs.join(occurs, "term").join(entities, "entity").withColumns({"share": share, "own": -F.log2(chance), "bits": F.log2(share / chance)})
    return scored.join(F.broadcast(of_class), "class")  # as many rows as CLASSES


def sensitive_terms(docs: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """(term, removed, label) of the terms that disclose an entity, from all of docs (text)."""
    scored = scored_terms(docs) if scored is None else scored
    found = scored.where((F.col("share") >= GENERALISE_AT) & (F.col("bits") >= LEAST_DISCLOSED * F.col("own")))
    above = found.groupBy("entity", "class").agg((F.sum("together") / F.first("of_class")).alias("class_share"))
    found = found.join(above, ["entity", "class"])
    gone = (F.max("share") >= REMOVE_AT) | (F.max("class_share") >= GENERALISE_AT)
    return found.groupBy("term").agg(gone.alias("removed"), F.first("class").alias("label"))


SPANS = "array<struct<start:long,kind:int,end:long,removed:boolean,label:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("removed", pa.bool_()), ("label", pa.string())]))


def _spans_of(text: str, terms: dict) -> list[dict]:
    """The fixed spans of a text and those of some terms (term -> removed, label), by start and kind."""
    base = base_spans(text)
    spans = [{"start": a, "kind": k, "end": b, "removed": False, "label": KINDS[k].upper()} for a, k, b in base]
    if not terms:
        return spans
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    free = lambda a, b: not ((k := bisect_left(starts, b)) and reach[k - 1] > a)
    for m in _TERM.finditer(text):
        if (found := terms.get(m[0].lower())) and free(m.start(), m.end()):
            spans.append({"start": m.start(), "kind": 4, "end": m.end(), "removed": found[0], "label": found[1]})
    return sorted(spans, key=lambda s: (s["start"], s["kind"]))


def _replaced(text: str, spans: list[dict]) -> str:
    parts, done = [], 0
    for s in spans:
        if s["start"] >= done:
            parts += [text[done : s["start"]], "" if s["removed"] else f"[{s['label']}]"]
        done = max(done, s["end"])
    return "".join(parts) + text[done:] if parts else text


def _finder(terms: dict[str, tuple[bool, str]] | None, spans_at: str, replace: bool = False):
    """Fills the column spans_at, and with replace rewrites text; without terms a row brings its own in its last column."""

    def run(batches):
        for batch in slices(batches):
            place, at = batch.schema.get_field_index(spans_at), batch.schema.get_field_index("text")
            old, columns, names = batch.column(at).to_pylist(), list(batch.columns), batch.schema.names
            if terms is None:
                own = [{t["term"]: (t["removed"], t["label"]) for t in ts or ()} for ts in columns.pop().to_pylist()]
                names = names[:-1]
            else:
                own = [terms] * len(old)
            spans = [_spans_of(t, o) for t, o in zip(old, own, strict=True)]
            columns[place] = pa.array(spans, _SPANS)
            if replace:
                columns[at] = pa.array([_replaced(t, s) for t, s in zip(old, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _with_terms(docs: DataFrame, terms: DataFrame, name: str) -> DataFrame:
    """docs with those of terms that their text holds, in a last column. Rows are numbered in a
    written table; a document sends each of its words once, and only sensitive ones come back."""
    row = free_name("_row", docs)
    docs = keep(docs.withColumn(row, F.monotonically_increasing_id()), "pii-rows")
    words = docs.select(row, F.explode(F.array_distinct(F.split(F.lower("text"), NO_TERM))).alias("term")).where("length(term) > 1")
    held = words.join(terms, "term").groupBy(row).agg(F.collect_list(F.struct("term", "removed", "label")).alias(name))
    return docs.join(held, row, "left").drop(row)


def _passed(docs: DataFrame, spans_at: str, replace: bool, scored: DataFrame | None = None) -> DataFrame:
    """docs (text null as empty) with their spans, and replaced texts. Up to TERMS_HELD terms every task holds them all."""
    terms = keep(sensitive_terms(docs, scored), "pii-terms")
    rows = docs.withColumn("text", texts("text")).withColumn(spans_at, F.array().cast(SPANS))
    if terms.count() > TERMS_HELD:
        return _with_terms(rows, terms, free_name("_terms", rows)).mapInArrow(_finder(None, spans_at, replace), rows.schema)
    some = {r["term"]: (r["removed"], r["label"]) for r in terms.toLocalIterator()}  # counted: at most TERMS_HELD
    return rows.mapInArrow(_finder(some, spans_at, replace), rows.schema)


def find(docs: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """docs (with text, null as empty) and _spans: struct<start, kind, end, removed, label>, by start and kind."""
    return _passed(docs.drop("_spans"), "_spans", False, scored)


def sanitised(rows: DataFrame, spans_at: str = "_spans") -> DataFrame:
    """rows of find() with the spans in text replaced by [LABEL], or removed."""

    def run(batches):
        for batch in slices(batches):
            at, place = batch.schema.get_field_index("text"), batch.schema.get_field_index(spans_at)
            columns = list(batch.columns)
            columns[at] = pa.array([_replaced(t, s) for t, s in zip(batch.column(at).to_pylist(), batch.column(place).to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with personal data in text replaced. Columns: those of docs."""
    return _passed(docs, free_name("_spans", docs), True).select(*docs.columns)


def _joined(spans):
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Beside the contract's columns, how strong the corpus' candidates are: the pairs of a term and
    an entity that were weighed, and the greatest share and disclosed part of an entity among them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = keep(scored_terms(docs), "pii-scored")
    best = scored.agg(F.count("*").alias("n"), F.max("share").alias("share"), F.max(F.col("bits") / F.col("own")).alias("disclosed")).first()
    rows = find(docs, scored).select("doc_id", "_spans")
    of = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[of(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(_joined(F.filter("_spans", lambda s: s["kind"] < 4)), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"),
        F.size("_spans").cast("long").alias("n_spans"),
        F.lit(best["n"]).alias("weighed_pairs"), F.lit(best["share"]).cast("double").alias("greatest_share"), F.lit(best["disclosed"]).cast("double").alias("greatest_disclosed"),
    )


def pii_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with personal data replaced in text, and n_chars of the new text."""
    out = sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
