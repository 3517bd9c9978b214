"""Secret scans: character Markov models beside fixed patterns.

Fixed patterns find assignments, access keys and long hex strings. Beyond them every
run of 20 or more key characters is scored by two first-order character models, one of
random strings and one of ordinary identifiers, trained from labelled samples (words of
good documents as code joins them; what the fixed patterns find in labelled documents, and
generated keys): the sum over its character pairs of log P(pair | random) - log P(pair | identifier). Runs whose
total and mean pass the thresholds and that touch no fixed span are added as "random".

Main path: DataFrame functions only. The trained model is ALPHABET squared numbers.

Defined results: null texts are empty; spans are code points, end exclusive; a text
without spans has the hash of the empty string; repeated rows count as rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_max, running_sums, texts

#: Kind, pattern (letters of keywords in either case), least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The two runs below are maximal, so their least lengths can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_K = len(ALPHABET) + 1
#: Least log-likelihood ratio of a run in all, and a character pair.
LEAST_TOTAL, LEAST_MEAN = 12.0, 0.35
#: Pairs that the probability of a character alone weighs as much as.
BACK_OFF = 8.0
#: The samples are bounded: labelled documents read, and strings made of each kind.
SAMPLE_DOCS, SAMPLE_STRINGS = 2_000, 20_000
LEAST_SAMPLE = 16


def identifier_samples(docs: DataFrame, labels: DataFrame, n: int = SAMPLE_DOCS) -> DataFrame:
    """(value, random = 0): words of n good labelled documents, alone and joined as code joins them."""
    good = labels.where("quality = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    words = F.regexp_extract_all(texts("text"), F.lit("[A-Za-z]{3,}"), F.lit(0))
    some = docs.join(F.broadcast(good), "doc_id").select(words.alias("_w"))  # n rows at most, whole texts
    at = F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0)))
    w = lambda i: F.coalesce(F.get(F.col("_w"), i), F.lit("x"))
    number = lambda i: F.pmod(F.hash(w(i)), F.lit(1000)).cast("string")
    each = lambda i: F.array(
        w(i),
        F.concat(F.lower(w(i)), F.lit("_"), F.lower(w(i + 1)), F.lit("_"), F.lower(w(i + 2))),
        F.concat(F.lower(w(i)), F.initcap(w(i + 1)), F.initcap(w(i + 2))),
        F.concat(F.lower(w(i)), F.lit("-"), F.lower(w(i + 1)), F.lit("/"), F.lower(w(i + 2))),
        F.concat(F.upper(w(i)), F.lit("_"), F.upper(w(i + 1))),
        F.when(F.pmod(i, F.lit(4)) == 0, F.concat(F.lower(w(i)), F.lit("-"), number(i), F.lit("/"), number(i + 1))),
    )
    rules = F.array(*[F.lit(c * 24) for c in "-=_+/"])  # ruled lines
    forms = F.concat(F.filter(F.flatten(F.transform(at, each)), lambda v: v.isNotNull()), rules)
    return some.select(F.explode(forms).alias("value"), F.lit(0).alias("random"))


def found_samples(docs: DataFrame, labels: DataFrame, n: int = SAMPLE_DOCS) -> DataFrame:
    """(value, random = 1): what the fixed patterns find in n labelled documents; of
    assignments only values with digits among LEAST_SAMPLE characters or more, as others may be words."""
    some = labels.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    of = lambda p, group=0: F.regexp_extract_all(texts("text"), F.lit(p), F.lit(group))
    values = F.filter(of(ASSIGN, 2), lambda v: (F.length(v) >= LEAST_SAMPLE) & F.regexp_like(v, F.lit("[0-9]")))
    return docs.join(F.broadcast(some), "doc_id").select(F.explode(F.concat(values, of(ACCESS), of(HEX))).alias("value"), F.lit(1).alias("random"))  # n rows at most


def samples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All training samples: (value, random)."""
    return identifier_samples(docs, labels).unionByName(found_samples(docs, labels)).unionByName(random_samples(docs.sparkSession))


def random_samples(spark, n: int = SAMPLE_STRINGS) -> DataFrame:
    """(value, random = 1): n strings each of base 64, hex and letters with digits."""
    raw = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    coded = F.base64(F.unhex(raw))
    kinds = F.array(coded, raw, F.upper(F.translate(coded, "+/=", "")), F.translate(coded, "+/=", "-_"))
    return spark.range(n).select(F.explode(kinds).alias("value"), F.lit(1).alias("random"))


def _codes(text: Column) -> Column:
    """The place of each character of a text in ALPHABET, 0 for others; the text is split once."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(text: Column, use) -> Column:
    """use(a, b) of the codes of each two neighbours, the first after 0."""
    return let(_codes(text), lambda c: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(c, 1, F.size(c) - 1)), c, use))


def train(samples: DataFrame) -> list[float]:
    """The log ratio of each character pair, row by row, from (value, random).

    A pair's probability is smoothed towards that of its second character alone, which
    weighs as much as BACK_OFF pairs: a pair whose first character was never seen says
    what its second one says.
    """
    pairs = _pairs(F.col("value"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    counts = samples.where(F.length("value") > 0).select("random", F.inline(pairs)).groupBy("a", "b").agg(F.count_if(F.col("random") == 1).alias("r"), F.count_if(F.col("random") == 0).alias("w"))
    rows = {(x["a"], x["b"]): (x["r"], x["w"]) for x in counts.toLocalIterator()}  # _K squared at most
    alone = []
    for k in (0, 1):
        seen = [sum(rows.get((a, b), (0, 0))[k] for a in range(_K)) + 0.5 for b in range(_K)]
        alone.append([x / sum(seen) for x in seen])
    out = []
    for a in range(_K):
        sums = [sum(rows.get((a, b), (0, 0))[k] for b in range(_K)) for k in (0, 1)]
        for b in range(_K):
            p = [(rows.get((a, b), (0, 0))[k] + BACK_OFF * alone[k][b]) / (sums[k] + BACK_OFF) for k in (0, 1)]
            out.append(math.log(p[0]) - math.log(p[1]))
    return out


def log_ratio(value: Column, model: list[float]) -> Column:
    """How much likelier a string (not empty) is under the random model."""
    weights = F.lit(model)
    return F.aggregate(_pairs(value, lambda a, b: F.get(weights, a * _K + b)), F.lit(0.0), lambda t, w: t + w)


SPANS = "array<struct<start:bigint,kind:int,end:bigint,text:string>>"


def _spans(text: str, pattern: str, order: int, good=None) -> Column:
    """array<struct<start, kind, end, text>> of a pattern's matches in a column, in one pass over them:
    a match begins where the gaps and matches before it end."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))

    def placed(m: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.slice(m, 1, F.size(m) - 1), lambda t: F.length(t).cast("long")))
        starts = running_sums(F.zip_with(F.slice(gaps, 1, F.size(m)), before, lambda g, b: g + b))
        return F.zip_with(starts, m, lambda s, t: F.struct(s.alias("start"), F.lit(order).alias("kind"), (s + F.length(t)).alias("end"), t.alias("text")))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(F.array().cast(SPANS)))
    return F.filter(spans, lambda s: good(s["text"])) if good else spans


def _apart(base: str, runs: str) -> Column:
    """Those of runs that overlap no span of base: in order of start, none before one ends
    after its start and none after one starts before its end."""
    def pick(every: Column) -> Column:
        ends = running_max(F.transform(every, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(F.lit(-1).cast("long"))))
        starts = F.reverse(running_max(F.reverse(F.transform(every, lambda s: F.when(s["kind"] < 3, -s["start"]).otherwise(F.lit(-(1 << 62)))))))
        each = F.zip_with(F.zip_with(every, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), starts, lambda x, b: F.struct(x["s"].alias("s"), x["e"].alias("e"), (-b).alias("b")))
        return F.transform(F.filter(each, lambda x: (x["s"]["kind"] == 3) & (x["e"] <= x["s"]["start"]) & (x["b"] >= x["s"]["end"])), lambda x: x["s"])

    return F.when(F.size(base) == 0, F.col(runs)).when(F.size(runs) == 0, F.col(runs)).otherwise(let(F.array_sort(F.concat(base, runs)), pick))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame, model: list[float]) -> DataFrame:
    """doc_id, base and all: arrays of struct<start, kind, end, text>, in order."""
    rows = docs.select("doc_id", texts("text").alias("_t"))
    long_value = lambda t: F.length(F.regexp_extract(t, ASSIGN, 2)) >= LEAST_VALUE
    base = F.array_sort(F.concat(_spans("_t", ASSIGN, 0, long_value), _spans("_t", ACCESS, 1), _spans("_t", HEX, 2)))
    rows = rows.select("doc_id", base.alias("base"), _spans("_t", RUN, 3).alias("_runs"))
    rows = rows.select("doc_id", "base", _apart("base", "_runs").alias("_runs"))
    scored = F.transform("_runs", lambda r: F.struct(r.alias("r"), log_ratio(r["text"], model).alias("score")))
    random = F.transform(F.filter(scored, lambda s: (s["score"] >= LEAST_TOTAL) & (s["score"] >= LEAST_MEAN * F.length(s["r"]["text"]))), lambda s: s["r"])
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("all"))


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(samples(docs, labels))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs, model).select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
    )
