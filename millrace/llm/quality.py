"""Quality rules with risk-controlled thresholds.

Rules score a text (share of symbols, of repeated windows, of duplicate lines, length
of words). A rule rejects what lies beyond its cutoff, and the cutoff is chosen per
stratum from a fixed grid. One third of the labelled documents, by a hash of the id, is
for choosing; the others, the holdout, certify:

- Choosing: of each rule the cutoff that gains most, the share of bad documents it rejects
  less COST times that of good ones. The rules of a stratum that gain LEAST_GAIN or more
  are ranked by it, and as many are taken as the size of its holdout could certify at all.
- Certifying: the m rules taken share the stratum's limit and confidence. A cutoff is
  certified if its exact binomial tail P(Bin(n, limit / m) <= wrongly rejected) is at most
  confidence / (m * strata). A rule's grid is tested as a fixed sequence from lax to strict
  that stops at the first failure, so the grid costs no correction, and with the stated
  confidence all strata keep their false rejections under the limit at once (Bonferroni
  over strata and rules taken). What is chosen depends on the first third and on sizes only.
- Of a rule's certified cutoffs the one that gains most is used.

All of this is DataFrame expressions; labels join narrow counts, never texts.

Defined results: null texts have no words and fail; null languages form a stratum of
their own; strata without enough labels get no cutoffs and keep what passes the base
rules; several labels of one id count as bad if any is; repeated rows count as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, free_name, keep, texts, words_of

#: False rejections allowed among the good documents of a stratum, all rules together.
LIMIT = 0.05
CONFIDENCE = 0.05
#: What the share of good documents that a cutoff rejects counts against that of bad ones, and the least gain of a rule.
COST, LEAST_GAIN = 2.0, 0.01
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Rule -> (score of the counts, cutoffs from strict to lax). A text is rejected above.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.02, 0.05, 0.1, 0.15)),
    "dup_lines": ("n_dup_lines / greatest(n_words, 1)", (0.005, 0.01, 0.02, 0.05, 0.1)),
    "long_words": ("word_chars / greatest(n_words, 1)", (8.0, 10.0, 15.0, 25.0)),
    "short_words": ("-word_chars / greatest(n_words, 1)", (-4.0, -3.0, -2.5, -2.0)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def window_hashes(words: Column) -> Column:
    """Hashes of all 5-word windows of a text, in order."""
    at = F.sequence(F.lit(0), F.size(words) - 5)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]))
    return F.when(F.size(words) > 5, hashes).otherwise(F.array().cast("array<bigint>"))


def text_counts(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns named and the five counts of each text."""
    base = docs.select(*columns, texts("text").alias("_t"))
    base = base.withColumn("_w", words_of(F.col("_t")))
    base = base.withColumn("_h", window_hashes(F.col("_w")))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    base = base.select(
        *columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("_l"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.col("_h")).alias("_h"),
    )
    # each step is a column of its own: inside a lambda an expression would be built anew for every element
    base = base.withColumn("_p", F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    same = lambda k, p: F.coalesce(F.get(F.col("_p"), k)["h"] == p["h"], F.lit(False))
    base = base.withColumn("_s", F.array_sort(F.filter(F.transform("_p", lambda p, k: F.when(same(k - 1, p) | same(k + 1, p), p["i"])), lambda i: i.isNotNull())))
    covered = F.aggregate("_s", F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return base.select(
        *columns, "n_words", "word_chars", "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms term by term."""
    first = n * F.log(1 - p)
    step = F.log(p / (1 - p))
    zero = F.struct(first.alias("term"), first.alias("total"))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + step
        high, low = F.greatest(a["total"], term), F.least(a["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.exp(F.aggregate(terms, zero, add, lambda a: a["total"])))


def cutoffs(counts: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT, confidence: float = CONFIDENCE) -> DataFrame:
    """(_stratum, _rule, _cutoff): for each stratum and rule taken the certified cutoff that
    gains most, where one does. Strata times rules rows; strata are languages, or another
    bounded column."""
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    seen = counts.where(~base_failed()).join(label, "doc_id").withColumn("_held", F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0)
    # every row is counted into a fixed set of sums before anything is shuffled
    names = [(r, float(c)) for r, (_, cs) in RULES.items() for c in cs]
    good, bad, held = F.col("_good") == 1, F.col("_good") == 0, F.col("_held")
    flags = seen.select(F.col(stratum).alias("_stratum"), "_good", "_held", *[(F.expr(RULES[r][0]) > c).alias(f"_o{i}") for i, (r, c) in enumerate(names)])
    sums = flags.groupBy("_stratum").agg(
        F.count_if(good & held).alias("n"), F.count_if(bad & ~held).alias("n_bad"), F.count_if(good & ~held).alias("n_good"),
        *[x for i in range(len(names)) for x in (F.count_if(good & held & F.col(f"_o{i}")).alias(f"k{i}"), F.count_if(bad & ~held & F.col(f"_o{i}")).alias(f"b{i}"), F.count_if(good & ~held & F.col(f"_o{i}")).alias(f"g{i}"))],
    )
    # strata are counted before inline: Spark explodes first where both stand in one select
    sums = sums.withColumn("_strata", F.count("*").over(Window.partitionBy()))
    tests = F.array(*[F.struct(F.lit(r).alias("_rule"), F.lit(c).alias("_cutoff"), F.col(f"k{i}").alias("k"), F.col(f"b{i}").alias("b"), F.col(f"g{i}").alias("g")) for i, (r, c) in enumerate(names)])
    each = sums.select("_stratum", "n", "n_bad", "n_good", "_strata", F.inline(tests))
    gain = F.col("b") / F.greatest("n_bad", F.lit(1)) - COST * F.col("g") / F.greatest("n_good", F.lit(1))
    each = each.withColumn("_gain", gain)

    # chosen on the first third: rules by their best gain, as many as n good documents without one false rejection would certify
    within = F.when(F.col("g") <= limit * F.col("n_good"), F.col("_gain"))
    best = each.groupBy("_stratum", "_rule", "n", "_strata").agg(F.max(within).alias("_best")).where(F.col("_best") >= LEAST_GAIN)
    best = best.withColumn("_rank", F.row_number().over(Window.partitionBy("_stratum").orderBy(F.desc("_best"), "_rule")))
    needed = F.log(confidence / (F.col("_rank") * F.col("_strata"))) / F.log(1 - limit / F.col("_rank"))
    best = best.withColumn("_m", F.max(F.when(F.col("n") >= needed, F.col("_rank"))).over(Window.partitionBy("_stratum")))
    taken = best.where(F.col("_rank") <= F.col("_m")).select(F.col("_stratum").alias("_s"), F.col("_rule").alias("_r"), "_m")

    tried = each.join(taken, each["_stratum"].eqNullSafe(taken["_s"]) & (each["_rule"] == taken["_r"]))
    tail = binomial_tail(F.col("n"), F.col("k"), limit / F.col("_m"))
    passed = tail <= confidence / (F.col("_m") * F.col("_strata"))
    laxer = Window.partitionBy("_stratum", "_rule").orderBy(F.desc("_cutoff")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sure = tried.withColumn("_passed", passed).withColumn("_sure", F.min("_passed").over(laxer)).where(F.col("_sure") & (F.col("_gain") > 0))
    return sure.groupBy("_stratum", "_rule").agg(F.max_by("_cutoff", F.struct("_gain", "_cutoff")).alias("_cutoff"))


def judge(counts: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """counts with base_failed and kept. The cutoffs (strata times rules) are the only
    thing sent to all tasks, as one small map for each stratum.

    counts are read twice, so they are written first: a filter on them would otherwise be
    pushed into the counting, which then runs anew for every word of a text.
    """
    counts = keep(counts, "quality-counts")
    found = cutoffs(counts, labels, stratum, **options)
    per = found.groupBy("_stratum").agg(*[F.max(F.when(F.col("_rule") == r, F.col("_cutoff"))).alias(f"_c_{r}") for r in RULES])
    over = F.lit(False)
    for r, (e, _) in RULES.items():
        over = over | F.coalesce(F.expr(e) > F.col(f"_c_{r}"), F.lit(False))
    joined = counts.join(per, counts[stratum].eqNullSafe(per["_stratum"]), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~over).select(*counts.columns, "base_failed", "kept")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    counts = text_counts(docs.select("doc_id", "text", "lang"), "doc_id", "lang")
    return judge(counts, labels).select("doc_id", *COUNTS, "base_failed", "kept")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those the rules reject; a row's verdict rests on its own text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    row = free_name("_row", docs)
    rows = docs.withColumn(row, F.xxhash64("text"))
    counts = text_counts(rows.select("doc_id", "text", "lang", F.col(row).alias("_row")), "doc_id", "lang", "_row")
    gone = judge(counts, labels).where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("_row").alias("_gone_row"))
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["_gone_id"]) & (rows[row] == gone["_gone_row"]), "left_anti").select(*docs.columns)
