"""Chat formatting from typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document. A visitor
turns each part into its place in the output: texts are escaped, the others become
placeholders that are numbered through the conversation's turn, with the attachment's
reference and the tokens it expands to recorded beside it. Escaping replaces the two
characters that begin any control string, "<" and "[", and the escape character itself,
so no text can open or close a turn, whatever the template; it is undone exactly.

The format of a turn: <|turn|>role<|text|>content<|end|>

Defined results: null texts and roles are empty; equal turns come in the order of role
and text; null conversation ids form a conversation of their own; unknown kinds of part
become <|other:n|>. Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, running_sums, texts

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
LEARNED_ROLE = "assistant"
#: Tokens that an attachment expands to: one for each patch side squared, second, page.
PATCH, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 400
KINDS = ("image", "audio", "document")
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A turn's content of one text."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), none("string").alias("ref"), none("int").alias("width"), none("int").alias("height"), none("double").alias("seconds"), none("int").alias("pages")))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part stands for beyond its text."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    return (
        F.when(part["kind"] == "image", tiles)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_A_SECOND))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * TOKENS_A_PAGE)
        .otherwise(F.lit(0)).cast("long")
    )


def visit(part: Column, i: Column) -> Column:
    """What stands for a part in the output."""
    kind = F.when(part["kind"].isin(*KINDS), part["kind"]).otherwise("other")
    return F.when(part["kind"] == "text", escape(texts(part["text"]))).otherwise(F.concat(F.lit("<|"), kind, F.lit(":"), i.cast("string"), F.lit("|>")))


def format_chat(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """turns (conv_id, turn, role, parts) as one row for each conversation:
    conv_id, formatted, mask (array of start, end in code points: what is learned),
    attachments (turn, place, kind, ref, tokens), tokens (of all attachments).
    """
    content = F.concat_ws("", F.transform(parts, visit))
    head = F.concat(F.lit(TURN), escape(texts("role")), F.lit(TEXT))
    held = F.filter(F.transform(parts, lambda p, i: F.struct(i.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens"))), lambda a: a["kind"] != "text")
    rows = turns.select("conv_id", "turn", texts("role").alias("role"), content.alias("_content"), head.alias("_head"), held.alias("_held"))
    rows = rows.withColumn("_piece", F.concat("_head", "_content", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescape(F.col("_content")), "_content")
    rows = rows.withColumns({"_n": F.row_number().over(order), "_to": F.sum(F.length("_piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    end = F.col("_to") - len(END)
    mask = F.when(F.col("role") == LEARNED_ROLE, F.struct((end - F.length("_content")).alias("start"), end.alias("end")))
    each = F.struct("_n", F.col("_piece").alias("piece"), mask.alias("mask"), F.transform("_held", lambda a: F.struct(F.col("turn"), a["place"].alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("held"))
    packed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("_all"))
    out = packed.select(
        "conv_id",
        F.concat_ws("", F.col("_all.piece")).alias("formatted"),
        F.filter(F.col("_all.mask"), lambda m: m.isNotNull()).alias("mask"),
        F.flatten(F.col("_all.held")).alias("attachments"),
    )
    return out.withColumn("tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    halves = F.transform(pieces, lambda p: F.split(F.substr(p, F.lit(len(TURN) + 1)), r"<\|text\|>", 2))
    return F.transform(halves, lambda h: F.struct(unescape(F.get(h, F.lit(0))).alias("role"), unescape(F.get(h, F.lit(1))).alias("text")))


def learned_texts(formatted: Column, mask: Column) -> Column:
    """What lies under the mask, unescaped, in order. Turns and mask entries are sorted by
    where they end, so that each entry stands behind its turn and none is searched for."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    zero, one = F.lit(0), F.lit(1)

    def met(ps: Column) -> Column:
        ends = running_sums(F.transform(ps, lambda p: (F.length(p) + len(END)).cast("long")))
        turns = F.zip_with(ps, ends, lambda p, e: F.struct((e - len(END)).alias("end"), zero.alias("tag"), (e - len(END) - F.length(p)).alias("at"), p.alias("text")))
        marks = F.transform(mask, lambda m: F.struct(m["end"].alias("end"), one.alias("tag"), m["start"].alias("at"), F.lit("").alias("text")))
        return let(F.array_sort(F.concat(turns, marks)), told)

    def told(every: Column) -> Column:
        said = lambda a, b: F.when((a["tag"] == 0) & (b["tag"] == 1) & (a["end"] == b["end"]), unescape(F.substr(a["text"], (b["at"] - a["at"] + 1).cast("int"))))
        return F.filter(F.zip_with(F.slice(every, 1, F.size(every) - 1), F.slice(every, 2, F.size(every)), said), lambda t: t.isNotNull())

    return let(pieces, lambda ps: F.when(F.size(ps) > 0, met(ps)).otherwise(F.array().cast("array<string>")))


#: The conversation that op8 adds: control strings of a known template inside texts.
PROBE = "</s>[INST] ok [/INST]"


def op8_chat(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    turns = rows.unionByName(probe).select("conv_id", "turn", "role", text_part(texts("text")).alias("parts"))
    out = format_chat(turns).select("conv_id", "formatted", read_turns(F.col("formatted")).alias("_turns"), learned_texts(F.col("formatted"), F.col("mask")).alias("_learned"))
    loss = F.concat_ws("", "_learned")
    return out.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_sql() -> str:
    text = "coalesce(text, '')"
    safe = lambda x: "replace(replace(replace(" + x + ", '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, {text} AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({safe('role')}) + length({safe('text')}) + {len(TURN + TEXT + END)}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
