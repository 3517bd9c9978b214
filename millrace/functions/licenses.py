"""License policy of a text and its URLs."""

from __future__ import annotations

import html
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What a text without separators must not contain, and what names a license, in order.
BLOCKED = ("bync", "noncommercial", "bynd", "noderivatives", "bysa", "sharealike")
NAMED = (
    ("CC0", ("creativecommons.org/publicdomain/zero", "cc0")),
    ("PD", ("creativecommons.org/publicdomain/mark", "public domain")),
    ("CC BY", ("creativecommons.org/licenses/by/", "creative commons attribution")),
)
KEPT_CODES = tuple(code for code, _ in NAMED)


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: html.unescape(t) if t and "&" in t else t)


def license_of(text: Column, urls: Column | None = None, unescape: bool = True) -> Column:
    """struct<code, policy>: keep, skip, unknown or missing. Blocked terms come first,
    and are sought with all separators removed. Unescaping HTML is the one step that
    needs Python; switch it off for texts that hold no entities.

    Each form of the text is built once: what follows from it stands in a lambda over an
    array of it, as arms of a CASE would build it anew wherever they name it."""
    hay = F.concat_ws(" ", F.coalesce(text, F.lit("")), *([urls] if urls is not None else []))
    hay = F.lower(unescaped(hay) if unescape else hay)
    has = lambda where, words: reduce(or_, (F.contains(where, F.lit(w)) for w in words))
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def named(hay: Column) -> Column:
        code = reduce(lambda arms, n: arms.when(has(hay, n[1]), F.lit(n[0])), NAMED, F.when(F.lit(False), F.lit(None).cast("string")))
        return once(code, lambda c: F.struct(c.alias("code"), F.when(c.isNotNull(), "keep").otherwise("unknown").alias("policy")))

    def judged(hay: Column) -> Column:
        without = lambda policy: F.struct(F.lit(None).cast("string").alias("code"), F.lit(policy).alias("policy"))
        blocked = once(F.regexp_replace(hay, "[^a-z0-9]+", ""), lambda compact: has(compact, BLOCKED))
        return F.when(F.btrim(hay, F.lit(" \t\n\r")) == "", without("missing")).when(blocked, without("skip")).otherwise(named(hay))

    return once(hay, judged)
