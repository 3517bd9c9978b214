"""Retry folding: from logs of attempts to final statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ladder import BLOCKED, retryable


def fold_attempts(attempts: DataFrame, keys: list[str], order: str, status: str, max_retries: int = 2) -> DataFrame:
    """keys, attempts, retries, final_status.

    Attempts run until one is not retryable or the budget is spent; what is still
    retryable then is blocked. With no budget the first status stands as it is.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    rows = attempts.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= max_retries + 1)
    again = retryable(F.col(status))
    folded = rows.groupBy(*keys).agg(F.min(F.when(~again, F.col("_k"))).alias("_done"), F.max("_k").alias("_last"), F.min_by(status, F.when(~again, F.col("_k"))).alias("_fine"), F.max_by(status, "_k").alias("_end"))
    spent = F.col("_done").isNull() & (F.col("_last") > max_retries) & F.lit(max_retries > 0)
    n = F.coalesce("_done", "_last")
    return folded.select(
        *keys, n.cast("long").alias("attempts"), (n - 1).cast("long").alias("retries"),
        F.when(F.col("_done").isNotNull(), F.col("_fine")).when(spent, F.concat(F.lit(BLOCKED), "_end")).otherwise(F.col("_end")).alias("final_status"),
    )


def history(attempts: DataFrame, keys: list[str], order: str, entry: list[str], repair_pass: str | None = None) -> DataFrame:
    """keys and retry_history: entries in order, marked with the pass that made them."""
    fields = [F.col(order), *[F.col(c) for c in entry if c != order], *([F.lit(repair_pass).alias("repair_pass")] if repair_pass else [])]
    return attempts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("retry_history"))


ENTRY = "array<struct<attempt:int,status:string,error:string,repair_pass:string>>"


def continued(rows: DataFrame, attempts: DataFrame, keys: list[str], order: str, status: str, max_retries: int, label: str) -> DataFrame:
    """rows after another pass over them, with the history that they bring carried on.

    rows: keys, status, retry_history (as ENTRY, or null), row_attempts, row_retries and any
    others; attempts: keys, order, status and error, of which those up to the first that is
    not retryable count, and one more than max_retries at most. Every retryable one becomes
    an entry behind the old ones, numbered on and marked with label. What is retryable to the
    end is blocked; a success tells its attempts only where there is a history; without
    retries the attempt's status stands as it is. Columns of rows that attempts bring too
    are taken from the last attempt that counts. A row whose attempts have not come to an
    end, or that has none, gets a null status.
    """
    others = [c for c in attempts.columns if c in rows.columns and c not in (*keys, status, "error")]
    error = F.col("error") if "error" in attempts.columns else F.lit(None).cast("string")
    each = F.struct(F.col(order).alias("o"), F.col(status).alias("s"), error.alias("e"), *others)
    first = Window.partitionBy(*keys).orderBy(order)
    budget = attempts.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= max_retries + 1)  # so the lists are as short
    tries = budget.groupBy(*keys).agg(F.array_sort(F.collect_list(each)).alias("_tries"))
    all_ = rows.join(tries, keys, "left").withColumn("_tries", F.coalesce("_tries", F.array().cast(tries.schema["_tries"].dataType)))
    ended = F.array_position(F.transform("_tries", lambda t: retryable(t["s"])), False)  # from 1, 0 for never
    used = F.when(F.lit(max_retries <= 0), F.least(F.size("_tries"), F.lit(1)).cast("long")).when(ended > 0, ended).otherwise(F.size("_tries").cast("long"))
    out = all_.withColumn("_used", used).withColumn("_last", F.get("_tries", F.col("_used").cast("int") - 1))
    again = retryable(F.col("_last.s")) & F.lit(max_retries > 0)
    past = F.coalesce("retry_history", F.array().cast(ENTRY))
    failed = F.slice("_tries", 1, (F.col("_used") - F.when(again, 0).otherwise(1)).cast("int"))
    entries = F.transform(failed, lambda t, i: F.struct((F.size(past) + i + 1).cast("int").alias("attempt"), t["s"].alias("status"), t["e"].alias("error"), F.lit(label).alias("repair_pass")))
    out = out.withColumn("_again", again).withColumn("_history", F.when(F.col("_used") > 0, F.concat(past, entries)).otherwise(past))
    spent = F.col("_used") > max_retries
    told = (
        F.when(F.col("_used") == 0, F.lit(None).cast("string"))
        .when(F.col("_again") & spent, F.concat(F.lit(BLOCKED), F.col("_last.s")))
        .when(~F.col("_again"), F.col("_last.s"))
    )
    n = F.size("_history")
    tells = n > 0
    made = {
        status: told, "retry_history": F.when(tells, F.col("_history")), "row_attempts": F.when(tells, n + F.when(F.col("_again"), 0).otherwise(1)).cast("int"),
        "row_retries": F.when(tells, n).cast("int"), **{c: F.when(F.col("_used") > 0, F.col(f"_last.{c}")).otherwise(F.col(c)) for c in others},
    }
    return out.select(*[made[c].alias(c) if c in made else F.col(c) for c in rows.columns])
