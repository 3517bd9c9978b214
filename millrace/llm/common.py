"""What the operators share: word rules, and tables written to the shared folder."""

from __future__ import annotations

import sys
import types
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import delete, new_path

#: Characters that part words, as in the class [\x20\x09-\x0D].
SPACES = " \t\n\u000b\u000c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Rows that Spark sends to a Python worker at once while a table is written.
BATCH_ROWS = 1_000


@contextmanager
def small_batches(spark):
    """Bounds the memory of tasks that hand whole texts to Python; the session's setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: a cut of the
    lineage that outlives executors."""
    path = new_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a kept table that nothing reads any more."""
    delete(df.sparkSession, df._millrace_path)


def free_name(name: str, df: DataFrame) -> str:
    """name, with as many underscores behind it as tell it from all columns of df."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def texts(column: str | Column) -> Column:
    """A text, null as the empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text as an array (empty for none)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def n_words_of(text: Column) -> Column:
    """How many words a text has, without building them twice."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("long")


def let(value: Column, use) -> Column:
    """use(value), with value computed once: what stands in a lambda is else computed anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, add, block: int = 256) -> Column:
    """What add makes of the elements of an array of longs up to and including each one.

    An array that grows by one element costs the square of its length, so it grows only
    inside blocks, and once over their ends.
    """
    grow = lambda a, x: F.concat(a, F.array(F.when(F.size(a) > 0, add(F.element_at(a, -1), x)).otherwise(x)))
    none = F.array().cast("array<bigint>")

    def of(v: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(v), F.lit(block))
        blocks = F.transform(firsts, lambda at: F.aggregate(F.slice(v, at, F.lit(block)), none, grow))
        return let(blocks, lambda bs: let(F.aggregate(F.transform(bs, lambda x: F.element_at(x, -1)), none, grow), lambda ends: joined(bs, ends)))

    def joined(bs: Column, ends: Column) -> Column:
        after = lambda x, k: F.when(k == 0, x).otherwise(let(F.get(ends, k - 1), lambda e: F.transform(x, lambda v: add(e, v))))
        return F.flatten(F.transform(bs, after))

    return let(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(none))


def running_sums(values: Column) -> Column:
    return running(values, lambda a, x: a + x)


def running_max(values: Column) -> Column:
    return running(values, lambda a, x: F.greatest(a, x))


def slices(batches, most: int = 2 << 20):
    """Arrow batches cut into ones of about most bytes (a row at least), so that what is
    made of one is bounded however many rows Spark sends at once."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_store() -> dict:
    """A dict that lives as long as a Python worker, so tasks can share what costs to build."""
    return sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")).__dict__
