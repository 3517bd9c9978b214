"""Buckets of finished rows that are committed whole, and repaired whole.

A run writes the buckets it has finished as Parquet, a folder for each run and bucket, and
then one table of commits that names them, which appears in one piece. What counts of a
bucket is its last committed run: a run that is killed before its commits are written
changes nothing, whatever files it leaves, and its number is used again. Buckets that a run
does not touch stay as they are, files included. Readers join the rows with the last commits,
so Spark reads the files of those alone.

A repair pass takes new attempts at the rows that may be retried. It commits the buckets
with such rows whose attempts have come to an end, continues the history of every row that it
ran again, and leaves the others: those without targets are a no-op, those whose attempts
have not ended stay incomplete and keep their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.ladder import retry_target
from ..sources.artifacts import exists
from .joins import overlay
from .retry import continued

COMMITS = "run bigint, n_rows bigint, n_targets bigint"


@dataclass
class Buckets:
    """A table of rows under path by the columns of bucket; at tells a row's place in its bucket."""

    spark: SparkSession
    path: str
    schema: StructType
    bucket: list[str]
    at: str = "at"

    def _exists(self, part: str) -> bool:
        return exists(self.spark, f"{self.path}/{part}")

    def commits(self) -> DataFrame:
        """All commits: the columns of bucket, run, n_rows, n_targets (rows that may be retried)."""
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields if f.name in self.bucket)
        schema = f"{kinds}, {COMMITS}"
        return self.spark.read.schema(schema).parquet(f"{self.path}/commits") if self._exists("commits") else self.spark.createDataFrame([], schema)

    def last(self) -> DataFrame:
        """The last commit of each bucket."""
        return self.commits().groupBy(*self.bucket).agg(F.max("run").alias("run"), F.max_by("n_rows", "run").alias("n_rows"), F.max_by("n_targets", "run").alias("n_targets"))

    def rows(self) -> DataFrame:
        """The rows of all buckets as they were last committed, with run."""
        schema = StructType([*self.schema.fields, StructField("run", LongType())])
        if not self._exists("rows"):
            return self.spark.createDataFrame([], schema)
        kept = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        last = self.last().where("n_rows > 0").select(*self.bucket, "run")  # a filter, so that the join prunes folders
        return kept.join(last, [*self.bucket, "run"]).select(*self.schema.names, "run")

    def next_run(self) -> int:
        return (self.commits().agg(F.max("run")).first()[0] or 0) + 1

    def stage(self, rows: DataFrame, run: int) -> DataFrame:
        """Writes rows as those of a run that is not committed yet, over what a killed one left, and reads them again."""
        folder = f"{self.path}/rows/run={run}"
        ordered = rows.select(*self.schema.names).repartition(*self.bucket).sortWithinPartitions(*self.bucket, self.at)
        ordered.write.mode("overwrite").partitionBy(*self.bucket).parquet(folder)
        return self.spark.read.schema(self.schema).parquet(folder)

    def commit(self, rows: DataFrame, status: str = "status") -> DataFrame:
        """Commits rows as the new state of their buckets. A bucket with a row whose status is
        null is not finished and is left out. Returns bucket, n_rows, n_missing, state ("commit" or "incomplete")."""
        run = self.next_run()
        staged = self.stage(rows, run)
        counts = staged.groupBy(*self.bucket).agg(F.count("*").alias("n_rows"), F.count_if(F.col(status).isNull()).alias("n_missing"), F.count_if(retry_target(F.col(status))).alias("n_targets"))
        done = counts.where("n_missing = 0").select(*self.bucket, F.lit(run).cast("long").alias("run"), "n_rows", "n_targets")
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")  # a row for each bucket of the run
        return counts.select(*self.bucket, "n_rows", "n_missing", F.when(F.col("n_missing") == 0, "commit").otherwise("incomplete").alias("state"))

    def repair(self, attempts: DataFrame, label: str, max_retries: int = 2, status: str = "status") -> DataFrame:
        """Repairs what may be retried by attempts (bucket, at, try, status, and columns of the
        schema that a new row brings). Returns bucket, n_targets, n_missing (targets whose
        attempts have not ended), state ("noop", "commit" or "incomplete")."""
        keys = [*self.bucket, self.at]
        last = self.last()
        touched = last.where("n_targets > 0").select(*self.bucket)
        old = self.rows().drop("run").join(touched, self.bucket, "left_semi")
        targets = old.where(retry_target(F.col(status)))
        new = continued(targets, attempts, keys, "try", status, max_retries, label)
        # a target whose attempts have not ended has no status, so its bucket is not committed
        states = self.commit(overlay(old, new.select(*self.schema.names), keys), status)
        out = last.join(states.select(*self.bucket, "n_missing", "state"), self.bucket, "left")
        return out.select(*self.bucket, "n_targets", F.coalesce("n_missing", F.lit(0).cast("long")).alias("n_missing"), F.coalesce("state", F.lit("noop")).alias("state"))
