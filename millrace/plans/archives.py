"""Archives of finished buckets: accounted for at the hand-off, and written anew by a repair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_wins
from ..operators.joins import inventory, member_sizes
from ..sources import tar
from ..sources.shared import new_path
from .handoff import KINDS, members, payload_members

#: Missing members that an account shows, and that a strict one names.
SHOWN, NAMED = 100, 10


@dataclass
class Account:
    """members: source_id, kind, tar_path, member, size_bytes. archives: tar_path, tar_size_bytes, rows,
    members, payload_bytes and both of each kind. missing: tar_path, member, source_id, error."""

    members: DataFrame
    archives: DataFrame
    missing: DataFrame

    def totals(self) -> DataFrame:
        """One row: archives, and the sums of their sizes and counts."""
        sums = [c for c in self.archives.columns if c != "tar_path"]
        return self.archives.agg(F.count("*").alias("tar_files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])

    def first_missing(self, most: int = SHOWN) -> DataFrame:
        return self.missing.orderBy("tar_path", "error", "source_id", "member").limit(most)


def account(spark: SparkSession, rows: DataFrame, path: str, strict: bool = False) -> Account:
    """The members that accepted rows name, against the archives under path: their sizes as
    the archives' headers tell them, the last of equal names, 0 for what is missing. An
    archive that does not exist is one missing thing, and with it each of its members. With
    strict, anything missing is an error that names the first of them. The members with their
    sizes are written to the shared folder, so the archives are read once, whatever is asked
    of the account."""
    named = rows.groupBy("tar_path").agg(F.count("*").alias("rows"))
    sizes = tar.archives(spark, path).select("tar_path", F.col("size").alias("_tar_size"))
    found = tar.member_sizes(tar.read_tar(spark, path))
    kept = new_path(spark, "account")
    member_sizes(members(rows), found, ["tar_path", "member"], "size").write.parquet(kept)
    sized = spark.read.parquet(kept)
    per = named.join(sizes, "tar_path", "left").join(inventory(sized, "tar_path", F.col("kind"), list(KINDS)), "tar_path")
    lost = per.where("_tar_size is null").select("tar_path", F.lit(None).cast("string").alias("member"), F.lit(None).cast("string").alias("source_id"), F.lit("missing_tar").alias("error"))
    lost = lost.unionByName(sized.where("missing").select("tar_path", "member", "source_id", F.lit("missing_member").alias("error")))
    out = Account(sized.select("source_id", "kind", "tar_path", "member", "size_bytes"), per.withColumn("tar_size_bytes", F.coalesce("_tar_size", F.lit(0).cast("long"))).drop("_tar_size"), lost)
    if strict and (bad := out.first_missing(NAMED).collect()):
        raise ValueError("missing accepted members: " + ", ".join(f"{r['error']} {r['tar_path']} {r['member'] or ''}".strip() for r in bad))
    return out


def repaired(spark: SparkSession, path: str, rows: DataFrame, payloads: DataFrame) -> DataFrame:
    """The members, in order, of the archives under path that hold a repaired row.

    rows: tar_path, row, source_member, xml_member, figures and target (whether the row was
    run again), all rows of those archives; payloads: tar_path, row, members (array of member,
    content) of the targets. Rows that were not run again keep the members that they name,
    each once, as the archive has them; targets bring theirs. A member that the old archive
    lacks, and a target without payload, stay without content, which the write refuses.
    """
    touched = rows.where("target").select("tar_path").distinct()
    mine = rows.join(touched, "tar_path", "left_semi")
    named = mine.where("not target").select("tar_path", "row", F.posexplode(payload_members(F.col("source_member"), F.col("xml_member"), F.col("figures"))).alias("at", "member"))
    once = first_wins(named, ["tar_path", "member"], ["row", "at"])
    only = [r["tar_path"] for r in touched.collect()]  # the archives of buckets that are repaired
    held = tar.read_tar(spark, path, payload=True, only=only).where("is_file").groupBy("tar_path", "member").agg(F.max_by("content", "ordinal").alias("content"))
    kept = once.join(held, ["tar_path", "member"], "left").select("tar_path", "row", "at", "member", "content")
    new = tar.assemble(mine.where("target").select("tar_path", "row"), payloads, ["tar_path", "row"])
    return kept.unionByName(new)


def repair_archives(spark: SparkSession, path: str, rows: DataFrame, payloads: DataFrame) -> None:
    """Writes the archives of repaired() in the place of the old ones, once all of them are whole; others are not touched."""
    tar.write_tar(repaired(spark, path, rows, payloads), path, mode="overwrite", order=("row", "at"))
