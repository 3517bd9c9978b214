"""Verification of finished shards: what manifests name against the archives that exist and their members.

A manifest is a bucket of rows. Its archives are those that its rows name; one that does not
exist is an error. Of each that exists all rows of the manifest are counted by status, and
those that are packaged must have their XML member and every good figure's member in it: a
manifest of several archives so counts and checks its rows once for each, as the reports of
the pipeline do. With own, a row is held against its own archive alone, and rows whose
archive is missing are counted too. Provenance members are not checked here but at the hand-off.

Joins are on archives and on (archive, member); nothing of a shard is gathered but its report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ladder import ACCEPTED, INCOMPLETE

#: Errors that a report shows of each shard.
SHOWN = 20
KINDS = ("tar", "xml", "figure")


@dataclass
class Verified:
    """statuses: shard, status, n. errors: shard, the manifest's other columns, tar_path, at, kind
    (tar, xml or figure), place (of a figure), member."""

    statuses: DataFrame
    errors: DataFrame
    shard: str
    order: list[str]

    def report(self, most: int = SHOWN) -> DataFrame:
        """shard, n_rows, n_errors, and one count for each kind of error, and the first errors in order of manifest, archive and row."""
        w = Window.partitionBy(self.shard).orderBy(*self.order)
        text = F.when(F.col("kind") == "tar", F.concat(F.lit("missing tar "), "tar_path")).otherwise(F.concat(F.lit("missing "), "kind", F.lit(" member "), F.coalesce("member", F.lit("None")), F.lit(" in "), "tar_path"))
        # Spark keeps the first rows of a shard in each task before it deals them
        first = self.errors.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).groupBy(self.shard).agg(F.array_sort(F.collect_list(F.struct("_k", text.alias("text")))).alias("_first"))
        counts = self.errors.groupBy(self.shard).agg(F.count("*").alias("n_errors"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS])
        rows = self.statuses.groupBy(self.shard).agg(F.sum("n").alias("n_rows"))
        out = rows.join(counts, self.shard, "full").join(first, self.shard, "left")
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return out.select(self.shard, zero("n_rows"), zero("n_errors"), *[zero(f"n_{k}") for k in KINDS], F.coalesce(F.col("_first.text"), F.array().cast("array<string>")).alias("errors"))

    def check(self) -> None:
        """Raises where any shard has an error, with the first of them."""
        bad = self.errors.orderBy(self.shard, *self.order).limit(SHOWN).collect()
        if bad:
            raise ValueError("verification failed: " + "; ".join(f"{self.shard} {r[self.shard]}: {r['kind']} {r['member'] or ''} {r['tar_path']}".replace("  ", " ") for r in bad))


def verify(rows: DataFrame, archives: DataFrame, members: DataFrame, manifest: list[str], at: str, done: DataFrame | None = None, own: bool = False) -> Verified:
    """rows (the columns of manifest, the first of which is the shard; at, status, tar_path,
    xml_member, figures) against archives (tar_path) and members (tar_path, member). Shards
    of done were verified before and are left out."""
    shard, others = manifest[0], manifest[1:]
    if done is not None:
        rows = rows.join(done.select(shard), shard, "left_anti")
    named = rows.where(F.coalesce("tar_path", F.lit("")) != "").select(*manifest, "tar_path").distinct()
    there = archives.select("tar_path").distinct().withColumn("_there", F.lit(True))
    tars = named.join(there, "tar_path", "left")
    missing = tars.where("_there is null").select(*manifest, "tar_path", F.lit(None).cast("long").alias("at"), F.lit("tar").alias("kind"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("member"))
    mine = rows.select(*manifest, F.col(at).cast("long").alias("at"), "status", "xml_member", "figures", *(["tar_path"] if own else []))
    existing = tars.where("_there").select(*manifest, "tar_path")
    held = mine.join(existing, [*manifest, "tar_path"] if own else manifest)
    counted = mine if own else held
    statuses = counted.groupBy(shard, F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))
    packaged = held.where(F.col("status").isin(*ACCEPTED, *INCOMPLETE))
    member = lambda kind, place, name: F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), name.alias("member"))
    xml = F.array(member("xml", F.lit(None), F.col("xml_member")))
    good = F.filter(F.transform("figures", lambda f, i: F.struct(f["status"].alias("s"), i.alias("i"), f["member"].alias("m"))), lambda f: f["s"] == "ok")
    figures = F.coalesce(F.transform(good, lambda f: member("figure", f["i"], f["m"])), F.slice(xml, 1, 0))
    wanted = packaged.select(*manifest, "tar_path", "at", F.inline(F.concat(xml, figures)))
    named_ = F.coalesce("member", F.lit("")) != ""
    known = members.select("tar_path", "member").distinct()
    lost = wanted.where(named_).join(known, ["tar_path", "member"], "left_anti").select(*wanted.columns).union(wanted.where(~named_))
    return Verified(statuses, missing.unionByName(lost), shard, [*others, "tar_path", "at", "place"])
