"""The hand-off as one job: accepted rows enriched, flattened, accounted for and written with a summary and checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import histogram
from ..sources import artifacts
from . import archives, handoff
from .seed import enrich

#: The names of the artifacts.
ACCEPTED, FLAT, MEMBERS, INVENTORY = "accepted_manifest.jsonl", "accepted_manifest.parquet", "accepted_members.jsonl", "tar_inventory.jsonl"
BLOCKED, SUMMARY, README, CHECKSUMS = "retry_blocked_manifest.jsonl", "converter_summary.json", "README.md", "checksums.sha256"

ABOUT = f"""# Hand-off

Only complete accepted rows are here: their status is ok or no_figures, their license is one
that is kept, and they name an archive, an XML member and a provenance member.

- {ACCEPTED}: the accepted rows, whole
- {FLAT}: the same rows as a flat table
- {MEMBERS}: every member of them, with its size
- {INVENTORY}: rows, members and bytes of each archive
- {BLOCKED}: rows that are left out because their retries are spent
- {SUMMARY}: counts and volumes
- {CHECKSUMS}: SHA-256 of every file beside it
"""


def _counts(rows: DataFrame, column: str, missing: str) -> dict[str, int]:
    return {r["k"]: r["n"] for r in histogram(rows, F.col(column), "k", missing).collect()}  # as many as statuses or licenses


def _document(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text.removesuffix("\n"),)], "value string").coalesce(1).write.text(path)


def checksums(spark: SparkSession, path: str, to: str) -> int:
    """A line for each file under path, its SHA-256 and its place below, in order. Returns how many."""
    files = artifacts.listing(spark, path).select(F.concat("sha256", F.lit("  "), F.substring_index("path", path.rstrip("/").rpartition(":")[2] + "/", -1)).alias("value"))
    return artifacts.counted(files.coalesce(1), lambda rows: rows.write.text(to))["rows"]


def convert(spark: SparkSession, rows: DataFrame, seed: DataFrame, data: str, out: str, strict: bool = True, source: str = "corpus") -> dict:
    """Writes the hand-off of manifest rows, with what their seed adds and the archives under
    data, to the folder out, which must not exist. Returns the summary that it writes there.
    With strict, a member or archive that is missing fails the job before anything but the rows is written."""
    good, blocked, rejected = handoff.split(enrich(rows, seed))
    told = {"accepted_rows": artifacts.write_jsonl(good, f"{out}/{ACCEPTED}")["rows"]}
    accepted = spark.read.schema(good.schema).json(f"{out}/{ACCEPTED}")  # what follows reads what was written
    account = archives.account(spark, accepted, data, strict)
    handoff.write_flat(handoff.flatten(accepted, source), f"{out}/{FLAT}")
    told["retry_blocked_rows"] = artifacts.write_jsonl(blocked, f"{out}/{BLOCKED}")["rows"]
    artifacts.write_jsonl(account.members, f"{out}/{MEMBERS}")
    artifacts.write_jsonl(account.archives, f"{out}/{INVENTORY}")
    inventory = spark.read.schema(account.archives.schema).json(f"{out}/{INVENTORY}")
    totals = archives.Account(account.members, inventory, account.missing).totals().first().asDict()
    sums = handoff.byte_totals(accepted)
    told |= {
        "manifest_rows": rows.count(), "status_counts": _counts(rows, "status", "unknown"), "license_counts": _counts(rows, "license_code", "NONE"),
        "accepted_status_counts": _counts(accepted, "status", "unknown"), "accepted_license_counts": _counts(accepted, "license_code", "NONE"),
        "retry_blocked_status_counts": _counts(blocked, "status", "unknown"), "rejected_accepted_like_count": rejected.count(),
        "rejected_accepted_like_examples": [r.asDict() for r in handoff.rejected_examples(rejected, "source_id").collect()],
        "byte_totals": sums.first().asDict(), "member_totals": totals, "missing_member_count": account.missing.count(),
        "missing_members": [r.asDict() for r in account.first_missing().collect()],
        "volume_gb": handoff.volumes(sums).first().asDict() | {"accepted_payload_exact_members": round(totals["payload_bytes"] / 1e9, 3), "tar_files_referenced": totals["tar_files"], "tar_files_referenced_size": round(totals["tar_size_bytes"] / 1e9, 3)},
    }
    _document(spark, artifacts.json_text(told), f"{out}/{SUMMARY}")
    _document(spark, ABOUT, f"{out}/{README}")
    told["files"] = checksums(spark, out, f"{out}/{CHECKSUMS}")
    return told
