"""Verification against the loops of its rules, with missing archives, members and several archives in a manifest."""

import collections
import random

import pytest

from millrace.operators.verify import verify

ROWS = "shard string, sub string, at int, status string, tar_path string, xml_member string, figures array<struct<status:string,member:string>>"
PACKAGED = {"ok", "partial_figures", "figures_failed", "no_figures"}


def corpus(seed):
    rng, rows, archives, members = random.Random(seed), [], set(), set()
    for shard in ("00", "01", "02"):
        for sub in ("000", "001"):
            tars = [f"{shard}/{sub}{x}.tar" for x in ("", "-b")[: rng.choice([1, 1, 2])]]
            archives |= {t for t in tars if rng.random() < 0.8}
            for at in range(rng.randrange(1, 15)):
                key = f"{shard}{sub}{at}"
                figures = None if rng.random() < 0.2 else [(rng.choice(["ok", "error", None]), rng.choice([f"{key}/f{i}", None])) for i in range(rng.randrange(3))]
                row = (shard, sub, at, rng.choice([*PACKAGED, "license_skip", None]), rng.choice([*tars, *tars, None, ""]), rng.choice([f"{key}/x"] * 5 + [None, ""]), figures)
                rows.append(row)
                for t in tars:
                    members |= {(t, m) for m in [row[5], *[f[1] for f in figures or []]] if m and rng.random() < 0.8}
    return rows, archives, members


def loops(rows, archives, members):
    """Statuses and errors as nested loops over manifests, archives and rows tell them."""
    counts, errors = collections.Counter(), collections.defaultdict(list)
    manifests = collections.defaultdict(list)
    for r in rows:
        manifests[r[0], r[1]].append(r)
    for (shard, _), mine in sorted(manifests.items()):
        for tar in sorted({r[4] for r in mine if r[4]}):
            if tar not in archives:
                errors[shard].append(f"missing tar {tar}")
                continue
            for _, _, _, status, _, xml, figures in mine:
                counts[shard, status or "unknown"] += 1
                if status in PACKAGED:
                    if not xml or (tar, xml) not in members:
                        errors[shard].append(f"missing xml member {xml} in {tar}")
                    errors[shard] += [f"missing figure member {m} in {tar}" for s, m in figures or [] if s == "ok" and (tar, m) not in members]
    return counts, errors


@pytest.mark.parametrize("seed", range(4))
def test_against_loops(spark, seed):
    rows, archives, members = corpus(seed)
    tables = spark.createDataFrame(rows, ROWS), spark.createDataFrame([(a,) for a in archives], "tar_path string"), spark.createDataFrame(list(members), "tar_path string, member string")
    got, (counts, errors) = verify(*tables, ["shard", "sub"], "at"), loops(rows, archives, members)
    assert {(r["shard"], r["status"]): r["n"] for r in got.statuses.collect()} == counts
    report = {r["shard"]: r for r in got.report().collect()}
    shown = {s: [e.replace(" member  in", " member None in") for e in report[s]["errors"]] for s in report}
    for shard in ("00", "01", "02"):
        want = [e.replace(" member  in", " member None in") for e in errors[shard]]
        assert shown[shard] == want[:20] and report[shard]["n_errors"] == len(want)
        assert report[shard]["n_tar"] == sum(e.startswith("missing tar") for e in want) and report[shard]["n_rows"] == sum(n for (s, _), n in counts.items() if s == shard)
    done = verify(*tables, ["shard", "sub"], "at", done=spark.createDataFrame([("01",)], "shard string"))
    assert {r["shard"] for r in done.report().collect()} == {"00", "02"}


def test_own_archives(spark):
    rows = [("0", "a", 0, "ok", "t", "x0", None), ("0", "a", 1, "no_figures", "u", "x1", []), ("0", "a", 2, "ok", "v", "x2", None), ("0", "a", 3, "license_skip", None, None, None)]
    tables = spark.createDataFrame(rows, ROWS), spark.createDataFrame([("t",), ("u",)], "tar_path string"), spark.createDataFrame([("t", "x0"), ("u", "x1"), ("w", "x2")], "tar_path string, member string")
    own = verify(*tables, ["shard", "sub"], "at", own=True)
    assert own.report().first()["errors"] == ["missing tar v"] and own.report().first()["n_rows"] == 4
    with pytest.raises(ValueError, match="verification failed: shard 0: tar v"):
        own.check()
    every = verify(*tables, ["shard", "sub"], "at").report().first()
    assert (every["n_rows"], every["n_tar"], every["n_xml"]) == (8, 1, 4)
    clean = verify(tables[0].where("at < 2"), *tables[1:], ["shard", "sub"], "at", own=True)
    clean.check()
    assert clean.report().first()["n_errors"] == 0
