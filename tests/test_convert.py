"""The hand-off as one job: artifacts, summary, checksums, and a strict run that fails."""

import hashlib
import json

import pytest

from millrace.plans import convert
from millrace.plans.seed import load_seed
from millrace.sources import tar

ROWS = "source_id string, status string, license_policy string, license_code string, tar_path string, xml_member string, source_member string, document_type string, xml_bytes long, figure_bytes long, original_figure_bytes long, expected_figure_files int, downloaded_figure_files int, rendered_figure_files int, figures array<struct<status:string,member:string,url:string>>"


def test_hand_off(spark, tmp_path):
    members = [("a.tar", k, m, b"x" * k) for k, m in enumerate(("1/x", "1/s", "1/f", "2/x", "2/s"), 1)]
    tar.write_tar(spark.createDataFrame(members, "tar_path string, ordinal int, member string, content binary"), str(tmp_path / "data"))
    rows = spark.createDataFrame([
        ("1", "ok", "keep", "CC BY", "a.tar", "1/x", "1/s", None, 3_000_000_000, 7, 0, 1, 1, 0, [("ok", "1/f", "u"), ("error", None, "v")]),
        ("2", "no_figures", "keep", "CC0", "a.tar", "2/x", "2/s", "own", 5, None, None, 0, 0, 0, []),
        ("3", "ok", "keep", "CC BY", "a.tar", "", "3/s", None, 5, 1, 1, 1, 1, 1, None),
        ("4", "retry_blocked_row_error", None, None, None, None, None, None, None, None, None, None, None, None, None),
        ("5", None, "skip", None, None, None, None, None, None, None, None, None, None, None, None),
    ], ROWS)
    (tmp_path / "seed.jsonl").write_text('{"source_id":"1","document_type":"old"}\n\n{"source_id":"1","document_type":"article","fulltexts":{"html":{"en":"é"}}}\n{"source_id":7,"document_type":"n"}\n{"source_id":"2","document_type":"other","publication_year":"2020"}\n')
    seed, out = load_seed(spark, str(tmp_path / "seed.jsonl")), tmp_path / "out"
    assert sorted(r["source_id"] for r in seed.collect()) == ["1", "2"] and load_seed(spark, str(tmp_path / "none")).count() == 0
    told = convert.convert(spark, rows, seed, str(tmp_path / "data"), str(out))
    assert (told["manifest_rows"], told["accepted_rows"], told["retry_blocked_rows"], told["rejected_accepted_like_count"], told["missing_member_count"]) == (5, 2, 1, 1, 0)
    assert told["status_counts"] == {"ok": 2, "no_figures": 1, "retry_blocked_row_error": 1, "unknown": 1} and told["license_counts"] == {"CC BY": 2, "CC0": 1, "NONE": 2}
    assert told["member_totals"]["payload_bytes"] == 15 and told["volume_gb"]["xml_manifest"] == 3.0 and told["byte_totals"]["original_figure_bytes_manifest"] == 7
    flat = {r["source_id"]: r for r in spark.read.parquet(str(out / convert.FLAT)).collect()}
    assert len(flat["1"]) == 45 and (flat["1"]["document_type"], flat["1"]["fulltexts_json"]) == ("article", '{"html":{"en":"é"}}') and (flat["2"]["document_type"], flat["2"]["publication_year"]) == ("own", "2020")
    summary = json.loads("".join(p.read_text() for p in sorted((out / convert.SUMMARY).glob("part-*"))))
    assert summary == {k: v for k, v in told.items() if k != "files"} and convert.ABOUT == "".join(p.read_text() for p in (out / convert.README).glob("part-*"))
    lines = "".join(p.read_text() for p in (out / convert.CHECKSUMS).glob("part-*")).splitlines()
    assert len(lines) == told["files"] and [x.split("  ")[1] for x in lines] == sorted(x.split("  ")[1] for x in lines)
    assert all(hashlib.sha256((out / x.split("  ")[1]).read_bytes()).hexdigest() == x.split("  ")[0] for x in lines)
    with pytest.raises(ValueError, match="missing_member a.tar 9/x"):
        convert.convert(spark, rows.replace("1/x", "9/x"), seed, str(tmp_path / "data"), str(tmp_path / "strict"))
