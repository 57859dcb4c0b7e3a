import hashlib
import json

from pyspark.sql import functions as F

from almagest.__main__ import main
from almagest.functions import presentation as P
from almagest.operators import receipts


def test_controls_of_receipts(spark):
    summary = {"state": "AVAILABLE", "reason": None, "counts": {"input_observations": 10, "rejected_observations": 2}, "controls": [{"check_id": "K", "affected_rows": 1, "denominator": 8, "denominator_grain": "contracts", "passed": False, "severity": "CRITICAL"}]}
    coverage = {"acquisitions": [{"campaign_id": "c1", "state": "COMPLETE", "truncated": False, "scope_scan_complete": True}]}
    df = spark.createDataFrame([(json.dumps(summary), json.dumps(coverage), "COVERED"), ('{"state": "UNAVAILABLE"}', "{}", None)], "summary string, coverage string, coverage_state string")
    got = {(r.control, r.state): (r.numerator, r.denominator, r.grain, r.reason) for r in receipts.quality_mart(df).collect()}
    assert got[("rejected_observations", "AVAILABLE")] == (2, 10, "OBSERVATION", None)
    assert got[("K", "FAILED")] == (1, 8, "contracts", "CRITICAL")
    assert got[("acquisition:c1:scope_scan_complete", "COMPLETE")] == (1, 1, "ACQUISITION_LANE", "COVERED")
    assert got[("acquisition:c1:baseline_check_complete", "COMPLETE")][0] == 0
    assert sum(k[1] == "UNAVAILABLE" and v[:2] == (None, None) for k, v in got.items()) == 6 and len(got) == 12
    assert receipts.quality_mart(df.limit(0)).count() == 0


def test_presentation(spark):
    rows = [(["AMOUNT_NULL", "X"], "LATER_INVALID_OBSERVED", 2, 0, [("LATER", ["DATE_INVALID"]), ("ODD", [])], "MISSING_CODE", "UNKNOWN"), ([], "LEGACY_UNASSESSED", None, None, [], None, "KNOWN"), (None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "w array<string>, s string, l bigint, e bigint, k array<struct<relation:string,rejection_codes:array<string>>>, r string, i string")
    got = df.select(P.listed(F.col("w")), P.condition_text(F.col("s"), F.col("l"), F.col("e")), P.evidence_text(F.col("k")), P.identity_text(F.col("i"), F.col("r"))).collect()
    assert tuple(got[0]) == ("no amount, issue X", "a later invalid observation, 2 later", "seen later: no such date\nrelation ODD: no issues", "no code given")
    assert tuple(got[1]) == ("no issues", "never assessed", "no evidence", "known")
    assert tuple(got[2]) == ("not assessed", "not stated", "not assessed", "not stated")
    assert df.select(P.listed(F.col("w"), {"X": "un", "*": "?"}, between="/")).first()[0] == "?AMOUNT_NULL/un"


def test_command_line(capsys):
    assert main(["list"]) == 0 and "silver_counts\t" in capsys.readouterr().out
    assert main(["run", "nothing", "--data", "x"]) == 2


def test_commands_on_folders(spark, tmp_path, capsys):
    from almagest.sources import package, runs, store

    root = f"file://{tmp_path}"
    text = '[{"k":1}]'
    page = {"path": "p.json", "sha256": hashlib.sha256(text.encode()).hexdigest(), "rows": 1}
    (tmp_path / "runs" / "a").mkdir(parents=True)
    (tmp_path / "runs" / "a" / "p.json").write_text(text)
    store.write_text(spark, f"{root}/runs/a/manifest.json", runs.manifest("a", "d", "c", [page], "prepared"))
    assert main(["runs", f"{root}/runs", "--dataset", "d"]) == 0 and capsys.readouterr().out == ""
    assert main(["runs", f"{root}/runs", "--dataset", "d", "--recover"]) == 0 and capsys.readouterr().out == "SETTLED a\na\t1 pages\t1 rows\n"
    assert main(["runs", f"{root}/runs", "--dataset", "e"]) == 1 and "OTHER_DATASET" in capsys.readouterr().err
    (tmp_path / "runs" / "a" / "p.json").write_text("[{}]")
    assert main(["runs", f"{root}/runs", "--dataset", "d"]) == 1 and "PAGE_HASH a/p.json" in capsys.readouterr().err
    package.write_package(spark, f"{root}/pkg", {"t": spark.range(3)})
    assert main(["verify", f"{root}/pkg"]) == 0
    next((tmp_path / "pkg" / "t").glob("*.parquet")).unlink()
    assert main(["verify", f"{root}/pkg"]) == 1 and "FILE_MISSING t/" in capsys.readouterr().err
    held = store.VersionStore(spark, f"{root}/store")
    a, b = held.publish(spark.range(1)), held.publish(spark.range(2))
    assert main(["versions", f"{root}/store", "--activate", a, "--expect", b]) == 0 and f"* {a}" in capsys.readouterr().out
    assert main(["versions", f"{root}/store", "--activate", a, "--expect", b]) == 1 and "CURRENT_CHANGED" in capsys.readouterr().err
