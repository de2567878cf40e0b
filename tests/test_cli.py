import json
import os
import subprocess
import sys

from .test_claims_job import CLAIM_CSV, CONTRACT_CSV

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_runs_the_claims_job(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "Contract.csv").write_bytes(CONTRACT_CSV.encode("utf-8"))
    (src / "Claim.csv").write_bytes(CLAIM_CSV.encode("utf-8"))
    env = dict(os.environ, PYTHONPATH=REPO)
    cmd = [sys.executable, "-m", "sluice", "claims", "--input", str(src), "--output", str(tmp_path / "out"),
           "--batch-id", "b1", "--format", "parquet"]
    done = subprocess.run(cmd, capture_output=True, text=True, env=env, cwd=REPO, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert report["published_rows"] == 7 and report["quality"]["claim"]["valid"] == 7
    assert (tmp_path / "out" / "TRANSACTIONS" / "batch_date=b1").is_dir()
    bad = subprocess.run(cmd[:5] + [str(tmp_path / "nope")] + cmd[6:], capture_output=True, text=True,
                         env=env, cwd=REPO, timeout=600)
    assert bad.returncode == 1


def test_cli_reads_application_config_and_rule_files(tmp_path):
    from sluice.plans.claims import CLAIM_RULES_SPEC, CONTRACT_RULES_SPEC

    src = tmp_path / "in"
    src.mkdir()
    # semicolon-separated input, as declared by the config's csv_options
    (src / "Contract.csv").write_bytes(CONTRACT_CSV.replace(",", ";").encode("utf-8"))
    (src / "Claim.csv").write_bytes(CLAIM_CSV.replace(",", ";").encode("utf-8"))
    rules = tmp_path / "rules"
    rules.mkdir()
    (rules / "contract_validation.json").write_text(json.dumps(CONTRACT_RULES_SPEC))
    claim_spec = dict(CLAIM_RULES_SPEC)
    claim_spec["CLAIM_TYPE"] = dict(claim_spec["CLAIM_TYPE"], allowed_values=["1", None, ""])  # type 2 now fails
    (rules / "claim_validation.json").write_text(json.dumps(claim_spec))
    cfg = tmp_path / "application.json"
    cfg.write_text(json.dumps({
        "file_formats": {"destination": "file", "input_format": "csv", "output_format": "json"},
        "csv_options": {"delimiter": ";", "quote_char": '"', "escape_char": '"', "header": "true",
                        "mode": "PERMISSIVE", "multiline": "true"},
    }))
    env = dict(os.environ, PYTHONPATH=REPO)
    done = subprocess.run(
        [sys.executable, "-m", "sluice", "claims", "--input", str(src), "--output", str(tmp_path / "out"),
         "--batch-id", "b1", "--config", str(cfg), "--rules-dir", str(rules)],
        capture_output=True, text=True, env=env, cwd=REPO, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert report["quality"]["claim"] == {"rows": 7, "valid": 3, "invalid": 4, "unknown": 0, "invalid_rate": 4 / 7}  # four type-2 claims
    assert report["published_rows"] == 3
    assert any(f.endswith(".json") for f in os.listdir(tmp_path / "out" / "TRANSACTIONS" / "batch_date=b1"))
