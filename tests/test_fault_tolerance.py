import json
import os
import subprocess
import sys

from .test_claims_job import CLAIM_CSV, CONTRACT_CSV, GOLDEN

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_job_survives_a_lost_worker(tmp_path):
    (tmp_path / "Contract.csv").write_bytes(CONTRACT_CSV.encode("utf-8"))
    (tmp_path / "Claim.csv").write_bytes(CLAIM_CSV.encode("utf-8"))
    done = subprocess.run([sys.executable, os.path.join(REPO, "tests", "fault_job.py"), str(tmp_path)],
                          capture_output=True, text=True, cwd=REPO, timeout=600,
                          env=dict(os.environ, PYTHONPATH=REPO))
    assert done.returncode == 0, done.stderr[-3000:]
    out = json.loads(done.stdout.strip().splitlines()[-1])
    assert out["crashed"]  # a task really failed and was retried
    assert out["published"] == 7
    assert out["quality"]["claim"] == {"rows": 7, "valid": 7, "invalid": 0, "unknown": 0, "invalid_rate": 0.0}
    assert out["ids"] == sorted(g[-1] for g in GOLDEN)  # nothing lost, nothing doubled
