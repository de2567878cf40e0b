import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__ as E
md4 = E.queries()["digest_md4"](spark, "/root/testdata/sf0.001").collect()
enr = E.queries()["enrich_by_key"](spark, "/root/testdata/sf0.001").collect()
print("OK", len(md4), len(enr), md4[0].text_md4 is not None)
"""


def test_workers_import_the_package_from_any_directory(tmp_path):
    # run from a folder that does not contain the package: executors get it via addPyFile
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), capture_output=True, text=True,
                          env=env, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.strip().splitlines()[-1].startswith("OK 200 ")
    assert done.stdout.strip().endswith("True")
