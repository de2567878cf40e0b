"""Run the golden claims job while Python workers die on their first attempt.

    python tests/fault_job.py <workdir>

Used by tests/test_fault_tolerance.py in its own process (task retries need a
``local[n,maxFailures]`` master). Prints one JSON line.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from sluice.plans.claims import RULES, claims_transform  # noqa: E402
from sluice.plans.job import run_job  # noqa: E402
from sluice.sources.readers import read_table  # noqa: E402
from sluice.sources.sinks import read_batches  # noqa: E402


def main(work: str) -> None:
    spark = (
        SparkSession.builder.master("local[2,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    marker = os.path.join(work, "crashed")

    @F.pandas_udf(StringType())
    def crash_once(s: pd.Series) -> pd.Series:
        if not os.path.exists(marker):
            open(marker, "w").close()
            os._exit(1)  # the Python worker dies mid-task
        return s

    sources = {
        "contract": read_table(spark, os.path.join(work, "Contract.csv")),
        "claim": read_table(spark, os.path.join(work, "Claim.csv")),
    }

    def transform(valid):
        out = claims_transform(valid, run_ts="2024-01-01 00:00:00")
        return out.withColumn("NSE_ID", crash_once("NSE_ID"))

    res = run_job(spark, sources, RULES, transform, output_base=os.path.join(work, "out"), fmt="parquet",
                  batch_id="b1", stage="table")
    back = read_batches(spark, os.path.join(work, "out"), "TRANSACTIONS", "parquet")
    print(json.dumps({
        "crashed": os.path.exists(marker),
        "quality": res.quality,
        "published": res.published_rows,
        "ids": sorted(r.NSE_ID for r in back.collect()),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
