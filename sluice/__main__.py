"""Command line: run the claims job on a folder of raw files.

    python -m sluice claims --input IN --output OUT [--format csv] [--input-format csv]
                            [--batch-id ID] [--stage table|recompute|persist] [--digest md4]
                            [--config application.json] [--rules-dir DIR]

Reads ``IN/Contract.csv`` and ``IN/Claim.csv`` (files or folders), quarantines
invalid rows under ``OUT/invalid/<name>/batch_date=<id>`` and publishes
``OUT/TRANSACTIONS/batch_date=<id>``. Exit code 1 on any error. The session
comes from ``SparkSession.builder.getOrCreate()``, so master and settings are
whatever ``spark-submit`` or the defaults give.
"""

from __future__ import annotations

import argparse
import json
import logging
import posixpath
import sys

# Input file names of the claims job.
CONTRACT_FILE = "Contract.csv"
CLAIM_FILE = "Claim.csv"


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m sluice")
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("claims", help="contracts + claims -> transaction records")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--input-format", default="csv")
    p.add_argument("--format", default="csv")
    p.add_argument("--batch-id", default=None)
    p.add_argument("--stage", default="table", choices=["table", "recompute", "persist"])
    p.add_argument("--digest", default="md4")
    p.add_argument("--on-unknown", default="quarantine", choices=["quarantine", "drop"])
    p.add_argument("--config", default=None,
                   help='application JSON: {"file_formats": {"input_format", "output_format"}, "csv_options": {...}}')
    p.add_argument("--rules-dir", default=None, help="folder with contract_validation.json and claim_validation.json")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    from pyspark.sql import SparkSession

    from .plans.claims import HEADER_ALIASES, RULES, claims_transform
    from .plans.job import run_job
    from .rules import TableRules
    from .sources.readers import csv_options_from_config, read_table

    config: dict = {}
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            config = json.load(f)
    formats = config.get("file_formats", {})
    input_format = formats.get("input_format", args.input_format)
    output_format = formats.get("output_format", args.format)
    read_opts = csv_options_from_config(config) if input_format.lower() == "csv" else {}
    rules = dict(RULES)
    if args.rules_dir:
        rules = {
            name: TableRules.from_json(posixpath.join(args.rules_dir, f"{name}_validation.json")).with_aliases(
                HEADER_ALIASES
            )
            for name in RULES
        }

    spark = SparkSession.builder.appName("sluice-claims").getOrCreate()
    try:
        sources = {
            "contract": read_table(spark, posixpath.join(args.input, CONTRACT_FILE), input_format, options=read_opts),
            "claim": read_table(spark, posixpath.join(args.input, CLAIM_FILE), input_format, options=read_opts),
        }
        result = run_job(
            spark,
            sources,
            rules,
            lambda valid: claims_transform(valid, digest=args.digest),
            output_base=args.output,
            fmt=output_format,
            batch_id=args.batch_id,
            stage=args.stage,
            on_unknown=args.on_unknown,
        )
        print(json.dumps({"batch_id": result.batch_id, "output": result.output_path,
                          "quality": result.quality, "published_rows": result.published_rows}))
        return 0
    except Exception as e:  # report and fail the run
        logging.getLogger("sluice").error("job failed: %s", e)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
