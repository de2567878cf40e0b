"""

Every query reads the given parquet tables (or tables Spark derives from
them) in full. Queries that exercise a sink write to a fresh folder under
the session's shared checkpoint directory and return the read-back frame.
"""

from __future__ import annotations

import logging
import os
import posixpath
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.functions.columns import map_prefix, map_values, parse_date, parse_timestamp, strip_cast  # noqa: E402
from sluice.functions.digest import digest  # noqa: E402
from sluice.operators.enrich import Retry, distinct_keys, enrich_by_key  # noqa: E402
from sluice.operators.header import conform_header  # noqa: E402
from sluice.operators.joins import SkewSalt, lookup_join  # noqa: E402
from sluice.operators.keys import foreign_key, reject_duplicates, reject_orphans  # noqa: E402
from sluice.operators.validate import (  # noqa: E402
    annotate,
    column_verdict,
    failure_combinations,
    quality_report,
    split_annotated,
    validate,
)
from sluice.plans import claims as C  # noqa: E402
from sluice.plans.fixtures import (  # noqa: E402
    CLAIM_SOURCE_COLUMNS,
    CONTRACT_SOURCE_COLUMNS,
    ClaimDigestService,
    no_wait,
    raw_claim,
    raw_claim_by_order,
    raw_contract,
)
from sluice.plans.job import run_job  # noqa: E402
from sluice.rules import TableRules  # noqa: E402
from sluice.session import ship_package, shared_dir  # noqa: E402
from sluice.streaming.incremental import start_file_job, start_incremental_job  # noqa: E402
from sluice.sources.commits import read_committed  # noqa: E402
from sluice.sources.readers import read_by_name, read_table  # noqa: E402
from sluice.sources.sinks import (  # noqa: E402
    COMPRESSED_TEXT,
    TEXT_DATE_FORMAT,
    TEXT_TIMESTAMP_FORMAT,
    read_batches,
    write_batch,
    write_bucketed,
    write_quarantine,
    write_table,
)

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = "2024-01-01 00:00:00"
BATCH_ID = "20240101_000000"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)  # executors import the package for UDFs and resolvers
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _source(spark: SparkSession, sf: str, name: str, columns: list[str]) -> DataFrame:
    """The columns a derivation reads; its filters reach the parquet scan."""
    return _t(spark, sf, name).select(*columns)


def _contract(spark, sf):
    return raw_contract(_source(spark, sf, "orders", CONTRACT_SOURCE_COLUMNS))


def _claim(spark, sf):
    return raw_claim(_source(spark, sf, "lineitem", CLAIM_SOURCE_COLUMNS))


def _valid(spark, sf):
    return {
        "contract": validate(_contract(spark, sf), C.CONTRACT_RULES).valid,
        "claim": validate(_claim(spark, sf), C.CLAIM_RULES).valid,
    }


# ---------------------------------------------------------------- flagship


def q_claims_transactions(spark, sf, digest_algo="md5"):
    return C.claims_transform(_valid(spark, sf), digest=digest_algo, run_ts=RUN_TS)


def q_claims_transactions_md4(spark, sf):
    return q_claims_transactions(spark, sf, "md4")


def q_claims_job_csv(spark, sf):
    """The whole job as run on files: raw CSV in (with the header
    misspellings), quarantine and result published as compressed
    CSV batches."""
    root = shared_dir(spark, "claims_job_csv")
    src = {"contract": posixpath.join(root, "in", "contract"), "claim": posixpath.join(root, "in", "claim")}
    write_table(_contract(spark, sf), src["contract"], "csv")
    write_table(_claim(spark, sf), src["claim"], "csv")
    sources = {k: read_table(spark, p, "csv") for k, p in src.items()}
    out = posixpath.join(root, "out")
    run_job(
        spark,
        sources,
        C.RULES,
        lambda valid: C.claims_transform(valid, digest="md5", run_ts=RUN_TS),
        output_base=out,
        fmt="csv",
        batch_id=BATCH_ID,
        stage="table",
        write_options=COMPRESSED_TEXT,
    )
    return read_batches(spark, out, "TRANSACTIONS", "csv", batch_id=BATCH_ID)


def q_claims_job_persisted(spark, sf):
    """The job on the parquet-derived inputs with the annotated inputs held in
    executor memory/disk for both writes, published as a parquet batch."""
    out = shared_dir(spark, "claims_job_persisted")
    run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: C.claims_transform(valid, digest="md5", run_ts=RUN_TS),
        output_base=out,
        fmt="parquet",
        batch_id=BATCH_ID,
        stage="persist",
    )
    return read_batches(spark, out, "TRANSACTIONS", "parquet")


# Raw text files are read split, so a task's rows need not be bounded per file.
WHOLE_FILES = {"maxRecordsPerFile": "0"}


def _bucketed_contracts(spark, contract, table, path):
    """The keys of the valid contracts, stored so that no epoch's join moves them."""
    keys = ["SOURCE_SYSTEM", "CONTRACT_ID"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return write_bucketed(validate(contract, C.CONTRACT_RULES).valid.select(*keys), table, keys, buckets, path)


def q_claims_stream(spark, sf):
    """The job run incrementally: claim files are picked up by a file stream
    (two files per micro-batch), each micro-batch is validated, quarantined,
    joined to the valid contracts, which lie in buckets of the join key, and
    published as its own compressed batch."""
    root = shared_dir(spark, "claims_stream")
    claim_dir = posixpath.join(root, "in", "claim")
    write_table(_contract(spark, sf), posixpath.join(root, "in", "contract"), "csv")
    write_table(_claim(spark, sf), claim_dir, "csv", options=WHOLE_FILES)
    contract = read_table(spark, posixpath.join(root, "in", "contract"), "csv")
    # the static side is validated and shuffled once into a table, not once per micro-batch
    table = "contract_valid_" + posixpath.basename(root)
    valid_contract = _bucketed_contracts(spark, contract, table, posixpath.join(root, "contract_valid"))
    out = posixpath.join(root, "out")
    q = start_incremental_job(
        spark,
        claim_dir,
        C.CLAIM_RULES,
        lambda claims: C.claims_transform({"contract": valid_contract, "claim": claims}, digest="md5", run_ts=RUN_TS),
        output_base=out,
        output_name="TRANSACTIONS",
        checkpoint=posixpath.join(root, "checkpoint"),
        max_files_per_trigger=2,
        write_options=COMPRESSED_TEXT,
    )
    q.awaitTermination()
    spark.sql(f"DROP TABLE {table}")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return read_batches(spark, out, "TRANSACTIONS", "csv").drop("batch_date")


# ---------------------------------------------------------------- sources / sinks


def q_csv_roundtrip(spark, sf):
    path = shared_dir(spark, "csv_roundtrip")
    cust = _t(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(16,2)"))
    write_table(cust, path, "csv")
    return read_table(spark, path, "csv")


def q_csv_permissive_malformed(spark, sf):
    """Lines with a missing trailing field (null) or an extra field (dropped)."""
    path = shared_dir(spark, "csv_malformed")
    _malformed_lines(spark, sf, path)
    return read_table(spark, path, "csv")


def _malformed_lines(spark, sf, path):
    """Customers as CSV lines: every 7th lacks its last field, every 11th has one more."""
    cust = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    base = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string")]
    line = (
        F.when(k % 7 == 0, F.concat_ws(",", *base))
        .when(k % 11 == 0, F.concat_ws(",", *base, F.col("c_mktsegment"), F.lit("extra")))
        .otherwise(F.concat_ws(",", *base, F.col("c_mktsegment")))
    )
    header = "c_custkey,c_name,c_nationkey,c_mktsegment"
    cust.select(line.alias(header)).write.mode("overwrite").option("header", "true").option("sep", "\x01").csv(path)


CUSTOMER_RULES = TableRules.from_dict(
    "customer", {"c_custkey": {"required": True}, "c_name": {}, "c_nationkey": {"allowed_values": [str(n) for n in range(20)]}, "c_mktsegment": {}}
)


def q_csv_corrupt_evidence(spark, sf):
    path = shared_dir(spark, "csv_evidence")
    _malformed_lines(spark, sf, path)
    return read_table(spark, path, "csv", evidence=True)


def q_quarantine_evidence(spark, sf):
    """Malformed lines and rows of nations 20 and above, quarantined with reason and text."""
    path = shared_dir(spark, "csv_evidence")
    _malformed_lines(spark, sf, path)
    annotated = annotate(read_table(spark, path, "csv", evidence=True), CUSTOMER_RULES, reject_malformed=True)
    return split_annotated(annotated, CUSTOMER_RULES).invalid


def q_csv_by_name(spark, sf):
    """Contracts in files of three headers: another order, a misspelt name, a further column."""
    root = shared_dir(spark, "csv_by_name")
    rows = _contract(spark, sf).withColumnsRenamed({"INSUDRED_PERIOD_TO": "INSURED_PERIOD_TO"})
    part = F.pmod(F.xxhash64("CONTRACT_ID"), F.lit(3))
    write_table(rows.where(part == 0), posixpath.join(root, "a"), "csv")
    write_table(rows.where(part == 1).select(*reversed(rows.columns)).withColumnsRenamed({"INSURED_PERIOD_TO": "INSUDRED_PERIOD_TO"}), posixpath.join(root, "b"), "csv")
    write_table(rows.where(part == 2).withColumn("NOTE", F.lit("x")), posixpath.join(root, "c"), "csv")
    return read_by_name(spark, root, C.CONTRACT_RULES)


def q_failure_combinations(spark, sf):
    parts = [
        failure_combinations(annotate(df, rules, with_mask=True), rules).withColumn("table_name", F.lit(rules.name))
        for df, rules in ((_contract(spark, sf), C.CONTRACT_RULES), (_claim(spark, sf), C.CLAIM_RULES))
    ]
    return parts[0].unionByName(parts[1])


def q_job_failure_combinations(spark, sf):
    """The same counts as the job's own writes collect them."""
    result = run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: valid["contract"],
        output_base=shared_dir(spark, "job_failures"),
        fmt="parquet",
        batch_id=BATCH_ID,
        stage="table",
    )
    rows = [(name, ",".join(columns), n) for name, found in result.failures.items() for columns, n in found]
    return spark.createDataFrame(rows, "table_name string, failed_columns string, n_rows long")


def q_job_row_counts(spark, sf):
    """The row counts of a whole job, collected during its own writes."""
    result = run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: C.claims_transform(valid, digest="md5", run_ts=RUN_TS),
        output_base=shared_dir(spark, "job_counts"),
        fmt="parquet",
        batch_id=BATCH_ID,
    )
    rows = [(name, q["rows"], q["valid"], q["invalid"], q["unknown"]) for name, q in result.quality.items()]
    rows.append(("TRANSACTIONS", result.published_rows, result.published_rows, 0, 0))
    return spark.createDataFrame(rows, "table_name string, n_rows long, n_valid long, n_invalid long, n_unknown long")


def q_invalid_handler(spark, sf):
    """A job whose invalid rows go to a handler of the caller's, not to the quarantine."""
    path = shared_dir(spark, "invalid_handler")

    def handle(invalid):
        parts = [df.groupBy("validation_error").count().withColumn("table_name", F.lit(name)) for name, df in invalid.items()]
        write_table(parts[0].unionByName(parts[1]), posixpath.join(path, "handled"))

    run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: valid["contract"],
        output_base=posixpath.join(path, "out"),
        fmt="parquet",
        on_invalid=handle,
    )
    handled = read_table(spark, posixpath.join(path, "handled"), "parquet")
    return handled.select("table_name", "validation_error", F.col("count").alias("n_rows"))


def q_no_rule_passthrough(spark, sf):
    """Columns without a check: every row is valid, nulls and empty texts too."""
    rules = TableRules.from_dict("contract", {"CONTRACT_TYPE": {}, "CONTRACT_ID": {"description": "kept as it is"}})
    out = validate(_contract(spark, sf), rules)
    return out.valid.withColumn("side", F.lit("valid")).unionByName(out.invalid.drop("validation_error").withColumn("side", F.lit("invalid")))


def q_claims_job_committed(spark, sf):
    """Quarantine and result of the job, published at one commit."""
    out = shared_dir(spark, "claims_job_committed")
    run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: C.claims_transform(valid, digest="md5", run_ts=RUN_TS),
        output_base=out,
        fmt="parquet",
        batch_id=BATCH_ID,
        stage="table",
        commit=True,
    )
    result = read_committed(spark, out, "TRANSACTIONS").select(F.lit("result").alias("part"), F.col("NSE_ID").alias("what"), "batch_date")
    bad = read_committed(spark, out, "invalid/claim").select(F.lit("quarantine").alias("part"), F.col("validation_error").alias("what"), "batch_date")
    return result.unionByName(bad)


def q_claims_file_stream(spark, sf):
    """The job over files of two headers as they arrive, joined to contracts in
    buckets of the join key, each epoch's tables at one commit."""
    root = shared_dir(spark, "claims_file_stream")
    claims = _claim(spark, sf)
    misspelt = F.pmod(F.xxhash64("CLAIM_ID"), F.lit(2)) == 0
    src = posixpath.join(root, "in")
    renamed = claims.where(~misspelt).withColumnsRenamed({"CONTRAT_ID": "CONTRACT_ID"})
    write_table(claims.where(misspelt), src, "csv", options=WHOLE_FILES)
    write_table(renamed.select(*reversed(renamed.columns)), src, "csv", mode="append", options=WHOLE_FILES)
    table = "contracts_" + posixpath.basename(root)
    contracts = _bucketed_contracts(spark, _contract(spark, sf), table, posixpath.join(root, "contracts"))
    out = posixpath.join(root, "out")
    q = start_file_job(
        spark,
        src,
        C.CLAIM_RULES,
        lambda valid: C.claims_transform({"contract": contracts, "claim": valid}, digest="md5", run_ts=RUN_TS),
        output_base=out,
        output_name="TRANSACTIONS",
        checkpoint=posixpath.join(root, "checkpoint"),
        fmt="parquet",
        max_files_per_trigger=8,
    )
    q.awaitTermination()
    spark.sql(f"DROP TABLE {table}")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return read_committed(spark, out, "TRANSACTIONS").drop("batch_date")


def _roundtrip(fmt):
    def run(spark, sf):
        orders = _t(spark, sf, "orders")
        path = shared_dir(spark, f"{fmt}_roundtrip")
        write_table(orders, path, fmt)
        return read_table(spark, path, fmt, schema=orders.schema if fmt == "json" else None)

    return run


def q_batch_write_readback(spark, sf):
    base = shared_dir(spark, "batch_write")
    write_batch(q_claims_transactions(spark, sf), base, "TRANSACTIONS", BATCH_ID, "parquet")
    return read_batches(spark, base, "TRANSACTIONS", "parquet")


def q_json_batch_readback(spark, sf):
    """The result published as a JSON batch (null fields kept, fixed text
    formats for dates and timestamps, compressed) and read back with its schema."""
    base = shared_dir(spark, "json_batch")
    result = q_claims_transactions(spark, sf)
    write_batch(result, base, "TRANSACTIONS", BATCH_ID, "json", options=COMPRESSED_TEXT)
    schema = result.schema.add("batch_date", "string")
    opts = {"timestampFormat": TEXT_TIMESTAMP_FORMAT, "dateFormat": TEXT_DATE_FORMAT}
    return read_batches(spark, base, "TRANSACTIONS", "json", options=opts, schema=schema)


def q_quarantine_readback(spark, sf):
    base = shared_dir(spark, "quarantine")
    invalid = validate(_claim(spark, sf), C.CLAIM_RULES).invalid
    write_quarantine({"claim": invalid}, base, BATCH_ID, "csv")
    return read_batches(spark, posixpath.join(base, "invalid"), "claim", "csv")


# ---------------------------------------------------------------- header + rules


def q_header_alias_rename(spark, sf):
    return conform_header(_claim(spark, sf), C.CLAIM_RULES)


def _rule_query(table, key, column):
    def run(spark, sf):
        raw, rules = (_contract(spark, sf), C.CONTRACT_RULES) if table == "contract" else (_claim(spark, sf), C.CLAIM_RULES)
        df = conform_header(raw, rules)
        return df.select(key, column, column_verdict(rules[column]).alias("ok"))

    return run


def q_row_verdict_valid(spark, sf):
    return validate(_contract(spark, sf), C.CONTRACT_RULES).valid


def q_row_verdict_invalid(spark, sf):
    return validate(_contract(spark, sf), C.CONTRACT_RULES).invalid


def q_failed_columns_message(spark, sf):
    return validate(_claim(spark, sf), C.CLAIM_RULES).invalid.select("CLAIM_ID", "validation_error")


def q_quality_report(spark, sf):
    return quality_report(_contract(spark, sf), C.CONTRACT_RULES).unionByName(
        quality_report(_claim(spark, sf), C.CLAIM_RULES)
    )


def q_quality_report_drop(spark, sf):
    """Quality counts in parity mode: a NULL verdict is neither pass nor fail."""
    return quality_report(_contract(spark, sf), C.CONTRACT_RULES, on_unknown="drop").unionByName(
        quality_report(_claim(spark, sf), C.CLAIM_RULES, on_unknown="drop")
    )


def q_unknown_verdict_drop(spark, sf):
    v = validate(_claim(spark, sf), C.CLAIM_RULES, on_unknown="drop", cast=False)
    return v.valid.withColumn("split", F.lit("valid")).unionByName(
        v.invalid.drop("validation_error").withColumn("split", F.lit("invalid"))
    )


def q_conform_types(spark, sf):
    return validate(_claim(spark, sf), C.CLAIM_RULES).valid


# ---------------------------------------------------------------- declared keys


def q_key_uniqueness(spark, sf):
    """Claims with repeated ids, one of them on a third of all rows."""
    claims = raw_claim_by_order(_source(spark, sf, "lineitem", CLAIM_SOURCE_COLUMNS))
    checked = reject_duplicates(annotate(claims, C.CLAIM_RULES), C.CLAIM_RULES, broadcast_keys=100, hot_rows=50)
    return checked.select("CLAIM_ID", "CONTRACT_ID", "AMOUNT", "is_valid", "validation_error")


def q_foreign_key_presence(spark, sf):
    contracts = annotate(_contract(spark, sf), C.CONTRACT_RULES).where("is_valid")
    fk = foreign_key(C.CLAIM_RULES, C.CONTRACT_RULES)
    checked = reject_orphans(annotate(_claim(spark, sf), C.CLAIM_RULES), contracts, fk)
    return checked.select("CLAIM_ID", "CONTRACT_SOURCE_SYSTEM", "CONTRACT_ID", "is_valid", "validation_error")


def q_claims_job_keys(spark, sf):
    """The job with its declared keys checked."""
    out = shared_dir(spark, "claims_job_keys")
    run_job(
        spark,
        {"contract": _contract(spark, sf), "claim": _claim(spark, sf)},
        C.RULES,
        lambda valid: C.claims_transform(valid, digest="md5", run_ts=RUN_TS),
        output_base=out,
        fmt="parquet",
        batch_id=BATCH_ID,
        stage="table",
        unique=["contract", "claim"],
        references={"claim": [foreign_key(C.CLAIM_RULES, C.CONTRACT_RULES)]},
    )
    return read_batches(spark, out, "TRANSACTIONS", "parquet")


# ---------------------------------------------------------------- joins, keys, enrichment


def q_claim_contract_left_join(spark, sf):
    v = _valid(spark, sf)
    return C.join_claims_to_contracts(v["contract"], v["claim"])


def q_claim_contract_salted_join(spark, sf):
    v = _valid(spark, sf)
    return C.join_claims_to_contracts(v["contract"], v["claim"], skew=SkewSalt(buckets=4, min_rows=5))


def q_lookup_default(spark, sf):
    nation = _t(spark, sf, "nation")
    lookup = nation.where(F.col("n_regionkey") != 3).select(
        "n_nationkey", F.when(F.col("n_regionkey") == 1, F.lit("")).otherwise(F.col("n_name")).alias("n_name")
    )
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup_join(cust, lookup, "c_nationkey", "n_nationkey", "n_name", "nation_name", default="UNKNOWN")


def q_distinct_keys(spark, sf):
    return distinct_keys(_claim(spark, sf), "CLAIM_ID")


def q_enrich_by_key(spark, sf):
    claims = _claim(spark, sf).select("CLAIM_ID")
    retry = Retry(max_attempts=3, backoff=2.0, retry_on=(TimeoutError,), sleep=no_wait)
    return enrich_by_key(claims, "CLAIM_ID", ClaimDigestService(), "NSE_ID", default=C.UNKNOWN_ID, retry=retry)


def _digest_query(algo):
    def run(spark, sf):
        return _t(spark, sf, "documents").select("doc_id", digest("text", algo).alias(f"text_{algo}"))

    return run


# ---------------------------------------------------------------- scalar functions


def q_strip_prefix_cast(spark, sf):
    return _claim(spark, sf).select("CLAIM_ID", strip_cast("CLAIM_ID", C.ID_PREFIX_PATTERN, "int").alias("SOURCE_SYSTEM_ID"))


def q_map_values(spark, sf):
    status = {"F": "Fulfilled", "O": "Open", "P": "Partial"}
    return _t(spark, sf, "orders").select(
        "o_orderkey", map_values("o_orderstatus", status, "Unknown").alias("status_name")
    )


def q_map_prefix(spark, sf):
    prefixes = [("STANDARD", "S"), ("PROMO", "P"), ("ECONOMY", "E")]
    return _t(spark, sf, "part").select("p_partkey", map_prefix("p_type", prefixes).alias("type_class"))


def q_parse_dates(spark, sf):
    return _contract(spark, sf).select(
        "CONTRACT_ID",
        parse_date("INSURED_PERIOD_FROM", C.DATE_FORMAT).alias("PERIOD_FROM"),
        parse_date("INSUDRED_PERIOD_TO", C.DATE_FORMAT).alias("PERIOD_TO"),
        parse_timestamp("CREATION_DATE", C.TIMESTAMP_FORMAT).alias("CREATED_AT"),
    )


def q_constant_and_projection(spark, sf):
    return (
        _claim(spark, sf)
        .withColumnsRenamed({"CREATION_DATE": "claim_created", "CONTRAT_ID": "claimed_contract"})
        .select(
            F.lit(C.SOURCE_SYSTEM_LABEL).alias("CONTRACT_SOURCE_SYSTEM"),
            "CLAIM_ID",
            "claimed_contract",
            "claim_created",
        )
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "claims_transactions": q_claims_transactions,
    "claims_transactions_md4": q_claims_transactions_md4,
    "claims_job_csv": q_claims_job_csv,
    "claims_job_persisted": q_claims_job_persisted,
    "claims_stream": q_claims_stream,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_permissive_malformed": q_csv_permissive_malformed,
    "csv_corrupt_evidence": q_csv_corrupt_evidence,
    "quarantine_evidence": q_quarantine_evidence,
    "csv_by_name": q_csv_by_name,
    "failure_combinations": q_failure_combinations,
    "job_failure_combinations": q_job_failure_combinations,
    "job_row_counts": q_job_row_counts,
    "invalid_handler": q_invalid_handler,
    "no_rule_passthrough": q_no_rule_passthrough,
    "claims_job_committed": q_claims_job_committed,
    "claims_file_stream": q_claims_file_stream,
    "json_roundtrip": _roundtrip("json"),
    "orc_roundtrip": _roundtrip("orc"),
    "parquet_roundtrip": _roundtrip("parquet"),
    "batch_write_readback": q_batch_write_readback,
    "json_batch_readback": q_json_batch_readback,
    "quarantine_readback": q_quarantine_readback,
    "header_alias_rename": q_header_alias_rename,
    "rule_required": _rule_query("contract", "CONTRACT_ID", "SOURCE_SYSTEM"),
    "rule_regex": _rule_query("claim", "CLAIM_ID", "AMOUNT"),
    "rule_allowed_values": _rule_query("claim", "CLAIM_ID", "CLAIM_TYPE"),
    "rule_date": _rule_query("contract", "CONTRACT_ID", "INSURED_PERIOD_TO"),
    "rule_timestamp": _rule_query("claim", "CLAIM_ID", "CREATION_DATE"),
    "rule_optional_bypass": _rule_query("contract", "CONTRACT_ID", "CONTRACT_TYPE"),
    "row_verdict_valid": q_row_verdict_valid,
    "row_verdict_invalid": q_row_verdict_invalid,
    "failed_columns_message": q_failed_columns_message,
    "quality_report": q_quality_report,
    "quality_report_drop": q_quality_report_drop,
    "unknown_verdict_drop": q_unknown_verdict_drop,
    "conform_types": q_conform_types,
    "key_uniqueness": q_key_uniqueness,
    "foreign_key_presence": q_foreign_key_presence,
    "claims_job_keys": q_claims_job_keys,
    "claim_contract_left_join": q_claim_contract_left_join,
    "claim_contract_salted_join": q_claim_contract_salted_join,
    "lookup_default": q_lookup_default,
    "distinct_keys": q_distinct_keys,
    "enrich_by_key": q_enrich_by_key,
    "digest_md5": _digest_query("md5"),
    "digest_sha256": _digest_query("sha256"),
    "digest_md4": _digest_query("md4"),
    "strip_prefix_cast": q_strip_prefix_cast,
    "map_values": q_map_values,
    "map_prefix": q_map_prefix,
    "parse_dates": q_parse_dates,
    "constant_and_projection": q_constant_and_projection,
}


def _training_data():
    """Queries and oracles of the training-data subpackage and its pipeline, if they are there."""
    try:
        import corpus_pipeline
        from sluice.llm.queries import ORACLE_SQL, QUERIES
    except ImportError as e:
        # the folders may be gone, or a library that only they need
        logging.getLogger(__name__).warning("training-data queries left out: %s", e)
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, ORACLE_SQL | pipeline_sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: claims -> transaction records, MD4 surrogate ids."""
    return q_claims_transactions(spark, SMOKE_DIR, "md4")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _training_data()[0]


# ================================================================ oracle SQL (DuckDB)

_RAW_CTES = """
raw_contract AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE concat('SYS_', CAST(o_orderkey % 3 AS VARCHAR)) END AS SOURCE_SYSTEM,
    CASE WHEN o_orderkey % 89 = 0 THEN concat('abc', CAST(o_orderkey AS VARCHAR)) ELSE CAST(o_orderkey AS VARCHAR) END AS CONTRACT_ID,
    CASE WHEN o_orderkey % 83 = 0 THEN 'Other' WHEN o_orderkey % 4 = 0 THEN 'Direct'
         WHEN o_orderkey % 4 = 1 THEN 'Reinsurance' WHEN o_orderkey % 4 = 2 THEN '' ELSE NULL END AS CONTRACT_TYPE,
    strftime(o_orderdate, '%d.%m.%Y') AS INSURED_PERIOD_FROM,
    CASE WHEN o_orderkey % 79 = 0 THEN '31.02.2020' ELSE '01.01.2099' END AS INSUDRED_PERIOD_TO,
    strftime(o_orderdate, '%d.%m.%Y %H:%M') AS CREATION_DATE
  FROM orders
),
raw_claim AS (
  SELECT
    'CLM' AS SOURCE_SYSTEM,
    concat(CASE WHEN l_returnflag = 'R' THEN 'RX' WHEN l_returnflag = 'A' THEN 'CL' ELSE 'CX' END, '_',
           CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)) AS CLAIM_ID,
    CASE WHEN l_orderkey % 11 = 0 THEN 'SYS_9' ELSE concat('SYS_', CAST(l_orderkey % 3 AS VARCHAR)) END AS CONTRACT_SOURCE_SYSTEM,
    CAST(l_orderkey AS VARCHAR) AS CONTRAT_ID,
    CASE WHEN (l_orderkey + l_linenumber) % 61 = 0 THEN '3' WHEN l_linenumber % 4 = 0 THEN NULL
         WHEN l_linenumber % 4 = 3 THEN '' ELSE CAST(l_linenumber % 4 AS VARCHAR) END AS CLAIM_TYPE,
    strftime(l_shipdate, '%d.%m.%Y') AS DATE_OF_LOSS,
    CASE WHEN (l_partkey + l_linenumber) % 53 = 0 THEN '-5'
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) END AS AMOUNT,
    strftime(l_shipdate, '%d.%m.%Y %H:%M') AS CREATION_DATE
  FROM lineitem
),
contract_named AS (
  SELECT SOURCE_SYSTEM, CONTRACT_ID, CONTRACT_TYPE, INSURED_PERIOD_FROM,
         INSUDRED_PERIOD_TO AS INSURED_PERIOD_TO, CREATION_DATE
  FROM raw_contract
),
claim_named AS (
  SELECT SOURCE_SYSTEM, CLAIM_ID, CONTRACT_SOURCE_SYSTEM, CONTRAT_ID AS CONTRACT_ID, CLAIM_TYPE,
         DATE_OF_LOSS, AMOUNT, CREATION_DATE
  FROM raw_claim
)"""

# The claims rules as DuckDB predicates, written out here and not derived from the package's rule tables.
_CONTRACT_SPECS = {
    "SOURCE_SYSTEM": "SOURCE_SYSTEM IS NOT NULL AND SOURCE_SYSTEM <> ''",
    "CONTRACT_ID": "CONTRACT_ID IS NOT NULL AND CONTRACT_ID <> '' AND regexp_matches(CONTRACT_ID, '^[0-9]+$')",
    "CONTRACT_TYPE": "CONTRACT_TYPE IN ('Direct', 'Reinsurance', NULL, '') OR CONTRACT_TYPE IS NULL OR CONTRACT_TYPE = ''",
    "INSURED_PERIOD_FROM": "INSURED_PERIOD_FROM IS NOT NULL AND try_strptime(INSURED_PERIOD_FROM, '%d.%m.%Y') IS NOT NULL",
    "INSURED_PERIOD_TO": "INSURED_PERIOD_TO IS NOT NULL AND try_strptime(INSURED_PERIOD_TO, '%d.%m.%Y') IS NOT NULL",
    "CREATION_DATE": "CREATION_DATE IS NOT NULL AND try_strptime(CREATION_DATE, '%d.%m.%Y %H:%M') IS NOT NULL",
}
_CLAIM_SPECS = {
    "SOURCE_SYSTEM": "SOURCE_SYSTEM IS NOT NULL AND SOURCE_SYSTEM <> ''",
    "CLAIM_ID": "CLAIM_ID IS NOT NULL AND CLAIM_ID <> '' AND regexp_matches(CLAIM_ID, '^[A-Z]+_[0-9]+$')",
    "CONTRACT_SOURCE_SYSTEM": "CONTRACT_SOURCE_SYSTEM IS NOT NULL AND CONTRACT_SOURCE_SYSTEM <> ''",
    "CONTRACT_ID": "CONTRACT_ID IS NOT NULL AND CONTRACT_ID <> '' AND regexp_matches(CONTRACT_ID, '^[0-9]+$')",
    "CLAIM_TYPE": "CLAIM_TYPE IN ('1', '2', NULL, '') OR CLAIM_TYPE IS NULL OR CLAIM_TYPE = ''",
    "DATE_OF_LOSS": "DATE_OF_LOSS IS NOT NULL AND try_strptime(DATE_OF_LOSS, '%d.%m.%Y') IS NOT NULL",
    "AMOUNT": r"AMOUNT IS NOT NULL AND AMOUNT <> '' AND regexp_matches(AMOUNT, '^[0-9]+\.?[0-9]*$')",
    "CREATION_DATE": "CREATION_DATE IS NOT NULL AND try_strptime(CREATION_DATE, '%d.%m.%Y %H:%M') IS NOT NULL",
}


def _checked_cte(name: str, source: str, specs: dict, three_valued: bool = False) -> str:
    cols = ",\n    ".join(f"({s}) AS v_{c}" if three_valued else f"coalesce({s}, FALSE) AS v_{c}" for c, s in specs.items())
    allv = " AND ".join(f"v_{c}" for c in specs)
    return f"""{name}_checked AS (
  SELECT *,
    {cols}
  FROM {source}
),
{name}_flag AS (SELECT *, ({allv}) AS v_row FROM {name}_checked)"""


def _message_sql(specs: dict) -> str:
    parts = ", ".join(f"CASE WHEN NOT v_{c} THEN '{c}' END" for c in specs)
    return (
        f"CASE WHEN concat_ws(', ', {parts}) <> '' "
        f"THEN concat('Failed columns: ', concat_ws(', ', {parts})) ELSE 'Validation failed' END"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


_BASE = _with(
    _RAW_CTES.strip(),
    _checked_cte("contract", "contract_named", _CONTRACT_SPECS),
    _checked_cte("claim", "claim_named", _CLAIM_SPECS),
    """contract_valid AS (SELECT SOURCE_SYSTEM, TRY_CAST(CONTRACT_ID AS BIGINT) AS CONTRACT_ID, CONTRACT_TYPE,
       INSURED_PERIOD_FROM, INSURED_PERIOD_TO, CREATION_DATE FROM contract_flag WHERE v_row)""",
    """claim_valid AS (SELECT SOURCE_SYSTEM, CLAIM_ID, CONTRACT_SOURCE_SYSTEM, TRY_CAST(CONTRACT_ID AS BIGINT) AS CONTRACT_ID,
       TRY_CAST(CLAIM_TYPE AS INTEGER) AS CLAIM_TYPE, DATE_OF_LOSS, TRY_CAST(AMOUNT AS DECIMAL(16,5)) AS AMOUNT,
       CREATION_DATE FROM claim_flag WHERE v_row)""",
    """joined AS (
  SELECT c.SOURCE_SYSTEM, c.CLAIM_ID, c.CONTRACT_SOURCE_SYSTEM, c.CONTRACT_ID AS claimed_contract,
         c.CLAIM_TYPE, c.DATE_OF_LOSS, c.AMOUNT, c.CREATION_DATE AS claim_created,
         k.CONTRACT_ID AS matched_contract, k.CREATION_DATE AS contract_created
  FROM claim_valid c LEFT JOIN contract_valid k
    ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
)""",
    f"""transactions AS (
  SELECT 'Europe 3' AS CONTRACT_SOURCE_SYSTEM,
         matched_contract AS CONTRACT_SOURCE_SYSTEM_ID,
         TRY_CAST(regexp_replace(CLAIM_ID, '^[A-Za-z_]+', '') AS INTEGER) AS SOURCE_SYSTEM_ID,
         CASE CLAIM_TYPE WHEN 1 THEN 'Private' WHEN 2 THEN 'Corporate' ELSE 'Unknown' END AS TRANSACTION_TYPE,
         CASE WHEN CLAIM_ID LIKE 'CL%' THEN 'COINSURANCE' WHEN CLAIM_ID LIKE 'RX%' THEN 'REINSURANCE' END AS TRANSACTION_DIRECTION,
         CAST(AMOUNT AS DECIMAL(16,5)) AS CONFORMED_VALUE,
         CAST(try_strptime(DATE_OF_LOSS, '%d.%m.%Y') AS DATE) AS BUSINESS_DATE,
         try_strptime(claim_created, '%d.%m.%Y %H:%M') AS CREATION_DATE,
         TIMESTAMP '{RUN_TS}' AS SYSTEM_TIMESTAMP,
         CASE WHEN CLAIM_ID IS NULL OR CLAIM_ID = '' THEN 'UNKNOWN_HASH' ELSE md5(CLAIM_ID) END AS NSE_ID
  FROM joined
)""",
)


_UNIQUE_BASE = _BASE
for _table, _key in (("contract", "CONTRACT_ID"), ("claim", "CLAIM_ID")):
    _UNIQUE_BASE = _UNIQUE_BASE.replace(
        f"FROM {_table}_flag WHERE v_row)",
        f"FROM {_table}_flag WHERE v_row QUALIFY count(*) OVER (PARTITION BY {_table}_flag.SOURCE_SYSTEM, {_table}_flag.{_key}) = 1)",
    )


def _md4_sql(source: str, column: str) -> str:
    """Distinct texts of at most 55 ASCII bytes with their MD4: one 64-byte block, a subquery for each of the 48 steps."""
    words = ", ".join(
        "CAST('0x' || " + " || ".join(f"substr(h, {8 * w + 2 * k + 1}, 2)" for k in (3, 2, 1, 0)) + f" AS BIGINT) AS x{w}"
        for w in range(16)
    )
    padded = "rpad(hex(encode(t)) || '80', 112, '0') || printf('%02X%02X000000000000', 8 * length(t) % 256, 8 * length(t) // 256)"
    # fixed values of RFC 1320
    start = "1732584193 AS a, 4023233417 AS b, 2562383102 AS c, 271733878 AS d"
    rounds = (
        ("((b & c) | ((4294967295 - b) & d))", 0, (3, 7, 11, 19), (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)),
        ("((b & c) | (b & d) | (c & d))", 1518500249, (3, 5, 9, 13), (0, 4, 8, 12, 1, 5, 9, 13, 2, 6, 10, 14, 3, 7, 11, 15)),
        ("xor(b, xor(c, d))", 1859775393, (3, 9, 11, 15), (0, 8, 4, 12, 2, 10, 6, 14, 1, 9, 5, 13, 3, 11, 7, 15)),
    )
    sql = f"""md4_0 AS MATERIALIZED (SELECT t, {words}, {start}
  FROM (SELECT t, {padded} AS h FROM (SELECT DISTINCT {column} AS t FROM {source} WHERE {column} <> '')))"""
    step = 0
    for f, const, shifts, order in rounds:
        for i, w in enumerate(order):
            s = shifts[i % 4]
            sql += f""",
md4_{step + 1} AS MATERIALIZED (SELECT * EXCLUDE (a, b, c, d, v), d AS a, ((v << {s}) | (v >> {32 - s})) & 4294967295 AS b, b AS c, c AS d
  FROM (SELECT *, (a + {f} + x{w} + {const}) & 4294967295 AS v FROM md4_{step}))"""
            step += 1
    sums = zip("abcd", (1732584193, 4023233417, 2562383102, 271733878), strict=True)
    hexes = [f"printf('%08x', ({r} + {v}) & 4294967295)" for r, v in sums]
    digest = " || ".join(f"substr({h}, {k}, 2)" for h in hexes for k in (7, 5, 3, 1))
    return f"{sql},\nmd4 AS (SELECT t, {digest} AS digest FROM md4_{step})"


_TS_TEXT = "%Y-%m-%dT%H:%M:%S.%gZ"


def _quality_sql(table: str, specs: dict) -> str:
    rows = []
    names = list(specs) + ["__row__"]
    for i, c in enumerate(names):
        v = "v_row" if c == "__row__" else f"v_{c}"
        rows.append(
            f"SELECT '{table}' AS table_name, {i} AS ordinal, '{c}' AS column_name, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE NOT {v}) AS n_failed, "
            f"count(*) FILTER (WHERE NOT {v}) / count(*) AS failed_rate FROM {table}_flag"
        )
    return "\nUNION ALL\n".join(rows)


def _rule_oracle(table: str, key: str, column: str) -> str:
    return f"{_BASE}\nSELECT {key}, {column}, v_{column} AS ok FROM {table}_checked"


def _combinations_sql() -> str:
    def one(table: str, specs: dict) -> str:
        names = ", ".join(f"CASE WHEN NOT v_{c} THEN '{c}' END" for c in specs)
        return f"SELECT '{table}' AS table_name, concat_ws(',', {names}) AS failed_columns, count(*) AS n_rows FROM {table}_flag GROUP BY 1, 2"

    return f"{_BASE}\n{one('contract', _CONTRACT_SPECS)}\nUNION ALL\n{one('claim', _CLAIM_SPECS)}"


_LINES = """WITH lines AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
         CASE WHEN c_custkey % 7 = 0 THEN concat_ws(',', c_custkey, c_name, c_nationkey)
              WHEN c_custkey % 11 = 0 THEN concat_ws(',', c_custkey, c_name, c_nationkey, c_mktsegment, 'extra') END AS raw_record
  FROM customer
)"""
_CLAIM_COLS = ", ".join(_CLAIM_SPECS)
_CONTRACT_COLS = ", ".join(_CONTRACT_SPECS)
_DROP_BASE = _with(
    _RAW_CTES.strip(),
    _checked_cte("claim", "claim_named", _CLAIM_SPECS, three_valued=True),
)
_DROP_BOTH = _with(
    _RAW_CTES.strip(),
    _checked_cte("contract", "contract_named", _CONTRACT_SPECS, three_valued=True),
    _checked_cte("claim", "claim_named", _CLAIM_SPECS, three_valued=True),
)

_ORACLE = {
    "claims_transactions": f"{_BASE}\nSELECT * FROM transactions",
    "claims_transactions_md4": f"""{_BASE},
named AS (SELECT DISTINCT CLAIM_ID, md5(CLAIM_ID) AS other FROM joined),
{_md4_sql("named", "CLAIM_ID")}
SELECT transactions.* EXCLUDE (NSE_ID), coalesce(digest, NSE_ID) AS NSE_ID
FROM transactions LEFT JOIN named ON NSE_ID = other LEFT JOIN md4 ON t = CLAIM_ID""",
    "claims_job_csv": f"""{_BASE}
SELECT CONTRACT_SOURCE_SYSTEM,
       CAST(CONTRACT_SOURCE_SYSTEM_ID AS VARCHAR) AS CONTRACT_SOURCE_SYSTEM_ID,
       CAST(SOURCE_SYSTEM_ID AS VARCHAR) AS SOURCE_SYSTEM_ID,
       TRANSACTION_TYPE, TRANSACTION_DIRECTION,
       CAST(CONFORMED_VALUE AS VARCHAR) AS CONFORMED_VALUE,
       strftime(BUSINESS_DATE, '%Y-%m-%d') AS BUSINESS_DATE,
       strftime(CREATION_DATE, '{_TS_TEXT}') AS CREATION_DATE,
       strftime(SYSTEM_TIMESTAMP, '{_TS_TEXT}') AS SYSTEM_TIMESTAMP,
       NSE_ID, '{BATCH_ID}' AS batch_date
FROM transactions""",
    "claims_job_persisted": f"{_BASE}\nSELECT *, '{BATCH_ID}' AS batch_date FROM transactions",
    "claims_stream": f"""{_BASE}
SELECT CONTRACT_SOURCE_SYSTEM,
       CAST(CONTRACT_SOURCE_SYSTEM_ID AS VARCHAR) AS CONTRACT_SOURCE_SYSTEM_ID,
       CAST(SOURCE_SYSTEM_ID AS VARCHAR) AS SOURCE_SYSTEM_ID,
       TRANSACTION_TYPE, TRANSACTION_DIRECTION,
       CAST(CONFORMED_VALUE AS VARCHAR) AS CONFORMED_VALUE,
       strftime(BUSINESS_DATE, '%Y-%m-%d') AS BUSINESS_DATE,
       strftime(CREATION_DATE, '{_TS_TEXT}') AS CREATION_DATE,
       strftime(SYSTEM_TIMESTAMP, '{_TS_TEXT}') AS SYSTEM_TIMESTAMP,
       NSE_ID
FROM transactions""",
    "csv_roundtrip": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_permissive_malformed": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "csv_corrupt_evidence": f"{_LINES}\nSELECT c_custkey, c_name, c_nationkey, c_mktsegment, raw_record FROM lines",
    "quarantine_evidence": f"""{_LINES}
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, raw_record,
       concat_ws('; ', CASE WHEN CAST(c_nationkey AS INTEGER) > 19 THEN 'Failed columns: c_nationkey' END,
                       CASE WHEN raw_record IS NOT NULL THEN 'Malformed record' END) AS validation_error
FROM lines WHERE raw_record IS NOT NULL OR CAST(c_nationkey AS INTEGER) > 19""",
    "csv_by_name": f"""{_BASE}
SELECT {", ".join(f"NULLIF({c}, '') AS {c}" for c in _CONTRACT_SPECS)} FROM contract_named""",
    "failure_combinations": _combinations_sql(),
    "job_failure_combinations": f"SELECT * FROM ({_combinations_sql()}) WHERE failed_columns <> ''",
    "job_row_counts": f"""{_BASE}
SELECT 'contract' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE v_row) AS n_valid,
       count(*) FILTER (WHERE NOT v_row) AS n_invalid, 0 AS n_unknown FROM contract_flag
UNION ALL
SELECT 'claim', count(*), count(*) FILTER (WHERE v_row), count(*) FILTER (WHERE NOT v_row), 0 FROM claim_flag
UNION ALL
SELECT 'TRANSACTIONS', count(*), count(*), 0, 0 FROM transactions""",
    "invalid_handler": f"""{_BASE}
SELECT 'contract' AS table_name, {_message_sql(_CONTRACT_SPECS)} AS validation_error, count(*) AS n_rows
FROM contract_flag WHERE NOT v_row GROUP BY 2
UNION ALL
SELECT 'claim', {_message_sql(_CLAIM_SPECS)}, count(*) FROM claim_flag WHERE NOT v_row GROUP BY 2""",
    "no_rule_passthrough": f"{_BASE}\nSELECT CONTRACT_TYPE, CONTRACT_ID, 'valid' AS side FROM contract_named",
    "claims_job_committed": f"""{_BASE}
SELECT 'result' AS part, NSE_ID AS what, '{BATCH_ID}' AS batch_date FROM transactions
UNION ALL
SELECT 'quarantine', {_message_sql(_CLAIM_SPECS)}, '{BATCH_ID}' FROM claim_flag WHERE NOT v_row""",
    "claims_file_stream": f"{_BASE}\nSELECT * FROM transactions",
    "json_roundtrip": "SELECT * FROM orders",
    "orc_roundtrip": "SELECT * FROM orders",
    "parquet_roundtrip": "SELECT * FROM orders",
    "batch_write_readback": f"{_BASE}\nSELECT *, '{BATCH_ID}' AS batch_date FROM transactions",
    "json_batch_readback": f"{_BASE}\nSELECT *, '{BATCH_ID}' AS batch_date FROM transactions",
    "quarantine_readback": f"""{_BASE}
SELECT {", ".join(f"NULLIF({c}, '') AS {c}" for c in _CLAIM_SPECS)},
       {_message_sql(_CLAIM_SPECS)} AS validation_error, '{BATCH_ID}' AS batch_date
FROM claim_flag WHERE NOT v_row""",
    "header_alias_rename": f"{_BASE}\nSELECT {_CLAIM_COLS} FROM claim_named",
    "rule_required": _rule_oracle("contract", "CONTRACT_ID", "SOURCE_SYSTEM"),
    "rule_regex": _rule_oracle("claim", "CLAIM_ID", "AMOUNT"),
    "rule_allowed_values": _rule_oracle("claim", "CLAIM_ID", "CLAIM_TYPE"),
    "rule_date": _rule_oracle("contract", "CONTRACT_ID", "INSURED_PERIOD_TO"),
    "rule_timestamp": _rule_oracle("claim", "CLAIM_ID", "CREATION_DATE"),
    "rule_optional_bypass": _rule_oracle("contract", "CONTRACT_ID", "CONTRACT_TYPE"),
    "row_verdict_valid": f"{_BASE}\nSELECT * FROM contract_valid",
    "row_verdict_invalid": f"""{_BASE}
SELECT {_CONTRACT_COLS}, {_message_sql(_CONTRACT_SPECS)} AS validation_error FROM contract_flag WHERE NOT v_row""",
    "failed_columns_message": f"""{_BASE}
SELECT CLAIM_ID, {_message_sql(_CLAIM_SPECS)} AS validation_error FROM claim_flag WHERE NOT v_row""",
    "quality_report": f"{_BASE}\n{_quality_sql('contract', _CONTRACT_SPECS)}\nUNION ALL\n{_quality_sql('claim', _CLAIM_SPECS)}",
    "quality_report_drop": f"{_DROP_BOTH}\n{_quality_sql('contract', _CONTRACT_SPECS)}\nUNION ALL\n{_quality_sql('claim', _CLAIM_SPECS)}",
    "unknown_verdict_drop": f"""{_DROP_BASE}
SELECT {_CLAIM_COLS}, 'valid' AS split FROM claim_flag WHERE v_row
UNION ALL
SELECT {_CLAIM_COLS}, 'invalid' AS split FROM claim_flag WHERE NOT v_row""",
    "conform_types": f"{_BASE}\nSELECT * FROM claim_valid",
    "key_uniqueness": f"""{_BASE},
by_order AS (
  SELECT * REPLACE (CASE WHEN CAST(CONTRACT_ID AS BIGINT) % 3 = 0 THEN 'CX_0'
                    ELSE concat(substr(CLAIM_ID, 1, 2), '_', CONTRACT_ID) END AS CLAIM_ID)
  FROM claim_named
),
{_checked_cte("by_order", "by_order", _CLAIM_SPECS)},
counted AS (SELECT *, count(*) FILTER (WHERE v_row) OVER (PARTITION BY SOURCE_SYSTEM, CLAIM_ID) AS n FROM by_order_flag)
SELECT CLAIM_ID, CONTRACT_ID, AMOUNT, v_row AND n = 1 AS is_valid,
       CASE WHEN NOT v_row THEN {_message_sql(_CLAIM_SPECS)}
            WHEN n > 1 THEN 'Duplicate key: SOURCE_SYSTEM, CLAIM_ID' END AS validation_error
FROM counted""",
    "foreign_key_presence": f"""{_BASE},
found AS (
  SELECT c.*, EXISTS (SELECT 1 FROM contract_flag k WHERE k.v_row AND k.SOURCE_SYSTEM = c.CONTRACT_SOURCE_SYSTEM
                      AND k.CONTRACT_ID = c.CONTRACT_ID) AS has_parent
  FROM claim_flag c
)
SELECT CLAIM_ID, CONTRACT_SOURCE_SYSTEM, CONTRACT_ID, v_row AND has_parent AS is_valid,
       CASE WHEN NOT v_row THEN {_message_sql(_CLAIM_SPECS)}
            WHEN NOT has_parent THEN 'Missing parent: CONTRACT_SOURCE_SYSTEM, CONTRACT_ID in contract' END AS validation_error
FROM found""",
    "claims_job_keys": f"""{_UNIQUE_BASE}
SELECT *, '{BATCH_ID}' AS batch_date FROM transactions WHERE CONTRACT_SOURCE_SYSTEM_ID IS NOT NULL""",
    "claim_contract_left_join": f"{_BASE}\nSELECT * FROM joined",
    "claim_contract_salted_join": f"{_BASE}\nSELECT * FROM joined",
    "lookup_default": """SELECT c.c_custkey, c.c_nationkey,
       coalesce(NULLIF(CASE WHEN n.n_regionkey = 1 THEN '' ELSE n.n_name END, ''), 'UNKNOWN') AS nation_name
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) n ON c.c_nationkey = n.n_nationkey""",
    "distinct_keys": f"{_BASE}\nSELECT DISTINCT CLAIM_ID FROM raw_claim WHERE CLAIM_ID IS NOT NULL",
    "enrich_by_key": f"""{_BASE}
SELECT CLAIM_ID,
       CASE WHEN CAST(regexp_extract(CLAIM_ID, '[0-9]+$') AS BIGINT) % 7 = 0 THEN 'UNKNOWN_HASH'
            WHEN CAST(regexp_extract(CLAIM_ID, '[0-9]+$') AS BIGINT) % 11 = 0 THEN 'UNKNOWN_HASH'
            ELSE md5(CLAIM_ID) END AS NSE_ID
FROM raw_claim""",
    "digest_md5": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "digest_sha256": "SELECT doc_id, sha256(text) AS text_sha256 FROM documents",
    "strip_prefix_cast": f"""{_BASE}
SELECT CLAIM_ID, TRY_CAST(regexp_replace(CLAIM_ID, '^[A-Za-z_]+', '') AS INTEGER) AS SOURCE_SYSTEM_ID FROM raw_claim""",
    "map_values": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
       WHEN 'P' THEN 'Partial' ELSE 'Unknown' END AS status_name FROM orders""",
    "map_prefix": """SELECT p_partkey, CASE WHEN p_type LIKE 'STANDARD%' THEN 'S' WHEN p_type LIKE 'PROMO%' THEN 'P'
       WHEN p_type LIKE 'ECONOMY%' THEN 'E' END AS type_class FROM part""",
    "parse_dates": f"""{_BASE}
SELECT CONTRACT_ID,
       CAST(try_strptime(INSURED_PERIOD_FROM, '%d.%m.%Y') AS DATE) AS PERIOD_FROM,
       CAST(try_strptime(INSUDRED_PERIOD_TO, '%d.%m.%Y') AS DATE) AS PERIOD_TO,
       try_strptime(CREATION_DATE, '%d.%m.%Y %H:%M') AS CREATED_AT
FROM raw_contract""",
    "constant_and_projection": f"""{_BASE}
SELECT 'Europe 3' AS CONTRACT_SOURCE_SYSTEM, CLAIM_ID, CONTRAT_ID AS claimed_contract,
       CREATION_DATE AS claim_created FROM raw_claim""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query. digest_md4 has none (DuckDB has no MD4 and its texts
    are longer than a block); pytest checks it against RFC 1320 vectors."""
    return _ORACLE | _training_data()[1]
