import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sluice.plans.claims import OUTPUT_COLUMNS, RULES, claims_transform
from sluice.plans.job import run_job
from sluice.sources.readers import read_table
from sluice.sources.sinks import read_batches

from .helpers import plan_text

# The sample inputs: UTF-8 with BOM, CRLF line ends, misspelled headers.
CONTRACT_CSV = (
    "﻿SOURCE_SYSTEM,CONTRACT_ID,CONTRACT_TYPE,INSURED_PERIOD_FROM,INSUDRED_PERIOD_TO,CREATION_DATE\r\n"
    "Contract_SR_Europa_3,408124123,Direct,01.01.2015,01.01.2099,17.01.2022 13:42\r\n"
    "Contract_SR_Europa_3,46784575,Direct,01.01.2015,01.01.2099,17.01.2022 13:42\r\n"
    "Contract_SR_Europa_3,97563756,,01.01.2015,01.01.2099,17.01.2022 13:42\r\n"
    "Contract_SR_Europa_3,13767503,Reinsurance,01.01.2015,01.01.2099,17.01.2022 13:42\r\n"
    "Contract_SR_Europa_3,656948536,,01.01.2015,01.01.2099,17.01.2022 13:42"
)
CLAIM_CSV = (
    "﻿SOURCE_SYSTEM,CLAIM_ID,CONTRACT_SOURCE_SYSTEM,CONTRAT_ID,CLAIM_TYPE,DATE_OF_LOSS,AMOUNT,CREATION_DATE\r\n"
    "Claim_SR_Europa_3,CL_68545123,Contract_SR_Europa_3,97563756,2,14.02.2021,523.21,17.01.2022 14:45\r\n"
    "Claim_SR_Europa_3,CL_962234,Contract_SR_Europa_4,408124123,1,30.01.2021,52369.0,17.01.2022 14:46\r\n"
    "Claim_SR_Europa_3,CL_895168,Contract_SR_Europa_3,13767503,,02.09.2020,98465,17.01.2022 14:45\r\n"
    "Claim_SR_Europa_3,CX_12066501,Contract_SR_Europa_3,656948536,2,04.01.2022,9000,17.01.2022 14:45\r\n"
    "Claim_SR_Europa_3,RX_9845163,Contract_SR_Europa_3,656948536,2,04.06.2015,11000,17.01.2022 14:45\r\n"
    "Claim_SR_Europa_3,CL_39904634,Contract_SR_Europa_3,656948536,2,04.11.2020,11000,17.01.2022 14:46\r\n"
    "Claim_SR_Europa_3,U_7065313,Contract_SR_Europa_3,46589516,1,29.09.2021,11000,17.01.2022 14:46"
)


def _ts(h, m):
    return dt.datetime(2022, 1, 17, h, m)


# (contract id, source id, type, direction, value, business date, creation, digest)
GOLDEN = {
    (97563756, 68545123, "Corporate", "COINSURANCE", Decimal("523.21000"), dt.date(2021, 2, 14), _ts(14, 45), "238cf61c3a7e1574bf12615d87697e45"),
    (None, 962234, "Private", "COINSURANCE", Decimal("52369.00000"), dt.date(2021, 1, 30), _ts(14, 46), "738f8bad9d69baf14f9264f8be6d821d"),
    (13767503, 895168, "Unknown", "COINSURANCE", Decimal("98465.00000"), dt.date(2020, 9, 2), _ts(14, 45), "01ffa3820d8f2d9421ca828a53be7449"),
    (656948536, 12066501, "Corporate", None, Decimal("9000.00000"), dt.date(2022, 1, 4), _ts(14, 45), "3be76cd7f9646dd9d79132c46b3dd603"),
    (656948536, 9845163, "Corporate", "REINSURANCE", Decimal("11000.00000"), dt.date(2015, 6, 4), _ts(14, 45), "96038ac921f5c5cc6405001d96760847"),
    (656948536, 39904634, "Corporate", "COINSURANCE", Decimal("11000.00000"), dt.date(2020, 11, 4), _ts(14, 46), "572deffbf618d7c3b5f3448eb9c5c4c1"),
    (None, 7065313, "Private", None, Decimal("11000.00000"), dt.date(2021, 9, 29), _ts(14, 46), "22e72db452e973fec96bd223cc67d213"),
}


def _inputs(spark, tmp_path):
    (tmp_path / "Contract.csv").write_bytes(CONTRACT_CSV.encode("utf-8"))
    (tmp_path / "Claim.csv").write_bytes(CLAIM_CSV.encode("utf-8"))
    return {
        "contract": read_table(spark, str(tmp_path / "Contract.csv"), "csv"),
        "claim": read_table(spark, str(tmp_path / "Claim.csv"), "csv"),
    }


def _rows(df):
    return {
        (r.CONTRACT_SOURCE_SYSTEM_ID, r.SOURCE_SYSTEM_ID, r.TRANSACTION_TYPE, r.TRANSACTION_DIRECTION,
         r.CONFORMED_VALUE, r.BUSINESS_DATE, r.CREATION_DATE, r.NSE_ID)
        for r in df.collect()
    }


def test_golden_sample_job(spark, tmp_path):
    out = str(tmp_path / "out")
    res = run_job(
        spark, _inputs(spark, tmp_path), RULES, lambda v: claims_transform(v, run_ts="2024-01-01 00:00:00"),
        output_base=out, fmt="parquet", batch_id="20240101_000000",
    )
    assert res.quality["contract"] == {"rows": 5, "valid": 5, "invalid": 0, "unknown": 0, "invalid_rate": 0.0}
    assert res.quality["claim"] == {"rows": 7, "valid": 7, "invalid": 0, "unknown": 0, "invalid_rate": 0.0}
    assert res.published_rows == 7
    back = read_batches(spark, out, "TRANSACTIONS", "parquet")
    assert back.columns == OUTPUT_COLUMNS + ["batch_date"]
    assert _rows(back) == GOLDEN
    assert {r.CONTRACT_SOURCE_SYSTEM for r in back.collect()} == {"Europe 3"}
    assert dict(back.dtypes) == {
        "CONTRACT_SOURCE_SYSTEM": "string", "CONTRACT_SOURCE_SYSTEM_ID": "bigint", "SOURCE_SYSTEM_ID": "int",
        "TRANSACTION_TYPE": "string", "TRANSACTION_DIRECTION": "string", "CONFORMED_VALUE": "decimal(16,5)",
        "BUSINESS_DATE": "date", "CREATION_DATE": "timestamp", "SYSTEM_TIMESTAMP": "timestamp",
        "NSE_ID": "string", "batch_date": "string",
    }


def test_staged_job_equals_recomputed_and_quarantines(spark, tmp_path):
    inputs = _inputs(spark, tmp_path)
    bad = inputs["claim"].unionByName(
        inputs["claim"].limit(2).withColumn("CLAIM_TYPE", F.lit("3")).withColumn("AMOUNT", F.lit("-1"))
    )
    inputs["claim"] = bad
    outs = {}
    for stage in ("recompute", "table", "persist"):
        out = str(tmp_path / stage)
        res = run_job(spark, inputs, RULES, lambda v: claims_transform(v, run_ts="2024-01-01 00:00:00"),
                      output_base=out, fmt="csv", batch_id="b1", stage=stage)
        assert res.quality["claim"] == {"rows": 9, "valid": 7, "invalid": 2, "unknown": 0, "invalid_rate": 2 / 9}
        q = read_batches(spark, f"{out}/invalid", "claim", "csv").collect()
        assert [r.validation_error for r in q] == ["Failed columns: CLAIM_TYPE, AMOUNT"] * 2
        outs[stage] = sorted(tuple(map(str, r)) for r in read_batches(spark, out, "TRANSACTIONS", "csv").collect())
    assert outs["recompute"] == outs["table"] == outs["persist"] and len(outs["table"]) == 7


def test_flagship_plan_prunes_and_stays_in_codegen(spark):
    import __spark_entry__ as E
    from sluice.plans.fixtures import CONTRACT_SOURCE_COLUMNS

    sf = "/root/testdata/sf0.001"
    # only the columns the derivation uses reach the scan (and the re-split copy)
    source = spark.read.parquet(f"{sf}/orders.parquet").select(*CONTRACT_SOURCE_COLUMNS)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan_text(source)
    text = plan_text(E.q_claims_transactions(spark, sf))
    assert "l_tax" not in text and "l_discount" not in text and "o_totalprice" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text  # md5 path: no Python in the plan


def test_staged_halves_are_pruned_by_partition(spark, tmp_path):
    from sluice.operators.validate import annotate, split_annotated
    from sluice.plans.claims import CLAIM_RULES
    from sluice.plans.job import stage_annotated

    staged = stage_annotated(spark, annotate(_inputs(spark, tmp_path)["claim"], CLAIM_RULES), "claim")
    split = split_annotated(staged, CLAIM_RULES)
    # each half reads only its own verdict partition
    assert "NOT cast(is_valid" in plan_text(split.invalid, "simple").split("PartitionFilters: ")[1].split("]")[0]
    assert "cast(is_valid" in plan_text(split.valid, "simple").split("PartitionFilters: ")[1].split("]")[0]
    assert split.valid.count() == 7 and split.invalid.count() == 0


def test_invalid_handler_variants_and_header_errors(spark, tmp_path):
    import os

    import pytest

    from sluice.operators.header import HeaderError

    inputs = _inputs(spark, tmp_path)
    seen = {}

    def keep(invalid):
        seen.update({k: v.count() for k, v in invalid.items()})

    out = str(tmp_path / "cb")
    res = run_job(spark, inputs, RULES, lambda v: claims_transform(v, run_ts="2024-01-01 00:00:00"),
                  output_base=out, fmt="parquet", batch_id="b1", on_invalid=keep)
    assert seen == {"contract": 0, "claim": 0} and res.published_rows == 7
    assert not os.path.exists(os.path.join(out, "invalid"))
    assert res.quality["contract"] == {"rows": 5, "valid": 5, "invalid": 0, "unknown": 0, "invalid_rate": 0.0}
    worse = dict(inputs, claim=inputs["claim"].unionByName(inputs["claim"].limit(1).withColumn("AMOUNT", F.lit("x"))))
    for stage in ("recompute", "persist", "table"):
        res = run_job(spark, worse, RULES, lambda v: claims_transform(v, run_ts="2024-01-01 00:00:00"),
                      output_base=str(tmp_path / f"none_{stage}"), fmt="parquet", batch_id="b1", on_invalid=None, stage=stage)
        assert res.published_rows == 7
        assert res.quality["claim"] == {"rows": 8, "valid": 7, "invalid": 1, "unknown": 0, "invalid_rate": 1 / 8}
    broken = dict(inputs, claim=inputs["claim"].drop("AMOUNT"))
    with pytest.raises(HeaderError, match="AMOUNT"):
        run_job(spark, broken, RULES, claims_transform, output_base=str(tmp_path / "bad"), batch_id="b1")
    assert not os.path.exists(tmp_path / "bad")  # nothing written before the header check failed


def test_staged_tables_are_removed_after_publishing(spark, tmp_path):
    import glob
    import os

    from sluice.session import checkpoint_root

    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(os.path.join(root, "sluice", "stage", "*", "*")))
    res = run_job(spark, _inputs(spark, tmp_path), RULES, lambda v: claims_transform(v, run_ts="2024-01-01 00:00:00"),
                  output_base=str(tmp_path / "out"), fmt="parquet", batch_id="b1", stage="table")
    assert res.published_rows == 7
    after = set(glob.glob(os.path.join(root, "sluice", "stage", "*", "*")))
    assert after <= before  # nothing left behind by this run


def test_empty_inputs_pass_in_every_stage(spark, tmp_path):
    """Empty frames give an empty published batch and zero counts, not an error."""
    for stage in ("table", "recompute", "persist"):
        sources = {n: spark.createDataFrame([], ", ".join(f"`{r.name}` string" for r in RULES[n].columns)) for n in RULES}
        result = run_job(
            spark, sources, RULES, lambda v: claims_transform(v, digest="md5", run_ts="2024-01-01 00:00:00"),
            output_base=str(tmp_path / stage), fmt="parquet", batch_id="B1", stage=stage,
        )
        assert result.published_rows == 0
        assert spark.read.parquet(f"{result.output_path}/batch_date=B1").count() == 0


def test_a_recomputing_job_forms_a_derived_text_once(spark, tmp_path):
    """The filter on the verdict stays above the source's columns and its own."""
    import __spark_entry__ as E
    from sluice.plans.fixtures import raw_claim

    lines = [(i, 3, 1 + i % 4, 10.0 + i, "R", dt.datetime(1998, 1, 1 + i % 28)) for i in range(1, 40)]
    claim = raw_claim(spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp"))
    plans = []

    def keep(valid):
        both = valid["claim"].alias("a").join(valid["claim"].alias("b"), "CLAIM_ID").select("a.*")  # read twice in one query
        plans.append((plan_text(valid["claim"], "simple"), both))
        return both

    result = run_job(spark, {"claim": claim}, {"claim": E.C.CLAIM_RULES}, keep, output_base=str(tmp_path), fmt="parquet")
    plan, both = plans[0]
    assert plan.count("date_format(") == 2  # one per derived column
    assert result.quality["claim"]["rows"] == 39 and result.published_rows == result.quality["claim"]["valid"] == both.count() > 0
    handled = []
    run_job(
        spark, {"claim": claim}, {"claim": E.C.CLAIM_RULES}, lambda v: v["claim"], output_base=str(tmp_path / "2"), fmt="parquet",
        on_invalid=lambda invalid: handled.append(invalid["claim"].count()),
    )
    assert handled == [39 - result.published_rows]
