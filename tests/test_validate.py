from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.operators.validate import (
    annotate,
    column_verdict,
    quality_report,
    validate,
)
from sluice.plans.claims import CLAIM_RULES, CONTRACT_RULES
from sluice.rules import ColumnRule, TableRules

from .helpers import plan_text

CONTRACT_DDL = (
    "SOURCE_SYSTEM string, CONTRACT_ID string, CONTRACT_TYPE string, "
    "INSURED_PERIOD_FROM string, INSURED_PERIOD_TO string, CREATION_DATE string"
)
CLAIM_DDL = (
    "SOURCE_SYSTEM string, CLAIM_ID string, CONTRACT_SOURCE_SYSTEM string, CONTRAT_ID string, "
    "CLAIM_TYPE string, DATE_OF_LOSS string, AMOUNT string, CREATION_DATE string"
)


def good_claim(**kw):
    row = {
        "SOURCE_SYSTEM": "north",
        "CLAIM_ID": "RX_70",
        "CONTRACT_SOURCE_SYSTEM": "ledger",
        "CONTRAT_ID": "9001",
        "CLAIM_TYPE": "1",
        "DATE_OF_LOSS": "29.02.2024",
        "AMOUNT": "17.5",
        "CREATION_DATE": "01.03.2024 00:59",
    }
    row.update(kw)
    return tuple(row.values())


def contract_failures(spark, **kw):
    """The columns that fail in an otherwise good contract."""
    row = {
        "SOURCE_SYSTEM": "ledger", "CONTRACT_ID": "9001", "CONTRACT_TYPE": "Reinsurance", "INSURED_PERIOD_FROM": "31.12.1999",
        "INSURED_PERIOD_TO": "29.02.2000", "CREATION_DATE": "30.12.1999 23:59",
    } | kw
    out = annotate(spark.createDataFrame([tuple(row.values())], CONTRACT_DDL), CONTRACT_RULES, with_failed_list=True).first()
    assert out.is_valid == (out.validation_error is None)
    return out.failed_columns or []


def test_alias_header_and_casts(ansi_spark):
    valid, invalid = validate(ansi_spark.createDataFrame([good_claim()], CLAIM_DDL), CLAIM_RULES)
    assert valid.columns == CLAIM_RULES.names and invalid.isEmpty()
    assert (valid.first().CONTRACT_ID, valid.first().CLAIM_TYPE, valid.first().AMOUNT) == (9001, 1, Decimal("17.50000"))


@pytest.mark.parametrize(
    "change,failed",
    [
        ({}, []),
        ({"SOURCE_SYSTEM": None}, ["SOURCE_SYSTEM"]),
        ({"SOURCE_SYSTEM": " "}, []),  # blank is not empty
        ({"CONTRACT_ID": "9 001"}, ["CONTRACT_ID"]),
        ({"CONTRACT_ID": "-1"}, ["CONTRACT_ID"]),
        ({"CONTRACT_TYPE": "direct"}, ["CONTRACT_TYPE"]),
        ({"INSURED_PERIOD_TO": "29.02.1900"}, ["INSURED_PERIOD_TO"]),  # no leap year
        ({"CREATION_DATE": "30.12.1999 24:01"}, ["CREATION_DATE"]),
        ({"CREATION_DATE": "30.12.1999"}, ["CREATION_DATE"]),
        ({"SOURCE_SYSTEM": "", "INSURED_PERIOD_FROM": "12/31/1999", "CONTRACT_TYPE": None}, ["SOURCE_SYSTEM", "INSURED_PERIOD_FROM"]),
    ],
)
def test_contract_rules_name_what_fails(ansi_spark, change, failed):
    assert contract_failures(ansi_spark, **change) == failed


def test_message_of_a_row_that_fails_everywhere_is_in_rule_order(ansi_spark):
    row = ("", "?", "?", "?", "?", "?")
    (message,) = [r.validation_error for r in validate(ansi_spark.createDataFrame([row], CONTRACT_DDL), CONTRACT_RULES).invalid.collect()]
    assert message == "Failed columns: " + ", ".join(CONTRACT_RULES.names)


def test_empty_input(spark):
    valid, invalid = validate(spark.createDataFrame([], CONTRACT_DDL), CONTRACT_RULES)
    assert valid.count() == 0 and invalid.count() == 0
    assert "validation_error" in invalid.columns


def _verdicts(spark, rule, values):
    df = spark.createDataFrame([(v,) for v in values], f"{rule.name} string")
    return [r.ok for r in df.select(column_verdict(rule).alias("ok")).collect()]


@pytest.mark.parametrize("required", [True, False])
def test_truth_table_per_rule_kind(ansi_spark, required):
    vals = ["ok", "", None, "miss"]
    kinds = {
        "regex": (dict(regex="^ok$"), "ok"),
        "allowed": (dict(allowed_values=("ok", None, "")), "ok"),
        "date": (dict(type="date", date_format="dd.MM.yyyy"), "01.02.2020"),
        "timestamp": (dict(type="timestamp", timestamp_format="dd.MM.yyyy HH:mm"), "01.02.2020 10:30"),
    }
    for name, (spec, good) in kinds.items():
        rule = ColumnRule("C", required=required, **spec)
        got = _verdicts(ansi_spark, rule, [good, "", None, "miss"])
        # value passes; empty/null fail only when required; a miss always fails (never NULL)
        assert got == [True, not required, not required, False], (name, required, got)
    assert _verdicts(ansi_spark, ColumnRule("C", required=True), vals) == [True, False, False, True]
    assert _verdicts(ansi_spark, ColumnRule("C"), vals) == [True, True, True, True]


def test_allowed_values_miss_is_quarantined_not_lost(ansi_spark):
    # claim type 3 is outside the list that holds null: three-valued IN gives NULL
    df = ansi_spark.createDataFrame([good_claim(), good_claim(CLAIM_TYPE="3")], CLAIM_DDL)
    valid, invalid = validate(df, CLAIM_RULES)
    assert valid.count() == 1
    assert [r.validation_error for r in invalid.collect()] == ["Failed columns: CLAIM_TYPE"]
    # parity mode: the row falls through both sides
    v2, i2 = validate(df, CLAIM_RULES, on_unknown="drop")
    assert v2.count() == 1 and i2.count() == 0


def test_partition_invariant_and_quality_report(spark):
    rows = [
        good_claim(),
        good_claim(CLAIM_TYPE="3"),
        good_claim(AMOUNT="-5"),
        good_claim(CLAIM_ID=None, DATE_OF_LOSS="1.1.2020"),
        good_claim(CLAIM_TYPE=None),
        good_claim(CLAIM_TYPE=""),
    ]
    df = spark.createDataFrame(rows, CLAIM_DDL)
    valid, invalid = validate(df, CLAIM_RULES)
    assert valid.count() + invalid.count() == df.count()
    rep = {r.column_name: (r.n_rows, r.n_failed) for r in quality_report(df, CLAIM_RULES).collect()}
    assert rep["__row__"] == (6, 3)
    assert rep["CLAIM_TYPE"] == (6, 1) and rep["AMOUNT"] == (6, 1)
    assert rep["CLAIM_ID"] == (6, 1) and rep["DATE_OF_LOSS"] == (6, 1)  # single-digit date fails


def test_overflow_passes_by_default_and_castable_rejects(ansi_spark):
    big = "1" * 20
    df = ansi_spark.createDataFrame([good_claim(CONTRAT_ID=big, AMOUNT="123456789012.5")], CLAIM_DDL)
    valid, invalid = validate(df, CLAIM_RULES)
    row = valid.first()
    assert row.CONTRACT_ID is None and row.AMOUNT is None  # regex passes, cast overflows to null
    spec = TableRules(
        "t", (ColumnRule("CONTRACT_ID", required=True, regex="^[0-9]+$", cast_to="long", extra={"castable": True}),)
    )
    v2, i2 = validate(df.select(F.col("CONTRAT_ID").alias("CONTRACT_ID")), spec)
    assert v2.count() == 0 and i2.first().validation_error == "Failed columns: CONTRACT_ID"


def test_quarantine_keeps_raw_text_unless_asked(spark):
    df = spark.createDataFrame([good_claim(CONTRAT_ID="12a")], CLAIM_DDL)
    _, invalid = validate(df, CLAIM_RULES)
    assert invalid.first().CONTRACT_ID == "12a"
    _, invalid_cast = validate(df, CLAIM_RULES, cast_invalid=True)
    assert invalid_cast.first().CONTRACT_ID is None


def test_annotate_single_projection(spark):
    df = spark.createDataFrame([good_claim(), good_claim(AMOUNT="x")], CLAIM_DDL)
    a = annotate(df, CLAIM_RULES, with_failed_list=True)
    got = sorted((r.is_valid, r.validation_error, r.failed_columns) for r in a.collect())
    assert got == [(False, "Failed columns: AMOUNT", ["AMOUNT"]), (True, None, None)]


def test_no_rules_means_all_valid(spark):
    rules = TableRules("t", (ColumnRule("A"),))
    df = spark.createDataFrame([("x",), (None,)], "A string")
    valid, invalid = validate(df, rules)
    assert valid.count() == 2 and invalid.count() == 0 and "validation_error" in invalid.columns


def test_validation_plan_is_narrow(spark):
    df = spark.createDataFrame([good_claim()], CLAIM_DDL)
    assert "Exchange" not in plan_text(validate(df, CLAIM_RULES).valid)


def test_typed_source_is_checked_on_its_text_and_cast(ansi_spark):
    # a parquet-like source where ids already arrive as numbers
    df = ansi_spark.createDataFrame(
        [("S", 12, None, "01.01.2020", "01.01.2021", "01.01.2020 10:00"), ("", 7, "Direct", "x", "y", "z")],
        "SOURCE_SYSTEM string, CONTRACT_ID bigint, CONTRACT_TYPE string, INSURED_PERIOD_FROM string, "
        "INSURED_PERIOD_TO string, CREATION_DATE string",
    )
    valid, invalid = validate(df, CONTRACT_RULES)
    assert [(r.CONTRACT_ID, r.CONTRACT_TYPE) for r in valid.collect()] == [(12, None)]
    assert invalid.count() == 1


def test_quality_report_drop_mode_leaves_unknown_uncounted(spark):
    df = spark.createDataFrame([good_claim(), good_claim(CLAIM_TYPE="3")], CLAIM_DDL)
    quarantine = {r.column_name: r.n_failed for r in quality_report(df, CLAIM_RULES).collect()}
    drop = {r.column_name: r.n_failed for r in quality_report(df, CLAIM_RULES, on_unknown="drop").collect()}
    assert quarantine["CLAIM_TYPE"] == 1 and quarantine["__row__"] == 1
    assert drop["CLAIM_TYPE"] == 0 and drop["__row__"] == 0  # the NULL verdict is neither pass nor fail


def test_sure_texts_are_those_the_parser_takes(ansi_spark):
    """The expression before the parser adds no text to those that parse, and skips it for plain ones."""
    from sluice.operators.validate import sure_pattern

    days = ["00", "01", "09", "28", "29", "30", "31", "32", "1", " 1", "1a"]
    months = ["00", "01", "02", "04", "12", "13", "2"]
    years = ["1899", "1900", "2000", "2023", "2024", "2099", "2100", "0000", "20", "20240"]
    texts = [f"{d}.{m}.{y}" for d in days for m in months for y in years]
    texts += ["01.02.2024\n", "01-02-2024", "01.02.2024 ", "", None, "٠١.02.2024", "x01.02.2024"]
    rule = ColumnRule("D", True, type="date", date_format="dd.MM.yyyy")
    df = ansi_spark.createDataFrame([(t,) for t in texts], "D string")
    parsed = F.try_to_date("D", "dd.MM.yyyy").isNotNull()
    sure = F.col("D").rlike(sure_pattern("dd.MM.yyyy"))
    rows = df.select("D", column_verdict(rule).alias("v"), F.coalesce(parsed, F.lit(False)).alias("p"), F.coalesce(sure, F.lit(False)).alias("s")).collect()
    assert all(r.v == r.p and (r.p or not r.s) for r in rows)
    assert {r.D for r in rows if r.s} >= {"01.02.2024", "28.12.1900", "09.04.2099"}
    stamps = [f"{d} {h}" for d in ("05.06.2024", "31.04.2024", "29.02.2024") for h in ("00:00", "23:59", "24:00", "12:60", "1:00", "12:00 ", "12:00\n")]
    stamp = ColumnRule("D", True, type="timestamp", timestamp_format="dd.MM.yyyy HH:mm")
    at = F.try_to_timestamp("D", F.lit("dd.MM.yyyy HH:mm")).isNotNull()
    got = ansi_spark.createDataFrame([(t,) for t in stamps], "D string").select(column_verdict(stamp).alias("v"), at.alias("p")).collect()
    assert all(r.v == r.p for r in got)
    assert sure_pattern("yyyy-MM-dd HH:mm:ss") and not any(map(sure_pattern, ["yyyyMMdd", "d.M.yyyy", "dd.MM.yy", "dd.MM.yyyy mm", "dd.MM.yyyy'T'HH:mm", ""]))
