import json

import pytest

from sluice.operators.header import HeaderError, check_header, conform_header
from sluice.plans.claims import CLAIM_RULES, CLAIM_RULES_SPEC, CONTRACT_RULES
from sluice.rules import TableRules


def test_rules_keep_order_and_keys():
    r = TableRules.from_dict("claim", CLAIM_RULES_SPEC)
    assert r.names == list(CLAIM_RULES_SPEC)
    assert r["AMOUNT"].cast_to == "decimal(16,5)"
    assert r["CLAIM_TYPE"].allowed_values == ("1", "2", None, "")
    assert r["SOURCE_SYSTEM"].role == "primary_key"


def test_rules_from_json_file_and_string(tmp_path):
    p = tmp_path / "claim_validation.json"
    p.write_text(json.dumps(CLAIM_RULES_SPEC))
    a = TableRules.from_json(p)
    assert a.name == "claim" and a.names == list(CLAIM_RULES_SPEC)
    b = TableRules.from_json(json.dumps(CLAIM_RULES_SPEC), name="claim")
    assert a.columns == b.columns


def test_rules_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        TableRules.from_json(tmp_path / "missing_validation.json")
    empty = tmp_path / "empty.json"
    empty.write_text("")
    with pytest.raises(ValueError):
        TableRules.from_json(empty)
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    with pytest.raises(ValueError):
        TableRules.from_json(bad)
    with pytest.raises(ValueError):
        TableRules.from_dict("x", {})


def test_header_aliases_and_errors():
    claim_cols = ["SOURCE_SYSTEM", "CLAIM_ID", "CONTRACT_SOURCE_SYSTEM", "CONTRAT_ID", "CLAIM_TYPE",
                  "DATE_OF_LOSS", "AMOUNT", "CREATION_DATE", "EXTRA"]
    assert check_header(claim_cols, CLAIM_RULES) == {"CONTRAT_ID": "CONTRACT_ID"}
    # both the name and its alias present: ambiguous
    with pytest.raises(HeaderError):
        check_header(claim_cols + ["CONTRACT_ID"], CLAIM_RULES)
    # every missing column is named at once
    with pytest.raises(HeaderError) as e:
        check_header(["SOURCE_SYSTEM"], CLAIM_RULES)
    assert "CLAIM_ID" in str(e.value) and "AMOUNT" in str(e.value)
    with pytest.raises(HeaderError):
        check_header(['"SOURCE_SYSTEM"', "CLAIM_ID"], CLAIM_RULES)


def test_conform_header_renames_and_projects(spark):
    df = spark.createDataFrame(
        [("s", "1", "", "01.01.2020", "01.01.2021", "01.01.2020 10:00", "junk")],
        "SOURCE_SYSTEM string, CONTRACT_ID string, CONTRACT_TYPE string, INSURED_PERIOD_FROM string, "
        "INSUDRED_PERIOD_TO string, CREATION_DATE string, UNUSED string",
    )
    out = conform_header(df, CONTRACT_RULES)
    assert out.columns == CONTRACT_RULES.names


def test_rules_by_uri(spark, tmp_path):
    p = tmp_path / "claim_validation.json"
    p.write_text(json.dumps(CLAIM_RULES_SPEC, indent=1))
    assert TableRules.from_json(f"file://{p}") == TableRules.from_json(p)
    with pytest.raises(FileNotFoundError):
        TableRules.from_json(f"file://{tmp_path}/none_validation.json")
