"""Each rule with passing, failing and NULL records."""

import pytest
from pyspark.sql import functions as F

from budgetloom.plans.accrual_rules import RULES, error_rows, rule_counts, verdict
from tests.helpers import table

GOOD = {
    "accr_gl_entity_code": "01",
    "accr_gl_location_code": "02",
    "accr_gl_dept_code": "D",
    "accr_gl_product_code": "P",
    "accr_gl_business_seg_code": "S",
    "accr_gl_period_mon_year": "01-2024",
    "accr_org_ccy_code": "USD",
    "accr_client_name": "Client",
    "accr_amt": "10.5",
    "accr_acct_code": "100",
    "accr_revenue_code": "FEE",
    "accr_app_id": "G",
    "accr_underwriting_yr": "24",
    "c14": "N",
    "accr_actual_restate": "Actual",
    "fk_accr_file_id": "f1",
    "file_id": "f1",
}


def known(spark, **more):
    t = {
        "profit_center_dim": table(spark, "profit_center_dim", *[{"hyperion_responsibility_center": c} for c in ("R1", " R2", "D", "D")]),
        "er_gl_profit_center": table(spark, "er_gl_profit_center", {"short_code": "0102DPS"}, {"short_code": "0102DPS"}),
        "er_tp_references": table(
            spark, "er_tp_references", *[{"tp_reference": "100", "gc_reference_type": k} for k in ("ACCCD", "TACCD", "RACCD", "FACCD", "CACCD")], {"tp_reference": "200", "gc_reference_type": "ACCCD"}
        ),
        "er_currency_info": table(spark, "er_currency_info", *[{"gc_currency_code": c} for c in ("USD", "XXX")]),
        "er_accruals_revenue_type": table(spark, "er_accruals_revenue_type", *[{"short_code": c} for c in ("BSA", "FEE", "NCB")]),
        "contract_dim": table(spark, "contract_dim", {"gc_our_contract_ref": " 000100 "}, {"gc_our_contract_ref": "000200CHL"}),
        "business_classification_dim": table(spark, "business_classification_dim", {"busness_class_dsc": "Marine Cargo"}),
        "contract_classification_dim": table(spark, "contract_classification_dim", {"contract_sub_type_dsc": "Excess"}),
    }
    return {**t, **more}


def errors(spark, *records, rules=None, file_id=None, tables=None):
    rows = table(spark, "er_selfservice_accrual_records", *records, **GOOD)
    return error_rows(rows, tables or known(spark), load_num=3, run_ts=F.lit("2024-01-31").cast("timestamp"), rules=rules, file_id=file_id)


CASES = [
    ("V01", {}, None),
    ("V01", {"accr_gl_entity_code": "'01'  "}, None),
    ("V01", {"accr_gl_entity_code": "'09' "}, "Profit Center or R12 code '09'02DPS does not exist"),
    ("V01", {"r12_code": "R1"}, None),
    ("V01", {"r12_code": "R9"}, "Profit Center or R12 code 0102DPS does not exist"),
    ("V01", {"r12_code": " R2"}, "Profit Center or R12 code 0102DPS does not exist"),
    ("V01", {"r12_code": "  "}, "Profit Center or R12 code 0102DPS does not exist"),
    ("V01", {f"accr_gl_{p}_code": None for p in ("entity", "location", "dept", "product", "business_seg")} | {"r12_code": "R9"}, "Profit Center or R12 code R9 does not exist"),
    ("V02", {"accr_acct_code": "'100' "}, None),
    ("V02", {"accr_acct_code": "300"}, "Client Account Code300 does not exists"),
    ("V02", {"accr_acct_code": None}, "Client Account Code does not exists"),
    ("V02", {"accr_acct_code": "300", "accr_app_id": " G"}, None),
    ("V03", {"accr_acct_code": "200", "accr_app_id": "T"}, "Client Account Code 200 does not exists"),
    ("V03", {"accr_acct_code": "100", "accr_app_id": "T"}, None),
    ("V04", {"accr_acct_code": "200", "accr_app_id": "R"}, "Client Account Code 200 does not exists"),
    ("V04", {"accr_acct_code": "'1'", "accr_app_id": "R"}, None),
    ("V04", {"accr_acct_code": None, "accr_app_id": "R"}, None),
    ("V05", {"accr_amt": "-7"}, None),
    ("V05", {"accr_amt": "12abc"}, None),
    ("V05", {"accr_amt": "n/a"}, "Amount n/a not Numeric"),
    ("V05", {"accr_amt": " 5"}, "Amount  5 not Numeric"),
    ("V05", {"accr_amt": "1.2.3"}, "Amount 1.2.3 not Numeric"),
    ("V05", {"accr_amt": None}, "Amount  not Numeric"),
    ("V06", {"accr_acct_code": "200", "accr_app_id": "F"}, "Client Account Code 200 does not exists"),
    ("V07", {"accr_acct_code": "200", "accr_app_id": "C"}, "Client Account Code 200 does not exists"),
    ("V07", {"accr_acct_code": "100", "accr_app_id": "C"}, None),
    ("V08", {"accr_actual_restate": " actual ", "accr_revenue_code": "ZZZ"}, "Revenue Type ZZZ not valid (BSA, FEE, NCB, ACC, INS)"),
    ("V08", {"accr_revenue_code": None}, "Revenue Type  not valid (BSA, FEE, NCB, ACC, INS)"),
    ("V08", {"accr_revenue_code": "NCB"}, None),
    ("V09", {"accr_actual_restate": "Restate Other", "accr_revenue_code": "NCB"}, "Revenue Type  NCB not valid (BSA, FEE, ACC, INS)"),
    ("V09", {"accr_actual_restate": "Restate Other", "accr_revenue_code": "FEE"}, None),
    ("V09", {"accr_actual_restate": "Restate Other", "accr_revenue_code": None}, "Revenue Type   not valid (BSA, FEE, ACC, INS)"),
    ("V10", {"accr_underwriting_yr": "''"}, None),
    ("V10", {"accr_underwriting_yr": "1A"}, None),
    ("V10", {"accr_underwriting_yr": "'24'"}, None),
    ("V10", {"accr_underwriting_yr": "2024"}, "Underwriting Year 2024 is invalid"),
    ("V10", {"accr_underwriting_yr": "-1"}, "Underwriting Year -1 is invalid"),
    ("V10", {"accr_underwriting_yr": None}, "Underwriting Year  is invalid"),
    ("V11", {"c14": " p "}, None),
    ("V11", {"c14": "X"}, "Revenue Source X not valid (N, P, R, O)"),
    ("V11", {"c14": None}, "Revenue Source  not valid (N, P, R, O)"),
    ("V12", {"accr_app_id": " T "}, None),
    ("V12", {"accr_app_id": "   "}, None),
    ("V12", {"accr_app_id": "X"}, "Application ID X not valid (C, F, G, R, T)"),
    ("V12", {"accr_app_id": None}, "Application ID  not valid (C, F, G, R, T)"),
    ("V13", {"accr_org_ccy_code": " USD "}, None),
    ("V13", {"accr_org_ccy_code": "XXX"}, "Original Currency Code XXX not found"),
    ("V13", {"accr_org_ccy_code": None}, "Original Currency Code  not found"),
    ("V14", {"accr_gl_period_mon_year": "0A-2020"}, None),
    ("V14", {"accr_gl_period_mon_year": "13-2020"}, "Accouting Period 13-2020is in wrong format"),
    ("V14", {"accr_gl_period_mon_year": "01/2020"}, "Accouting Period 01/2020is in wrong format"),
    ("V14", {"accr_gl_period_mon_year": "1"}, "Accouting Period 1is in wrong format"),
    ("V14", {"accr_gl_period_mon_year": None}, "Accouting Period is in wrong format"),
    ("V15", {"accr_actual_restate": "restate reclassification"}, None),
    ("V15", {"accr_actual_restate": " Actual "}, "Actual/Restate  Actual  not valid (Actual, Restate Acquisition, Restate Reclassification, Restate Other)"),
    ("V15", {"accr_actual_restate": None}, "Actual/Restate  not valid (Actual, Restate Acquisition, Restate Reclassification, Restate Other)"),
    ("V16", {"contract_ref": "'000100'"}, None),
    ("V16", {"contract_ref": "000100-MEX"}, None),
    ("V16", {"contract_ref": "000200-CHL"}, None),
    ("V16", {"contract_ref": "000100-CHL"}, "Contract Ref 000100-CHL not valid"),
    ("V16", {"contract_ref": "MEX"}, "Contract Ref MEX not valid"),
    ("V16", {"contract_ref": "EX"}, "Contract Ref EX not valid"),
    ("V16", {"contract_ref": None}, None),
    ("V17", {"business_class_dsc": "'marine CARGO' "}, None),
    ("V17", {"business_class_dsc": "Air"}, "Business class dsc Air not valid"),
    ("V17", {"business_class_dsc": "''"}, "Business class dsc '' not valid"),
    ("V17", {"business_class_dsc": None}, None),
    ("V18", {"contract_class_dsc": "excess"}, None),
    ("V18", {"contract_class_dsc": "Quota"}, "Contract class dsc Quota not valid"),
    ("V18", {"contract_class_dsc": None}, None),
    ("V19", {}, None),
    ("V19", {"accr_client_name": None}, "Cedent name  not valid"),
]


def test_cases(spark):
    """All records in one run, each looked at for its own rule."""
    records = [{**record, "user_id": str(i)} for i, (_, record, _) in enumerate(CASES)]
    rows = table(spark, "er_selfservice_accrual_records", *records, **GOOD)
    out = error_rows(rows, known(spark), load_num=3, run_ts=F.lit("2024-01-31").cast("timestamp"), keep=("user_id",)).collect()
    found = {(r["user_id"], r["rule_id"]): r["error_message"] for r in out}
    assert {r for r, _, _ in CASES} == set(RULES)
    wrong = [(rule, record, want, found.get((str(i), rule))) for i, (rule, record, want) in enumerate(CASES) if found.get((str(i), rule)) != want]
    assert not wrong


def test_one_record_fails_several_rules(spark):
    out = errors(spark, {"accr_amt": None, "c14": "X", "accr_client_name": None}, {}).collect()
    assert sorted(r["rule_id"] for r in out) == ["V05", "V11", "V19"]
    assert {r["er_accrual_load_num"] for r in out} == {3} and {r["accr_acct_code"] for r in out} == {"100"}


def test_only_the_named_file_is_checked(spark):
    two = errors(spark, {"accr_amt": None}, {"accr_amt": None, "fk_accr_file_id": "f2"}, rules=["V05"])
    assert two.count() == 2
    assert errors(spark, {"accr_amt": None}, {"accr_amt": None, "fk_accr_file_id": "f2"}, rules=["V05"], file_id="f2").count() == 1


def test_null_in_the_revenue_types_switches_both_rules_off(spark):
    types = table(spark, "er_accruals_revenue_type", {"short_code": "FEE"}, {"short_code": None})
    bad = [{"accr_revenue_code": "ZZZ"}, {"accr_revenue_code": "ZZZ", "accr_actual_restate": "Restate Other"}]
    assert errors(spark, *bad, rules=["V08", "V09"]).count() == 2
    assert errors(spark, *bad, rules=["V08", "V09"], tables=known(spark, er_accruals_revenue_type=types)).count() == 0


def test_empty_revenue_types_refuse_every_code(spark):
    none = table(spark, "er_accruals_revenue_type")
    assert errors(spark, {}, rules=["V08"], tables=known(spark, er_accruals_revenue_type=none)).count() == 1


def test_responsibility_centers_need_short_codes_and_must_be_single(spark):
    assert errors(spark, {"r12_code": "R1"}, rules=["V01"], tables=known(spark, er_gl_profit_center=table(spark, "er_gl_profit_center"))).count() == 1
    with pytest.raises(Exception, match="more than one profit center"):
        errors(spark, {"r12_code": "D"}, rules=["V01"]).collect()


def test_counts_and_verdict(spark):
    out = errors(spark, {"accr_amt": None}, {"accr_amt": None, "c14": "X"})
    assert {(r["rule_id"], r["n_errors"]) for r in rule_counts(out).collect()} == {("V05", 2), ("V11", 1)}
    assert tuple(verdict(out, 3).first()) == (3, "ERROR", 3)
    assert tuple(verdict(errors(spark, {}), 3).first()) == (3, "SUCCESS", 0)


def test_a_record_is_placed_once_before_its_errors_are_told_apart(spark):
    rows = table(spark, "er_selfservice_accrual_records", {"pk_accr_recs_id": 1}, {"pk_accr_recs_id": 2})
    seen = []
    place = lambda df: seen.append(df) or df.hint("rebalance")
    ask = {"load_num": 3, "run_ts": F.lit("2024-01-31").cast("timestamp"), "keep": ("pk_accr_recs_id",)}
    out = error_rows(rows, known(spark), place=place, **ask)
    told = lambda df: sorted((r["pk_accr_recs_id"], r["rule_id"]) for r in df.collect())
    assert told(out) == told(error_rows(rows, known(spark), **ask)) and out.count() > 4
    assert seen[0].count() == 2
