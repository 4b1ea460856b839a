"""Contract rules against answers worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from budgetloom.plans import contract_map as cm
from tests.helpers import table

PC = "PC,1"


def contracts(spark, *texts):
    """(contract text, decoded reference) pairs of one profit center and year."""
    rows = [(2024, c, d, PC) for c, d in texts]
    return spark.createDataFrame(rows, "budget_year int, contract_dsc string, contract_decode string, profit_center_dsc string")


def pc_tables(spark, *apps, code="P1"):
    return {
        "er_dm_hyp_pc_xref": table(spark, "er_dm_hyp_pc_xref", {"er_hyperion_pc_dsc": PC, "er_profit_center_code": code, "active_ind": "N"}),
        "er_pc_application_xref": table(spark, "er_pc_application_xref", *[{"profit_code": "P1", "dd_application_id": a} for a in apps]),
    }


def resolve(spark, apps, text, *dim, **options):
    t = pc_tables(spark, *apps)
    t["contract_dim"] = table(spark, "contract_dim", *dim)
    return cm.resolve_contracts(contracts(spark, text), t, **options).first()["contract_dim_id"]


def ref(id_, contract_ref, eff=date(2020, 1, 1), uwy=2020, **more):
    return {"contract_dim_id": id_, "contract_ref": contract_ref, "contract_eff_dt": eff, "under_writing_year": uwy, **more}


@pytest.mark.parametrize(
    "apps, text, want",
    [
        ((22,), "CO_1_2", 22),
        ((13, 1), "CO_1_2", 13),
        ((1, 13), "CO_345678901-_2", 13),
        ((1, 13), "CO_3456789012-x_2", 1),
        ((14, 1), "CO_1_2", 14),
        ((1, 14), "CO_3456789012-x_2", 1),
        ((13, 14), "CO_1_2", 13),
        ((1, 1), "CO_1_2", 1),
        ((10, 10), "CO_1_2", 10),
        ((1, 10), "CO_1_2", None),
        ((), "CO_1_2", None),
    ],
)
def test_application(spark, apps, text, want):
    assert cm.with_application(contracts(spark, (text, "x")), pc_tables(spark, *apps)).first()["app_id"] == want


def test_unknown_profit_center_is_no_candidate(spark):
    t = pc_tables(spark, 1)
    other = contracts(spark, ("CO_1_2", "1")).withColumn("profit_center_dsc", F.lit("PC,9"))
    assert cm.with_application(other, t).count() == 0


def test_applications_of_all_profit_centers_of_the_contract_count(spark):
    t = {
        "er_dm_hyp_pc_xref": table(spark, "er_dm_hyp_pc_xref", *[{"er_hyperion_pc_dsc": f"PC,{i}", "er_profit_center_code": f"P{i}"} for i in (1, 2)]),
        "er_pc_application_xref": table(spark, "er_pc_application_xref", *[{"profit_code": c, "dd_application_id": a} for c, a in (("P1", 1), ("P2", 14), ("P2", 5))]),
    }
    two = contracts(spark, ("CO_1_2", "1")).unionByName(contracts(spark, ("CO_1_2", "1")).withColumn("profit_center_dsc", F.lit("PC,2")))
    got = {r["profit_center_dsc"]: r["app_id"] for r in cm.with_application(two, t).collect()}
    assert got == {"PC,1": 1, "PC,2": 14}


def test_two_codes_for_one_description_take_the_smallest(spark):
    t = pc_tables(spark, 7)
    t["er_dm_hyp_pc_xref"] = table(spark, "er_dm_hyp_pc_xref", *[{"er_hyperion_pc_dsc": PC, "er_profit_center_code": c} for c in ("P2", "P1")])
    assert cm.with_application(contracts(spark, ("CO_1_2", "1")), t).first()["app_id"] == 7
    assert [tuple(r) for r in cm.profit_center_conflicts(t).collect()] == [(PC, "P1", "P2")]


@pytest.mark.parametrize("text", ["CO_1_NA", "CL_1_2", "Client_1", "Unallocated x", "New_Client 1", "Not_Available", None])
def test_texts_that_name_no_contract(spark, text):
    assert cm.candidates(contracts(spark, (text, "1"))).count() == 0


# --- application 1 ---


def test_app1_widens_a_17_character_reference(spark):
    assert resolve(spark, (1,), ("CO_x", "00000103-01-02-03"), ref(5, "00000103-001-02-03")) == 5


def test_app1_rebuilds_a_short_reference(spark):
    assert resolve(spark, (1,), ("CO_x", "00000109-12-3"), ref(5, "00000109-012-03-00")) == 5
    assert resolve(spark, (1,), ("CO_x", "00000109-123-45"), ref(5, "00000109-123-45-00")) == 5


def test_app1_takes_the_section_digit_of_the_text(spark):
    text = ("CO_00000103YY-01-02-03-1_103", "00000103-01-02-03")
    assert resolve(spark, (1,), text, ref(5, "00000103-001-02-03"), ref(6, "00000103-001-01-03")) == 6


def test_app1_newest_underwriting_year_then_largest_id(spark):
    dim = [ref(9, "R", uwy=2019), ref(7, "R", uwy=2021), ref(8, "R", uwy=2021)]
    assert resolve(spark, (1,), ("CO_x", "R"), *dim) == 8


def test_app1_year_is_looked_up_untrimmed_and_rows_trimmed(spark):
    assert resolve(spark, (1,), ("CO_x", "R"), ref(7, "R ", uwy=2021), ref(8, "R", uwy=2020)) == 8
    assert resolve(spark, (1,), ("CO_x", "R"), ref(9, "R ", uwy=2020), ref(8, "R", uwy=2020)) == 9
    assert resolve(spark, (1,), ("CO_x", "R"), ref(9, "R ", uwy=2020)) == -1


# --- application 10 ---


def test_app10_latest_year_and_smallest_suffix(spark):
    dim = [ref(1, "000112001", date(2019, 1, 1)), ref(2, "000112002", date(2020, 5, 1)), ref(3, "000112003", date(2020, 1, 1)), ref(4, "000112000", None)]
    assert resolve(spark, (10,), ("CO_000112YY01_15", "000112"), *dim) == 2
    assert resolve(spark, (10,), ("CO_000112YY01_15", "000112"), *dim, ref(5, "000112002", date(2020, 7, 1))) == -2


def test_app10_row_without_suffix_is_found_only_beside_none(spark):
    text = ("CO_000112YY01_15", "000112")
    assert resolve(spark, (10,), text, ref(1, "000112"), ref(2, "000112002")) == 2
    assert resolve(spark, (10,), text, ref(1, "000112")) == -1


def test_app10_suffix(spark):
    text = ("CO_000104", "000104")  # no YY, last underscore at 3: suffix 00 and the second character
    assert resolve(spark, (10,), text, ref(1, "00010400O"), ref(2, "000104")) == 1
    dated = [ref(1, "00010400O", date(2020, 1, 1)), ref(2, "00010400O", date(2021, 1, 1))]
    assert resolve(spark, (10,), text, *dated) == 2
    assert resolve(spark, (10,), text, *dated, ref(0, "00010400O", None)) == 0


@pytest.mark.parametrize(
    "text, near",
    [
        ("CO_12345YY_9", True),
        ("CO_12YY345678_9", True),
        ("CO_1YY3456789_9", False),
        ("CO_YY", True),  # starts before the text count from its end
        ("CO_xxxxxYY", True),
        ("abcdeYYxyz", True),
        ("YYabcdefgh", False),
        ("YY_abcdefghij", True),
    ],
)
def test_year_mark_near_the_last_underscore(spark, text, near):
    df = cm.with_positions(contracts(spark, (text, "1")))
    assert df.select(cm.year_mark_near_end().alias("v")).first()["v"] is near


# --- applications 13, 14 and others ---


@pytest.mark.parametrize(
    "text, want",
    [
        ("CO_000105-MX_96_1", "000105-MX-PER"),
        ("CO_000105-MX_82_1", "000105-MXCHL"),
        ("CO_000105-MX_97_1", "000105-MX"),
        ("CO_000105-MX_50_1", "000105-MX-"),
        ("CO_000105-MX_ZZ_1", None),
    ],
)
def test_app13_reference(spark, text, want):
    rows = cm.with_positions(contracts(spark, (text, text[3:-2])))
    assert rows.select(cm.office_reference().alias("v")).first()["v"] == want


def test_app13_counts_dated_rows(spark):
    text = ("CO_000105-MX_96_1", "000105-MX_96")
    assert resolve(spark, (13,), text, ref(1, "000105-MX-PER")) == 1
    both = [ref(1, "000105-MX-PER", date(2019, 1, 1)), ref(2, "000105-MX-PER", date(2020, 1, 1))]
    assert resolve(spark, (13,), text, *both) == -2
    assert resolve(spark, (13,), text, *both, latest_year_only=True) == 2
    assert resolve(spark, (13,), text, ref(1, "000105-MX-PER", None)) == -1


def test_app14_latest_year_of_the_budget_reference(spark):
    dim = [ref(9, "a", date(2019, 1, 1), budget_ref="B"), ref(3, "b", date(2020, 1, 1), budget_ref="B"), ref(4, "c", date(2020, 9, 1), budget_ref="B"), ref(8, "d", None, budget_ref="B")]
    assert resolve(spark, (14,), ("CO_x", "B"), *dim) == 4


def test_other_applications_match_the_reference(spark):
    assert resolve(spark, (22,), ("CO_x", "R"), ref(1, "R"), ref(2, "R ")) == 1
    assert resolve(spark, (22,), ("CO_x", "R"), ref(1, "R"), ref(2, "R")) == -2


# --- fallback ---


def test_fallback_on_section_then_on_budget_reference(spark):
    text = ("CO_x", "00000109-12-3")
    sectioned = ref(1, "z", uwy=2019, budget_ref="00000109-012 ", section_number="3")
    assert resolve(spark, (22,), text, sectioned) == 1
    assert resolve(spark, (22,), text, sectioned, ref(2, "z", uwy=2020, budget_ref="00000109-012", section_number="03")) == 1
    assert resolve(spark, (22,), text, ref(4, "z", uwy=2018, budget_ref="00000109-12-3"), ref(3, "z", uwy=2019, budget_ref="00000109-12-3 ")) == 3


def test_fallback_without_hyphen_uses_the_effective_year(spark):
    assert resolve(spark, (22,), ("CO_x", "B"), ref(1, "z", date(2021, 1, 1), budget_ref="B"), ref(2, "z", date(2020, 1, 1), budget_ref="B")) == 1


def test_ambiguous_match_gets_no_fallback_and_nothing_found_is_minus_one(spark):
    assert resolve(spark, (22,), ("CO_x", "R"), ref(1, "R"), ref(2, "R"), ref(3, "z", budget_ref="R")) == -2
    assert resolve(spark, (22,), ("CO_x", None), ref(1, "R")) == -1
